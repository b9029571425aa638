"""Rule-based risk scores and cascade labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import bounds, scaled
from riskweave.functions.hashing import draw, pair56
from riskweave.operators.ranking import quantile, smallest_k
from riskweave.session import materialize

# Shock percentile, contagion probability, number of waves, wave factor,
# share of idiosyncratic shocks, percentile of the unlearning label.
SHOCK_PERCENTILE, CONTAGION_RATE, WAVES, WAVE_FACTOR = 0.85, 0.35, 2, 0.5
RANDOM_SHARE, UNLEARN_PERCENTILE = 0.10, 0.90


def risk_score(features: DataFrame) -> DataFrame:
    """Add ``risk_score``: leverage 40 %, systemic weight 30 %, contagion 30 %.

    Minima and maxima come from one aggregate over the table, so pass a written table.
    """
    ready = features.withColumns({
        "_leverage": F.coalesce(F.try_divide("total_exposure", F.col("equity") + 1), F.lit(0.0)),
        "_flow": F.col("incoming_exposure") + F.col("outgoing_exposure"),
    })
    used = ["_leverage", "pagerank_score", "betweenness_centrality", "total_degree",
            "clustering_coefficient", "_flow"]
    limits = bounds(ready, used)
    leverage, rank, between, degree, clustering, flow = (scaled(c, limits) for c in used)
    systemic = 0.4 * rank + 0.3 * between + 0.3 * degree
    contagion = 0.6 * (1 - clustering) + 0.4 * flow
    return ready.withColumn(
        "risk_score", 0.40 * leverage + 0.30 * systemic + 0.30 * contagion).drop("_leverage", "_flow")


def unlearn_risk_score(features: DataFrame) -> DataFrame:
    """Add ``unlearn_score``: weighted min-max of four measures."""
    weights = {"pagerank_score": 0.3, "total_degree": 0.2, "betweenness_centrality": 0.3,
               "total_exposure": 0.2}
    limits = bounds(features, list(weights))
    total = None
    for name, weight in weights.items():
        term = scaled(name, limits) * weight
        total = term if total is None else total + term
    return features.withColumn("unlearn_score", total)


def unlearn_labels(features: DataFrame) -> DataFrame:
    """Label of the unlearning job: score strictly above its 90th percentile."""
    scored = materialize(unlearn_risk_score(features), "scored")
    cut = quantile(scored, "unlearn_score", UNLEARN_PERCENTILE)
    return scored.withColumn(
        "cascade_occurred", F.when(F.col("unlearn_score") > F.lit(cut), 1).otherwise(0))


def cascade_shock(features: DataFrame, strict: bool = False) -> DataFrame:
    """Risk score and the initial shock: score at or above its 85th percentile.

    Many tied scores at the cut make many shocks; ``strict`` asks for more than the cut.
    """
    scored = materialize(risk_score(features), "scored")
    cut = F.lit(quantile(scored, "risk_score", SHOCK_PERCENTILE))
    hit = F.col("risk_score") > cut if strict else F.col("risk_score") >= cut
    return scored.withColumn("initial_shock", F.when(hit, 1).otherwise(0))


def cascade_labels(
    features: DataFrame, seed: int = 42, edges: DataFrame | None = None,
    neighbour_contagion: bool = False, strict: bool = False, kind: str = "xx",
) -> DataFrame:
    """Add ``cascade_occurred``: shocks, two contagion waves, then 10 % of the rest.

    Every draw is a hash of seed, phase and node id, so labels do not depend on the
    partitioning. By default a wave asks only for incoming exposure; with
    ``neighbour_contagion`` it asks for an edge from a node that has already fallen.
    """
    shocked = cascade_shock(features, strict)
    out = shocked.withColumn("cascade_occurred", F.col("initial_shock"))
    for wave in range(WAVES):
        exposed: Column = F.col("incoming_exposure") > 0
        if neighbour_contagion:
            out = materialize(out, "wave")
            fallen = out.where("cascade_occurred = 1").select(F.col("node_id").alias("source_id"))
            hit = edges.join(fallen, "source_id", "left_semi").select(
                F.col("target_id").alias("node_id"), F.lit(True).alias("_hit")).distinct()
            out = out.join(hit, "node_id", "left")
            exposed = F.coalesce("_hit", F.lit(False))
        chance = F.col("risk_score") * CONTAGION_RATE * (wave + 1) * WAVE_FACTOR
        falls = exposed & (draw(f"{seed}:wave{wave}", F.col("node_id"), kind=kind) < chance)
        out = out.withColumn(
            "cascade_occurred", F.when((F.col("cascade_occurred") == 0) & falls, 1)
            .otherwise(F.col("cascade_occurred"))).drop("_hit")
    out = materialize(out, "waves")
    hashed = pair56(F.concat(F.lit(f"{seed}:random|"), F.col("node_id")), kind)[0]
    safe = materialize(out.where("cascade_occurred = 0").select("node_id", hashed.alias("h")), "safe")
    n_random = int(safe.count() * RANDOM_SHARE)
    random_hits = smallest_k(safe, "h", ["node_id"], n_random).select("node_id", F.lit(1).alias("_random"))
    return out.join(random_hits, "node_id", "left").withColumn(
        "cascade_occurred", F.when(F.col("_random") == 1, 1).otherwise(F.col("cascade_occurred"))
    ).drop("_random")
