"""Named queries: every operator over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import calendar, columns as C
from riskweave.functions.hashing import draw
from riskweave.operators import (
    cascade, explain, fairness, graph, integrate, labels, learn, lsh, macro, neighbours, privacy, ranking,
    sketches, stats,
)
from riskweave.plans import tables as T
from riskweave.session import materialize, scratch_path
from riskweave.sources import readers, writers
from riskweave.streaming import stateful, unified, upsert

KIND = "md5"  # the hash family any SQL engine can repeat
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# -- integration ------------------------------------------------------------------------

@query
def unified_nodes(spark, sf):
    return T.nodes(spark, sf)


@query
def unified_edges(spark, sf):
    return T.edges(spark, sf)


@query
def entity_mapping(spark, sf):
    return T.mapping(spark, sf)


@query
def bridge_edges(spark, sf):
    return integrate.bridge_edges(T.mapping(spark, sf))


@query
def ticker_sets(spark, sf):
    return integrate.ticker_sets(T.nodes(spark, sf))


@query
def network_statistics(spark, sf):
    return stats.network_statistics(T.nodes(spark, sf), T.edges(spark, sf))


@query
def type_counts(spark, sf):
    return stats.type_counts(T.nodes(spark, sf), T.edges(spark, sf))


@query
def bridge_stats(spark, sf):
    return stats.bridge_stats(T.edges(spark, sf), T.mapping(spark, sf))


@query
def layer_connectivity(spark, sf):
    return stats.layer_connectivity(T.edges(spark, sf))


@query
def path_count(spark, sf):
    return stats.path_count(T.mapping(spark, sf), T.edges(spark, sf))


@query
def validation_report(spark, sf):
    nodes, edges = T.graph(spark, sf, ("relationship_type", "network_layer"))
    return stats.validation_report(materialize(integrate.entity_mapping(nodes), "mapping"), nodes, edges)


@query
def dataset_summary(spark, sf):
    return stats.dataset_summary({name: T.read(spark, sf, name) for name in T.TABLES})


@query
def distinct_keys(spark, sf):
    return stats.distinct_keys(T.edges(spark, sf), ["network_layer", "relationship_type"])


@query
def import_nodes(spark, sf):
    return integrate.to_import_nodes(T.nodes(spark, sf))


@query
def import_edges(spark, sf):
    return integrate.to_import_edges(T.edges(spark, sf))


@query
def cik_to_ticker(spark, sf):
    listed = F.concat(F.lit("T"), F.col("p_partkey").cast("string"))
    companies = T.read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("cik"),
        F.when(F.col("p_size") > 25, listed).alias("ticker"))
    return integrate.cik_to_ticker(T.holdings(spark, sf), companies)


@query
def sec_union(spark, sf):
    companies = T.read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("cik"), F.col("p_name").alias("title"))
    insider = T.read(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("company_cik"),
        F.col("o_totalprice").alias("price_per_share"))
    return integrate.sec_union(
        companies, T.holdings(spark, sf).drop("seq"), insider, T.ownership(spark, sf).drop("seq"))


# -- scalar helpers ---------------------------------------------------------------------

@query
def sanitize_rel_type(spark, sf):
    return T.read(spark, sf, "orders").groupBy(
        "o_orderpriority", C.sanitize_rel_type("o_orderpriority").alias("rel_type")
    ).agg(F.count("*").alias("n"))


@query
def safe_casts(spark, sf):
    text = F.col("o_orderdate").cast("string")
    return T.read(spark, sf, "orders").select(
        "o_orderkey", C.safe_date(F.substring(text, 1, 10)).cast("string").alias("order_date"),
        C.safe_date("o_orderpriority").cast("string").alias("bad_date"),
        C.safe_int(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        C.safe_int(F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0"))).alias("priority_from_float"),
        C.safe_cast("o_orderpriority", "double", 0.0).alias("bad_number"),
        C.safe_ts("o_orderpriority").cast("string").alias("bad_ts"))


@query
def zfill10(spark, sf):
    return T.read(spark, sf, "customer").select(
        "c_custkey", C.zfill10(F.col("c_custkey").cast("string")).alias("padded"),
        C.zfill10("c_name").alias("kept"))


@query
def company_columns(spark, sf):
    return C.company_columns(T.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("CIK_STR"), F.col("c_mktsegment").alias("Ticker"),
        F.col("c_name").alias("company_title")))


@query
def sic_financial(spark, sf):
    return C.sic_financial(T.read(spark, sf, "part").select(
        "p_partkey", (F.lit(6000) + F.col("p_size") * 20).cast("string").alias("sic_code")))


@query
def blank_to_null(spark, sf):
    """Properties of every order that are not empty, as a count and as cleaned text."""
    df = T.read(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.regexp_replace("o_orderpriority", "^[0-9]-(LOW|HIGH)$", "").alias("priority"))
    return df.select(
        "o_orderkey", C.blank_to_null("priority").alias("priority"),
        F.size(C.properties_map(df, ["status", "priority"])).alias("n_properties"))


@query
def prefixed_keys(spark, sf):
    return T.read(spark, sf, "customer").select(
        C.prefixed_key("INST", "c_custkey").alias("node_id"),
        C.fdic_key(F.col("c_nationkey").cast("double").cast("string")).alias("fdic_id"))


@query
def min_max(spark, sf):
    df = T.read(spark, sf, "customer").select("c_custkey", "c_acctbal", F.lit(1.0).alias("constant"))
    return _round(C.min_max(df, ["c_acctbal", "constant"]), 10, "norm_c_acctbal")


@query
def nan_inf_to_zero(spark, sf):
    ratio = F.try_divide(F.col("l_extendedprice"), F.col("l_discount"))
    df = T.read(spark, sf, "lineitem").select(
        "l_returnflag", F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(ratio).alias("ratio"))
    clean = C.nan_inf_to_zero(df, ["ratio"])
    return clean.groupBy("l_returnflag").agg(
        F.count_if(F.col("ratio") == 0).alias("zeros"), F.max("ratio").alias("largest"))


@query
def fill_zero_all(spark, sf):
    return C.fill_zero_all(T.nodes(spark, sf))


@query
def quarter_ends(spark, sf):
    spans = T.read(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return calendar.quarter_ends(spans).select("o_custkey", F.col("quarter_end").cast("string").alias("quarter_end"))


@query
def flatten_records(spark, sf):
    records = T.read(spark, sf, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint").alias("data"))
    return readers.flatten_records(records)


@query
def parse_records(spark, sf):
    """Records from text that holds an object or an array of objects."""
    texts = T.read(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "view", F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")))
        .otherwise(F.col("props")).alias("body"))
    return readers.parse_records(texts, "body", readers.schemas.schema("k bigint"))


@query
def high_risk_flag(spark, sf):
    return T.transactions(spark, sf).select("seq", C.high_risk_flag("weight").alias("is_high_risk"))


@query
def risk_level(spark, sf):
    return T.predictions(spark, sf).select(
        "node_id", C.risk_level("cascade_probability").alias("risk_level"))


# -- graph measures ---------------------------------------------------------------------

ENDS = ("source_id", "target_id")


@query
def node_universe(spark, sf):
    return graph.node_universe(T.nodes(spark, sf), T.edges(spark, sf, *ENDS))


@query
def degree(spark, sf):
    return graph.degree(T.nodes(spark, sf), T.edges(spark, sf, *ENDS))


@query
def exposure_sum(spark, sf):
    return graph.exposure(T.nodes(spark, sf), T.edges(spark, sf, *ENDS, "weight"))


@query
def exposure_last(spark, sf):
    return graph.exposure(T.nodes(spark, sf), T.transactions(spark, sf), "last", "seq")


@query
def neighbour_sets(spark, sf):
    return graph.neighbour_sets(T.edges(spark, sf, *ENDS))


@query
def clustering(spark, sf):
    return _round(graph.clustering(*T.graph(spark, sf, ENDS)), 10, "clustering_coefficient")


@query
def pagerank(spark, sf):
    return _round(graph.pagerank(*T.graph(spark, sf, ENDS)), 12, "pagerank_score")


@query
def bfs_tree(spark, sf):
    nodes, edges = T.graph(spark, sf, ENDS)
    return graph.bfs_tree(nodes, edges, graph.seeded_sources(graph.node_universe(nodes, edges)))


@query
def betweenness_sampled(spark, sf):
    return _round(graph.betweenness_sampled(*T.graph(spark, sf, ENDS)), 12, "betweenness_centrality")


FEATURE_COLUMNS = ["node_id", "node_type", "tier", "total_assets", "equity", *graph.METRICS]


@query
def node_features(spark, sf):
    nodes, edges = T.nodes(spark, sf), T.edges(spark, sf, *ENDS, "weight")
    return _round(
        graph.node_features(nodes, edges).select(*FEATURE_COLUMNS), 10,
        "pagerank_score", "betweenness_centrality", "clustering_coefficient")


# The feature table and the model serve many queries and are built once per data folder.
_BUILT: dict[tuple, object] = {}


def _once(spark, sf, name, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def _graph(spark, sf):
    """Nodes and weighted edges, written once for the features and what else reads the edges."""
    return _once(spark, sf, "graph", lambda: T.graph(spark, sf, (*ENDS, "weight")))


def _features(spark, sf):
    return _once(spark, sf, "features", lambda: graph.node_features(*_graph(spark, sf), written=True))


def _labelled(spark, sf):
    return _once(spark, sf, "labelled", lambda: materialize(
        learn.stratified_split(labels.cascade_labels(_features(spark, sf), kind=KIND), kind=KIND), "labelled"))


def _model(spark, sf):
    return _once(spark, sf, "model", lambda: learn.train_model(_labelled(spark, sf).where("split = 'train'")))


def _scored(spark, sf):
    return _once(spark, sf, "scored", lambda: materialize(
        learn.score(_model(spark, sf), _features(spark, sf)), "scored"))


@query
def risk_score(spark, sf):
    return _round(labels.risk_score(_features(spark, sf)).select("node_id", "risk_score"), 9, "risk_score")


@query
def cascade_shock(spark, sf):
    return labels.cascade_shock(_features(spark, sf)).select("node_id", "initial_shock")


@query
def cascade_labels(spark, sf):
    return labels.cascade_labels(_features(spark, sf), kind=KIND).select("node_id", "cascade_occurred")


@query
def neighbour_contagion(spark, sf):
    return labels.cascade_labels(
        _features(spark, sf), edges=_graph(spark, sf)[1], neighbour_contagion=True, kind=KIND
    ).select("node_id", "cascade_occurred")


@query
def unlearn_score(spark, sf):
    scored = labels.unlearn_labels(_features(spark, sf))
    return _round(scored.select("node_id", "unlearn_score", "cascade_occurred"), 9, "unlearn_score")


# -- sketches ---------------------------------------------------------------------------

@query
def bloom_bits(spark, sf):
    return sketches.bloom_build(T.edges(spark, sf), sketches.edge_key(), kind=KIND)


@query
def bloom_pack(spark, sf):
    packed = sketches.bloom_pack(sketches.bloom_build(T.edges(spark, sf), sketches.edge_key(), m=200_000, kind=KIND))
    return packed.select("bucket", F.bitmap_count("bitmap").alias("bits_set"))


@query
def bloom_contains(spark, sf):
    """Every ownership key asked of a filter that holds the loan keys."""
    edges = T.edges(spark, sf)
    held = edges.where("network_layer = 'banking'")
    bits = sketches.bloom_build(held, sketches.edge_key(), m=200_000, kind=KIND)
    return sketches.bloom_contains(edges, sketches.edge_key(), bits, m=200_000, kind=KIND)


@query
def bloom_parts(spark, sf):
    """Set bits in each part of a filter sized by the number of keys."""
    filled, _, _ = sketches.counted_filter(T.edges(spark, sf, *ENDS), sketches.edge_key(), 1 / 128, kind=KIND)
    return sketches.part_fill(filled)


@query
def bloom_parts_contains(spark, sf):
    """Every edge key asked of a filter sized by the loan keys it holds."""
    edges = materialize(T.edges(spark, sf), "edges")
    filled, parts, k = sketches.counted_filter(edges.where("network_layer = 'banking'"), sketches.edge_key(), 1 / 128, kind=KIND)
    return sketches.part_contains(edges, sketches.edge_key(), filled, parts, k, kind=KIND)


@query
def bloom_stats(spark, sf):
    return _round(sketches.bloom_stats(T.transactions(spark, sf), sketches.edge_key(), kind=KIND),
                  9, "fill_rate", "estimated_fpr")


@query
def bloom_dedupe(spark, sf):
    return sketches.bloom_dedupe(T.transactions(spark, sf), sketches.edge_key(), "seq").select("seq", "is_duplicate")


@query
def trailing_ones(spark, sf):
    return sketches.trailing_ones(T.transactions(spark, sf), C.high_risk_flag("weight"), "seq")


@query
def trailing_ones_by_lender(spark, sf):
    return sketches.trailing_ones(
        T.transactions(spark, sf), C.high_risk_flag("weight"), "seq", window=20, by=["source_id"])


@query
def dgim(spark, sf):
    return sketches.dgim(T.transactions(spark, sf), C.high_risk_flag("weight"), "seq")


@query
def dgim_stats(spark, sf):
    return sketches.dgim_stats(sketches.dgim(T.transactions(spark, sf), C.high_risk_flag("weight"), "seq"))


def _fm(df, col, **kw):
    out = sketches.fm_distinct(df, col, kind=KIND, **kw)
    return out.withColumn(
        "max_trailing_zeros", F.array_join(F.col("max_trailing_zeros").cast("array<string>"), ","))


@query
def fm_distinct(spark, sf):
    edges = T.edges(spark, sf)
    return _fm(edges, "source_id").withColumn("side", F.lit("source")).unionByName(
        _fm(edges, "target_id").withColumn("side", F.lit("target")))


@query
def fm_distinct_by_layer(spark, sf):
    return _fm(T.edges(spark, sf), "target_id", by=["network_layer"])


@query
def reservoir(spark, sf):
    return sketches.reservoir(T.transactions(spark, sf), ["seq"])


@query
def reservoir_stats(spark, sf):
    return sketches.reservoir_stats(T.transactions(spark, sf))


@query
def stream_summary(spark, sf):
    return sketches.stream_summary(T.transactions(spark, sf), sketches.edge_key())


@query
def edge_stream_report(spark, sf):
    """The numbers of the report, a column each."""
    report = sketches.edge_stream_report(materialize(T.transactions(spark, sf), "stream"), "seq", kind=KIND)
    return report.select(
        "bloom_filter.items_added", "bloom_filter.bits_set", "dgim.current_time", "dgim.num_buckets", "dgim.estimated_count",
        F.col("flajolet_martin_src.estimated_cardinality").alias("distinct_sources"),
        F.col("flajolet_martin_dst.estimated_cardinality").alias("distinct_targets"),
        "reservoir.current_sample_size", "summary.edges_processed", "summary.duplicates_detected", "summary.high_risk_edges")


# -- similarity -------------------------------------------------------------------------

def _signatures(spark, sf):
    return lsh.minhash_signature(graph.neighbour_sets(T.edges(spark, sf, *ENDS)), kind=KIND)


@query
def minhash_signature(spark, sf):
    return _signatures(spark, sf).select(
        "entity", F.array_join(F.col("signature").cast("array<string>"), "_").alias("signature"))


@query
def lsh_bands(spark, sf):
    return lsh.lsh_bands(_signatures(spark, sf))


@query
def lsh_stats(spark, sf):
    return _round(lsh.lsh_stats(lsh.lsh_bands(_signatures(spark, sf))), 9, "avg_bucket_size")


@query
def signature_groups(spark, sf):
    return lsh.signature_groups(_signatures(spark, sf)).drop("signature")


@query
def similar_pairs(spark, sf):
    return lsh.similar_pairs(_signatures(spark, sf), 0.5)


@query
def lsh_candidates(spark, sf):
    return lsh.lsh_candidates(_signatures(spark, sf))


@query
def similar_to(spark, sf):
    """Entities similar to each bank."""
    sigs = materialize(_signatures(spark, sf), "signatures")
    banks = T.nodes(spark, sf).where("node_type = 'bank'").select(F.col("node_id").alias("entity"))
    return lsh.similar_to(sigs, banks, 0.5)


@query
def similar_entities(spark, sf):
    return lsh.similar_entities(T.edges(spark, sf, *ENDS), 0.3, 15, kind=KIND)


# -- cascades and privacy ---------------------------------------------------------------

# Relationship types that a cascade follows; the subgraph holds every type.
CASCADE = (cascade.LISTED, cascade.OWNED)
# Edge columns of a cascade; one that only counts follows the ends alone.
FOLLOWED = (*ENDS, "relationship_type")


def _cascade_graph(spark, sf, *values):
    return T.graph(spark, sf, (*FOLLOWED, *values), CASCADE)


@query
def cascade_impact(spark, sf):
    return cascade.cascade_impact(*_cascade_graph(spark, sf, "weight"))


@query
def cascade_impact_all_hops(spark, sf):
    impact = cascade.cascade_impact(*_cascade_graph(spark, sf, "weight"), require_all_hops=True)
    return impact.groupBy("bank", "hop", "entity_type", "impact_type").agg(F.count("*").alias("n"))


@query
def cascade_summary(spark, sf):
    return cascade.systemic_score(cascade.cascade_summary(*_cascade_graph(spark, sf)))


@query
def systemic_ranking(spark, sf):
    """All banks, in the order of their supplier key."""
    asked = T.read(spark, sf, "supplier").select(
        (F.col("s_suppkey") * T.BANK_STEP).cast("string").alias("institution_id"),
        (F.col("s_suppkey") + 1).alias("position"))
    return cascade.systemic_ranking(*_cascade_graph(spark, sf), asked)


@query
def sector_breakdown(spark, sf):
    return cascade.sector_breakdown(*_cascade_graph(spark, sf), k=3)


@query
def cascade_subgraph(spark, sf):
    return cascade.cascade_subgraph(*T.graph(spark, sf, (*FOLLOWED, "weight")))


QUASI, NAMES = ["bank", "entity_type", "sector", "impact_type"], ["entity_id", "entity_name"]


def _impact(spark, sf):
    return cascade.cascade_impact(*_cascade_graph(spark, sf, "weight"))


@query
def k_anonymize(spark, sf):
    # read twice: for the sizes and for the rows
    return privacy.k_anonymize(materialize(_impact(spark, sf), "impact"), QUASI, NAMES, 3)


@query
def group_size(spark, sf):
    return privacy.with_group_size(T.read(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"]).select(
        "c_custkey", "group_size")


@query
def k_anon_summary(spark, sf):
    return privacy.k_anon_summary(_impact(spark, sf), ["hop", *QUASI], 3)


@query
def anonymization_report(spark, sf):
    return privacy.anonymization_report(_impact(spark, sf), QUASI, 3)


# -- audit ------------------------------------------------------------------------------

@query
def fairness_by_group(spark, sf):
    return _round(fairness.fairness_by_group(T.predictions(spark, sf), "node_type"),
                  9, "predicted_cascade_rate", "avg_probability")


@query
def disparate_impact(spark, sf):
    return _round(fairness.disparate_impact(T.predictions(spark, sf), "tier"), 9, "rate", "ratio")


@query
def fairness_report(spark, sf):
    return _round(fairness.fairness_report(T.predictions(spark, sf)), 9,
                  "predicted_cascade_rate", "avg_probability", "ratio")


@query
def classification_metrics(spark, sf):
    return _round(fairness.classification_metrics(T.predictions(spark, sf), "truth", "cascade_prediction"),
                  9, "precision", "recall", "f1_score")


@query
def class_balance(spark, sf):
    return fairness.class_balance(T.predictions(spark, sf), "truth")


@query
def high_risk_entities(spark, sf):
    return _round(ranking.high_risk_entities(T.predictions(spark, sf)).select(
        "node_id", "cascade_probability"), 9, "cascade_probability")


@query
def top_predictions(spark, sf):
    return _round(ranking.top_predictions(T.predictions(spark, sf), 5).select(
        "node_id", "cascade_probability"), 9, "cascade_probability")


# -- macro series and order statistics --------------------------------------------------

@query
def pivot_series(spark, sf):
    return _round(macro.pivot_series(T.hourly_series(spark, sf), T.SERIES), 9, *T.SERIES)


@query
def forward_fill(spark, sf):
    wide = macro.pivot_series(T.hourly_series(spark, sf), T.SERIES)
    return _round(macro.forward_fill(wide, T.SERIES, "date"), 9, *T.SERIES)


@query
def stress_index(spark, sf):
    return macro.stress_index(T.hourly_series(spark, sf), T.SERIES, T.RULES).select(
        "date", "stress_score", "high_stress_flag")


@query
def sector_correlation(spark, sf):
    sectors = T.read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"), F.col("p_type").alias("sector"))
    return _round(macro.sector_correlation(T.correlations(spark, sf), sectors), 9, "correlation")


@query
def largest(spark, sf):
    return ranking.largest(T.read(spark, sf, "customer"), 100, "c_acctbal", ["c_custkey"]).select(
        "c_custkey", "c_acctbal")


@query
def quantile(spark, sf):
    lines = T.read(spark, sf, "lineitem")
    ps = (0.5, 0.85, 0.9)
    rows = list(zip(ps, ranking.quantiles(lines, "l_extendedprice", ps)))
    return _round(spark.createDataFrame(rows, "p double, value double"), 6, "value")


@query
def values_at_ranks(spark, sf):
    """First, middle and last event value of every user, all users in one set of passes."""
    events = T.read(spark, sf, "events").where("value is not null").select("user_id", "value")
    sizes = events.groupBy("user_id").agg(F.count("*").alias("n"))
    wanted = sizes.select("user_id", F.explode(F.array_distinct(F.array(F.lit(0).cast("bigint"), F.call_function("div", F.col("n"), F.lit(2).cast("bigint")), F.col("n") - 1))).alias("k"))
    return ranking.values_at(events, ["user_id"], "value", wanted)


# -- models -----------------------------------------------------------------------------

@query
def stratified_split(spark, sf):
    return learn.stratified_split(
        T.read(spark, sf, "customer"), "c_mktsegment", 0.3, 42, ["c_custkey"], KIND
    ).select("c_custkey", "c_mktsegment", "split")


@query
def standard_scale(spark, sf):
    scaled = learn.standardized(T.read(spark, sf, "part"), ["p_retailprice", "p_size"])
    return _round(scaled.select("p_partkey", "z_p_retailprice", "z_p_size"), 7, "z_p_retailprice", "z_p_size")


@query
def class_weight(spark, sf):
    return _round(learn.class_weight(T.predictions(spark, sf), "truth").groupBy("truth").agg(
        F.max("class_weight").alias("class_weight"), F.count("*").alias("n")), 9, "class_weight")


@query
def training_matrix(spark, sf):
    ready = learn.training_matrix(_features(spark, sf)).select("node_id", *learn.FEATURES)
    return _round(ready, 10, "pagerank_score", "betweenness_centrality", "clustering_coefficient")


@query
def smote(spark, sf):
    train = learn.training_matrix(_labelled(spark, sf).where("split = 'train'"))
    balanced = learn.smote(learn.standard_scale(train).transform(train))
    return balanced.groupBy(learn.LABEL).agg(F.count("*").alias("n"))


@query
def nearest_neighbours(spark, sf):
    """Five nearest others of every distinct (price, size) of the parts."""
    points = T.read(spark, sf, "part").select(F.array(F.col("p_retailprice").cast("double"), F.col("p_size").cast("double")).alias("x"))
    near = neighbours.nearest_points(points, 5).select("x", F.posexplode("near").alias("place", "other"))
    return near.select(
        F.get("x", F.lit(0)).alias("price"), F.get("x", F.lit(1)).alias("size"), (F.col("place") + 1).cast("bigint").alias("rank"),
        F.get("other", F.lit(0)).alias("near_price"), F.get("other", F.lit(1)).alias("near_size"))


@query
def train_forest(spark, sf):
    model = _model(spark, sf)
    return learn.evaluate(model, _labelled(spark, sf).where("split = 'test'"))


@query
def cross_validate_f1(spark, sf):
    return learn.cross_validate_f1(_labelled(spark, sf).where("split = 'train'"))


@query
def score(spark, sf):
    return _scored(spark, sf).select("node_id", "cascade_prediction", "cascade_probability", "risk_level")


@query
def model_fairness(spark, sf):
    return fairness.fairness_report(_scored(spark, sf))


def _asked_to_forget(spark, sf):
    """Banks whose balance is negative ask to be forgotten."""
    return T.nodes(spark, sf).where("node_type = 'bank' and total_assets < 0").select("node_id")


@query
def forget(spark, sf):
    return learn.forget(T.nodes(spark, sf), _asked_to_forget(spark, sf)).select("node_id", "node_type")


@query
def verify_forgotten(spark, sf):
    ids = _asked_to_forget(spark, sf)
    return learn.verify_forgotten(learn.forget(T.nodes(spark, sf), ids), ids)


@query
def unlearn(spark, sf):
    ids = _asked_to_forget(spark, sf)
    model, kept = learn.unlearn(_features(spark, sf), ids)
    checked = learn.verify_forgotten(kept, ids)
    scored = learn.score(model, kept).agg(
        F.count("*").alias("remaining"), F.sum("cascade_prediction").alias("predicted_cascades"))
    return checked.withColumns({
        c: scored.select(c).scalar() for c in ("remaining", "predicted_cascades")})


def _attributions(spark, sf):
    return _once(spark, sf, "attributions", lambda: materialize(explain.attributions(
        _model(spark, sf), explain.attribution_sample(_features(spark, sf), 100), _features(spark, sf)), "attributions"))


@query
def attributions(spark, sf):
    return _attributions(spark, sf)


@query
def global_importance(spark, sf):
    return explain.global_importance(_attributions(spark, sf))


@query
def explain_top(spark, sf):
    sampled = explain.attribution_sample(_scored(spark, sf), 100)
    return explain.explain_top(sampled, _attributions(spark, sf))


@query
def save_and_load_model(spark, sf):
    folder = scratch_path(spark, "models")
    writers.save_model(_model(spark, sf), folder)
    loaded = writers.load_latest(spark, folder)
    return learn.score(loaded, _features(spark, sf)).groupBy("risk_level").agg(F.count("*").alias("n"))


# -- streams ----------------------------------------------------------------------------

def _events(spark, sf):
    return T.read(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")


def _replay(spark, df, seq, n_files=4):
    return readers.replay_stream(spark, df, scratch_path(spark, "replay"), n_files, seq)


def _finish(started):
    started.awaitTermination()


def _run(stream, spark, mode="append"):
    """Run a stream over the files now present and read its file sink."""
    out = scratch_path(spark, "sink")
    _finish(stream.writeStream.format("parquet").outputMode(mode).option(
        "checkpointLocation", scratch_path(spark, "stream")).trigger(availableNow=True).start(out))
    return spark.read.schema(stream.schema).parquet(out)


@query
def unified_stream(spark, sf):
    """Events of each type dropped as records of one layer, then read as one stream."""
    events = _events(spark, sf)
    value, key = F.col("value"), F.col("event_id").cast("string")
    day = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd")
    records = {
        "market": ("view", [key.alias("symbol"), day.alias("timestamp"), F.lit("price_tick").alias("stream_type"),
                            F.struct(key.alias("symbol"), value.alias("price")).alias("payload")]),
        "banking": ("click", [day.alias("date"), F.lit("rate").alias("indicator_name"), key.alias("series_id"), value.alias("value")]),
        "fdic": ("signup", [F.struct(key.alias("CERT"), F.concat(F.lit("Bank "), key).alias("NAME"), value.alias("ASSET")).alias("data")]),
        "fred": ("error", [day.alias("date"), key.alias("series_id"), value.alias("value")]),
        "sedc": ("purchase", [F.lit("13f").alias("record_type"), key.alias("filer_cik"), value.alias("value")]),
    }
    dirs = {}
    for layer, (kind, cols) in records.items():
        dirs[layer] = scratch_path(spark, f"drop-{layer}")
        writers.publish_json(events.where(F.col("event_type") == kind).select(*cols), dirs[layer], layer, kind)
    out = scratch_path(spark, "unified")
    _finish(unified.run_unified_stream(spark, dirs, out, scratch_path(spark, "stream")))
    return spark.read.parquet(out).select(
        "layer", "stream", "symbol", "series_id", "cert", "filer_cik",
        F.coalesce("price", "value", "asset").alias("amount"))


@query
def replay_stream(spark, sf):
    return _run(_replay(spark, _events(spark, sf), "event_id"), spark).select("event_id", "user_id", "event_type")


@query
def stream_dedupe(spark, sf):
    pairs = _replay(spark, _events(spark, sf), "event_id").select("user_id", "event_type")
    return _run(stateful.stream_dedupe(pairs, ["user_id", "event_type"]), spark)


@query
def stream_bloom_dedupe(spark, sf):
    """First sights of (user, type) by a filter of fixed size that hardly ever errs."""
    state, out = scratch_path(spark, "bloom-state"), scratch_path(spark, "first-sights")
    pairs = F.concat_ws("|", F.col("user_id").cast("string"), "event_type")
    _finish(stateful.run_stream_bloom(
        _replay(spark, _events(spark, sf), "event_id"), pairs, "event_id", state, out, scratch_path(spark, "stream"), 1_000_000, 1e-9, kind=KIND))
    return stateful.first_sights(spark, out).select("event_id", "user_id", "event_type")


def _last_update(stream, spark):
    """Run a one-row stream in update mode and read its last row."""
    out = scratch_path(spark, "updates")

    def write(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    _finish(stream.writeStream.outputMode("update").option(
        "checkpointLocation", scratch_path(spark, "stream")).foreachBatch(write).trigger(availableNow=True).start())
    return spark.read.parquet(out).orderBy(F.desc("batch")).limit(1).drop("batch", "b")


@query
def stream_distinct(spark, sf):
    stream = stateful.stream_distinct(_replay(spark, _events(spark, sf), "event_id"), "user_id", kind=KIND)
    return _last_update(stream, spark).select(
        F.array_join(F.col("max_trailing_zeros").cast("array<string>"), ",").alias("max_trailing_zeros"),
        "estimated_cardinality")


@query
def stream_dgim(spark, sf):
    """Large event values of each user among the user's last 20 events."""
    state = scratch_path(spark, "dgim-state")
    _finish(stateful.run_stream_dgim(
        _replay(spark, _events(spark, sf), "event_id"), F.col("value") > 50, "event_id", ["user_id"],
        state, scratch_path(spark, "stream"), window=20))
    buckets = stateful.stream_dgim_state(spark, state, ["user_id"]).where("ones is not null")
    return sketches.dgim_stats(buckets, 20, ["user_id"])


@query
def stream_reservoir(spark, sf):
    state = scratch_path(spark, "reservoir")
    _finish(stateful.run_stream_reservoir(
        _replay(spark, _events(spark, sf), "event_id"), ["event_id"], state, scratch_path(spark, "stream")))
    return spark.read.parquet(stateful.latest_version(spark, state)).select("event_id", "user_id")


@query
def graph_upsert_nodes(spark, sf):
    """Users as nodes: every event sets the type, only large ones set the value."""
    stream = _replay(spark, _events(spark, sf), "event_id").select(
        C.prefixed_key("USER", "user_id").alias("node_id"), "event_id",
        F.col("event_type").alias("last_type"), F.when(F.col("value") > 100, F.col("value")).alias("last_large"))
    state = scratch_path(spark, "nodes-state")
    _finish(upsert.run_node_upsert(stream, state, scratch_path(spark, "stream"), "event_id"))
    return upsert.state_values(upsert.read_state(spark, state, upsert.NODE_KEY), upsert.NODE_KEY)


@query
def graph_upsert_edges(spark, sf):
    """Loans upserted by lender, borrower and cleaned type; the ends become nodes."""
    stream = _replay(spark, T.transactions(spark, sf), "seq")
    edges, ends = scratch_path(spark, "edges-state"), scratch_path(spark, "ends-state")
    _finish(upsert.run_edge_upsert(stream, edges, ends, scratch_path(spark, "stream"), "seq"))
    out = upsert.state_values(upsert.read_state(spark, edges, upsert.EDGE_KEY), upsert.EDGE_KEY)
    known = upsert.read_state(spark, ends, upsert.NODE_KEY)
    return out.join(known.select(F.col("node_id").alias("target_id")), "target_id", "left_semi").select(
        *upsert.EDGE_KEY, "weight")


@query
def graph_upsert_files(spark, sf):
    """The import files of the graph followed into node and edge state."""
    folder, state = scratch_path(spark, "files"), scratch_path(spark, "graph-state")
    nodes, edges = T.nodes(spark, sf), T.edges(spark, sf)
    writers.write_graph(integrate.to_import_nodes(nodes), f"{folder}/nodes", compression="gzip")
    writers.write_graph(integrate.to_import_edges(edges), f"{folder}/edges", compression="gzip")
    for started in upsert.run_graph_upsert(spark, folder, state, scratch_path(spark, "stream")):
        _finish(started)
    return upsert.graph_nodes(spark, f"{state}/nodes", f"{state}/ends")


@query
def first_rows_of_files(spark, sf):
    """Orders as a stock table in files by date: each customer's first row stays, by its place alone."""
    path = scratch_path(spark, "first-rows")
    orders = T.read(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey").select(
        F.col("o_custkey").alias("symbol"), F.col("o_orderkey").cast("string").alias("company_name"), F.col("o_totalprice").alias("market_cap"))
    writers.write_graph(orders, path)
    table = readers.read_table(spark, path, readers.schemas.DATASETS["company_fundamentals"], position="seq")
    return integrate.unified_nodes(fundamentals=table).select("ticker", "name", "market_cap")


@query
def last_rows_of_files(spark, sf):
    """Events as node files, a user's rows in one file: the last row wins, missing values come from earlier ones."""
    folder, state = scratch_path(spark, "node-files"), scratch_path(spark, "last-rows")
    events = _events(spark, sf).select(
        C.prefixed_key("USER", "user_id").alias("node_id"), F.col("event_type").alias("node_type"),
        F.when(F.col("value") > 100, F.col("value")).alias("total_assets"), "event_id")
    placed = events.repartition("node_id").sortWithinPartitions("event_id")
    writers.write_graph(integrate.to_import_nodes(integrate.conform(placed, readers.schemas.NODES)), folder)
    stream = readers.graph_stream(spark, folder, readers.schemas.NODES, arrival="arrived")
    _finish(upsert.run_node_upsert(stream, state, scratch_path(spark, "stream"), "arrived"))
    return upsert.state_values(upsert.read_state(spark, state, upsert.NODE_KEY), upsert.NODE_KEY).select("node_id", "node_type", "total_assets")


@query
def graph_round_trip(spark, sf):
    """Edges written as import CSV, packed, and read back typed."""
    path = scratch_path(spark, "import")
    writers.write_graph(integrate.to_import_edges(T.edges(spark, sf)), path, compression="gzip")
    return readers.read_graph_csv(spark, path, readers.schemas.EDGES)


@query
def uniform_draws(spark, sf):
    """Seeded draw per customer; the source of every random choice."""
    return T.read(spark, sf, "customer").select(
        "c_custkey", F.round(draw(7, F.col("c_custkey"), kind=KIND), 9).alias("draw"))
