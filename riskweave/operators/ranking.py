"""Order statistics and exact top or bottom rows without a global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import materialize

# Intervals that a pass cuts the open range of each rank into.
CUTS = 4_096
# Open ranges that are sent to every task; more of them meet the rows by group.
SENT = 10_000


def _cut(v: Column, low: Column, high: Column, whole: bool) -> Column:
    """Interval of a value in ``[low, high]``, never falling in the value; the ends are alone."""
    halves = F.try_divide(v / 2 - low / 2, high / 2 - low / 2)  # no overflow
    # whole numbers far from zero keep their differences only as whole numbers
    share = F.coalesce(F.try_subtract(v, low).cast("double") / F.try_subtract(high, low).cast("double"), halves) if whole else halves
    middle = F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0))
    place = F.least(F.lit(CUTS - 1), F.greatest(F.lit(0), F.floor(middle * CUTS))).cast("int")
    return F.when(v == low, -1).when(v == high, CUTS).otherwise(place)


def values_at(df: DataFrame, by: Sequence[str], col: str, wanted: DataFrame) -> DataFrame:
    """``by, k, value``: exact values at 0-based ranks ``k`` of each group; ``wanted`` lists ``by, k``.

    ``col`` is numeric without nulls and NaN. Radix refinement for all ranks of all groups at once: a
    pass counts the rows of each open range by interval, and every rank goes on in the interval
    that holds it, between the least and the greatest value found there. A pass leaves at most one
    interval in ``CUTS`` open, so their number follows from the spread of the values, not from the
    number of ranks or groups. Ranks outside a group are left out.
    """
    by = list(by)
    whole = not isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
    rows = df.select(*by, F.col(col).alias("_v"))
    group = [F.col(c) for c in by]

    def same(left: DataFrame, right: DataFrame) -> Column:
        return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in by], F.lit(True))

    ends = rows.groupBy(*by).agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count("*").alias("_n"))
    ends = materialize(ends, "ends")
    wanted = wanted.select(*by, F.col("k").cast("bigint").alias("k"))
    ranks = wanted.join(ends, same(wanted, ends)).select(*[wanted[c] for c in by], "k", "low", "high", F.lit(0).cast("bigint").alias("below"), "_n")
    ranks = materialize(ranks.where("k >= 0 and k < _n").drop("_n"), "ranks")
    while True:
        spans = ranks.where("low < high").select(*by, "low", "high").distinct()
        n_spans = spans.count()
        if n_spans == 0:
            return ranks.select(*by, "k", F.col("low").alias("value"))
        spans = materialize(spans, "spans")
        if n_spans <= SENT:
            met = rows.join(F.broadcast(spans), same(rows, spans) & rows["_v"].between(spans["low"], spans["high"]))
        else:
            met = rows.join(spans, same(rows, spans) & rows["_v"].between(spans["low"], spans["high"]))
        cut = met.select(*[rows[c] for c in by], spans["low"], spans["high"], rows["_v"], _cut(rows["_v"], spans["low"], spans["high"], whole).alias("_cut"))
        counted = cut.groupBy(*by, "low", "high", "_cut").agg(F.count("*").alias("c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        # at most CUTS + 2 rows for each range
        upto = F.sum("c").over(Window.partitionBy(*group, "low", "high").orderBy("_cut").rowsBetween(Window.unboundedPreceding, 0))
        counted = counted.withColumn("_upto", upto)
        inside = same(ranks, counted) & (ranks["low"] == counted["low"]) & (ranks["high"] == counted["high"])
        place = ranks["k"] - ranks["below"]
        found = ranks.join(counted, inside & (place < counted["_upto"]) & (place >= counted["_upto"] - counted["c"]))
        moved = found.select(*[ranks[c] for c in by], ranks["k"], counted["_low"].alias("low"), counted["_high"].alias("high"), (ranks["below"] + counted["_upto"] - counted["c"]).alias("below"))
        ranks = materialize(moved.unionByName(ranks.where("low = high")), "ranks")


def kth_values(df: DataFrame, col: str, ks: Sequence[int]) -> list:
    """Exact values at the 0-based ranks ``ks`` of a numeric column without nulls, in one set of passes."""
    if not ks:
        return []
    wanted = df.sparkSession.createDataFrame([(int(k),) for k in sorted(set(ks))], "k bigint")
    found = {r["k"]: r["value"] for r in values_at(df, [], col, wanted).collect()}
    if len(found) < len(set(ks)):
        raise ValueError(f"ranks {sorted(set(ks) - set(found))} are outside the table")
    return [found[k] for k in ks]


def quantiles(df: DataFrame, col: str, ps: Sequence[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, all in one set of passes; null and NaN are left out."""
    values = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)")
    n = values.count()
    if n == 0:
        return [None] * len(ps)
    places = [(n - 1) * p for p in ps]
    ks = sorted({k for x in places for k in (math.floor(x), math.ceil(x))})
    at = dict(zip(ks, kth_values(values, "v", ks), strict=True))

    def between(x: float) -> float:
        low, high = at[math.floor(x)], at[math.ceil(x)]
        return low if low == high else low + (high - low) * (x - math.floor(x))

    return [between(x) for x in places]


def quantile(df: DataFrame, col: str, p: float) -> float | None:
    """Exact quantile with linear interpolation; null and NaN are left out."""
    return quantiles(df, col, [p])[0]


def smallest_by(df: DataFrame, by: Sequence[str], col: str, ids: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Of every group the rows with the smallest ``col``, as many as ``wanted`` (``by, n``) says.

    A group with fewer rows comes whole. One set of passes finds the cuts of all groups. Only rows
    equal to a cut are ordered, by id, so ``col`` should have few ties, as a hash has.
    """
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count("*").alias("_size"))
    asked = reduce(Column.__and__, [wanted[c].eqNullSafe(sizes[c]) for c in by], F.lit(True))
    last = wanted.join(sizes, asked).select(*[wanted[c] for c in by], (F.least("n", "_size") - 1).alias("k")).where("k >= 0")
    cuts = values_at(df, by, col, last)
    cuts = materialize(cuts.select(*by, (F.col("k") + 1).alias("_wanted"), F.col("value").alias("_cutoff")), "cutoffs")
    groups = reduce(Column.__and__, [df[c].eqNullSafe(cuts[c]) for c in by], F.lit(True))
    placed = df.join(cuts, groups & (df[col] <= cuts["_cutoff"])).select(*[df[c] for c in df.columns], cuts["_wanted"], cuts["_cutoff"])
    below = placed.where(F.col(col) < F.col("_cutoff"))
    taken = below.groupBy(*by).agg(F.count("*").alias("_taken"))
    ties = placed.where(F.col(col) == F.col("_cutoff"))
    same = reduce(Column.__and__, [ties[c].eqNullSafe(taken[c]) for c in by], F.lit(True))
    ties = ties.join(taken, same, "left").select(*[ties[c] for c in ties.columns], F.coalesce("_taken", F.lit(0)).alias("_taken"))
    ordered = ties.withColumn("_place", F.row_number().over(Window.partitionBy(*[F.col(c) for c in by], F.lit(0)).orderBy(*ids)))
    last = ordered.where(F.col("_place") <= F.col("_wanted") - F.col("_taken"))
    return below.select(df.columns).unionByName(last.select(df.columns))


def smallest_k(df: DataFrame, col: str, ids: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the smallest ``col``; rows tied at the cut are taken by id.

    For large ``k``: one filter against the exact cut value, and a limit only among ties.
    """
    if k <= 0:
        return df.limit(0)
    if k >= df.count():
        return df
    cut = kth_values(df, col, [k - 1])[0]
    below = df.where(F.col(col) < cut)
    open_places = k - below.count()
    return below.unionByName(df.where(F.col(col) == cut).orderBy(*ids).limit(open_places))


def largest(df: DataFrame, n: int, col: str, tiebreak: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(col), *tiebreak).limit(n)


def limited(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ranked(df: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    """Rank inside small groups such as the features of one row; reduce to a top-k first."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def high_risk_entities(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    return scored.where(F.col("cascade_probability") > threshold).orderBy(
        F.desc("cascade_probability"), "node_id")


def top_predictions(scored: DataFrame, n: int = 5) -> DataFrame:
    return largest(scored, n, "cascade_probability", ["node_id"])
