"""Macro time series: wide calendar, forward fill, stress index, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Stress rules as (series, comparison, limit), points per rule, flag limit.
STRESS_RULES = (("T10Y2Y", "<", 0.0), ("VIXCLS", ">", 30.0), ("BAMLH0A0HYM2", ">", 7.0))
POINTS, HIGH_STRESS = 2, 4


def pivot_series(
    df: DataFrame, series: Sequence[str], date: str = "date", name: str = "series_id",
    value: str = "value", seq: str | None = None,
) -> DataFrame:
    """Long to wide for a known list of series; the latest row by ``seq`` wins a repeat."""
    v = F.max(F.struct(F.col(seq), F.col(value)))[value] if seq else F.first(value)
    return df.groupBy(date).pivot(name, list(series)).agg(v)


def forward_fill(
    df: DataFrame, cols: Sequence[str], order: str, by: Sequence[str] = (),
) -> DataFrame:
    """Last known value of each column in date order, per entity when ``by`` is given.

    Meant for calendars: one row per date and entity.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def stress_index(
    long: DataFrame, series: Sequence[str], rules=STRESS_RULES, date: str = "date",
    name: str = "series_id", value: str = "value", seq: str | None = None,
) -> DataFrame:
    """Wide filled calendar with a stress score and flag; a missing value adds nothing.

    The single window runs over the calendar, one row per date, after the grouping.
    """
    wide = forward_fill(pivot_series(long, series, date, name, value, seq), series, date)
    score = F.lit(0)
    for column, test, limit in rules:
        c = F.col(f"`{column}`")
        hit = c < limit if test == "<" else c > limit
        score = score + F.when(hit, POINTS).otherwise(0)
    return wide.withColumn("yield_curve", F.col(f"`{rules[0][0]}`")).withColumn(
        "stress_score", score).withColumn(
        "high_stress_flag", F.when(F.col("stress_score") >= HIGH_STRESS, 1).otherwise(0))


def sector_correlation(correlations: DataFrame, sectors: DataFrame) -> DataFrame:
    """Mean correlation per sector pair with the stocks seen on each side."""
    one = sectors.select(F.col("symbol").alias("symbol1"), F.col("sector").alias("s1"))
    two = sectors.select(F.col("symbol").alias("symbol2"), F.col("sector").alias("s2"))
    joined = correlations.join(one, "symbol1").join(two, "symbol2").where("s1 <> s2")
    first = F.col("s1") < F.col("s2")
    return joined.select(
        F.least("s1", "s2").alias("sector1"), F.greatest("s1", "s2").alias("sector2"), "correlation",
        F.when(first, F.col("symbol1")).otherwise(F.col("symbol2")).alias("a"),
        F.when(first, F.col("symbol2")).otherwise(F.col("symbol1")).alias("b"),
    ).groupBy("sector1", "sector2").agg(
        F.avg("correlation").alias("correlation"),
        F.count_distinct("a").alias("num_stocks_sector1"),
        F.count_distinct("b").alias("num_stocks_sector2"))
