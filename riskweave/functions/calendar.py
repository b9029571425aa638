"""Calendar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quarter_ends(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per quarter end that falls inside each ``[start, end]`` span.

    ``spans`` keeps its columns; ``quarter_end`` is added.
    """
    first = F.trunc(F.col(start).cast("date"), "quarter")
    begins = spans.select("*", F.explode(
        F.sequence(first, F.col(end).cast("date"), F.expr("interval 3 months"))).alias("_begin"))
    ends = begins.withColumn("quarter_end", F.last_day(F.add_months("_begin", 2))).drop("_begin")
    return ends.where(F.col("quarter_end").between(F.col(start).cast("date"), F.col(end).cast("date")))
