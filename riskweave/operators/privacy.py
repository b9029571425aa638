"""k-anonymous release of entity tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import REDACTED, group_label


def group_sizes(df: DataFrame, quasi_ids: Sequence[str]) -> DataFrame:
    return df.groupBy(*quasi_ids).agg(F.count("*").alias("group_size"))


def with_group_size(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the group's size to each row.

    Sizes are counted first and joined back null-safely, so a group that holds a third of
    the rows is never gathered in one task.
    """
    sizes = group_sizes(df, by).select(*[F.col(c).alias(f"_{c}") for c in by], "group_size")
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return df.join(sizes, match).drop(*[f"_{c}" for c in by])


def k_anonymize(
    df: DataFrame, quasi_ids: Sequence[str], identifiers: Sequence[str], k: int = 3,
) -> DataFrame:
    """Rows of groups with at least ``k`` members, identifiers replaced by the group label.

    Raw identifiers leave the table. Null quasi-identifiers form groups like other values.
    """
    kept = with_group_size(df, quasi_ids).where(F.col("group_size") >= k)
    label = group_label(quasi_ids)
    return kept.withColumns({
        **{f"{c}_anonymized": label for c in identifiers},
        **{f"{c}_original": F.lit(REDACTED) for c in identifiers},
        "anonymization_level": F.lit("k-anonymous"),
    }).drop(*identifiers)


def k_anon_summary(
    df: DataFrame, by: Sequence[str], k: int = 3, entity: str = "entity_id", value: str = "impact_value",
) -> DataFrame:
    """Entity count and total impact per group, groups below ``k`` left out."""
    total = F.sum(F.col(value).cast("decimal(28,2)")).cast("double")
    return df.groupBy(*by).agg(
        F.count(entity).alias("entity_count"), total.alias("total_impact")
    ).where(F.col("entity_count") >= k)


def anonymization_report(df: DataFrame, quasi_ids: Sequence[str], k: int = 3) -> DataFrame:
    size = F.col("group_size")
    return group_sizes(df, quasi_ids).agg(
        F.lit(k).cast("bigint").alias("k_value"),
        F.count_if(size >= k).alias("groups_created"),
        F.coalesce(F.sum(F.when(size < k, size)), F.lit(0)).cast("bigint").alias("entities_suppressed"),
        F.coalesce(F.sum(F.when(size >= k, size)), F.lit(0)).cast("bigint").alias("entities_generalized"),
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total_entities"))


def anonymized_or_summary(
    df: DataFrame, quasi_ids: Sequence[str], identifiers: Sequence[str], k: int = 3,
) -> DataFrame:
    """The anonymised rows, or the summary when every group is too small."""
    rows = k_anonymize(df, quasi_ids, identifiers, k)
    if rows.isEmpty():
        return k_anon_summary(df, ["hop", *quasi_ids], k)
    return rows


def write_impact(
    df: DataFrame, anon_path: str, internal_path: str, quasi_ids: Sequence[str],
    identifiers: Sequence[str], k: int = 3,
) -> None:
    """The shareable table and the internal detail table, on separate paths."""
    anonymized_or_summary(df, quasi_ids, identifiers, k).write.mode("overwrite").option(
        "header", True).csv(anon_path)
    df.write.mode("overwrite").option("header", True).csv(internal_path)
