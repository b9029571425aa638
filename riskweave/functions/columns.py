"""Scalar column helpers: keys, casts, cleaning, flags and scores."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- keys and names ---------------------------------------------------------------------

def prefixed_key(prefix: str, c: Column | str) -> Column:
    """Node id: layer prefix plus natural key; null keys stay null."""
    return F.concat(F.lit(f"{prefix}_"), col_of(c).cast("string"))


def fdic_key(c: Column | str) -> Column:
    """Certificate numbers may arrive as ``628.0``; the key uses the whole number."""
    return prefixed_key("FDIC", safe_cast(safe_cast(c, "double"), "bigint"))


def resolve_alias(df: DataFrame, names: Sequence[str], default=None) -> Column:
    """First of ``names`` that exists as a column; a literal when none does."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    return F.lit(default)


def fuzzy_column(df: DataFrame, parts: Sequence[str]) -> str | None:
    """First column whose lower-case name contains one of ``parts``."""
    return next((c for c in df.columns if any(p in c.lower() for p in parts)), None)


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def company_columns(df: DataFrame) -> DataFrame:
    """Company registry with columns found by name part: cik (10 wide), ticker, title."""
    def found(*parts):
        name = fuzzy_column(df, parts)
        return F.col(f"`{name}`") if name else F.lit(None).cast("string")

    return df.select(
        zfill10(found("cik").cast("string")).alias("cik"),
        found("ticker").cast("string").alias("ticker"),
        found("title", "name").cast("string").alias("title"),
    )


# -- casts ------------------------------------------------------------------------------

def safe_cast(c: Column | str, dtype: str, default=None) -> Column:
    """Parse or null; ``default`` replaces missing and unparsable values."""
    parsed = col_of(c).try_cast(dtype)
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast(dtype))


def safe_int(c: Column | str, default=None) -> Column:
    """Whole number from text that may read ``2102.0``."""
    return safe_cast(safe_cast(c, "double"), "bigint", default)


def safe_date(c: Column | str) -> Column:
    return col_of(c).try_cast("date")


def safe_ts(c: Column | str) -> Column:
    return F.try_to_timestamp(col_of(c))


def zfill10(c: Column | str) -> Column:
    """Left pad to ten characters; longer text is kept whole."""
    c = col_of(c)
    return F.when(F.length(c) < 10, F.lpad(c, 10, "0")).otherwise(c)


def sanitize_rel_type(c: Column | str) -> Column:
    cleaned = F.regexp_replace(F.upper(F.trim(col_of(c))), "[^A-Z0-9_]", "_")
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("REL"))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit(""))


def properties_map(df: DataFrame, names: Iterable[str]) -> Column:
    """Text map of the non-empty properties of a row."""
    pairs = [x for n in names for x in (F.lit(n), blank_to_null(F.col(n).cast("string")))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


# -- rows -------------------------------------------------------------------------------

def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Coalesce present columns with a default and add absent ones as that default."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    })


def audit_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def sic_financial(df: DataFrame) -> DataFrame:
    """Keep industry codes 6000 up to 6799 when the table has a code column."""
    name = fuzzy_column(df, ["sic"])
    if name is None:
        return df
    code = safe_int(F.col(f"`{name}`"))
    return df.where((code >= 6000) & (code < 6800))


def nan_inf_to_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    def clean(name):
        c = F.col(name).cast("double")
        bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
        return F.when(bad, F.lit(0.0)).otherwise(c)

    return df.withColumns({name: clean(name) for name in cols})


def fill_zero_all(df: DataFrame, text_fill: str = "0") -> DataFrame:
    """Every missing cell becomes zero; text columns get ``text_fill``."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.fillna(0, numeric).fillna(text_fill, text)


# -- scores and flags -------------------------------------------------------------------

def bounds(df: DataFrame, cols: Sequence[str]) -> Column:
    """One-row subquery with the minimum and maximum of each column."""
    aggs = [f(c).alias(f"{tag}_{c}") for c in cols for tag, f in (("lo", F.min), ("hi", F.max))]
    return df.agg(F.struct(*aggs).alias("bounds")).scalar()


def scaled(c: str, limits: Column) -> Column:
    """``(x - min) / (max - min)``; a constant column scales to zero."""
    lo, hi = limits.getField(f"lo_{c}"), limits.getField(f"hi_{c}")
    return F.when(hi > lo, (F.col(c) - lo) / (hi - lo)).otherwise(F.lit(0.0))


def min_max(df: DataFrame, cols: Sequence[str], prefix: str = "norm_") -> DataFrame:
    limits = bounds(df, cols)
    return df.withColumns({f"{prefix}{c}": scaled(c, limits) for c in cols})


def risk_level(prob: Column | str) -> Column:
    """(0, 0.3] Low, (0.3, 0.7] Medium, (0.7, 1] High, anything else null."""
    p = col_of(prob)
    return (
        F.when((p > 0) & (p <= 0.3), "Low")
        .when((p > 0.3) & (p <= 0.7), "Medium")
        .when((p > 0.7) & (p <= 1), "High")
    )


# Fixed value: an edge is high-risk above this weight.
HIGH_RISK_LIMIT = 1e9


def high_risk_flag(weight: Column | str, limit: float = HIGH_RISK_LIMIT) -> Column:
    return F.coalesce(col_of(weight) > F.lit(limit), F.lit(False))


def abs_weight(c: Column | str) -> Column:
    return F.abs(col_of(c))


def signed_contribution(c: Column | str) -> Column:
    """Direction of a contribution: ``up`` above zero, else ``down``."""
    return F.when(col_of(c) > 0, "up").otherwise("down")


def group_label(cols: Sequence[str]) -> Column:
    """``Group[a=x, b=y]``."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in cols]
    return F.concat(F.lit("Group["), F.concat_ws(", ", *parts), F.lit("]"))


REDACTED = "***REDACTED***"


def redact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the raw identifiers and leave a redaction mark in their place."""
    return df.withColumns({f"{c}_original": F.lit(REDACTED) for c in cols}).drop(*cols)
