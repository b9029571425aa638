"""The risk network's input datasets as projections of the order tables.

Suppliers are banks, parts are stocks, customers are investors. A line links its bank and its
stock to those of the next line of its order, and every line is a holding. Every table is used
whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators import integrate, sequence
from riskweave.session import materialize

# Keys of banks are spread so that only some equal a stock's ticker.
BANK_STEP = 50
# Line prices become loan amounts around the high-risk limit.
AMOUNT_SCALE = 20000.0
# Order of the lines of an order.
LINE = ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount",
        "l_returnflag", "l_shipdate"]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    return (
        read(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("s_suppkey") * BANK_STEP).cast("string").alias("institution_id"),
            F.col("s_name").alias("institution_name"), F.col("r_name").alias("tier"),
            F.col("s_acctbal").alias("total_assets"),
            (F.col("s_acctbal") * F.lit(0.5)).alias("total_deposits"),
            (F.col("s_acctbal") * F.lit(0.25)).alias("total_loans"),
            (F.col("s_acctbal") * F.lit(0.125)).alias("equity"),
            (F.col("s_nationkey") + 1).cast("bigint").alias("num_branches"),
            (F.col("s_nationkey") * 100).cast("bigint").alias("num_employees")))


def fdic_banks(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "nation").join(
        read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("CERT"), F.col("n_name").alias("NAME"),
             F.lit(None).cast("double").alias("ASSET"), F.col("r_name").alias("CITY"),
             F.substring("n_name", 1, 2).alias("STALP"))


def fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("symbol"), F.col("p_name").alias("company_name"),
        F.col("p_type").alias("sector"), F.col("p_brand").alias("industry"),
        (F.col("p_retailprice") * F.lit(1024.0)).alias("market_cap"),
        F.col("p_size").cast("double").alias("trailing_pe"),
        F.nullif(F.col("p_size"), F.lit(1)).cast("double").alias("debt_to_equity"),
        F.lit(None).cast("double").alias("beta"))


# Type of a dataset's keys: text, as in its files. Edges take whole numbers, which are shorter to move.
TEXT, WHOLE = "string", "bigint"


def holdings(spark: SparkSession, sf: str, key: str = TEXT) -> DataFrame:
    """One filing per line: filer, issuer, value, shares."""
    lines = read(spark, sf, "lineitem").join(
        read(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("o_custkey").cast(key).alias("filer_cik"),
        F.col("o_orderdate").cast("date").alias("filing_date"),
        F.col("l_partkey").cast(key).alias("issuer_name"),
        F.col("l_extendedprice").alias("value"), F.col("l_quantity").cast("bigint").alias("shares"),
        F.col("l_orderkey").alias("seq"))


def filers(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("filer_cik"))


# Edge columns that come from a line's values; its keys and its flag are always kept.
FROM_LINE = {"l_extendedprice": ("weight",), "l_discount": ("weight", "interest_rate", "correlation"),
             "l_quantity": ("maturity_days",), "l_shipdate": ("transaction_date",), "l_linenumber": ()}


def line_pairs(spark: SparkSession, sf: str, columns: Sequence[str] = ()) -> DataFrame:
    """Every line ``f`` of an order with the next one ``g``, by line number and then by values.

    ``seq`` is the place of the first of them among the lines of all orders. With edge ``columns`` the lines
    keep only the values that these need.
    """
    kept = [c for c in LINE if not columns or c not in FROM_LINE or set(FROM_LINE[c]) & set(columns)]
    return sequence.following(
        read(spark, sf, "lineitem").select("l_orderkey", *LINE), ["l_orderkey"], LINE, ahead=["l_suppkey", "l_partkey"], kept=kept)


def _known(pairs: DataFrame, **values: tuple[str, Column]) -> list[Column]:
    """The values whose field the lines of ``pairs`` have kept."""
    fields = pairs.schema["f"].dataType.names
    return [value.alias(name) for name, (field, value) in values.items() if field in fields]


def lending(spark: SparkSession, sf: str, pairs: DataFrame | None = None, key: str = TEXT) -> DataFrame:
    """Loans between the banks of consecutive lines, in the sequence of the lines."""
    pairs = line_pairs(spark, sf) if pairs is None else pairs
    kind = (F.when(F.col("f.l_returnflag") == "A", "overnight_lending")
            .when(F.col("f.l_returnflag") == "R", "repo_agreement"))
    return pairs.where("f.l_suppkey <> g.l_suppkey").select(
        "seq",
        (F.col("f.l_suppkey") * BANK_STEP).cast(key).alias("from_institution"),
        (F.col("g.l_suppkey") * BANK_STEP).cast(key).alias("to_institution"),
        kind.alias("relationship_type"), *_known(
            pairs, amount_usd=("l_extendedprice", F.col("f.l_extendedprice") * F.lit(AMOUNT_SCALE)),
            transaction_date=("l_shipdate", F.col("f.l_shipdate").cast("date")),
            maturity_days=("l_quantity", F.col("f.l_quantity")), interest_rate=("l_discount", F.col("f.l_discount"))))


def correlations(spark: SparkSession, sf: str, pairs: DataFrame | None = None, key: str = TEXT) -> DataFrame:
    """Signed co-movement between the stocks of consecutive lines."""
    pairs = line_pairs(spark, sf) if pairs is None else pairs
    return pairs.where("f.l_partkey <> g.l_partkey").select(
        "seq",
        F.col("f.l_partkey").cast(key).alias("symbol1"),
        F.col("g.l_partkey").cast(key).alias("symbol2"),
        *_known(pairs, correlation=("l_discount", (F.col("f.l_discount") - F.lit(0.05)) * F.lit(16.0))))


def ownership(spark: SparkSession, sf: str, key: str = TEXT) -> DataFrame:
    return holdings(spark, sf, key).select(
        F.col("filer_cik").alias("owner_cik"), F.col("issuer_name").alias("owned_ticker"),
        F.col("value").alias("ownership_value"), F.col("shares").alias("shares_held"), "seq")


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """The raw loan stream with its sequence: parallel edges are still apart."""
    return lending(spark, sf).select(
        "seq", F.concat(F.lit("BANK_"), "from_institution").alias("source_id"),
        F.concat(F.lit("BANK_"), "to_institution").alias("target_id"),
        F.coalesce("relationship_type", F.lit("interbank_lending")).alias("relationship_type"),
        F.col("amount_usd").alias("weight"))


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.unified_nodes(
        profiles(spark, sf), fdic_banks(spark, sf), fundamentals(spark, sf), filers(spark, sf))


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.entity_mapping(nodes(spark, sf))


# Relationship types of the layers that pair lines.
LOANS, MOVES = ("overnight_lending", "repo_agreement", "interbank_lending"), ("market_correlation",)


def edges(spark: SparkSession, sf: str, *columns: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """All edges; with ``columns`` only these, so that no others are moved.

    With ``kinds`` only the edges of these relationship types: layers that hold none of them are not built.
    """
    if kinds is None or set(kinds) & {*LOANS, *MOVES}:
        pairs = line_pairs(spark, sf, columns)
        paired = lending(spark, sf, pairs, WHOLE), correlations(spark, sf, pairs, WHOLE)
    else:
        paired = None, None
    out = integrate.unified_edges(*paired, ownership(spark, sf, WHOLE), mapping(spark, sf), columns or None)
    if kinds is not None:
        out = out.where(F.col("relationship_type").isin(*kinds))
    return out.select(*columns) if columns else out


# Edge columns that graph jobs use.
LINKS = ("source_id", "target_id", "relationship_type", "network_layer", "weight")


def graph(spark: SparkSession, sf: str, columns: Sequence[str] = LINKS, kinds: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and the edge columns that graph jobs use, written out once for repeated reads.

    ``kinds`` names the relationship types that the job asks for, all if absent.
    """
    return materialize(nodes(spark, sf), "nodes"), materialize(edges(spark, sf, *columns, kinds=kinds), "edges")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as scored entities: two groups, prediction, probability, truth."""
    return read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("node_id"), F.col("lang").alias("node_type"),
        F.col("source").alias("tier"), F.col("quality").alias("cascade_prediction"),
        (F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0))).alias("cascade_probability"),
        F.col("toxic").alias("truth"))


def hourly_series(spark: SparkSession, sf: str) -> DataFrame:
    """Mean event value per hour and event type; hours without an event are absent."""
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return read(spark, sf, "events").groupBy(
        F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "yyyy-MM-dd HH").alias("date"),
        F.col("event_type").alias("series_id"),
    ).agg((total / F.count("*")).alias("value"))


SERIES = ["click", "error", "purchase", "signup", "view"]
# Stress rules over the hourly series, in the place of yield curve, volatility and spread.
RULES = (("click", "<", 40.0), ("error", ">", 60.0), ("purchase", ">", 55.0))
