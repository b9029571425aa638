"""Integration of the layers into one graph: nodes, edges, entity map, bridge edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave import schemas
from riskweave.functions.columns import (
    abs_weight, fdic_key, prefixed_key, require, resolve_alias, safe_cast, safe_int,
)

# Cross-layer edge types with their propagation factors.
BRIDGES = (("PUBLICLY_TRADED_AS", 0.9), ("REPRESENTS_BANK", 0.8))


def first_wins(df: DataFrame, keys: Sequence[str], seq: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the smallest ``seq`` per key; full ties fall to the row's values.

    A grouped minimum over a struct: each task reduces its own rows first, so a key that
    holds a large share of the table costs one row per task in the shuffle. ``columns`` names the values that
    the caller needs, all if absent: those behind the last of them decide nothing and do not travel.
    """
    rest = [c for c in df.columns if c not in keys and c not in seq]
    if columns is not None:
        rest = rest[:max((i + 1 for i, c in enumerate(rest) if c in columns), default=0)]
        if not rest:
            # in the order of the keys they take less room wherever they move or lie next
            return df.select(*keys).distinct().sortWithinPartitions(*keys)
    best = df.groupBy(*keys).agg(F.min(F.struct(*seq, *rest)).alias("_best"))
    return best.select([F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns if c in keys or c in rest or columns is None])


def conform(df: DataFrame, target) -> DataFrame:
    """Select the columns of ``target`` in order; absent ones become null."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target
    ])


def _or(df: DataFrame, names: Sequence[str], dtype: str, default=None) -> Column:
    found = resolve_alias(df, names).cast(dtype)
    return found if default is None else F.coalesce(found, F.lit(default).cast(dtype))


def _seq(df: DataFrame) -> Column:
    """Input order when the table carries one; equal otherwise, so values decide.

    A position in the files (see ``read_table``) counts as it is, anything else as a number.
    """
    if "seq" not in df.columns:
        return F.lit(0).cast("bigint").alias("_seq")
    seq = F.col("seq")
    return (seq if isinstance(df.schema["seq"].dataType, T.StructType) else seq.cast("bigint")).alias("_seq")


def bank_nodes(profiles: DataFrame) -> DataFrame:
    key = F.col("institution_id").cast("string")
    return profiles.select(
        prefixed_key("BANK", key).alias("node_id"),
        F.lit("bank").alias("node_type"), F.lit("banking").alias("network_layer"),
        F.coalesce(_or(profiles, ["institution_name"], "string"), key).alias("name"),
        key.alias("institution_id"),
        _or(profiles, ["tier"], "string", "unknown").alias("tier"),
        *[safe_cast(resolve_alias(profiles, [c], 0), "double").alias(c)
          for c in ("total_assets", "total_deposits", "total_loans", "equity")],
        *[safe_int(resolve_alias(profiles, [c], 0)).alias(c)
          for c in ("num_branches", "num_employees")],
        _seq(profiles),
    )


def fdic_nodes(banks: DataFrame) -> DataFrame:
    cert = resolve_alias(banks, ["CERT", "cert"])
    return banks.where(cert.isNotNull()).select(
        fdic_key(cert).alias("node_id"),
        F.lit("fdic_bank").alias("node_type"), F.lit("banking").alias("network_layer"),
        _or(banks, ["NAME", "name"], "string", "Unknown").alias("name"),
        safe_int(cert).alias("cert"),
        safe_cast(resolve_alias(banks, ["ASSET", "asset"]), "double", 0.0).alias("assets"),
        _or(banks, ["CITY", "city"], "string", "").alias("city"),
        _or(banks, ["STALP", "stalp"], "string", "").alias("state"),
        _seq(banks),
    )


def stock_nodes(fundamentals: DataFrame) -> DataFrame:
    symbol = resolve_alias(fundamentals, ["symbol", "ticker"]).cast("string")
    return fundamentals.where(symbol.isNotNull()).select(
        prefixed_key("STOCK", symbol).alias("node_id"),
        F.lit("stock").alias("node_type"), F.lit("market").alias("network_layer"),
        F.coalesce(_or(fundamentals, ["company_name"], "string"), symbol).alias("name"),
        symbol.alias("ticker"),
        _or(fundamentals, ["sector"], "string", "Unknown").alias("sector"),
        _or(fundamentals, ["industry"], "string", "Unknown").alias("industry"),
        safe_cast(resolve_alias(fundamentals, ["market_cap"], 0), "double").alias("market_cap"),
        safe_cast(resolve_alias(fundamentals, ["trailing_pe"]), "double").alias("trailing_pe"),
        safe_cast(resolve_alias(fundamentals, ["debt_to_equity"]), "double").alias("debt_to_equity"),
        safe_cast(resolve_alias(fundamentals, ["beta"]), "double", 1.0).alias("beta"),
        _seq(fundamentals),
    )


def investor_nodes(holdings: DataFrame) -> DataFrame:
    cik = F.col("filer_cik").cast("string")
    return require(holdings, ["filer_cik"]).select(cik.alias("cik")).distinct().select(
        prefixed_key("INST", "cik").alias("node_id"),
        F.lit("institutional_investor").alias("node_type"),
        F.lit("ownership").alias("network_layer"),
        F.concat(F.lit("Institution_"), F.col("cik")).alias("name"), "cik",
        F.lit(0).cast("bigint").alias("_seq"),
    )


def unified_nodes(
    profiles: DataFrame | None = None,
    fdic: DataFrame | None = None,
    fundamentals: DataFrame | None = None,
    holdings: DataFrame | None = None,
) -> DataFrame:
    """One row per node id over every present source; the first input row wins.

    Id prefixes keep the sources apart, so each source removes its own repeats.
    """
    parts = [
        build(source) for build, source in (
            (bank_nodes, profiles), (fdic_nodes, fdic),
            (stock_nodes, fundamentals), (investor_nodes, holdings),
        ) if source is not None
    ]
    unique = [conform(first_wins(p, ["node_id"], ["_seq"]), schemas.NODES) for p in parts]
    out = unique[0]
    for part in unique[1:]:
        out = out.unionByName(part)
    return out


def entity_mapping(nodes: DataFrame) -> DataFrame:
    """Banks against stocks by ticker: matched, bank only, stock only."""
    banks = nodes.where("node_type = 'bank'").select(
        F.col("institution_id").alias("ticker"), F.col("node_id").alias("bank_node_id"),
        F.col("name").alias("bank_name"), F.col("total_assets").alias("bank_assets"))
    stocks = nodes.where("node_type = 'stock'").select(
        "ticker", F.col("node_id").alias("stock_node_id"),
        F.col("name").alias("stock_name"), F.col("market_cap").alias("stock_cap"))
    has_bank, has_stock = F.col("bank_node_id").isNotNull(), F.col("stock_node_id").isNotNull()
    return banks.join(stocks, "ticker", "full").select(
        "ticker", "bank_node_id", "stock_node_id",
        F.when(has_bank, F.col("bank_name")).otherwise(F.col("stock_name")).alias("entity_name"),
        F.when(has_bank & has_stock, "publicly_traded_bank")
        .when(has_bank, "bank_not_public").otherwise("stock_not_bank").alias("entity_type"),
        (has_bank & has_stock).alias("matched"),
        F.when(has_bank, F.col("bank_assets")).otherwise(F.lit(0.0)).alias("total_assets"),
        F.when(has_stock, F.col("stock_cap")).otherwise(F.lit(0.0)).alias("market_cap"),
    )


def bridge_edges(mapping: DataFrame) -> DataFrame:
    """Two edges per matched entity: bank to stock and back."""
    ends = (("bank_node_id", "stock_node_id"), ("stock_node_id", "bank_node_id"))
    both = F.array(*[
        F.struct(
            F.col(src).alias("source_id"), F.col(dst).alias("target_id"),
            F.lit(kind).alias("relationship_type"), F.lit(factor).alias("propagation_factor"))
        for (src, dst), (kind, factor) in zip(ends, BRIDGES)
    ])
    return mapping.where("matched").select("ticker", F.inline(both)).select(
        "source_id", "target_id", "relationship_type",
        F.lit("cross_layer_bridge").alias("network_layer"), F.lit(True).alias("layer_bridge"),
        F.lit("corporate_identity").alias("bridge_type"), "ticker",
        F.lit(1.0).alias("weight"), "propagation_factor",
    )


EDGE_KEY = ["source_id", "target_id", "relationship_type"]
# Columns that a layer's edges share; they are set behind the choice of the first row.
COMMON = {"banking": {"currency": "USD"}, "market": {}, "ownership": {}}


# Id prefixes of a layer's edge ends.
PREFIXES = {"banking": ("BANK", "BANK"), "market": ("STOCK", "STOCK"), "ownership": ("INST", "STOCK")}


def _natural(df: DataFrame, c: str) -> Column:
    """The key of an edge's end as it moves: whole numbers stay, anything else is text."""
    return F.col(c) if isinstance(df.schema[c].dataType, T.IntegralType) else F.col(c).cast("string")


def _named(rows: DataFrame, layer: str) -> DataFrame:
    """Node ids in the place of natural keys; different keys get different ids."""
    source, target = PREFIXES[layer]
    end = prefixed_key(target, "target_id")
    if layer == "ownership":
        # A holding in another institution already names its node.
        own = F.col("target_id").cast("string")
        end = F.when(own.startswith("INST_"), own).otherwise(end)
    return rows.withColumns({"source_id": prefixed_key(source, "source_id"), "target_id": end})


def _lending_rows(lending: DataFrame) -> DataFrame:
    rows = require(lending, ["from_institution", "to_institution"])
    return rows.select(
        _natural(rows, "from_institution").alias("source_id"),
        _natural(rows, "to_institution").alias("target_id"),
        _or(rows, ["relationship_type"], "string", "interbank_lending").alias("relationship_type"),
        F.lit("banking").alias("network_layer"),
        safe_cast(resolve_alias(rows, ["amount_usd"], 0), "double").alias("weight"),
        resolve_alias(rows, ["transaction_date"]).cast("date").alias("transaction_date"),
        safe_int(resolve_alias(rows, ["maturity_days"], 0)).alias("maturity_days"),
        safe_cast(resolve_alias(rows, ["interest_rate"], 0), "double").alias("interest_rate"),
        F.lit("USD").alias("currency"), _seq(rows),
    )


def lending_edges(lending: DataFrame) -> DataFrame:
    return _named(_lending_rows(lending), "banking")


def _correlation_rows(correlations: DataFrame) -> DataFrame:
    rows = require(correlations, ["symbol1", "symbol2"])
    value = safe_cast(resolve_alias(rows, ["correlation"], 0), "double")
    return rows.select(
        _natural(rows, "symbol1").alias("source_id"),
        _natural(rows, "symbol2").alias("target_id"),
        F.lit("market_correlation").alias("relationship_type"),
        F.lit("market").alias("network_layer"),
        abs_weight(value).alias("weight"), value.alias("correlation"),
        safe_int(resolve_alias(rows, ["window_days"], 90), 90).alias("window_days"), _seq(rows),
    )


def correlation_edges(correlations: DataFrame) -> DataFrame:
    return _named(_correlation_rows(correlations), "market")


def _ownership_rows(ownership: DataFrame) -> DataFrame:
    rows = require(ownership, ["owner_cik", "owned_ticker"])
    return rows.select(
        _natural(rows, "owner_cik").alias("source_id"), _natural(rows, "owned_ticker").alias("target_id"),
        _or(rows, ["relationship_type"], "string", "equity_ownership").alias("relationship_type"),
        F.lit("ownership").alias("network_layer"),
        safe_cast(resolve_alias(rows, ["ownership_value"], 0), "double").alias("weight"),
        safe_int(resolve_alias(rows, ["shares_held"], 0), 0).alias("shares_held"), _seq(rows),
    )


def ownership_edges(ownership: DataFrame) -> DataFrame:
    return _named(_ownership_rows(ownership), "ownership")


def unified_edges(
    lending: DataFrame | None = None,
    correlations: DataFrame | None = None,
    ownership: DataFrame | None = None,
    mapping: DataFrame | None = None, columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per (source, target, type) over every layer, then the bridge edges.

    Layers cannot share a key, since their id prefixes or types differ, so each layer
    removes its own repeats, by natural keys: node ids are set behind that choice. ``columns`` names those that the caller needs, all if absent; the rows are the same.
    """
    wanted = [f for f in schemas.EDGES if columns is None or f.name in columns]

    def layer(rows: DataFrame, name: str) -> DataFrame:
        common = {"network_layer": name, **COMMON[name]}
        best = first_wins(rows.drop(*common), EDGE_KEY, ["_seq"], columns)
        return conform(_named(best, name).withColumns({c: F.lit(v) for c, v in common.items()}), wanted)

    parts = [
        layer(build(source), name) for name, build, source in (
            ("banking", _lending_rows, lending), ("market", _correlation_rows, correlations),
            ("ownership", _ownership_rows, ownership),
        ) if source is not None
    ]
    if mapping is not None:
        parts.append(conform(bridge_edges(mapping), wanted))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def cik_to_ticker(holdings: DataFrame, companies: DataFrame) -> DataFrame:
    """Ownership rows from holdings: ticker by issuer key, ``UNK_<issuer>`` when unknown.

    The registry is reduced to one ticker per key before the join.
    """
    known = require(companies, ["cik", "ticker"]).groupBy("cik").agg(
        F.max("ticker").alias("_ticker"))
    joined = holdings.join(known, F.col("issuer_name") == F.col("cik"), "left")
    return joined.select(
        F.col("filer_cik").alias("owner_cik"),
        F.coalesce("_ticker", F.concat(F.lit("UNK_"), F.col("issuer_name"))).alias("owned_ticker"),
        F.coalesce("issuer_name", F.lit("Unknown")).alias("owned_company_name"),
        F.col("value").alias("ownership_value"), F.col("shares").alias("shares_held"),
        "filing_date", F.lit("equity_ownership").alias("relationship_type"),
        F.lit("ownership").alias("network_layer"),
    )


def sec_union(companies: DataFrame, holdings: DataFrame, insider: DataFrame, ownership: DataFrame) -> DataFrame:
    """The four filing tables in one, told apart by ``record_type``."""
    out = None
    for df, tag in ((companies, "company"), (holdings, "13f"), (insider, "insider"), (ownership, "ownership")):
        part = df.withColumn("record_type", F.lit(tag))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def to_import_nodes(nodes: DataFrame) -> DataFrame:
    """Graph-import header layout."""
    return nodes.withColumn(":LABEL", F.col("node_type")).withColumnRenamed("node_id", "node_id:ID")


def to_import_edges(edges: DataFrame) -> DataFrame:
    return edges.withColumnsRenamed(
        {"source_id": ":START_ID", "target_id": ":END_ID", "relationship_type": ":TYPE"})


def ticker_sets(nodes: DataFrame) -> DataFrame:
    """Tickers on both sides, on the bank side only, on the stock side only."""
    return entity_mapping(nodes).select(
        "ticker",
        F.when(F.col("matched"), "both")
        .when(F.col("bank_node_id").isNotNull(), "bank_only").otherwise("stock_only").alias("side"))
