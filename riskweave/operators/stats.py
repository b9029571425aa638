"""Network statistics and the cross-layer validation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def network_statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node layer: nodes, edges, average degree and density."""
    n = nodes.groupBy("network_layer").agg(F.count("*").alias("nodes"))
    e = edges.groupBy("network_layer").agg(F.count("*").alias("edges"))
    joined = n.join(e, "network_layer", "left").fillna(0, ["edges"])
    pairs = F.col("nodes").cast("double") * (F.col("nodes") - 1)
    return joined.select(
        "network_layer", "nodes", "edges",
        (F.col("edges") / F.col("nodes")).alias("avg_degree"),
        F.when(F.col("nodes") > 1, F.col("edges") / pairs).otherwise(F.lit(0.0)).alias("density"),
    )


def type_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows ``(item, network_layer, type, n)`` for node types and relationship types."""
    def counts(df, tag, col):
        return df.groupBy("network_layer", F.col(col).alias("type")).agg(
            F.count("*").alias("n")).select(F.lit(tag).alias("item"), "network_layer", "type", "n")

    return counts(nodes, "node_type", "node_type").unionByName(
        counts(edges, "relationship_type", "relationship_type"))


def bridge_stats(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    bridges = edges.where("network_layer = 'cross_layer_bridge'").agg(
        F.count("*").alias("total_bridge_edges"),
        F.count_if(F.col("relationship_type") == "PUBLICLY_TRADED_AS").alias("publicly_traded_as"),
        F.count_if(F.col("relationship_type") == "REPRESENTS_BANK").alias("represents_bank"),
    )
    connected = mapping.agg(F.count_if("matched")).scalar()
    return bridges.withColumn("connected_entities", connected)


def layer_connectivity(edges: DataFrame) -> DataFrame:
    kind, layer = F.col("relationship_type"), F.col("network_layer")
    return edges.agg(
        F.count_if((layer == "cross_layer_bridge") & (kind == "PUBLICLY_TRADED_AS")).alias("banking_to_market"),
        F.count_if((layer == "cross_layer_bridge") & (kind == "REPRESENTS_BANK")).alias("market_to_banking"),
        F.count_if((layer == "ownership") & F.col("source_id").startswith("INST_")).alias("market_to_ownership"),
        F.lit(0).cast("bigint").alias("banking_to_ownership"),
    )


def path_count(mapping: DataFrame, edges: DataFrame) -> DataFrame:
    """Matched entities times ownership edges."""
    matched = mapping.agg(F.count_if("matched")).scalar()
    counted = edges.agg(F.count_if(F.col("network_layer") == "ownership").alias("ownership_edges"))
    return counted.select(matched.alias("matched"), "ownership_edges").withColumn(
        "possible_paths", F.col("matched") * F.col("ownership_edges"))


def validation_report(mapping: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows ``(section, item, value)``; the example chain starts at the smallest ticker."""
    def section(df, name, item, value):
        return df.select(
            F.lit(name).alias("section"), item.cast("string").alias("item"),
            value.cast("string").alias("value"))

    by_layer = nodes.groupBy("network_layer").agg(F.count("*").alias("n"))
    by_class = mapping.groupBy("entity_type").agg(F.count("*").alias("n"))
    total = mapping.agg(F.count("*").alias("n"))
    matched = mapping.where("matched").select("ticker", "entity_name")
    bridges = edges.where("network_layer = 'cross_layer_bridge'").groupBy(
        "relationship_type").agg(F.count("*").alias("n"))
    paths = path_count(mapping, edges).select(F.explode(F.create_map(
        F.lit("banking_to_market"), F.col("matched"),
        F.lit("market_to_ownership"), F.col("ownership_edges"),
        F.lit("full_chain"), F.col("possible_paths"))).alias("item", "n"))
    example = mapping.where("matched").agg(
        F.min(F.struct("ticker", "bank_node_id", "stock_node_id")).alias("x")
    ).where("x is not null").select(F.explode(F.create_map(
        F.lit("trigger"), F.col("x.bank_node_id"),
        F.lit("propagates_to"), F.col("x.stock_node_id"),
        F.lit("holders_of"), F.col("x.ticker"))).alias("item", "n"))
    return _union([
        section(by_layer, "node_counts", F.col("network_layer"), F.col("n")),
        section(by_class, "entity_matching", F.col("entity_type"), F.col("n")),
        section(total, "entity_matching", F.lit("total"), F.col("n")),
        section(matched, "matched_entities", F.col("ticker"), F.col("entity_name")),
        section(bridges, "bridge_edges", F.col("relationship_type"), F.col("n")),
        section(paths, "propagation_paths", F.col("item"), F.col("n")),
        section(example, "example_contagion", F.col("item"), F.col("n")),
    ])


def statistics_document(nodes: DataFrame, edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row of nested statistics, ready for the JSON report sink.

    Lists in it are bounded by the number of layers and types, not by the graph.
    """
    types = type_counts(nodes, edges).groupBy("network_layer").agg(*[
        F.map_from_entries(F.collect_list(
            F.when(F.col("item") == item, F.struct("type", "n")))).alias(name)
        for item, name in (("node_type", "node_types"), ("relationship_type", "relationship_types"))
    ])
    layers = network_statistics(nodes, edges).join(types, "network_layer", "left").agg(
        F.map_from_entries(F.collect_list(F.struct(
            "network_layer",
            F.struct("nodes", "edges", "node_types", "relationship_types", "avg_degree", "density"),
        ))).alias("layers"))
    return layers.select(
        F.current_timestamp().alias("timestamp"),
        nodes.agg(F.count("*")).scalar().alias("total_nodes"),
        edges.agg(F.count("*")).scalar().alias("total_edges"),
        "layers",
        bridge_stats(edges, mapping).select(F.struct("*")).scalar().alias("cross_layer_connections"),
        layer_connectivity(edges).select(F.struct("*")).scalar().alias("layer_connectivity_matrix"),
    )


def dataset_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per dataset."""
    return _union([
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for name, df in tables.items()
    ])


def distinct_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()
