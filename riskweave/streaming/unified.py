"""Five record streams in one, and the batch job that rebuilds the graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskweave import schemas
from riskweave.functions.columns import audit_columns
from riskweave.operators import integrate as ops
from riskweave.operators.stats import statistics_document, validation_report
from riskweave.session import materialize
from riskweave.sources.readers import drop_stream, load_datasets
from riskweave.sources.writers import write_graph, write_report


def unified_stream(streams: dict[str, DataFrame]) -> DataFrame:
    """Union of the layers' records with ``layer`` and the record kind in ``stream``."""
    parts = [
        df.drop("layer").select(
            F.lit(layer).alias("layer"), "*",
            F.col(schemas.STREAM_KIND[layer]).alias("stream"))
        for layer, df in streams.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def run_unified_stream(
    spark: SparkSession, dirs: dict[str, str], out: str, checkpoint: str,
    max_files: int | None = None, fmt: str = "parquet", once: bool = True,
) -> StreamingQuery:
    """Append the unified stream to ``out``; ``once`` stops after the files now present."""
    streams = {layer: drop_stream(spark, layer, path, max_files) for layer, path in dirs.items()}
    writer = unified_stream(streams).writeStream.format(fmt).outputMode("append").option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")
    return writer.start(out)


def integrate(spark: SparkSession, data_root: str, out: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read every dataset below ``data_root``, build the graph and write all its tables.

    Of rows with one key the one that stands first in its file stays. Any scheduler can call it
    again; every table is overwritten.
    """
    data = load_datasets(spark, data_root, position="seq")
    if not data:
        raise FileNotFoundError(f"no dataset below {data_root}")
    nodes = materialize(ops.unified_nodes(
        data.get("institution_profiles"), data.get("fdic_active_banks"),
        data.get("company_fundamentals"), data.get("13f_holdings")), "nodes")
    mapping = materialize(ops.entity_mapping(nodes), "mapping")
    edges = materialize(ops.unified_edges(
        data.get("interbank_lending"), data.get("market_correlations"),
        data.get("ownership_network"), mapping), "edges")
    write_graph(audit_columns(nodes), f"{out}/unified_nodes", "parquet", by_layer=True)
    write_graph(audit_columns(edges), f"{out}/unified_edges", "parquet", by_layer=True)
    write_graph(mapping, f"{out}/entity_mapping")
    write_graph(ops.to_import_nodes(audit_columns(nodes)), f"{out}/import/nodes")
    write_graph(ops.to_import_edges(audit_columns(edges)), f"{out}/import/edges")
    write_report(statistics_document(nodes, edges, mapping), f"{out}/network_statistics")
    write_report(validation_report(mapping, nodes, edges), f"{out}/validation_report")
    return nodes, edges, mapping
