"""Helpers shared by the corpus operators."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows turned into Python objects at a time, so that a batch of long texts stays small.
SLICE = 128


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns can neither clash nor cost."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _column(values: list, kind: pa.DataType) -> pa.Array:
    """Values as a column; lists of numbers that all come as typed arrays are joined and cast at once."""
    if not (pa.types.is_list(kind) and values and all(isinstance(v, array) for v in values) and len({v.typecode for v in values}) == 1):
        return pa.array(values, kind)
    ends = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
    flat = np.frombuffer(b"".join([v.tobytes() for v in values]), np.dtype(values[0].typecode))
    return pa.ListArray.from_arrays(ends, pa.array(flat).cast(kind.value_type), type=kind)


def map_texts(docs: DataFrame, start: Callable[[], Callable], ddl: str) -> DataFrame:
    """One output row per document.

    ``start()`` runs once per task and gives a function of a text (null becomes empty) that
    returns the values of all columns after ``doc_id``.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                rows = [work(text or "") for text in part.column(1).to_pylist()]
                columns = [part.column(0).cast(pa.int64())]
                columns += [_column(list(v), field.type) for v, field in zip(zip(*rows), list(schema)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(run, ddl)
