"""Places of rows in a sorted order and pairs of rows that follow each other.

A group may hold any share of the table: nothing is ordered in a window over a group. The order is cut
into ranges of the whole sort key, so a long group is spread over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import materialize

#: Rows of the order that are paired at a time.
SPAN = 100_000
ROW_BITS = 33  # of a row's id within its partition


def numbered(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Add the place of every row in the order, from 0 and without gaps.

    Rows equal in all of ``order`` stand next to each other in any order.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part, row = F.shiftright("_id", ROW_BITS), F.col("_id").bitwiseAND((1 << ROW_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # one row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    return placed.withColumn("_part", part).join(shift, "_part").select(*df.columns, (F.col("_before") + row).alias(name))


def _beside(names: Sequence[str], span: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows of a task with the columns ``names`` of the next row beside them; the last row gets nulls."""
    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for start in range(0, batch.num_rows, span):
                part = batch.slice(start, span)
                if held is not None:
                    yield joined(held, part)
                held = part
        if held is not None:
            yield joined(held, None)

    def joined(rows: pa.RecordBatch, after: pa.RecordBatch | None) -> pa.RecordBatch:
        ahead = []
        for c in names:
            own = rows.column(c)
            ahead.append(pa.concat_arrays([own.slice(1), pa.nulls(1, own.type) if after is None else after.column(c).slice(0, 1)]))
        return pa.RecordBatch.from_arrays([*rows.columns, *ahead], [*rows.schema.names, *[f"_next_{c}" for c in names]])

    return beside


def following(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "seq", span: int = SPAN, ahead: Sequence[str] | None = None,
    kept: Sequence[str] | None = None,
) -> DataFrame:
    """``by, name, f, g``: every row ``f`` with the next row ``g`` of its group; ``name`` is the place of ``f``.

    Places count over the whole table, by group and then by ``order``. Ranges of the order are paired where
    they are sorted, ``span`` rows at a time, and the first row of a range ends the one before. Rows with
    a null in ``by`` belong to no group. ``ahead`` names the columns that ``g`` needs, ``kept`` those of ``f``, all
    others if absent.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    by = list(by)
    rest = [c for c in df.columns if c not in by]
    ahead = rest if ahead is None else list(ahead)
    order = [*by, *[c for c in order if c not in by]]
    known = df.where(" and ".join(f"`{c}` is not null" for c in by))
    if kept is not None:
        rest = [c for c in rest if c in kept]
    used = {*by, *rest, *ahead}
    while order[-1] not in used and used <= {*order}:  # rows equal in all that is used may stand in any order
        order.pop()
    taken = [*by, *ahead]
    ranged = known.repartitionByRange(*order).sortWithinPartitions(*order).select(
        *by, *[c for c in known.columns if c not in by and (c in rest or c in ahead)]).withColumn("_id", F.monotonically_increasing_id())
    after = [T.StructField(f"_next_{c}", df.schema[c].dataType) for c in taken]
    beside = ranged.mapInArrow(_beside(taken, span), T.StructType([*ranged.schema.fields, *after]))
    part, row = F.shiftright("_id", ROW_BITS), F.col("_id").bitwiseAND((1 << ROW_BITS) - 1)
    same = reduce(Column.__and__, [F.col(f"_next_{c}") == F.col(c) for c in by])
    # the last row of a range meets its next row later; the last of a group has none and need not be written
    placed = materialize(
        beside.withColumn("_same", same).where(F.coalesce("_same", F.lit(True)) | (row == 0)).drop(*[f"_next_{c}" for c in by]), "ordered", "zstd")
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_rows"))
    firsts = placed.where(row == 0).select(part.alias("_part"), F.struct(*taken).alias("_first"))
    # one row per range
    places = Window.orderBy("_part")
    ranges = F.broadcast(sizes.join(firsts, "_part").select(
        "_part", "_rows", F.lead("_first").over(places).alias("_after"),
        F.coalesce(F.sum("_rows").over(places.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before")))
    last = row == F.col("_rows") - 1

    def then(c: str) -> Column:
        return F.when(last, F.col(f"_after.{c}")).otherwise(F.col(f"_next_{c}"))

    joins = reduce(Column.__and__, [F.col(f"_after.{c}") == F.col(c) for c in by])
    paired = placed.withColumn("_part", part).join(ranges, "_part").where(F.when(last, joins).otherwise(F.col("_same")))
    return paired.select(
        *by, (F.col("_before") + row).alias(name), F.struct(*rest).alias("f"), F.struct(*[then(c).alias(c) for c in ahead]).alias("g"))
