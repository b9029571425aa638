"""Exact handling of keys that hold a large share of a table.

A join key with ``n`` rows is cut into ``ceil(n / rows_per_split)`` parts. The heavy side
picks its part by a hash of its own row, the other side is repeated once per part. Keys that
need more than one part number at most ``rows / rows_per_split``, so that table stays small
whatever the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize

# Rows of one key that a single task should handle.
ROWS_PER_SPLIT = 1_000_000
# Pairs of rows of one key that a single task should make.
PAIRS_PER_CELL = 10_000_000
# Most heavy keys that are sent to every task.
SENT_KEYS = 1_000_000


def part_of(n_parts: Column, *row: Column) -> Column:
    """Part in ``[0, n_parts)`` for a row of the heavy side."""
    return F.pmod(F.xxhash64(*row), n_parts).cast("int")


def all_parts(n_parts: Column) -> Column:
    """Every part of a key, for the side that is repeated."""
    return F.explode(F.sequence(F.lit(0), n_parts - 1))


def heavy_keys(df: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys above ``rows_per_split`` rows with the number of parts they need."""
    return (
        df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows_per_split)
        .select(*keys, F.ceil(F.col("_n") / rows_per_split).cast("int").alias("_parts"))
    )


def split_join(
    heavy: DataFrame, other: DataFrame, keys: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT, how: str = "inner", hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose heavy keys are spread over several tasks.

    ``how`` is from the view of ``heavy``: ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("the repeated side cannot be kept: use inner or left")
    if hot is None:
        hot = materialize(heavy_keys(heavy, keys, rows_per_split), "heavy")
    hot = sent(hot)
    own = [c for c in heavy.columns if c not in keys] or list(keys)

    def with_parts(df):
        joined = df.join(hot, list(keys), "left")
        return joined.withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    left = with_parts(heavy).withColumn("_part", part_of(F.col("_parts"), *[F.col(c) for c in own]))
    right = with_parts(other).withColumn("_part", all_parts(F.col("_parts")))
    return left.drop("_parts").join(right.drop("_parts"), [*keys, "_part"], how).drop("_part")


def sent(hot: DataFrame) -> DataFrame:
    """A table of heavy keys, broadcast if it is small: joined by shuffle, they would be heavy again."""
    return F.broadcast(hot) if hot.count() <= SENT_KEYS else hot


def grid_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """``_across`` and ``_down``: parts of either side for keys with more than ``pairs_per_cell`` pairs of rows.

    The sides are cut in proportion to their rows, which copies the fewest.
    """
    n, m = F.col("_n").cast("double"), F.col("_m").cast("double")
    sizes = left.groupBy(*keys).agg(F.count("*").alias("_n")).join(right.groupBy(*keys).agg(F.count("*").alias("_m")), list(keys))
    big = sizes.withColumn("_cells", F.ceil(n * m / pairs_per_cell)).where("_cells > 1")
    across = F.least(F.col("_n"), F.ceil(F.sqrt(F.col("_cells") * n / m))).cast("int")
    cut = big.withColumn("_across", F.greatest(across, F.lit(1)))
    return cut.withColumn("_down", F.least(F.col("_m"), F.ceil(F.col("_cells") / F.col("_across"))).cast("int")).select(*keys, "_across", "_down")


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """Inner equi-join for keys that may be heavy on both sides.

    The pairs of a heavy key form a grid: rows of one side choose a column by hash and are copied
    to its rows, those of the other side the reverse, so that a cell makes about ``pairs_per_cell``
    pairs. Keys without a partner are not copied. Equal rows share a part, which keeps the choice the
    same when a lost task runs again: count them before the join.
    """
    hot = materialize(grid_keys(left, right, keys, pairs_per_cell), "grid")
    if hot.isEmpty():
        return left.join(right, list(keys))
    hot = sent(hot)

    def placed(df: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        rest = [F.col(c) for c in df.columns if c not in keys] or [F.col(c) for c in keys]
        joined = df.join(hot, list(keys), "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in (own, other)})
        chosen = part_of(F.col(own), *rest)
        return joined.withColumn(mine, chosen).withColumn(theirs, all_parts(F.col(other))).drop(own, other)

    return placed(left, "_across", "_down", "_i", "_j").join(placed(right, "_down", "_across", "_j", "_i"), [*keys, "_i", "_j"]).drop("_i", "_j")


def sized_join(
    heavy: DataFrame, other: DataFrame, keys: Sequence[str],
    rows_per_split: int = ROWS_PER_SPLIT, how: str = "inner",
) -> DataFrame:
    """``split_join`` when a key is heavy, a plain join when none is; counts the keys first."""
    hot = materialize(heavy_keys(heavy, keys, rows_per_split), "heavy")
    if hot.isEmpty():
        return heavy.join(other, list(keys), how)
    return split_join(heavy, other, keys, rows_per_split, how, hot)
