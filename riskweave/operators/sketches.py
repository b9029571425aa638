"""Mergeable sketches: Bloom, sliding count (exact and DGIM), Flajolet-Martin, reservoir.

Every sketch is an aggregate, so tasks reduce their rows before the shuffle and partial
results merge in any order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import HIGH_RISK_LIMIT, col_of, high_risk_flag
from riskweave.functions.hashing import base31, coefficients, linear_hash, order_key, pair56
from riskweave.operators.skew import ROWS_PER_SPLIT, split_join
from riskweave.session import materialize

# Default sizes of the sketches.
BLOOM_BITS, BLOOM_HASHES = 10_000, 5
FM_HASHES = 10
WINDOW = 1_000
RESERVOIR = 100
# Bits up to which a filter is sent to every task (1 MB); bigger ones meet the keys in a join.
SENT_BITS = 1 << 23
# Fixed value: Flajolet-Martin correction factor.
PHI = 0.77351


def edge_key(src: str = "source_id", dst: str = "target_id") -> Column:
    return F.concat_ws("-", F.col(src).cast("string"), F.col(dst).cast("string"))


# -- Bloom filter -----------------------------------------------------------------------

def bloom_positions(key: Column, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, kind: str = "xx") -> Column:
    """The ``k`` bit positions of a key by double hashing."""
    return _positions(*pair56(key, kind), m, k)


def _positions(first: Column, second: Column, m: int, k: int) -> Column:
    return F.array(*[F.pmod(first + F.lit(i) * second, F.lit(m)) for i in range(k)])


def bloom_build(
    df: DataFrame, key: Column | str, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, kind: str = "xx",
) -> DataFrame:
    """Set-bit table of the filter: one row per set position, at most ``m`` rows.

    Merging filters is ``union`` and ``distinct``.
    """
    first, second = pair56(col_of(key), kind)
    hashed = df.where(col_of(key).isNotNull()).select(first.alias("_first"), second.alias("_second"))
    return hashed.select(F.explode(_positions(F.col("_first"), F.col("_second"), m, k)).alias("bit")).distinct()


def bloom_pack(bits: DataFrame) -> DataFrame:
    """Stored form of the filter: 4 KiB bitmaps by bucket number."""
    return bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bitmap"))


def bloom_contains(
    df: DataFrame, key: Column | str, bits: DataFrame,
    m: int = BLOOM_BITS, k: int = BLOOM_HASHES, kind: str = "xx",
) -> DataFrame:
    """Each distinct key with ``maybe_present``: true when all its bits are set."""
    keys = df.select(col_of(key).alias("key")).where("key is not null").distinct()
    if m <= SENT_BITS:
        first, second = pair56(F.col("key"), kind)
        asked = keys.select("key", first.alias("_first"), second.alias("_second"))
        words = bit_words(bits, m).scalar()
        at = [F.pmod(F.col("_first") + F.lit(i) * F.col("_second"), F.lit(m)) for i in range(k)]
        has = [F.call_function("shiftrightunsigned", F.get(words, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1 for bit in at]
        return asked.select("key", reduce(Column.__and__, has).alias("maybe_present"))
    probes = keys.select("key", F.explode(bloom_positions(F.col("key"), m, k, kind)).alias("bit"))
    hits = probes.join(bits.select("bit", F.lit(True).alias("set")), "bit", "left")
    return hits.groupBy("key").agg(
        F.bool_and(F.coalesce("set", F.lit(False))).alias("maybe_present"))


def bit_words(bits: DataFrame, m: int) -> DataFrame:
    """The set-bit table of a small filter as one row: ``_words``, 64 bits in each, ``m / 8`` bytes in all."""
    place = F.shiftright("bit", 6)
    masks = bits.select(place.alias("_word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("_mask"))
    every = bits.sparkSession.range(-(-m // 64)).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_mask"))
    merged = masks.unionByName(every).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    listed = merged.agg(F.array_sort(F.collect_list(F.struct("_word", "_mask"))).alias("_all"))
    return listed.select(F.col("_all._mask").alias("_words"))


def bloom_stats(
    df: DataFrame, key: Column | str, m: int = BLOOM_BITS, k: int = BLOOM_HASHES, kind: str = "xx",
) -> DataFrame:
    """Size, distinct items added, set bits, fill rate and expected false positive rate."""
    bits = bloom_build(df, key, m, k, kind)
    n = df.agg(F.count_distinct(col_of(key))).scalar()
    counted = bits.agg(F.count("*").alias("bits_set")).select("bits_set", n.alias("items_added"))
    miss = F.lit(1.0) - F.exp(F.lit(-float(k)) * F.col("items_added") / F.lit(m))
    return counted.select(
        F.lit(m).cast("bigint").alias("size"), F.lit(k).cast("bigint").alias("hash_count"),
        "items_added", "bits_set", (F.col("bits_set") / F.lit(m)).alias("fill_rate"),
        F.when(F.col("items_added") == 0, F.lit(0.0)).otherwise(F.pow(miss, F.lit(k)))
        .alias("estimated_fpr"),
    )


def bloom_size(expected_items: int, false_positive_rate: float) -> tuple[int, int]:
    """Bits and hash count that hold the wanted rate."""
    m = math.ceil(-expected_items * math.log(false_positive_rate) / math.log(2) ** 2)
    return m, max(1, round(m / max(expected_items, 1) * math.log(2)))


# -- Bloom filter in parts --------------------------------------------------------------

# Fixed value: bits of a part, the size of Spark's bitmaps.
PART_BITS = 32_768


def part_plan(expected_items: int, false_positive_rate: float) -> tuple[int, int]:
    """Parts and hash count of a filter that holds the wanted rate; about half of its bits get set."""
    bits = math.ceil(-max(1, expected_items) * math.log(false_positive_rate) / math.log(2) ** 2)
    return -(-bits // PART_BITS), max(1, round(-math.log2(false_positive_rate)))


def part_of_key(key: Column, parts: int, kind: str = "xx") -> Column:
    return F.pmod(pair56(key, kind)[0], F.lit(parts)).alias("part")


def part_positions(key: Column, parts: int, k: int, kind: str = "xx") -> Column:
    """The ``k`` bits of a key inside its part, by double hashing with an odd step."""
    return F.array(*_in_part(*pair56(key, kind), parts, k))


def _in_part(first: Column, second: Column, parts: int, k: int) -> list[Column]:
    start, step = F.call_function("div", first, F.lit(parts).cast("bigint")), F.lit(2) * second + F.lit(1)
    return [F.pmod(start + F.lit(i) * step, F.lit(PART_BITS)).cast("int") for i in range(k)]


def part_words(placed: DataFrame, by: Sequence[str], bits: str = "bits") -> DataFrame:
    """A bitmap of each group as an array of 64-bit ``words``; ``bits`` lists the bits a row sets.

    Tasks set the bits of their own rows before the shuffle.
    """
    packed = placed.select(*by, F.explode(bits).alias("_bit")).groupBy(*by).agg(F.bitmap_construct_agg(F.col("_bit")).alias("_map"))
    eight = F.transform(F.sequence(F.lit(0), F.lit(PART_BITS // 64 - 1)), lambda i: F.conv(F.hex(F.substring("_map", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    return packed.select(*by, eight.alias("words"))


def all_set(words: Column, bits: Column) -> Column:
    """Whether a bitmap has every one of the bits; false without a bitmap."""
    return F.coalesce(F.forall(bits, lambda bit: _is_set(words, bit)), F.lit(False))


def _is_set(words: Column, bit: Column) -> Column:
    # eight bytes read as one number: the first byte is the highest
    place = F.lit(56) - F.shiftright(bit, 3).bitwiseAND(7) * 8 + bit.bitwiseAND(7)
    return F.call_function("shiftrightunsigned", F.get(words, F.shiftright(bit, 6)), place).bitwiseAND(1) == 1


def either(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.bitwiseOR(y))


def part_filter(df: DataFrame, key: Column | str, parts: int, k: int, kind: str = "xx") -> DataFrame:
    """Bloom filter as a table ``part, words``: 4 KiB for each part that holds a key.

    The hashes of distinct keys meet by part before any bitmap is made, so each part is filled once.
    """
    first, second = pair56(col_of(key), kind)
    hashed = df.where(col_of(key).isNotNull()).select(first.alias("_first"), second.alias("_second")).distinct()
    placed = hashed.select(F.pmod("_first", F.lit(parts)).alias("part"), "_first", "_second").repartition("part")
    return part_words(placed.select("part", F.array(*_in_part(F.col("_first"), F.col("_second"), parts, k)).alias("bits")), ["part"])


def part_contains(df: DataFrame, key: Column | str, filled: DataFrame, parts: int, k: int, kind: str = "xx") -> DataFrame:
    """Each distinct key with ``maybe_present``; a key meets its own part only."""
    keys = df.select(col_of(key).alias("key")).where("key is not null").distinct()
    first, second = pair56(F.col("key"), kind)
    asked = keys.select("key", first.alias("_first"), second.alias("_second")).withColumn("part", F.pmod("_first", F.lit(parts)))
    has = [_is_set(F.col("words"), bit) for bit in _in_part(F.col("_first"), F.col("_second"), parts, k)]
    return asked.join(filled, "part", "left").select("key", F.coalesce(reduce(Column.__and__, has), F.lit(False)).alias("maybe_present"))


def part_fill(filled: DataFrame) -> DataFrame:
    """``part, bits_set`` of a filter."""
    return filled.select("part", F.aggregate("words", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w)).alias("bits_set"))


def counted_filter(df: DataFrame, key: Column | str, false_positive_rate: float = 0.01, kind: str = "xx") -> tuple[DataFrame, int, int]:
    """A filter sized by the number of distinct keys, with its number of parts and hashes.

    The distinct keys are counted and hashed from one written table, so that ``df`` is read once.
    """
    keys = materialize(df.select(col_of(key).alias("key")).where("key is not null").distinct(), "keys", "zstd")
    parts, k = part_plan(keys.count(), false_positive_rate)
    return part_filter(keys, "key", parts, k, kind), parts, k


def bloom_dedupe(
    df: DataFrame, key: Column | str, seq: str, rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Flag rows whose key was seen earlier in ``seq`` order; exact, no false positives.

    The first position of a key is a partial aggregate and is joined back in parts, so a key
    with a third of all rows never meets in one task.
    """
    keyed = df.withColumn("_key", col_of(key))
    first = keyed.where("_key is not null").groupBy("_key").agg(F.min(seq).alias("_first"))
    joined = split_join(keyed, first, ["_key"], rows_per_split, "left")
    return joined.withColumn(
        "is_duplicate", F.coalesce(F.col(seq) > F.col("_first"), F.lit(False))).drop("_key", "_first")


# -- ordered counts ---------------------------------------------------------------------

def running_counts(
    df: DataFrame, bit: Column | str, seq: str, by: Sequence[str] = (), span: int = 1_000_000,
) -> DataFrame:
    """Add ``pos`` (row number) and ``ones`` (running sum of ``bit``) in ``seq`` order.

    ``seq`` is a unique whole number. Rows are cut into chunks of ``span`` sequence numbers;
    each chunk is numbered alone and shifted by the totals of the chunks before it. A
    shard that holds most rows is thus spread over many tasks.
    """
    by = list(by)
    from pyspark.sql import Window

    chunked = df.withColumns({
        "_bit": F.coalesce(col_of(bit).cast("bigint"), F.lit(0).cast("bigint")),
        "_chunk": F.floor(F.col(seq) / F.lit(span)),
    })
    totals = chunked.groupBy(*by, "_chunk").agg(
        F.count("*").alias("_rows"), F.sum("_bit").alias("_set"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(
        *by, "_chunk",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_set").over(before), F.lit(0)).alias("_set_before"))
    within = Window.partitionBy(*by, "_chunk").orderBy(seq)
    numbered = chunked.withColumns({
        "_rn": F.row_number().over(within), "_cum": F.sum("_bit").over(within)})
    return numbered.join(shift, [*by, "_chunk"]).withColumns({
        "pos": F.col("_rows_before") + F.col("_rn"),
        "ones": F.col("_set_before") + F.col("_cum"),
    }).drop("_chunk", "_rn", "_cum", "_rows_before", "_set_before")


def trailing_ones(
    df: DataFrame, bit: Column | str, seq: str, window: int = WINDOW,
    by: Sequence[str] = (), span: int = 1_000_000,
) -> DataFrame:
    """Exact number of ones in the last ``window`` items at every item.

    The difference of two running sums, met by an equi-join on the position, so the cost
    does not grow with the window.
    """
    by = list(by)
    counted = running_counts(df, bit, seq, by, span)
    earlier = counted.select(*by, (F.col("pos") + F.lit(window)).alias("pos"), F.col("ones").alias("_old"))
    return counted.join(earlier, [*by, "pos"], "left").select(
        *by, F.col(seq), "pos", F.col("_bit").alias("bit"),
        (F.col("ones") - F.coalesce("_old", F.lit(0))).alias("ones_in_window"))


def bucket_starts(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Buckets after ``total_ones`` ones: (shard, bucket_size, ones), the newest one of each.

    With one or two buckets per size, the sizes are the digits of the count in the base-2
    system with digits 1 and 2, so they follow from the count alone.
    """
    n = F.col("total_ones")
    sized = totals.where(n > 0).select(
        *by, "total_ones", F.explode(F.sequence(F.lit(0), F.length(F.bin(n + 1)) - 2)).alias("_level"))
    one, size = F.lit(1).cast("bigint"), F.expr("shiftleft(1L, _level)")
    # Ones in all smaller buckets.
    newer = F.pmod(n + one, size) + size - one
    return sized.select(
        *by, "total_ones", size.alias("bucket_size"), newer.alias("_newer"),
        F.explode(F.sequence(F.lit(0), F.expr("cast(shiftright(total_ones + 1L, _level) & 1L as int)"))).alias("_j"),
    ).select(*by, "bucket_size", (n - F.col("_newer") - F.col("_j") * F.col("bucket_size")).alias("ones"))


def dgim(
    df: DataFrame, bit: Column | str, seq: str, window: int = WINDOW,
    by: Sequence[str] = (), span: int = 1_000_000,
) -> DataFrame:
    """Exponential-bucket state after the whole stream: (shard, bucket_size, bucket_end).

    The state is a join of the ones with the few that end a bucket; no row is replayed in
    order. Buckets that ended ``window`` or more items ago are expired.
    """
    by = list(by)
    counted = running_counts(df, bit, seq, by, span)
    totals = counted.groupBy(*by).agg(
        F.max("pos").alias("current_time"), F.max("ones").alias("total_ones"))
    ends = counted.where("_bit = 1").select(*by, "ones", F.col("pos").alias("bucket_end"))
    found = ends.join(bucket_starts(totals, by), [*by, "ones"])
    if by:
        timed = found.join(totals.select(*by, "current_time"), by)
    else:
        timed = found.withColumn("current_time", totals.select("current_time").scalar())
    return timed.where(F.col("bucket_end") > F.col("current_time") - F.lit(window)).select(
        *by, "bucket_size", "bucket_end", "current_time")


def dgim_stats(state: DataFrame, window: int = WINDOW, by: Sequence[str] = ()) -> DataFrame:
    """Buckets held and the estimate: all of them less half of the oldest."""
    oldest = F.max("bucket_size")
    return state.groupBy(*by).agg(
        F.lit(window).cast("bigint").alias("window_size"), F.max("current_time").alias("current_time"),
        F.count("*").alias("num_buckets"),
        F.coalesce(F.sum("bucket_size") - F.floor(oldest / 2), F.lit(0)).cast("bigint").alias("estimated_count"))


# -- distinct count ---------------------------------------------------------------------

def trailing_zeros(h: Column) -> Column:
    """Zero bits below the lowest set bit; zero itself counts as one."""
    return F.when(h == 0, F.lit(1)).otherwise(F.bit_count(h.bitwiseAND(-h) - F.lit(1)))


def fm_registers(
    df: DataFrame, col: Column | str, h: int = FM_HASHES, kind: str = "xx", seed: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Largest trailing-zero count per hash function, as one array; merge by maximum."""
    base = df.where(col_of(col).isNotNull()).select(*by, base31(col_of(col), kind).alias("_base"))
    aggs = [
        F.max(trailing_zeros(linear_hash(F.col("_base"), a, b))).alias(f"r{i}")
        for i, (a, b) in enumerate(coefficients(h, seed))
    ]
    return base.groupBy(*by).agg(*aggs).select(
        *by, F.array(*[F.coalesce(f"r{i}", F.lit(0)) for i in range(h)]).alias("max_trailing_zeros"))


def fm_estimate(registers: Column, h: int = FM_HASHES) -> Column:
    """Upper median of 2^R over the correction factor, rounded down."""
    middle = F.element_at(F.array_sort(registers), h // 2 + 1)
    return F.floor(F.pow(F.lit(2.0), middle) / F.lit(PHI)).cast("bigint")


def fm_distinct(
    df: DataFrame, col: Column | str, h: int = FM_HASHES, kind: str = "xx", seed: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    return fm_registers(df, col, h, kind, seed, by).withColumn(
        "estimated_cardinality", fm_estimate(F.col("max_trailing_zeros"), h))


# -- uniform sample ---------------------------------------------------------------------

def reservoir(df: DataFrame, row_id: Sequence[str], k: int = RESERVOIR, seed: int = 0) -> DataFrame:
    """Uniform ``k``-sample: the rows with the smallest seeded hash of their unique id.

    Samples of two parts merge by taking the smallest ``k`` of their union.
    """
    ids = [F.col(c) for c in row_id]
    return df.orderBy(order_key(seed, *ids), *ids).limit(k)


def reservoir_stats(df: DataFrame, k: int = RESERVOIR) -> DataFrame:
    counted = df.agg(F.count("*").alias("items_processed"))
    n = F.col("items_processed")
    return counted.select(
        F.lit(k).cast("bigint").alias("reservoir_size"), "items_processed",
        F.least(n, F.lit(k)).cast("bigint").alias("current_sample_size"),
        F.when(n > 0, F.lit(float(k)) / n).otherwise(F.lit(0.0)).alias("sampling_probability"))


# -- summary ----------------------------------------------------------------------------

def stream_summary(
    edges: DataFrame, key: Column | str, weight: Column | str = "weight", limit: float = HIGH_RISK_LIMIT,
) -> DataFrame:
    """Rows processed, exact duplicates by key, rows above the weight limit."""
    per_key = edges.groupBy(col_of(key).alias("_key")).agg(
        F.count("*").alias("n"), F.count_if(high_risk_flag(weight, limit)).alias("high"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("edges_processed"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates_detected"),
        F.coalesce(F.sum("high"), F.lit(0)).cast("bigint").alias("high_risk_edges"))


def edge_stream_report(edges: DataFrame, seq: str, limit: float = HIGH_RISK_LIMIT, kind: str = "xx") -> DataFrame:
    """All sketch statistics of an edge stream as one nested row."""
    flag = high_risk_flag("weight", limit)

    def one(df):
        return df.select(F.struct("*")).scalar()

    key = edge_key()
    # Without any one in the window there is no bucket to tell the time.
    sliding = dgim_stats(dgim(edges, flag, seq)).withColumn(
        "current_time", edges.agg(F.count("*")).scalar())
    return reservoir_stats(edges).select(F.struct("*").alias("reservoir")).select(
        one(bloom_stats(edges, key, kind=kind)).alias("bloom_filter"),
        one(sliding).alias("dgim"),
        one(fm_distinct(edges, "source_id", kind=kind)).alias("flajolet_martin_src"),
        one(fm_distinct(edges, "target_id", kind=kind)).alias("flajolet_martin_dst"),
        "reservoir",
        one(stream_summary(edges, key, "weight", limit)).alias("summary"),
    )
