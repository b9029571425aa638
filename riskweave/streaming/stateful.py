"""Stateful stream operators: duplicates, sliding count, distinct count, uniform sample."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskweave.functions.columns import col_of
from riskweave.functions.hashing import base31, coefficients, linear_hash, order_key
from riskweave.operators.sketches import (
    FM_HASHES, PART_BITS, RESERVOIR, WINDOW, all_set, bucket_starts, either, fm_estimate, part_of_key, part_plan,
    part_positions, part_words, running_counts, trailing_zeros,
)
from riskweave.sources.writers import child_names
from riskweave.streaming import deltas
from riskweave.streaming.deltas import MERGE_EVERY


def version(batch_id: int) -> str:
    return f"v={batch_id:012d}"


def latest_version(spark: SparkSession, directory: str, before: int | None = None) -> str | None:
    """Path of the newest complete state, of a batch below ``before`` when given.

    A state is written from an earlier one under its own number, so a batch that runs again
    after a failure gives the same state.
    """
    names = sorted(n for n in child_names(spark, directory) if n.startswith("v="))
    for name in reversed(names):
        if (before is None or name < version(before)) and "_SUCCESS" in child_names(spark, f"{directory}/{name}"):
            return f"{directory}/{name}"
    return None


def drop_older(spark: SparkSession, directory: str, batch_id: int, keep: int = 2) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(directory).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in child_names(spark, directory):
        if name.startswith("v=") and name <= version(batch_id - keep):
            fs.delete(path(f"{directory}/{name}"), True)


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")
    return writer.start()


def stream_dedupe(
    stream: DataFrame, keys: Sequence[str], ts: str | None = None, delay: str | None = None,
) -> DataFrame:
    """First sight of every key; with ``ts`` and ``delay`` the state is bounded.

    A timestamp without zone cannot carry a watermark and is cast.
    """
    if ts is None:
        return stream.dropDuplicates(list(keys))
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


# -- approximate duplicates in bounded state ----------------------------------------------

def bloom_merge(rows: DataFrame) -> DataFrame:
    """Filters of equal generation as one; generations before the last two of a part are forgotten."""
    none = F.array_repeat(F.lit(0).cast("bigint"), PART_BITS // 64)
    whole = rows.groupBy("part", "generation").agg(
        F.sum("added").alias("added"), F.reduce(F.collect_list("words"), none, either).alias("words"))
    newest = whole.groupBy("part").agg(F.max("generation").alias("_newest"))
    return whole.join(newest, "part").where(F.col("generation") >= F.col("_newest") - 1).drop("_newest")


def bloom_batch(
    state: DataFrame | None, batch: DataFrame, key: Column | str, seq: str, parts: int, capacity: int, k: int, kind: str = "xx",
) -> tuple[DataFrame, DataFrame]:
    """First sights in a batch, and what they add to the state ``part, generation, added, words``.

    Keys of a batch are reduced to their first row before anything else, so a key with most of the
    rows costs one row per task. New keys of a part are numbered on from those it has; each
    ``capacity`` of them fill one generation. A key is known if the newest or the
    last full generation of its part holds it.
    """
    keyed = batch.withColumn("_key", col_of(key)).where("_key is not null")
    first = keyed.groupBy("_key").agg(F.min_by(F.struct(*batch.columns), seq).alias("_row"), F.min(seq).alias("_seq"))
    asked = first.select(part_of_key(F.col("_key"), parts, kind), part_positions(F.col("_key"), parts, k, kind).alias("bits"), "_seq", "_row")
    if state is None:
        fresh = asked.withColumn("_had", F.lit(0).cast("bigint"))
    else:
        # at most two generations of a part
        held = state.groupBy("part").agg(
            F.collect_list("words").alias("_held"), F.max(F.col("generation") * capacity + F.col("added")).alias("_had"))
        met = asked.join(held, "part", "left")
        known = F.coalesce(F.exists("_held", lambda words: all_set(words, F.col("bits"))), F.lit(False))
        fresh = met.where(~known).withColumn("_had", F.coalesce("_had", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("part").orderBy("_seq", F.xxhash64("_row")))
    fresh = fresh.withColumn("generation", F.call_function("div", F.col("_had") + place - 1, F.lit(capacity).cast("bigint")))
    newest = F.max("generation").over(Window.partitionBy("part"))
    lasting = fresh.withColumn("_newest", newest).where(F.col("generation") >= F.col("_newest") - 1)
    added = lasting.groupBy("part", "generation").agg(F.count("*").alias("added"))
    delta = part_words(lasting, ["part", "generation"]).join(added, ["part", "generation"]).select("part", "generation", "added", "words")
    return fresh.select("_row.*"), delta


def run_stream_bloom(
    stream: DataFrame, key: Column | str, seq: str, state_dir: str, out_dir: str, checkpoint: str,
    expected_items: int, false_positive_rate: float = 0.01, kind: str = "xx", once: bool = True, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """First sight of every key with a state of fixed size: a Bloom filter in parts, in generations.

    The state never exceeds two generations of ``expected_items`` keys at about ten bits a key for
    one per cent, whatever the stream's length. At least the last ``expected_items`` keys (spread
    evenly over the parts) are remembered; an older key may be passed again. A new key is
    withheld with at most ``false_positive_rate``, half of it for each generation.
    First sights are appended to ``out_dir``, one folder per batch; a batch that runs again after a
    failure replaces its folder and its part of the state.
    """
    spark = stream.sparkSession
    parts, k = part_plan(expected_items, false_positive_rate / 2)
    capacity = -(-expected_items // parts)

    def write(batch: DataFrame, batch_id: int) -> None:
        state = deltas.read(spark, state_dir, bloom_merge, batch_id - 1)
        fresh, delta = bloom_batch(state, batch, key, seq, parts, capacity, k, kind)
        fresh.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id:012d}")
        deltas.put(spark, delta, batch_id, state_dir, bloom_merge, merge_every)

    return _start(stream, write, checkpoint, once)


def first_sights(spark: SparkSession, out_dir: str) -> DataFrame:
    """All rows passed so far."""
    return spark.read.parquet(out_dir).drop("batch")


# -- sliding count ------------------------------------------------------------------------

def add_dgim_batch(
    state: DataFrame | None, batch: DataFrame, bit: Column | str, seq: str, by: Sequence[str],
    window: int = WINDOW, span: int = 1_000_000,
) -> DataFrame:
    """Bucket state after one more batch, whose items follow all earlier ones.

    State rows are (shard, current_time, total_ones, bucket_size, ones, bucket_end): one per
    bucket, or one without a bucket. Merging keeps the newer end of two buckets, so every new
    bucket ends at an old end or at a one of the batch. The batch is numbered in chunks and
    joined with the few ends; no shard is replayed in one task.
    """
    by = list(by)
    counted = running_counts(batch, bit, seq, by, span).select(*by, "pos", "ones", F.col("_bit").alias("bit"))
    added = counted.groupBy(*by).agg(F.max("pos").alias("current_time"), F.max("ones").alias("total_ones"))
    fresh = counted.where("bit = 1").select(*by, "ones", F.col("pos").alias("bucket_end"))
    if state is None:
        totals, ends = added, fresh
    else:
        past = state.groupBy(*by).agg(
            F.max("current_time").alias("_now"), F.max("total_ones").alias("_n"))
        moved = fresh.join(past, by, "left").select(
            *by, (F.col("ones") + F.coalesce("_n", F.lit(0))).alias("ones"),
            (F.col("bucket_end") + F.coalesce("_now", F.lit(0))).alias("bucket_end"))
        ends = moved.unionByName(state.where("ones is not null").select(*by, "ones", "bucket_end"))
        totals = added.unionByName(past.select(
            *by, F.col("_now").alias("current_time"), F.col("_n").alias("total_ones"))
        ).groupBy(*by).agg(F.sum("current_time").alias("current_time"), F.sum("total_ones").alias("total_ones"))
    buckets = ends.join(bucket_starts(totals, by), [*by, "ones"])
    alive = totals.join(buckets, by).where(F.col("bucket_end") > F.col("current_time") - F.lit(window))
    return totals.join(
        alive.select(*by, "bucket_size", "ones", "bucket_end"), by, "left")


def newest_of(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of every shard the rows that its last batch wrote."""
    last = rows.groupBy(*by).agg(F.max("version").alias("version"))
    return rows.join(last, [*by, "version"], "left_semi")


def run_stream_dgim(
    stream: DataFrame, bit: Column | str, seq: str, by: Sequence[str], state_dir: str, checkpoint: str,
    window: int = WINDOW, span: int = 1_000_000, once: bool = True, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Approximate ones among the last ``window`` items of every shard.

    Items count in order of arrival: by batch, and by ``seq`` inside one. A batch reads and writes
    the buckets of the shards it touches; the others stay where they are.
    """
    spark: SparkSession = stream.sparkSession
    by = list(by)

    def merge(rows: DataFrame) -> DataFrame:
        return newest_of(rows, by)

    def write(batch: DataFrame, batch_id: int) -> None:
        state = deltas.read(spark, state_dir, merge, batch_id - 1)
        batch = batch.persist()
        if state is not None:
            state = state.drop("version").join(batch.select(*by).distinct(), by, "left_semi")
        delta = add_dgim_batch(state, batch, bit, seq, by, window, span).withColumn("version", F.lit(batch_id).cast("bigint"))
        deltas.put(spark, delta, batch_id, state_dir, merge, merge_every)
        batch.unpersist()

    return _start(stream, write, checkpoint, once)


def stream_dgim_state(spark: SparkSession, state_dir: str, by: Sequence[str]) -> DataFrame:
    """Newest bucket state; ``dgim_stats`` of its rows with a bucket gives the estimates."""
    return deltas.read(spark, state_dir, lambda rows: newest_of(rows, by)).drop("version")


def stream_distinct(stream: DataFrame, col: str, h: int = FM_HASHES, kind: str = "xx", seed: int = 0) -> DataFrame:
    """Running distinct counts: Flajolet-Martin registers and the built-in sketch."""
    base = stream.where(F.col(col).isNotNull()).select(F.col(col), base31(F.col(col), kind).alias("_base"))
    maxima = [
        F.max(trailing_zeros(linear_hash(F.col("_base"), a, b))).alias(f"r{i}")
        for i, (a, b) in enumerate(coefficients(h, seed))]
    counted = base.groupBy().agg(*maxima, F.approx_count_distinct(col).alias("approx_distinct"))
    registers = F.array(*[F.coalesce(f"r{i}", F.lit(0)) for i in range(h)])
    return counted.select(
        registers.alias("max_trailing_zeros"), fm_estimate(registers, h).alias("estimated_cardinality"),
        "approx_distinct")


def run_stream_reservoir(
    stream: DataFrame, row_id: Sequence[str], state_dir: str, checkpoint: str,
    k: int = RESERVOIR, seed: int = 0, once: bool = True,
) -> StreamingQuery:
    """Running uniform sample: the ``k`` rows with the smallest seeded hash so far.

    State never exceeds ``k`` rows; ``row_id`` is unique in the stream.
    """
    spark: SparkSession = stream.sparkSession
    ids = [F.col(c) for c in row_id]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = latest_version(spark, state_dir, batch_id)
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(before)) if before else batch
        rows.orderBy(order_key(seed, *ids), *ids).limit(k).write.mode("overwrite").parquet(f"{state_dir}/{version(batch_id)}")
        drop_older(spark, state_dir, batch_id)

    return _start(stream, write, checkpoint, once)
