"""Stream state that stays small: filters in generations, and deltas of the shards a batch touches."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from riskweave.operators import sketches
from riskweave.sources import readers
from riskweave.sources.writers import child_names
from riskweave.streaming import deltas, stateful


def test_filter_in_parts_follows_the_number_of_keys(spark):
    for n in (1, 500, 60_000):
        df = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
        filled, parts, k = sketches.counted_filter(df.union(df), "key", 0.01)
        assert parts == math.ceil(n * -math.log(0.01) / math.log(2) ** 2 / sketches.PART_BITS) and k == 7
        assert sketches.part_contains(df, "key", filled, parts, k).where("not maybe_present").count() == 0
    fill = sketches.part_fill(filled).collect()
    assert len(fill) == parts and abs(sum(r.bits_set for r in fill) / parts / sketches.PART_BITS - 0.5) < 0.03
    others = spark.range(20_000).select(F.concat(F.lit("x"), F.col("id")).alias("key"))
    wrong = sketches.part_contains(others, "key", filled, parts, k).where("maybe_present").count()
    assert wrong < 20_000 * 0.015


def test_words_of_a_bitmap(spark):
    bits = [0, 7, 8, 63, 64, 1000, sketches.PART_BITS - 1]
    words = sketches.part_words(spark.createDataFrame([(1, [b]) for b in bits], "part int, bits array<int>"), ["part"])
    probes = words.crossJoin(spark.createDataFrame([(b, [b]) for b in [*bits, 1, 9, 62, 65]] + [(-1, bits), (-2, [*bits, 5])], "name int, bits array<int>"))
    got = {r.name: r.yes for r in probes.select("name", sketches.all_set(F.col("words"), F.col("bits")).alias("yes")).collect()}
    assert got == {**dict.fromkeys(bits, True), **dict.fromkeys([1, 9, 62, 65], False), -1: True, -2: False}


def feed(spark, batches, tmp_path, expected, rate, merge_every=4, upto=None):
    """Apply numbered batches of keys as the stream would; returns the keys passed by each."""
    parts, k = sketches.part_plan(expected, rate / 2)
    passed = []
    for i, keys in list(enumerate(batches))[:upto]:
        batch = spark.createDataFrame([(i * 10_000 + j, key) for j, key in enumerate(keys)], "seq long, key string")
        state = deltas.read(spark, f"{tmp_path}/s", stateful.bloom_merge, i - 1)
        fresh, delta = stateful.bloom_batch(state, batch, "key", "seq", parts, -(-expected // parts), k)
        passed.append(sorted(r.key for r in fresh.collect()))
        deltas.put(spark, delta, i, f"{tmp_path}/s", stateful.bloom_merge, merge_every)
    return passed


def test_state_stays_constant_and_remembers_the_last_keys(spark, tmp_path):
    expected = 150
    batches = [[f"k{j}" for j in range(i * 40, i * 40 + 60)] for i in range(14)]  # 20 of 60 were in the batch before
    passed = feed(spark, batches, tmp_path, expected, 0.02)
    new = sum(len(p) for p in passed)
    assert 14 * 40 * 0.98 <= new <= 14 * 40 + 20  # nothing recent passes twice, few new keys are withheld
    state = deltas.read(spark, f"{tmp_path}/s", stateful.bloom_merge)
    assert state.count() <= 2 * sketches.part_plan(expected, 0.01)[0]
    assert len(child_names(spark, f"{tmp_path}/s")) <= 2 + 8
    again = state.agg(F.max("generation")).first()[0]
    assert again >= 14 * 40 // expected - 1


def test_a_batch_beyond_the_capacity_fills_several_generations(spark, tmp_path):
    passed = feed(spark, [[f"k{i}" for i in range(1000)], ["k0", "k999", "k998", None]], tmp_path, 100, 1e-6)
    assert len(passed[0]) == 1000
    assert passed[1] == ["k0"]  # forgotten, the last hundred are not
    state = deltas.read(spark, f"{tmp_path}/s", stateful.bloom_merge)
    assert state.count() == 2 and {r.generation for r in state.collect()} == {9, 10}


def test_stream_survives_a_restart_and_a_batch_run_twice(spark, tmp_path):
    df = spark.range(400).selectExpr("id as seq", "concat('k', id % 90) as key")
    stream = readers.replay_stream(spark, df, f"{tmp_path}/in", 4, "seq")

    def run():
        stateful.run_stream_bloom(stream, "key", "seq", f"{tmp_path}/s", f"{tmp_path}/o", f"{tmp_path}/ck", 1000, 1e-6).awaitTermination()
        return sorted((r.seq, r.key) for r in stateful.first_sights(spark, f"{tmp_path}/o").collect())

    assert run() == [(i, f"k{i}") for i in range(90)]
    last = sorted((tmp_path / "ck/commits").iterdir())[-1]
    for name in (last, last.with_name(f".{last.name}.crc")):
        name.unlink(missing_ok=True)  # the last batch was not committed
    more = spark.range(400, 500).selectExpr("id as seq", "concat('k', id % 95) as key")
    more.write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == [(i, f"k{i}") for i in range(90)] + [(i, f"k{i % 95}") for i in range(470, 475)]


def test_a_batch_writes_the_shards_it_touches(spark, tmp_path):
    first = spark.range(3000).selectExpr("id as seq", "id % 1000 as shard", "1 as bit")
    first.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(first.schema).parquet(f"{tmp_path}/in")

    def run():
        stateful.run_stream_dgim(stream, "bit", "seq", ["shard"], f"{tmp_path}/s", f"{tmp_path}/ck", 8, merge_every=3).awaitTermination()
        return stateful.stream_dgim_state(spark, f"{tmp_path}/s", ["shard"])

    assert run().select("shard").distinct().count() == 1000
    whole = first
    for i in range(1, 5):
        part = spark.createDataFrame([(3000 + 10 * i + j, 7, j % 2) for j in range(5)], "seq long, shard long, bit int")
        part.write.mode("append").parquet(f"{tmp_path}/in")
        whole = whole.union(part)
        state = run()
        batch = spark.read.parquet(f"{tmp_path}/s/batch={i:012d}")
        assert [r.shard for r in batch.select("shard").distinct().collect()] == [7]
        want = sketches.dgim(whole, "bit", "seq", 8, ["shard"])
        cols = ["shard", "bucket_size", "bucket_end", "current_time"]
        assert sorted(state.where("ones is not null").select(*cols).collect()) == sorted(want.select(*cols).collect())
