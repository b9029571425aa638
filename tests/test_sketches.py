from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import sketches as K


def keys(spark, n):
    return spark.range(n).selectExpr("concat('edge_', id) as key", "id as seq")


def test_bloom_has_no_false_negative_and_merges(spark):
    df = keys(spark, 2000)
    bits = K.bloom_build(df, "key", 20000, 5)
    assert K.bloom_contains(df, "key", bits, 20000, 5).where("not maybe_present").count() == 0
    halves = K.bloom_build(df.where("seq < 1000"), "key", 20000, 5).union(
        K.bloom_build(df.where("seq >= 1000"), "key", 20000, 5)).distinct()
    assert halves.exceptAll(bits).count() == 0 and bits.exceptAll(halves).count() == 0
    others = spark.range(2000).selectExpr("concat('other_', id) as key")
    false = K.bloom_contains(others, "key", bits, 20000, 5).where("maybe_present").count()
    assert false / 2000 < 0.05
    packed = K.bloom_pack(bits).agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert packed == bits.count()


def test_bloom_statistics(spark):
    row = K.bloom_stats(keys(spark, 4601), "key").first()
    assert row["items_added"] == 4601 and math.isclose(row["estimated_fpr"], 0.589805589159197, rel_tol=1e-12)
    assert math.isclose(row["fill_rate"], row["bits_set"] / 10000)
    empty = K.bloom_stats(keys(spark, 0), "key").first()
    assert empty["estimated_fpr"] == 0.0 and empty["bits_set"] == 0
    m, k = K.bloom_size(1000, 0.01)
    assert 9500 < m < 9700 and k == 7


def test_duplicates_are_exact(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("a", 4), (None, 5)], "key string, seq long")
    for size in (1, 1000):
        flags = {r["seq"]: r["is_duplicate"] for r in K.bloom_dedupe(df, "key", "seq", size).collect()}
        assert flags == {1: False, 2: False, 3: True, 4: True, 5: False}


def stream(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = [(i * 3, rng.choice(["a", "a", "b"]), int(rng.random() < 0.6)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "seq long, shard string, bit int").repartition(5)


@pytest.mark.parametrize("span", [7, 100, 10_000])
def test_trailing_ones_matches_brute_force(spark, span):
    rows, df = stream(spark)
    whole = {r["seq"]: r["ones_in_window"] for r in K.trailing_ones(df, "bit", "seq", 50, span=span).collect()}
    bits = [b for _, _, b in rows]
    assert whole == {rows[i][0]: sum(bits[max(0, i - 49):i + 1]) for i in range(len(rows))}
    by = {r["seq"]: r["ones_in_window"] for r in K.trailing_ones(df, "bit", "seq", 20, ["shard"], span).collect()}
    for name in "ab":
        own = [(s, b) for s, k, b in rows if k == name]
        for i, (s, _) in enumerate(own):
            assert by[s] == sum(b for _, b in own[max(0, i - 19):i + 1])


def add_one(buckets, position):
    """Put a one in front of a newest-first list and merge while a size has three buckets."""
    buckets = [(1, position), *buckets]
    i = 0
    while i + 2 < len(buckets) and buckets[i][0] == buckets[i + 2][0]:
        size, newest = buckets[i + 1]
        buckets[i + 1:i + 3] = [(size * 2, newest)]
        i += 1
    return buckets


def sequential_dgim(bits, window):
    """Bucket list by replaying the stream; expired buckets are dropped at the end."""
    buckets, now = [], 0
    for bit in bits:
        now += 1
        if bit:
            buckets = add_one(buckets, now)
    return sorted((s, e) for s, e in buckets if e > now - window)


@pytest.mark.parametrize("window,span", [(10, 5), (64, 50), (1000, 10_000)])
def test_dgim_state_equals_the_replayed_one(spark, window, span):
    rows, df = stream(spark)
    state = K.dgim(df, "bit", "seq", window, span=span)
    assert sorted((r["bucket_size"], r["bucket_end"]) for r in state.collect()) == sequential_dgim(
        [b for _, _, b in rows], window)
    truth = sum(b for _, _, b in rows[-window:])
    estimate = K.dgim_stats(state, window).first()["estimated_count"]
    assert abs(estimate - truth) <= truth / 2
    shards = K.dgim(df, "bit", "seq", window, ["shard"], span)
    for name in "ab":
        assert sorted((r["bucket_size"], r["bucket_end"]) for r in shards.where(F.col("shard") == name).collect()) == \
            sequential_dgim([b for _, k, b in rows if k == name], window)


def test_dgim_demo_stream(spark):
    bits = [1, 0, 1, 1, 0, 1, 0, 0, 1, 1]
    df = spark.createDataFrame(list(enumerate(bits)), "seq long, bit int")
    assert K.dgim_stats(K.dgim(df, "bit", "seq", 10), 10).first()["estimated_count"] == 5
    assert K.dgim(df.withColumn("bit", F.lit(0)), "bit", "seq").count() == 0


def test_distinct_estimate(spark):
    df = keys(spark, 10000)
    estimate = K.fm_distinct(df, "key").first()["estimated_cardinality"]
    assert 10000 / 3 < estimate < 30000
    whole = K.fm_registers(df, "key").first()[0]
    parts = [K.fm_registers(df.where(c), "key").first()[0] for c in ("seq < 5000", "seq >= 5000")]
    assert whole == [max(a, b) for a, b in zip(*parts)]
    known = [[8, 7, 9, 8, 7, 11, 13, 8, 10, 7], [11, 9, 10, 10, 9, 11, 13, 9, 14, 16]]
    rows = spark.createDataFrame([(k,) for k in known], "r array<int>")
    assert [r[0] for r in rows.select(K.fm_estimate(F.col("r"))).collect()] == [330, 2647]


def test_trailing_zero_counts(spark):
    df = spark.createDataFrame([(0,), (1,), (8,), (12,)], "h long")
    assert [r[0] for r in df.select(K.trailing_zeros(F.col("h"))).collect()] == [1, 0, 3, 2]


def test_reservoir_is_uniform_fixed_and_mergeable(spark):
    df = spark.range(1000).withColumnRenamed("id", "seq")
    sample = [r["seq"] for r in K.reservoir(df, ["seq"], 10, 1).collect()]
    assert len(set(sample)) == 10
    merged = K.reservoir(df.where("seq < 500"), ["seq"], 10, 1).union(K.reservoir(df.where("seq >= 500"), ["seq"], 10, 1))
    assert [r["seq"] for r in K.reservoir(merged, ["seq"], 10, 1).collect()] == sample
    low = sum(r["seq"] < 500 for seed in range(20) for r in K.reservoir(df, ["seq"], 50, seed).collect())
    assert 420 < low < 580
    row = K.reservoir_stats(df, 100).first()
    assert (row["items_processed"], row["current_sample_size"], row["sampling_probability"]) == (1000, 100, 0.1)
    assert K.reservoir_stats(df.limit(0), 100).first()["sampling_probability"] == 0.0


def test_stream_summary_and_report(spark):
    edges = spark.createDataFrame(
        [(1, "a", "b", 2e9), (2, "a", "b", 1.0), (3, "b", "c", 1e9)], "seq long, source_id string, target_id string, weight double")
    row = K.stream_summary(edges, K.edge_key()).first()
    assert (row["edges_processed"], row["duplicates_detected"], row["high_risk_edges"]) == (3, 1, 1)
    report = K.edge_stream_report(edges, "seq").first()
    assert report["summary"]["edges_processed"] == 3 and report["bloom_filter"]["items_added"] == 2
    assert report["dgim"]["num_buckets"] == 1 and report["reservoir"]["current_sample_size"] == 3
    quiet = K.edge_stream_report(edges.withColumn("weight", F.lit(0.0)), "seq").first()
    assert quiet["summary"]["high_risk_edges"] == 0
    assert (quiet["dgim"]["num_buckets"], quiet["dgim"]["estimated_count"], quiet["dgim"]["current_time"]) == (0, 0, 3)


def test_lookup_in_a_sent_filter_equals_the_join(spark, monkeypatch):
    held = spark.range(300).selectExpr("cast(id as string) as key")
    asked = spark.range(200, 900).selectExpr("case when id = 250 then null else cast(id as string) end as key")
    bits = K.bloom_build(held, "key", 4_001, 5)
    sent = K.bloom_contains(asked, "key", bits, 4_001, 5)
    # no key is written out once for each of its bits
    assert "Generate" not in sent._jdf.queryExecution().optimizedPlan().toString().split("+- ")[0]
    none = K.bloom_contains(asked, "key", bits.limit(0), 4_001, 5)
    assert none.where("maybe_present").count() == 0 and none.count() == 699
    found = sorted(map(tuple, sent.collect()))
    monkeypatch.setattr(K, "SENT_BITS", 0)
    assert found == sorted(map(tuple, K.bloom_contains(asked, "key", bits, 4_001, 5).collect()))


def test_part_filter_meets_by_part_before_the_bitmaps(spark):
    keys = spark.range(500).selectExpr("cast(id % 100 as string) as key")
    filled = K.part_filter(keys, "key", 3, 7)
    assert "RepartitionByExpression" in filled._jdf.queryExecution().optimizedPlan().toString()
    old = K.part_words(keys.select(K.part_of_key(K.F.col("key"), 3), K.part_positions(K.F.col("key"), 3, 7).alias("bits")), ["part"])
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, old.collect()))
