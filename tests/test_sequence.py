from __future__ import annotations

import random

import pytest

from riskweave.operators import sequence


def plain(rows):
    """Place, and both rows of every pair, from one sorted list."""
    rows = sorted(r for r in rows if r[0] is not None)
    return [(i, a, b) for i, (a, b) in enumerate(zip(rows, rows[1:])) if a[0] == b[0]]


def pairs(df, span):
    got = sequence.following(df, ["k"], ["n", "v"], span=span).collect()
    return sorted((r.seq, (r.k, r.f.n, r.f.v), (r.k, r.g.n, r.g.v)) for r in got)


@pytest.mark.parametrize("span", [1, 2, 7, 100_000])
def test_pairs_equal_a_sorted_list(spark, span):
    draw = random.Random(5)
    # one group holds a third of all rows, others one row; ties and repeated rows
    rows = [(draw.choice([1] * 30 + list(range(2, 62))), draw.randint(1, 7), draw.randint(0, 3)) for _ in range(600)]
    rows += [(None, 1, 1), (99, 1, 1)]
    df = spark.createDataFrame(rows, "k int, n int, v int").repartition(5)
    assert pairs(df, span) == plain(rows)


def test_places_have_no_gaps(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id", "'x' as _part_of").repartition(7)
    got = sequence.numbered(df, ["k", "id"]).orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(1000))
    assert [(r.k, r.id) for r in got] == sorted((i % 10, i) for i in range(1000))


def test_empty_table_and_clashing_name(spark):
    empty = spark.createDataFrame([], "k int, n int, v int")
    assert pairs(empty, 4) == []
    with pytest.raises(ValueError):
        sequence.numbered(spark.range(3).withColumnRenamed("id", "seq"), ["seq"])


def test_pairing_moves_rows_once(spark):
    df = spark.createDataFrame([(1, i, i % 3) for i in range(50)], "k int, n int, v int").repartition(3)
    found = sequence.following(df, ["k"], ["n", "v"], ahead=["v"])
    # the pairs are ready when they are read: nothing but the short list of ranges is moved
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_stretch" not in plan and "Generate" not in plan
    assert found.schema["g"].dataType.names == ["v"]
    assert sorted((r.seq, r.f.n, r.g.v) for r in found.collect()) == [(i, i, (i + 1) % 3) for i in range(49)]


def test_pairs_across_ranges_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = [(i // 40, i, i * 7 % 5) for i in range(200)]
        assert pairs(spark.createDataFrame(rows, "k int, n int, v int").repartition(4), 2) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
