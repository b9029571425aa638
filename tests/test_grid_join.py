"""Joins whose heavy keys are heavy on both sides."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskweave.operators import cascade
from riskweave.operators.skew import grid_join, grid_keys


@pytest.fixture
def plain_joins(spark):
    """No broadcast by size and no repair at run time."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sides(spark):
    left = spark.range(3000).selectExpr("if(id < 1500, 'hot', concat('k', id % 300)) as key", "id as a")
    right = spark.range(2000).selectExpr("if(id < 1000, 'hot', concat('k', id % 500)) as key", "id as b")
    return left, right


def test_equals_a_plain_join(spark):
    left, right = sides(spark)
    left = left.union(spark.createDataFrame([(None, 1), ("only left", 2)], "key string, a long"))
    want = sorted(map(tuple, left.join(right, "key").collect()))
    for cell in (1, 50, 10_000, 10 ** 9):
        assert sorted(map(tuple, grid_join(left, right, ["key"], cell).collect())) == want


def test_no_task_makes_the_pairs_of_a_heavy_key(spark, plain_joins):
    left, right = sides(spark)
    cell = 15_000
    cuts = {r["key"]: (r["_across"], r["_down"]) for r in grid_keys(left, right, ["key"], cell).collect()}
    assert set(cuts) == {"hot"} and 100 <= cuts["hot"][0] * cuts["hot"][1] <= 130
    tasks = grid_join(left, right, ["key"], cell).groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    whole = left.join(right, "key").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert tasks[1] == whole[1] and whole[0] >= 1_500_000
    assert tasks[0] <= 8 * cell  # a few cells share one of the 64 tasks


def test_an_investor_heavy_on_both_sides(spark, plain_joins):
    """One investor holds every stock, and every stock belongs to a bank."""
    n = 120
    nodes = [(f"BANK_{i}", "bank", str(i), f"B{i}", None, None, None, 1.0) for i in range(n)] + [("INST_1", "institutional_investor", None, "I", None, None, None, None)]
    nodes += [(f"STOCK_{i}", "stock", None, f"S{i}", f"S{i}", "x", 1.0, None) for i in range(n)]
    edges = [(f"BANK_{i}", f"STOCK_{i}", "PUBLICLY_TRADED_AS", 1.0) for i in range(n)] + [("INST_1", f"STOCK_{i}", "equity_ownership", 2.0) for i in range(n)]
    graph = (spark.createDataFrame(nodes, "node_id string, node_type string, institution_id string, name string, ticker string, sector string, market_cap double, total_assets double"),
             spark.createDataFrame(edges, "source_id string, target_id string, relationship_type string, weight double"))
    rows = cascade.cascade_impact(*graph, rows_per_split=20, pairs_per_cell=500).groupBy("hop").agg(F.count("*").alias("n"), F.sum("impact_value").alias("s")).collect()
    assert sorted(map(tuple, rows)) == [(1, n, float(n)), (2, n, 2.0 * n), (3, n * (n - 1), 2.0 * n * (n - 1))]
    summary = cascade.cascade_summary(*graph, rows_per_split=20, pairs_per_cell=500).select("cascade_stocks").distinct().collect()
    assert [r[0] for r in summary] == [n - 1]
