"""Builds that run side by side, and tables that are written once."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from riskweave.operators import cascade, graph, learn
from riskweave.plans import catalog, tables as T
from riskweave.session import together

SF = "/root/testdata/sf0.001"


def test_independent_builds_run_side_by_side(spark):
    met = threading.Barrier(2, timeout=60)

    def build(n):
        met.wait()  # breaks unless both are running
        return spark.range(n)

    assert [df.count() for df in together(spark, [lambda: build(3), lambda: build(5)])] == [3, 5]


def test_an_error_of_a_build_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: spark.range(1), lambda: 1 / 0])


def test_features_are_those_of_the_single_measures(spark):
    nodes = spark.createDataFrame([(c, 1.0) for c in "abcde"], "node_id string, equity double")
    edges = spark.createDataFrame(
        [("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 4.0), ("c", "d", 0.5), ("a", "b", 3.0)], "source_id string, target_id string, weight double")
    rows = {r["node_id"]: r for r in graph.node_features(nodes, edges, written=True).collect()}
    assert sorted(rows) == list("abcde") and rows["e"]["total_degree"] == 0
    for part in (graph.pagerank(nodes, edges), graph.degree(nodes, edges), graph.betweenness_sampled(nodes, edges), graph.clustering(nodes, edges), graph.exposure(nodes, edges)):
        for want in part.collect():
            assert {c: rows[want["node_id"]][c] for c in part.columns} == pytest.approx(want.asDict())


def test_contagion_and_features_share_the_edges(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_BUILT", {})
    calls, edges = [], T.edges
    # the measures themselves are tested apart
    monkeypatch.setattr(graph, "node_features", lambda nodes, edges, written: nodes.withColumns({c: F.hash("node_id").cast("double") for c in graph.METRICS}))
    monkeypatch.setattr(T, "edges", lambda *a, **k: calls.append(a) or edges(*a, **k))
    assert catalog.neighbour_contagion(spark, SF).count() > 0
    assert len(calls) == 1


def test_forest_keeps_the_nodes_of_its_rows(spark):
    rows = spark.range(300).selectExpr("id % 2 label_", "double(id) a", "double(id * 7 % 31) b")
    ready = learn.standard_scale(rows, ["a", "b"]).transform(rows)
    kept = learn.train_forest(ready, "label_", numTrees=6, maxDepth=6)
    walked = learn.train_forest(ready, "label_", numTrees=6, maxDepth=6, cacheNodeIds=False)
    assert kept.getCacheNodeIds() and kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_cascades_pair_no_lines(spark, monkeypatch):
    whole = T.edges(spark, SF, *catalog.FOLLOWED, "weight").where(f"relationship_type in {catalog.CASCADE}")
    want = sorted(map(str, whole.collect()))

    def never(*_):
        raise AssertionError("lines are paired")

    monkeypatch.setattr(T, "line_pairs", never)
    assert sorted(map(str, catalog._cascade_graph(spark, SF, "weight")[1].collect())) == want != []
    with pytest.raises(AssertionError):
        T.edges(spark, SF, kinds=("repo_agreement",))


def test_listings_sent_or_met_by_shuffle_reach_the_same_holdings(spark):
    holdings = spark.createDataFrame([("i", "x", 1.0), ("j", "x", 2.0), ("j", "y", 3.0), ("k", None, 4.0)], "investor string, stock string, weight double")
    listings = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "z"), ("D", None)], "bank string, stock string")
    sent, met = (cascade._owned(holdings, listings, 1, n) for n in (10, 1))
    assert sorted(map(str, sent.select("bank", "investor", "weight").collect())) == sorted(map(str, met.select("bank", "investor", "weight").collect()))
    assert sent.count() == 4
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_reports_write_no_impact_rows(spark, monkeypatch):
    names = []

    def noted(df, name="table"):
        names.append(name)
        return materialize(df, name)

    from riskweave.session import materialize
    for module in (catalog, cascade):
        monkeypatch.setattr(module, "materialize", noted)
    assert catalog.k_anon_summary(spark, SF).columns and catalog.anonymization_report(spark, SF).count() == 1
    assert "impact" not in names and names.count("book") == names.count("first") == 2
