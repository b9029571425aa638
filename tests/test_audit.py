from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from riskweave.operators import fairness, macro, ranking


@pytest.fixture(scope="module")
def pred(spark):
    rows = [("bank", "t1", 1, 0.9)] * 4 + [("stock", "t1", 1, 0.8)] * 3 + [("stock", None, 0, 0.2)] + [("inst", "t2", 0, 0.7)] * 2
    return spark.createDataFrame(rows, "node_type string, tier string, cascade_prediction int, cascade_probability double")


def test_groups(pred):
    rows = {r["group_value"]: r for r in fairness.fairness_by_group(pred, "node_type").collect()}
    assert (rows["bank"]["count"], rows["bank"]["predicted_cascade_rate"], rows["bank"]["high_risk_count"]) == (4, 1.0, 4)
    assert rows["inst"]["high_risk_count"] == 0
    tiers = {r["group_value"] for r in fairness.fairness_by_group(pred, "tier").collect()}
    assert tiers == {"t1", "t2"}


def test_impact_ratios(pred):
    rows = {r["group_value"]: (r["ratio"], r["is_fair"]) for r in fairness.disparate_impact(pred, "node_type").collect()}
    assert rows == {"stock": (0.75, False), "inst": (0.0, False)}
    zero = {r["group_value"]: (r["ratio"], r["is_fair"]) for r in fairness.disparate_impact(pred, "node_type", "inst").collect()}
    assert zero == {"bank": (None, False), "stock": (None, False)}


def test_tied_rates_prefer_the_larger_group(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1)], "g string, cascade_prediction int")
    assert [r["group_value"] for r in fairness.disparate_impact(df, "g").collect()] == ["a"]


def test_report_sections(pred):
    rows = fairness.fairness_report(pred).collect()
    assert {r["section"] for r in rows} == {"audit_by_node_type", "audit_by_tier", "disparate_impact"}


def test_classification_metrics_of_a_published_run(spark):
    """Confusion cells 49 / 0 / 11 / 1325: F1 0.9959 and accuracy 0.9921."""
    rows = [(0, 0)] * 49 + [(1, 0)] * 11 + [(1, 1)] * 1325
    out = {r["class"]: r for r in fairness.classification_metrics(
        spark.createDataFrame(rows, "y int, p int"), "y", "p").collect()}
    assert out["1"]["precision"] == 1.0 and abs(out["1"]["f1_score"] - 0.9959) < 5e-5
    assert abs(out["accuracy"]["precision"] - 0.9921) < 5e-5 and out["0"]["support"] == 49
    assert abs(out["macro avg"]["recall"] - (1 + 1325 / 1336) / 2) < 1e-12


def test_absent_class_scores_zero(spark):
    df = spark.createDataFrame([(0, 1), (0, 1)], "y int, p int")
    out = {r["class"]: r for r in fairness.classification_metrics(df, "y", "p").collect()}
    assert out["0"]["precision"] == 0.0 and out["1"]["recall"] == 0.0


def test_stress_index(spark):
    d = dt.date
    rows = [(d(2020, 1, 1), "T10Y2Y", -0.5), (d(2020, 1, 1), "VIXCLS", 31.0), (d(2020, 1, 2), "VIXCLS", 10.0),
            (d(2020, 1, 3), "BAMLH0A0HYM2", 8.0), (d(2020, 1, 3), "T10Y2Y", 1.0)]
    df = spark.createDataFrame(rows, "date date, series_id string, value double")
    out = macro.stress_index(df, ["T10Y2Y", "VIXCLS", "BAMLH0A0HYM2"]).orderBy("date").collect()
    assert [(r["stress_score"], r["high_stress_flag"]) for r in out] == [(4, 1), (2, 0), (2, 0)]
    assert [r["yield_curve"] for r in out] == [-0.5, -0.5, 1.0]


def test_repeated_observation_takes_the_latest(spark):
    df = spark.createDataFrame([("d", "s", 1.0, 1), ("d", "s", 2.0, 2)], "date string, series_id string, value double, seq int")
    assert macro.pivot_series(df, ["s"], seq="seq").first()["s"] == 2.0


def test_sector_pairs(spark):
    corr = spark.createDataFrame([("A", "B", 0.5), ("C", "A", 0.1), ("A", "A2", 0.9)], "symbol1 string, symbol2 string, correlation double")
    sectors = spark.createDataFrame([("A", "f"), ("A2", "f"), ("B", "t"), ("C", "t")], "symbol string, sector string")
    rows = macro.sector_correlation(corr, sectors).collect()
    assert [tuple(r) for r in rows] == [("f", "t", 0.3, 1, 2)]


@pytest.mark.parametrize("values", [
    list(range(101)), [5.0] * 900 + [1.0, 2.0, 9.0], [3.5], [float(i % 7) for i in range(500)]])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    for p in (0.0, 0.5, 0.85, 0.9, 1.0):
        assert abs(ranking.quantile(df, "v", p) - np.percentile(values, p * 100)) < 1e-12
    assert ranking.quantile(df.limit(0), "v", 0.5) is None


def test_smallest_k_with_ties(spark):
    df = spark.createDataFrame([(f"i{i:03d}", 1 if i < 150 else 2) for i in range(200)], "id string, v int")
    out = sorted(r["id"] for r in ranking.smallest_k(df, "v", ["id"], 90).collect())
    assert out == [f"i{i:03d}" for i in range(90)]
    assert ranking.smallest_k(df, "v", ["id"], 0).count() == 0
    assert ranking.smallest_k(df, "v", ["id"], 500).count() == 200


def test_top_rows(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.7), ("d", 0.71)], "node_id string, cascade_probability double")
    assert [r["node_id"] for r in ranking.high_risk_entities(df).collect()] == ["a", "b", "d"]
    assert [r["node_id"] for r in ranking.top_predictions(df, 2).collect()] == ["a", "b"]
