from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskweave.operators import explain, labels, learn
from riskweave.sources import writers

SMALL = dict(numTrees=12, maxDepth=5)


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(240):
        x = rng.random(11)
        rows.append((f"n{i:03d}", *[float(v) for v in x[:9]], float(x[9]), float(x[10])))
    cols = ", ".join(f"{c} double" for c in learn.FEATURES)
    return spark.createDataFrame(rows, f"node_id string, {cols}").cache()


@pytest.fixture(scope="module")
def labelled(features):
    rule = F.when(F.col("pagerank_score") + F.col("equity") > 1.4, 1).otherwise(0)
    return features.withColumn(learn.LABEL, rule).cache()


@pytest.fixture(scope="module")
def model(labelled):
    return learn.train_model(labelled, **SMALL)


def test_risk_score_formula(features):
    rows = labels.risk_score(features).orderBy("node_id").collect()
    data = {c: np.array([r[c] for r in rows]) for c in learn.FEATURES}

    def mm(v):
        return (v - v.min()) / (v.max() - v.min())

    systemic = 0.4 * mm(data["pagerank_score"]) + 0.3 * mm(data["betweenness_centrality"]) + 0.3 * mm(data["total_degree"])
    contagion = 0.6 * (1 - mm(data["clustering_coefficient"])) + 0.4 * mm(data["incoming_exposure"] + data["outgoing_exposure"])
    want = 0.4 * mm(data["total_exposure"] / (data["equity"] + 1)) + 0.3 * systemic + 0.3 * contagion
    assert np.allclose([r["risk_score"] for r in rows], want)


def test_labels_are_fixed_and_grow_from_the_shock(features):
    out = labels.cascade_labels(features).cache()
    shocked = out.where("initial_shock = 1").count()
    assert shocked == 36 and out.where("initial_shock = 1 and cascade_occurred = 0").count() == 0
    fallen = out.where("cascade_occurred = 1").count()
    assert fallen >= 36 + int(0.1 * (240 - fallen))
    again = labels.cascade_labels(features.repartition(5))
    assert {tuple(r) for r in again.select("node_id", "cascade_occurred").collect()} == {
        tuple(r) for r in out.select("node_id", "cascade_occurred").collect()}


def test_neighbour_contagion_needs_a_fallen_neighbour(spark, features):
    none = spark.createDataFrame([], "source_id string, target_id string")
    out = labels.cascade_labels(features, edges=none, neighbour_contagion=True)
    assert out.where("cascade_occurred = 1").count() == 36 + int(0.1 * 204)


def test_constant_scores_label_everything_or_nothing(features):
    flat = features.select("node_id", *[F.lit(1.0).alias(c) for c in learn.FEATURES])
    assert labels.cascade_shock(flat).where("initial_shock = 1").count() == 240
    assert labels.cascade_shock(flat, strict=True).where("initial_shock = 1").count() == 0


def test_split_is_exact_per_class(labelled):
    out = learn.stratified_split(labelled)
    for row in labelled.groupBy(learn.LABEL).count().collect():
        test = out.where((F.col(learn.LABEL) == row[learn.LABEL]) & (F.col("split") == "test")).count()
        assert test == int(row["count"] * 0.3 + 0.5)


def test_scaling_uses_the_population(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert [tuple(r) for r in learn.standardized(df, ["x", "c"]).select("z_x", "z_c").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def points(spark, rows):
    return spark.createDataFrame([(f"p{i}", y, Vectors.dense(v)) for i, (y, v) in enumerate(rows)],
                                 ["node_id", "cascade_occurred", "features"])


def test_smote_balances_between_neighbours(spark):
    rows = [(0, [float(i), 100.0]) for i in range(40)] + [(1, [float(i), 0.0]) for i in range(7)]
    out = learn.smote(points(spark, rows)).select("cascade_occurred", vector_to_array("features").alias("x")).collect()
    ones = [r["x"] for r in out if r["cascade_occurred"] == 1]
    assert len(ones) == 40 and all(0 <= x[0] <= 6 and x[1] == 0.0 for x in ones)
    assert sum(x[0] != int(x[0]) for x in ones) > 20


def test_smote_of_copies_and_of_balanced_classes(spark):
    rows = [(0, [float(i), 1.0]) for i in range(30)] + [(1, [5.0, 5.0])] * 9
    out = learn.smote(points(spark, rows)).where("cascade_occurred = 1").select(vector_to_array("features").alias("x")).collect()
    assert len(out) == 30 and all(r["x"] == [5.0, 5.0] for r in out)
    even = points(spark, [(0, [1.0]), (1, [2.0])])
    assert learn.smote(even).count() == 2


def test_model_scores_and_survives_saving(spark, labelled, model, tmp_path):
    scored = learn.score(model, labelled)
    hits = scored.where("cascade_prediction = cascade_occurred").count()
    assert hits > 200 and "risk_level" in scored.columns
    assert scored.where("cascade_probability < 0 or cascade_probability > 1").count() == 0
    writers.save_model(model, str(tmp_path), "20240101_000000")
    writers.save_model(model, str(tmp_path), "20240102_000000")
    loaded = writers.load_latest(spark, str(tmp_path))
    a = {r["node_id"]: r["cascade_probability"] for r in scored.collect()}
    b = {r["node_id"]: r["cascade_probability"] for r in learn.score(loaded, labelled).collect()}
    assert a == b


def test_evaluation_rows(labelled, model):
    rows = {(r["section"], r["item"]): r["value"] for r in learn.evaluate(model, labelled).collect()}
    assert rows["summary", "roc_auc"] > 0.9
    assert sum(v for (s, _), v in rows.items() if s == "confusion_matrix") == 240
    assert abs(sum(v for (s, _), v in rows.items() if s == "feature_importance") - 1) < 1e-9
    assert rows["classification_report", "1.f1_score"] > 0.7


def test_cross_validation(labelled):
    row = learn.cross_validate_f1(labelled, folds=3, **SMALL).first()
    assert 0.3 < row["mean"] <= 1 and row["std"] >= 0


def test_unlearning_forgets(spark, features):
    ids = spark.createDataFrame([("n001",), ("n002",), ("stranger",)], "node_id string")
    model, kept = learn.unlearn(features, ids, **SMALL)
    assert kept.count() == 238
    assert tuple(learn.verify_forgotten(kept, ids).first()) == (3, 3)
    assert tuple(learn.verify_forgotten(features, ids).first()) == (3, 1)
    assert kept.where("cascade_occurred = 1").count() == 24
    assert learn.score(model, kept).count() == 238


def test_attributions_add_up(labelled, model):
    sample = explain.attribution_sample(labelled, 12)
    attr = explain.attributions(model, sample, labelled, permutations=10).cache()
    assert attr.count() == 12 * 11
    scored = learn.score(model, labelled)
    ground = explain.attribution_sample(labelled, 10, seed=1)
    base = learn.score(model, ground).agg(F.avg("cascade_probability")).first()[0]
    p = {r["node_id"]: r["cascade_probability"] for r in scored.collect()}
    for r in attr.groupBy("node_id").agg(F.sum("contribution").alias("s")).collect():
        assert abs(r["s"] - (p[r["node_id"]] - base)) < 1e-9
    top = [r["feature"] for r in explain.global_importance(attr).collect()]
    assert set(top[:2]) == {"pagerank_score", "equity"} and len(top) == 10
    rows = explain.explain_top(learn.score(model, sample), attr, 2, 3).collect()
    assert len(rows) == 6 and {r["rank"] for r in rows} == {1, 2, 3}
    assert all((r["direction"] == "up") == (r["contribution"] > 0) for r in rows)


def test_split_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "node_id string, cascade_risk int, x double")
    got = learn.stratified_split(empty, "cascade_risk")
    assert got.columns == ["node_id", "cascade_risk", "x", "split"] and got.count() == 0


def sizes(df):
    return sorted(df.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"])


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """A table of one large file and many small ones."""
    folder = str(tmp_path_factory.mktemp("uneven") / "rows")
    rows = spark.range(4_000).selectExpr("cast(id % 2 as int) cascade_occurred", "cast(id as double) a", "cast(id % 37 as double) b")
    ready = learn.standard_scale(rows, ["a", "b"]).transform(rows).select(learn.LABEL, "features")
    ready.limit(3_200).coalesce(1).write.parquet(folder)
    ready.limit(800).repartition(4).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def test_rows_of_a_forest_are_dealt_evenly(spark, uneven):
    parts = spark.sparkContext.defaultParallelism
    out = learn.dealt(uneven, 100)
    assert sorted(map(str, out.collect())) == sorted(map(str, uneven.collect()))
    assert sizes(out) == [4_000 // parts] * parts
    assert learn.dealt(uneven, 2_500) is uneven
    again = learn.dealt(uneven, 100)
    assert [str(r) for r in out.withColumn("p", F.spark_partition_id()).collect()] == [str(r) for r in again.withColumn("p", F.spark_partition_id()).collect()]


def test_the_forest_gets_even_parts_and_no_task_for_a_class(spark, uneven, monkeypatch):
    seen, deal = [], learn.dealt
    monkeypatch.setattr(learn, "dealt", lambda table: deal(table, 100))
    monkeypatch.setattr(learn, "train_forest", lambda df, *_, **__: seen.append(df) or learn.standard_scale(uneven.limit(1).selectExpr("1.0 a"), ["a"]).stages[0])
    rows = spark.range(4_000).selectExpr("concat('n', id) node_id", "cast(id % 2 as int) cascade_occurred", "cast(id as double) equity")
    learn.train_model(rows, cols=["equity"])
    assert max(sizes(seen[0])) <= 1.2 * 4_000 / spark.sparkContext.defaultParallelism
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scored_rows_are_dealt_evenly(spark, labelled, model):
    one = labelled.select("node_id", *learn.FEATURES).coalesce(1)
    assert len(sizes(learn.score(model, one))) == spark.sparkContext.defaultParallelism
