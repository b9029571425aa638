"""Training, evaluation, scoring and unlearning of the cascade model with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import nan_inf_to_zero, risk_level
from riskweave.functions.hashing import draw, pair56
from riskweave.operators.fairness import classification_metrics, confusion
from riskweave.operators.labels import unlearn_labels
from riskweave.operators.neighbours import nearest_points
from riskweave.operators.ranking import smallest_by, smallest_k, values_at
from riskweave.session import materialize

# Fixed value: model inputs in order.
FEATURES = [
    "pagerank_score", "in_degree", "out_degree", "total_degree", "betweenness_centrality",
    "clustering_coefficient", "incoming_exposure", "outgoing_exposure", "total_exposure",
    "total_assets", "equity",
]
LABEL = "cascade_occurred"
# Rows that a task should hold before a table is dealt to more tasks.
ROWS_PER_TASK = 5_000
# Forest settings.
FOREST = dict(numTrees=200, maxDepth=15, minInstancesPerNode=5, featureSubsetStrategy="sqrt",
              impurity="gini", seed=42, cacheNodeIds=True)


def training_matrix(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Clean numeric inputs; columns that the table lacks are left out."""
    return nan_inf_to_zero(df, [c for c in cols if c in df.columns])


def _hash(seed: int, *cols: str) -> Column:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return pair56(text)[0]


def stratified_split(
    df: DataFrame, label: str = LABEL, test_share: float = 0.3, seed: int = 42,
    ids: Sequence[str] = ("node_id",), kind: str = "xx",
) -> DataFrame:
    """Add ``split`` (train / test) with the exact test share in every class.

    Rows are chosen by a hash of their id below a cut; the cuts of all classes are found together.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    hashed = materialize(df.withColumn("_h", pair56(text, kind)[0]), "hashed")
    sizes = hashed.groupBy(label).agg(F.floor(F.count("*") * F.lit(test_share) + 0.5).alias("n"))
    test = smallest_by(hashed.select(label, "_h", *ids), [label], "_h", ids, sizes).select(*ids, F.lit("test").alias("_split"))
    return hashed.join(test, list(ids), "left").withColumn(
        "split", F.coalesce("_split", F.lit("train"))).drop("_h", "_split")


def standardized(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes zero."""
    stats = df.agg(F.struct(*[
        f(c).alias(f"{tag}_{c}") for c in cols for tag, f in (("avg", F.avg), ("sd", F.stddev_pop))
    ]).alias("s")).scalar()

    def z(c):
        sd = stats.getField(f"sd_{c}")
        return F.when(sd > 0, (F.col(c) - stats.getField(f"avg_{c}")) / sd).otherwise(F.lit(0.0))

    return df.withColumns({f"z_{c}": z(c) for c in cols})


def standard_scale(train: DataFrame, cols: Sequence[str] = FEATURES) -> PipelineModel:
    """Assembler and scaler fitted on the training rows."""
    used = [c for c in cols if c in train.columns]
    assembler = VectorAssembler(inputCols=used, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return PipelineModel([assembler, scaler.fit(assembler.transform(train))])


def class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add balanced weights n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k")).alias("s")).scalar()
    weights = counts.select(
        F.col(label), (total.getField("n") / (total.getField("k") * F.col("_n"))).alias("class_weight"))
    # one row for each class; joined by shuffle, every class would be one task
    return df.join(F.broadcast(weights), label)


def smote(
    df: DataFrame, label: str = LABEL, k: int = 5, seed: int = 42, ids: Sequence[str] = ("node_id",),
    features: str = "features",
) -> DataFrame:
    """Balance two classes with synthetic minority points; returns (label, features).

    Copies of a point are searched once. A point with more than ``k`` copies has only copies
    as neighbours, so its synthetic points equal it.
    """
    rows = materialize(df.select(
        *ids, label, vector_to_array(features).alias("x")), "scaled")
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    real = rows.select(label, "x")
    if len(counts) != 2 or min(counts.values()) == max(counts.values()):
        return real.select(label, array_to_vector("x").alias(features))
    minority = min(counts, key=lambda c: (counts[c], c))
    need = max(counts.values()) - counts[minority]
    small = rows.where(F.col(label) == minority).withColumn("_h", _hash(seed, *ids))
    copies = small.groupBy("x").agg(F.count("*").alias("copies"))
    near = nearest_points(copies.select("x"), k)
    # Other copies of a point come first among its neighbours.
    known = copies.join(near, "x").select("x", F.slice(F.concat(
        F.array_repeat(F.col("x"), F.least(F.col("copies") - 1, F.lit(k)).cast("int")), "near"),
        1, k).alias("near"))
    base, extra = divmod(need, counts[minority])
    more = smallest_k(small, "_h", ids, extra).select(*ids, F.lit(1).alias("_more"))
    seeds = small.join(more, list(ids), "left").withColumn(
        "times", F.lit(base) + F.coalesce("_more", F.lit(0))).where("times > 0")
    made = seeds.join(known, "x").where(F.size("near") > 0).select(
        *ids, label, "x", "near", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    tag = [F.col(c) for c in ids]
    pick = F.floor(draw(f"{seed}:near", *tag, F.col("copy")) * F.size("near")).cast("int")
    step = draw(f"{seed}:step", *tag, F.col("copy"))
    synthetic = made.select(label, "x", F.get("near", pick).alias("other"), step.alias("u")).select(
        label, F.transform(F.arrays_zip("x", "other"),
                           lambda p: p["x"] + F.col("u") * (p["other"] - p["x"])).alias("x"))
    return real.unionByName(synthetic).select(label, array_to_vector("x").alias(features))


def dealt(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A written table dealt to the cluster's tasks in equal parts, as long as each holds ``rows_per_task`` rows.

    Rows of a part lie in the order of their hash: a forest draws by part and place, so its draws do not depend
    on the order in which parts of rows arrive. Small tables stay as they are.
    """
    tasks = min(table.sparkSession.sparkContext.defaultParallelism, table.count() // rows_per_task)
    if tasks < 2:
        return table
    return materialize(table.repartition(tasks).sortWithinPartitions(F.xxhash64(*table.columns)), "dealt")


def train_forest(df: DataFrame, label: str = LABEL, weight: str | None = None, **params):
    """Random forest on the ``features`` vector.

    Every row keeps its node of each tree, so a deeper level does not walk the trees from the root again;
    the forest is the same.
    """
    settings = {**FOREST, **params}
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", maxMemoryInMB=1024, **settings)
    if weight:
        forest = forest.setWeightCol(weight)
    return forest.fit(df)


def train_model(
    train: DataFrame, label: str = LABEL, cols: Sequence[str] = FEATURES, seed: int = 42,
    oversample: bool = True, **params,
) -> PipelineModel:
    """Assembler, scaler and forest as one model; classes balanced before the fit."""
    clean = materialize(training_matrix(train, cols), "train")
    scaling = standard_scale(clean, cols)
    scaled = scaling.transform(clean)
    balanced = smote(scaled, label, seed=seed) if oversample else scaled.select(label, "features")
    weighted = class_weight(dealt(materialize(balanced, "balanced")), label)
    forest = train_forest(weighted, label, "class_weight", **params)
    return PipelineModel([*scaling.stages, forest])


def cross_validate_f1(
    df: DataFrame, folds: int = 5, label: str = LABEL, cols: Sequence[str] = FEATURES,
    seed: int = 42, ids: Sequence[str] = ("node_id",), **params,
) -> DataFrame:
    """Mean and deviation of the positive-class F1 over equal folds of each class."""
    clean = training_matrix(df, cols).withColumn("_h", _hash(seed, *ids))
    clean = materialize(clean, "train")
    sizes = clean.groupBy(label).agg(F.count("*").alias("n"))
    wanted = sizes.select(label, F.explode(F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: F.call_function("div", F.col("n") * i, F.lit(folds).cast("bigint")))).alias("k")).distinct()
    cuts = values_at(clean.select(label, "_h"), [label], "_h", wanted).groupBy(label).agg(F.collect_list("value").alias("_cuts"))
    placed = clean.join(cuts, clean[label].eqNullSafe(cuts[label]), "left").select(*[clean[c] for c in clean.columns], "_cuts")
    fold = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_h"))), F.lit(0))
    folded = class_weight(placed.withColumn("fold", fold).drop("_cuts"), label)
    scaled = dealt(materialize(
        standard_scale(clean, cols).transform(folded).select(label, "features", "fold", "class_weight"), "folds"))
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", weightCol="class_weight", maxMemoryInMB=1024,
        **{**FOREST, **params})
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    model = CrossValidator(
        estimator=forest, estimatorParamMaps=ParamGridBuilder().build(), evaluator=f1,
        numFolds=folds, foldCol="fold", parallelism=4).fit(scaled)
    return df.sparkSession.createDataFrame(
        [("cv_f1", float(model.avgMetrics[0]), float(model.stdMetrics[0]))],
        "metric string, mean double, std double")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to as many tasks as the cluster runs at once, by ``keys`` if there are any."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def score(model: PipelineModel, features: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Features with prediction, probability of the cascade class and risk level.

    A row walks every tree, so rows are dealt to all tasks alike, whatever files they come from.
    """
    p = vector_to_array("probability")[1]
    out = model.transform(spread(training_matrix(features, cols)))
    return out.select(
        *features.columns, F.col("prediction").cast("int").alias("cascade_prediction"),
        p.alias("cascade_probability"), risk_level(p).alias("risk_level"))


def evaluate(model: PipelineModel, test: DataFrame, label: str = LABEL, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Rows ``(section, item, value)``: AUC, report per class, confusion cells, importances."""
    out = materialize(
        model.transform(spread(training_matrix(test, cols)))
        .select(F.col(label).cast("double").alias(label), "prediction",
                vector_to_array("probability")[1].alias("rawPrediction")), "predictions")
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0).evaluate(out)
    report = classification_metrics(out, label, "prediction")
    cells = confusion(out, label, "prediction")
    used = model.stages[0].getInputCols()
    single = [("summary", "roc_auc", float(auc))] + [
        ("feature_importance", name, float(v)) for name, v in zip(used, model.stages[-1].featureImportances.toArray())]
    rows = test.sparkSession.createDataFrame(single, "section string, item string, value double")
    per_class = report.select(F.lit("classification_report").alias("section"), F.inline(F.array(*[
        F.struct(F.concat_ws(".", "class", F.lit(m)).alias("item"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1_score", "support")])))
    matrix = cells.select(
        F.lit("confusion_matrix").alias("section"), F.format_string("%d.%d", "label", "pred").alias("item"),
        F.col("n").cast("double").alias("value"))
    return rows.unionByName(per_class).unionByName(matrix)


def forget(df: DataFrame, ids: DataFrame, key: str = "node_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def verify_forgotten(train: DataFrame, ids: DataFrame, key: str = "node_id") -> DataFrame:
    """How many of the asked ids are absent from the rows that trained the model."""
    asked = ids.select(key).distinct()
    absent = asked.join(train.select(key), key, "left_anti").agg(F.count("*")).scalar()
    return asked.agg(F.count("*").alias("requested")).select("requested", absent.alias("forgotten"))


def unlearn(
    features: DataFrame, ids: DataFrame, label_fn: Callable[[DataFrame], DataFrame] = unlearn_labels,
    cols: Sequence[str] = FEATURES, **params,
) -> tuple[PipelineModel, DataFrame]:
    """Exact unlearning: labels and model from the remaining rows; returns both."""
    kept = materialize(label_fn(forget(features, ids)), "kept")
    return train_model(kept, cols=cols, oversample=False, **params), kept
