"""Per-label classifiers with Spark ML.

One pipeline per label: gradient-boosted trees when the label has two classes, a random forest (native
multi-class probabilities) otherwise.  Classes are indexed 0, 1, ... before the fit, whatever their
values; the pipeline carries the list, so scoring returns class values and probabilities by class.
Scoring produces the long probability table every evaluation operator reads: (row_id, label, model,
y_true, y_pred, p).
"""

from __future__ import annotations

import math
import re
import time
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenaria import defaults as D
from scenaria.functions import argmax_first, finite_or_zero, renormalize
from scenaria.operators import forest


#: Rows of a partition in a tree fit, from which its counts by node are no longer the larger part of its work.
FIT_ROWS = 1 << 16
#: Partitions of a small table in a tree fit.
FIT_PARTS = 4


def features_vector(df: DataFrame, features, out: str = "features") -> DataFrame:
    """Numeric columns or one array column -> ML vector."""
    features = list(features)
    if len(features) == 1 and dict(df.dtypes)[features[0]].startswith("array"):
        return df.withColumn(out, array_to_vector(F.transform(features[0], lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


def label_classes(df: DataFrame, labels) -> dict[str, list[int]]:
    """The sorted classes of every label, in one aggregate pass."""
    row = df.agg(*[F.sort_array(F.collect_set(F.col(lab).cast("int"))).alias(lab) for lab in labels]).first()
    return {lab: list(row[lab]) for lab in labels}


def n_classes(df: DataFrame, label: str) -> int:
    return len(label_classes(df, [label])[label])


def indexed(df: DataFrame, label: str, classes: list[int]) -> DataFrame:
    """``label`` as its place in ``classes`` (double), as Spark ML wants it."""
    return df.withColumn(label, (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("int")) - 1).cast("double"))


def with_classes(fitted, label: str, classes: list[int]) -> PipelineModel:
    """The fitted stage followed by one that adds the classes as a column; it is stored with the model."""
    known = ", ".join(map(str, classes))
    return PipelineModel(stages=[fitted, SQLTransformer(statement=f"SELECT *, array({known}) AS `{label}_classes` FROM __THIS__")])


def by_class(probability, classes) -> Column:
    """Probabilities by place in ``classes`` -> by class value, 0 where the model knows no such class."""
    at = lambda c: F.array_position(classes, c).cast("int")
    return F.transform(F.sequence(F.lit(0), F.array_max(classes)),
                       lambda c: F.when(at(c) > 0, F.get(probability, at(c) - 1)).otherwise(F.lit(0.0)))


def classifier(label: str, binary: bool, max_depth: int = max(D.CV_DEPTHS), n_trees: int = D.N_TREES,
               seed: int = D.SEED, learning_rate: float = D.LEARNING_RATE, subsample: float = D.SUBSAMPLE,
               max_bins: int = D.MAX_BINS, prefix: str | None = None):
    """GBT for binary labels, random forest otherwise; output columns prefixed by ``prefix`` so the
    models of several labels can score one pass over the rows."""
    common = dict(labelCol=label, featuresCol="features", maxDepth=max_depth, subsamplingRate=subsample, maxBins=max_bins,
                  seed=seed, featureSubsetStrategy=str(D.COLSAMPLE))
    clf = GBTClassifier(maxIter=n_trees, stepSize=learning_rate, **common) if binary else \
        RandomForestClassifier(numTrees=n_trees, **common)
    if prefix:
        clf = clf.setPredictionCol(f"{prefix}_pred").setProbabilityCol(f"{prefix}_prob").setRawPredictionCol(f"{prefix}_raw")
    return clf


def few_parts(x: DataFrame, rows: int = FIT_ROWS, least: int = FIT_PARTS) -> DataFrame:
    """``x``, persisted, with no more partitions than ``rows`` rows each ask for, or ``least``.  At every node a
    partition sends counts by feature, bin and class, however few its rows are: what a tree fit shuffles is that
    size by the partitions."""
    n = max(least, math.ceil(x.count() / rows))
    return x.coalesce(n) if x.rdd.getNumPartitions() > n else x


def boost_each_class(known: DataFrame, label: str, classes: list[int], **kw) -> PipelineModel:
    """One booster per class, that class against the others; scoring normalises their probabilities.  A class
    costs as much as a binary label, so this is for few classes or few trees."""
    stages = []
    for i in range(len(classes)):
        one = known.withColumn(label, (F.col(label) == i).cast("double"))
        stages.append(classifier(label, True, prefix=f"{label}_{i}", **kw).fit(one))
    return PipelineModel(stages=[*stages, SQLTransformer(
        statement=f"SELECT *, array({', '.join(map(str, classes))}) AS `{label}_classes` FROM __THIS__")])


def _scored(x: DataFrame, label: str) -> tuple[Column, Column]:
    """(predicted class, probabilities by class) of a label whose model has been applied."""
    classes = F.col(f"{label}_classes")
    if f"{label}_prob" in x.columns:
        return F.get(classes, F.col(f"{label}_pred").cast("int")), by_class(vector_to_array(f"{label}_prob"), classes)
    n = sum(1 for c in x.columns if re.fullmatch(re.escape(label) + r"_\d+_prob", c))
    p = renormalize(F.array(*[F.get(vector_to_array(f"{label}_{i}_prob"), F.lit(1)) for i in range(n)]))
    return F.get(classes, argmax_first(p)), by_class(p, classes)


def fit_per_label(train: DataFrame, features, labels, parallelism: int | None = None, boosted: bool = False, **kw) -> dict[str, PipelineModel]:
    """M1: one fitted pipeline per label (output columns ``<label>_pred`` / ``_prob`` / ``_raw``).
    ``boosted`` fits one booster per class of a multi-class label instead of a random forest.
    The label fits are independent Spark jobs submitted from ``parallelism`` driver threads, as
    ``CrossValidator(parallelism=...)`` does."""
    labels = list(labels)
    x = features_vector(train, features).persist()  # read by every label's fit

    def fit(lab):
        known = indexed(few.where(F.col(lab).isNotNull()), lab, classes[lab])
        if boosted and len(classes[lab]) > 2:
            return lab, boost_each_class(known, lab, classes[lab], **kw)
        clf = classifier(lab, len(classes[lab]) <= 2, prefix=lab, **kw)
        return lab, with_classes(clf.fit(known), lab, classes[lab])

    try:
        classes, few = label_classes(x, labels), few_parts(x)
        with ThreadPoolExecutor(max_workers=max(1, parallelism or len(labels))) as pool:
            return dict(pool.map(fit, labels))
    finally:
        x.unpersist()


def hash_folds(df: DataFrame, id_col: str, folds: int = D.CV_FOLDS, seed: int = D.SEED, name: str = "fold") -> DataFrame:
    """``df`` with the fold of every row, 0 to ``folds`` - 1, from a seeded hash of its id: the same in every run, however
    the table is dealt, and for equal ids."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.withColumn(name, F.pmod(h, F.lit(folds)).cast("int"))


def fold_counts(df: DataFrame, label: str, name: str = "fold") -> DataFrame:
    """(fold, class, n): what each fold holds out."""
    return df.groupBy(name, F.col(label).cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n"))


def cross_validate(train: DataFrame, features, label: str, depths=D.CV_DEPTHS, folds: int = D.CV_FOLDS,
                   parallelism: int = D.CV_PARALLELISM, seed: int = D.SEED, id_col: str | None = None, **kw):
    """M2: grid search over tree depth with k-fold CV on accuracy.  Returns (best model refitted on
    all training rows, as a one-stage pipeline; table of (max_depth, accuracy)).  With ``id_col`` the folds are
    those of ``hash_folds``; else rows are drawn into folds by Spark.  All folds are fitted at once, each by
    ``parallelism`` workers: a single fit of few rows leaves most of a cluster idle."""
    classes = label_classes(train, [label])[label]
    rows = hash_folds(train, id_col, folds, seed, "_fold") if id_col else train
    x = indexed(features_vector(rows, features).where(F.col(label).isNotNull()), label, classes)
    x = (x if id_col else x.withColumn("_fold", F.floor(F.rand(seed) * folds))).persist()
    few = few_parts(x)
    if id_col:
        held = {r["_fold"]: r["count"] for r in few.groupBy("_fold").count().collect()}
        if len(held) < max(2, folds):
            raise ValueError(f"some of the {folds} folds have no rows: {sorted(held)} have")
    clf = classifier(label, len(classes) <= 2, prefix=label, **kw)
    grid = ParamGridBuilder().addGrid(clf.maxDepth, list(depths)).build()
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=f"{label}_pred", metricName="accuracy")

    def accuracy(trial):
        fold, params = trial
        return ev.evaluate(clf.fit(few.where(F.col("_fold") != fold), params).transform(few.where(F.col("_fold") == fold)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism * folds)) as pool:
        found = list(pool.map(accuracy, [(fold, params) for params in grid for fold in range(folds)]))
    means = [sum(found[i * folds:(i + 1) * folds]) / folds for i in range(len(grid))]
    best = clf.fit(few, grid[max(range(len(grid)), key=means.__getitem__)])
    x.unpersist()
    spark = train.sparkSession
    table = spark.createDataFrame([(int(pm[clf.maxDepth]), float(a)) for pm, a in zip(grid, means)],
                                  "max_depth int, accuracy double")
    return with_classes(best, label, classes), table


def score(models: dict, df: DataFrame, features, row_id, model_name: str = "tree", flat: bool = True) -> DataFrame:
    """M3: all label models applied in one pass over the rows, then unpivoted to the long probability
    table (row key..., label, model, y_true, y_pred, p); ``row_id`` is one column (renamed ``row_id``)
    or a list of key columns kept as they are.

    Tree ensembles are scored from flat arrays (see ``forest``); with ``flat=False``, and for other models, each
    model's ``transform`` is used.  Both give the same rows."""
    quick = forest.flatten(df.sparkSession, models) if flat else None
    if quick:
        x = df.withColumn("_scored", quick.column(df.sparkSession, forest.feature_columns(df, features)))
        out = {lab: (F.col(f"_scored.l{i}.y"), F.col(f"_scored.l{i}.p")) for i, lab in enumerate(models)}
    else:
        x = features_vector(df, features)
        for m in models.values():
            x = m.transform(x)
        out = {lab: _scored(x, lab) for lab in models}
    parts = [F.struct(F.lit(lab).alias("label"), F.col(lab).cast("int").alias("y_true"), y.alias("y_pred"), p.alias("p"))
             for lab, (y, p) in out.items()]
    keys = [F.col(row_id).alias("row_id")] if isinstance(row_id, str) else [F.col(c) for c in row_id]
    names = ["row_id"] if isinstance(row_id, str) else list(row_id)
    return x.select(*keys, F.explode(F.array(*parts)).alias("_t")) \
        .select(*names, "_t.label", F.lit(model_name).alias("model"), "_t.y_true", "_t.y_pred", "_t.p")


def flatten_sequences(long_seqs: DataFrame, key: str, features, labels, seq_len: int) -> DataFrame:
    """M4 input: one row per sequence, steps x features flattened in step order, labels of the last step."""
    g = long_seqs.groupBy(key, "seq_id").agg(F.sort_array(F.collect_list(F.struct(
        "step", F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        *[F.col(l) for l in labels]))).alias("_s"))
    g = g.where(F.size("_s") == seq_len)
    return g.select(key, "seq_id", F.flatten(F.transform("_s", lambda t: t["x"])).alias("seq"),
                    *[F.element_at("_s", -1)[l].alias(l) for l in labels])


def sequence_vector(seqs: DataFrame) -> DataFrame:
    """``raw``: the window as a vector; a missing or non-finite value is 0."""
    return seqs.withColumn("raw", array_to_vector(F.transform("seq", lambda x: finite_or_zero(x))))


def fit_sequence_model(seqs: DataFrame, labels, n_inputs: int, n_classes_fixed: int = D.N_CLASSES, hidden: int = 32,
                       max_iter: int = 100, seed: int = D.SEED) -> dict[str, PipelineModel]:
    """M4 (re-aimed): standardised flattened windows -> one multilayer perceptron per label with a
    fixed class count; the scaler is fitted once and shared.  Rows without a label are left out."""
    x = sequence_vector(seqs)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(x)
    x = scaler.transform(x).persist()
    models = {}
    for lab in labels:
        mlp = MultilayerPerceptronClassifier(labelCol=lab, featuresCol="features", layers=[n_inputs, hidden, n_classes_fixed],
                                             maxIter=max_iter, seed=seed, predictionCol=f"{lab}_pred",
                                             probabilityCol=f"{lab}_prob", rawPredictionCol=f"{lab}_raw")
        fitted = mlp.fit(x.where(F.col(lab).isNotNull()).withColumn(lab, F.col(lab).cast("double")))
        models[lab] = PipelineModel(stages=[scaler, fitted])
    x.unpersist()
    return models


def score_sequences(models: dict, seqs: DataFrame, key: str, model_name: str = "seq") -> DataFrame:
    """M4 scoring: all label models in one pass over the windows, unpivoted once."""
    x = sequence_vector(seqs)
    for i, m in enumerate(models.values()):
        x = (m if i == 0 else PipelineModel(stages=m.stages[1:])).transform(x)  # one scaler for all
    parts = [F.struct(F.lit(lab).alias("label"), F.col(lab).cast("int").alias("y_true"), F.col(f"{lab}_pred").cast("int").alias("y_pred"),
                      vector_to_array(f"{lab}_prob").alias("p")) for lab in models]
    return x.select(F.col(key), "seq_id", F.explode(F.array(*parts)).alias("_t")) \
        .select(key, "seq_id", "_t.label", F.lit(model_name).alias("model"), "_t.y_true", "_t.y_pred", "_t.p")


def importances(models: dict, feature_names, top: int = D.TOP_IMPORTANCES) -> DataFrame:
    """Top feature importances per label (the vectors are feature-count sized, fitted metadata)."""
    rows = []
    for lab, m in models.items():
        each = [x.featureImportances.toArray() for x in m.stages if hasattr(x, "featureImportances")]
        imp = sum(each) / len(each)  # one model, or the mean over the boosters of a label's classes
        rows += [(lab, str(feature_names[i]) if i < len(feature_names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    t = spark.createDataFrame(rows, "label string, feature string, importance double")
    from pyspark.sql import Window
    w = Window.partitionBy("label").orderBy(F.desc("importance"), "feature")
    return t.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def scoring_time(named: dict[str, DataFrame]) -> DataFrame:
    """Wall time of scoring each model's table, forced with the no-op sink, and ms per row;
    the row count is observed during that same pass."""
    from pyspark.sql import Observation, SparkSession
    spark = SparkSession.getActiveSession()
    rows = []
    for name, df in named.items():
        obs = Observation(f"scoring_{name}")
        t0 = time.perf_counter()
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        total = time.perf_counter() - t0
        n = int(obs.get["n"])
        rows.append((name, n, total, total / n * 1000.0 if n else None))
    return spark.createDataFrame(rows, "model string, rows long, total_s double, ms_per_sample double")


def save(models: dict, path: str) -> None:
    """One Spark ML directory per label."""
    for lab, m in models.items():
        m.write().overwrite().save(f"{path}/{lab}")


def load(path: str, labels) -> dict:
    """Load what exists; a label without a stored model is absent from the result, any other failure (a
    corrupt store, no permission) is raised."""
    out = {}
    for lab in labels:
        try:
            out[lab] = PipelineModel.load(f"{path}/{lab}")
        except (AnalysisException, Py4JJavaError) as e:
            if "does not exist" not in str(e) and "PATH_NOT_FOUND" not in str(e):
                raise
    return out
