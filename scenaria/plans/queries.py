"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenaria.operators import windows
from scenaria.plans import views
from scenaria.plans.views import SERIES_ROLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


F2 = SERIES_ROLES.with_features(["f2"])


def _features(spark, sf_dir, kinds, **kw):
    s = views.series(spark, sf_dir).select("scenario_id", "event_id", "Time", "f2")  # positions carry these alone
    return windows.engineer_features(s, F2, kinds=kinds, time_since_start=False, **kw)


@query
def q_rolling_mean(spark, sf_dir):
    return _features(spark, sf_dir, ("rolling_mean",)).select(
        "event_id", "scenario_id", r6("f2_rolling_mean_10").alias("f2_rolling_mean_10"))


@query
def q_rolling_std(spark, sf_dir):
    return _features(spark, sf_dir, ("rolling_std",)).select(
        "event_id", "scenario_id", r6("f2_rolling_std_10").alias("f2_rolling_std_10"))


@query
def q_diff(spark, sf_dir):
    return _features(spark, sf_dir, ("diff",)).select("event_id", "scenario_id", r6("f2_diff").alias("f2_diff"))


@query
def q_ema(spark, sf_dir):
    return _features(spark, sf_dir, ("ema",)).select("event_id", "scenario_id", r6("f2_ema_10").alias("f2_ema_10"))


@query
def q_time_since_start(spark, sf_dir):
    out = windows.time_since_start(views.series(spark, sf_dir), SERIES_ROLES)
    return out.select("event_id", "scenario_id", r6("time_since_start").alias("time_since_start"))


@query
def q_time_to_failure(spark, sf_dir):
    s = views.series(spark, sf_dir)
    out = windows.engineer_features(s, SERIES_ROLES.with_features([]), kinds=(), time_since_start=False,
                                    ttf_label="A_label")
    return out.select("event_id", "scenario_id", r6("A_time_to_failure").alias("A_time_to_failure"))


def flagship(spark, sf_dir):
    """All window features of the series (both features) in one plan."""
    out = windows.engineer_features(views.series(spark, sf_dir), SERIES_ROLES, ttf_label="A_label")
    cols = [c for c in out.columns if c not in ("scenario_id", "event_id")]
    return out.select("scenario_id", "event_id", *[r6(c).alias(c) if c not in SERIES_ROLES.labels else c
                                                   for c in cols])


# ---- cleaning -------------------------------------------------------------------------------
from scenaria.operators import clean  # noqa: E402


@query
def q_interpolate(spark, sf_dir):
    out = clean.interpolate(views.series(spark, sf_dir), SERIES_ROLES, ["f1"])
    return out.select("event_id", "scenario_id", r6("f1").alias("f1"))


@query
def q_ffill_bfill(spark, sf_dir):
    out = clean.interpolate(views.series(spark, sf_dir), SERIES_ROLES, ["f1"], back_fill=True)
    return out.select("event_id", "scenario_id", r6("f1").alias("f1"))


@query
def q_mode_fill(spark, sf_dir):
    s = views.series(spark, sf_dir)
    s = s.withColumn("A_label", F.when(F.col("event_id") % 17 != 0, F.col("A_label")))
    return clean.mode_fill(s, ["A_label"]).select("event_id", "A_label")


@query
def q_mean_fill(spark, sf_dir):
    return clean.mean_fill(views.series(spark, sf_dir), ["f1"]).select("event_id", r6("f1").alias("f1"))


def nonfinite_input(spark, sf_dir):
    s = views.series(spark, sf_dir)
    e = F.col("event_id")
    x = (F.when(F.col("f1").isNull(), F.lit(float("nan")))
         .when(e % 7 == 0, F.lit(float("inf"))).when(e % 11 == 0, F.lit(float("-inf")))
         .otherwise(F.col("f1") / F.log(F.col("f2") + 2)))
    return s.select("event_id", x.alias("x"))


@query
def q_nonfinite_to_zero(spark, sf_dir):
    return clean.nonfinite_to_zero(nonfinite_input(spark, sf_dir), ["x"]).select("event_id", r6("x").alias("x"))


@query
def q_null_audit(spark, sf_dir):
    return clean.null_audit(views.series(spark, sf_dir))


# ---- label statistics and splits ----------------------------------------------------------
from scenaria.operators import split as splitting  # noqa: E402
from scenaria.operators import stats  # noqa: E402

LABELS = list(SERIES_ROLES.labels)


@query
def q_scenario_modes(spark, sf_dir):
    return stats.scenario_modes(views.series(spark, sf_dir), "scenario_id", LABELS)


@query
def q_class_counts(spark, sf_dir):
    return stats.class_counts(views.series(spark, sf_dir), LABELS)


@query
def q_combo_counts(spark, sf_dir):
    return stats.combo_counts(views.series(spark, sf_dir), LABELS)


@query
def q_top_combos(spark, sf_dir):
    return stats.top_combos(views.series(spark, sf_dir), LABELS, 10)


@query
def q_diversity(spark, sf_dir):
    return stats.diversity(views.series(spark, sf_dir), LABELS)


def series_split(spark, sf_dir):
    s = views.series(spark, sf_dir)
    return s, splitting.scenario_split(s, "scenario_id", "C_label")


@query
def q_split_scenarios(spark, sf_dir):
    return series_split(spark, sf_dir)[1]


@query
def q_split_rebalance(spark, sf_dir):
    s, sp = series_split(spark, sf_dir)
    modes = stats.scenario_modes(s, "scenario_id", LABELS)
    out, _moves = splitting.rebalance(sp, modes, "scenario_id", LABELS, "C_label")
    return out


@query
def q_split_report(spark, sf_dir):
    s, sp = series_split(spark, sf_dir)
    return splitting.split_report(s, sp, "scenario_id", LABELS)


@query
def q_split_missing_classes(spark, sf_dir):
    s, sp = series_split(spark, sf_dir)
    return splitting.missing_classes(s, sp, "scenario_id", LABELS)


@query
def q_row_split(spark, sf_dir):
    return splitting.row_split(views.series(spark, sf_dir), LABELS, "event_id")


# ---- sequences -------------------------------------------------------------------------------
from scenaria.operators import sequences  # noqa: E402

SEQ_COLS = ["scenario_id", "seq_id", "step", "event_id"]


@query
def q_sequences_strided(spark, sf_dir):
    out = sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 20, 15)
    return out.select(*SEQ_COLS, r6("f2").alias("f2"))


@query
def q_sequences_even(spark, sf_dir):
    out = sequences.even(views.series(spark, sf_dir), SERIES_ROLES, 20, 10)
    return out.select(*SEQ_COLS, r6("f2").alias("f2"))


@query
def q_sequences_random(spark, sf_dir):
    out = sequences.random_subset(views.series(spark, sf_dir), SERIES_ROLES, 20, 50, 42)
    return out.select(*SEQ_COLS, r6("f2").alias("f2"))


@query
def q_last_step(spark, sf_dir):
    out = sequences.last_step(sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 20, 15), 20)
    return out.select("scenario_id", "seq_id", "event_id", *LABELS)


# ---- normalisation ---------------------------------------------------------------------------
from scenaria.operators import scale  # noqa: E402

SEQ_FEATURES = ["f1", "f2"]


def _train_sequences(spark, sf_dir):
    return sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 20, 15)


@query
def q_feature_stats(spark, sf_dir):
    t = scale.scaler_table(scale.fit_scaler(_train_sequences(spark, sf_dir), SEQ_FEATURES), SEQ_FEATURES)
    return t.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


@query
def q_standardize(spark, sf_dir):
    seqs = _train_sequences(spark, sf_dir)
    out = scale.standardize(seqs, SEQ_FEATURES, scale.fit_scaler(seqs, SEQ_FEATURES))
    return out.select("scenario_id", "seq_id", "step", r6("f1").alias("f1"), r6("f2").alias("f2"))


@query
def q_one_hot(spark, sf_dir):
    last = sequences.last_step(_train_sequences(spark, sf_dir), 20)
    return scale.one_hot_long(last, "C_label", 6, ["scenario_id", "seq_id"])


# ---- metrics ---------------------------------------------------------------------------------
from scenaria.operators import ensemble, metrics  # noqa: E402


@query
def q_accuracy(spark, sf_dir):
    return metrics.accuracy(views.predictions(spark, sf_dir)).withColumn("accuracy", r6("accuracy"))


@query
def q_pooled_accuracy(spark, sf_dir):
    return metrics.pooled_accuracy(views.predictions(spark, sf_dir)).withColumn("accuracy", r6("accuracy"))


@query
def q_macro_accuracy(spark, sf_dir):
    return metrics.macro_accuracy(views.predictions(spark, sf_dir)).withColumn("accuracy", r6("accuracy"))


@query
def q_class_recall(spark, sf_dir):
    return metrics.class_recall(views.predictions(spark, sf_dir)).withColumn("recall", r6("recall"))


@query
def q_confusion_truth(spark, sf_dir):
    return metrics.confusion(views.predictions(spark, sf_dir), union=False)


@query
def q_confusion_union(spark, sf_dir):
    return metrics.confusion(views.predictions(spark, sf_dir), union=True)


@query
def q_class_report(spark, sf_dir):
    r = metrics.class_report(views.predictions(spark, sf_dir))
    return r.select("model", "label", "cls", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score", "support")])


# ---- blending --------------------------------------------------------------------------------

def _aligned(spark, sf_dir, drop_second=False):
    tree, seq = views.model_probs(spark, sf_dir)
    if drop_second:
        seq = seq.where(F.col("event_id") % 10 != 0)
    return tree, seq, ensemble.align(tree, seq, ["event_id", "label"])


@query
def q_blend(spark, sf_dir):
    j = _aligned(spark, sf_dir)[2]
    return ensemble.blended(j, 0.5).select("event_id", "y_true", "y_pred")


@query
def q_blend_truncated(spark, sf_dir):
    tree, seq = views.model_probs(spark, sf_dir)
    seq = seq.withColumn("p", F.slice("p", 1, 5))          # second model knows five classes
    j = ensemble.truncate_common(ensemble.align(tree, seq, ["event_id", "label"]))
    return ensemble.blended(j, 0.5).select("event_id", "y_true", "y_pred")


@query
def q_blend_mismatch(spark, sf_dir):
    tree, seq, _ = _aligned(spark, sf_dir, drop_second=True)
    out = ensemble.mismatch(tree, seq, ["event_id", "label"])
    return out.select("label", "n_first", "n_second", "n_aligned", "mismatch", "chosen",
                      r6("acc_chosen").alias("acc_chosen"), r6("acc_aligned").alias("acc_aligned"))


def _curve(spark, sf_dir, n_steps=20):
    return ensemble.weight_curve(views.aligned_probs(spark, sf_dir), n_steps)


@query
def q_weight_curve(spark, sf_dir):
    return _curve(spark, sf_dir).select("label", r6("weight").alias("weight"), r6("accuracy").alias("accuracy"))


@query
def q_best_weight(spark, sf_dir):
    b = ensemble.best_weight(_curve(spark, sf_dir))
    return b.select("label", r6("weight").alias("weight"), r6("accuracy").alias("accuracy"))


def _accuracies(spark, sf_dir):
    """(label, tree, seq, blend_50, blend_opt, weight_orig, weight_opt) over the aligned rows, all read
    off one aggregate: the 11-point grid and 0.5 lie on the 21-point grid."""
    from scenaria.session import cut_lineage
    g = cut_lineage(ensemble.grid_counts(views.aligned_probs(spark, sf_dir), 20))   # one small row per label
    c21 = ensemble.curve_from_counts(g, 20)
    orig = ensemble.best_weight(ensemble.curve_from_counts(g, 10)).select("label", F.col("weight").alias("weight_orig"))
    opt = ensemble.best_weight(c21).select("label", F.col("weight").alias("weight_opt"))
    at = lambda w, name: c21.where(F.col("weight") == w).select("label", F.col("accuracy").alias(name))
    tuned = c21.join(opt, "label").where(F.col("weight") == F.col("weight_opt")).select(
        "label", F.col("accuracy").alias("blend_opt"))
    single = g.select("label", (F.col("_first") / F.col("_n")).alias("tree"), (F.col("_second") / F.col("_n")).alias("seq"))
    return single.join(at(0.5, "blend_50"), "label").join(tuned, "label").join(orig, "label").join(opt, "label")


@query
def q_blend_gain(spark, sf_dir):
    a = _accuracies(spark, sf_dir)
    return a.select("label", r6("blend_50").alias("acc_default"), r6("blend_opt").alias("acc_opt"),
                    r6(F.col("blend_opt") - F.col("blend_50")).alias("improvement"))


@query
def q_best_model(spark, sf_dir):
    a = _accuracies(spark, sf_dir).select("label", "tree", "seq", F.col("blend_50").alias("blend"))
    t = ensemble.blend_improves(ensemble.best_model(a, ["tree", "seq", "blend"]), "tree", "seq", "blend")
    return t.select("label", *[r6(c).alias(c) for c in ("tree", "seq", "blend")], "best_model", "blend_improves")


@query
def q_model_comparison(spark, sf_dir):
    pred = views.predictions(spark, sf_dir)
    t = ensemble.comparison(metrics.accuracy(pred), ["tree", "seq"], metrics.pooled_accuracy(pred))
    return t.select("label", r6("tree").alias("tree"), r6("seq").alias("seq"))


@query
def q_before_after(spark, sf_dir):
    a = _accuracies(spark, sf_dir)
    cols = ["tree", "seq", "blend_50", "blend_opt"]
    overall = a.agg(*[F.avg(c).alias(c) for c in cols]).select(
        F.lit("overall").alias("label"), *cols, F.lit(None).cast("double").alias("weight_orig"),
        F.lit(None).cast("double").alias("weight_opt"))
    t = a.select("label", *cols, "weight_orig", "weight_opt").unionByName(overall)
    return t.select("label", *[r6(c).alias(c) for c in cols + ["weight_orig", "weight_opt"]])


# ---- balancing -------------------------------------------------------------------------------
from scenaria.operators import balance  # noqa: E402


@query
def q_knn_in_class(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings")
    return balance.knn_in_class(e, "vec_id", "embedding", "label", k=5).select(
        "vec_id", "rank", "nbr_id", r6("d2").alias("d2"))


@query
def q_smote_counts(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings")
    out, _plan = balance.smote_if_rare(e, "vec_id", "embedding", "label", 100, k=5)
    return out.groupBy(F.col("label").alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query
def q_smote_combo_counts(spark, sf_dir):
    lab = views.table(spark, sf_dir, "labels")
    docs = views.table(spark, sf_dir, "documents").select("doc_id", F.array(F.col("n_chars").cast("double")).alias("x"))
    t, _ran = balance.smote_combos(lab.join(docs, "doc_id"), "doc_id", "x", ["quality", "toxic"], k=5)
    return t.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


# ---- sources ---------------------------------------------------------------------------------
from scenaria.sources import io  # noqa: E402


@query
def q_read_roles(spark, sf_dir):
    """The series written as one CSV per scenario group (``a.csv``, ``b.v2.csv``) into the shared
    scratch folder, read back in one scan with header-derived types and file-name keys."""
    s = views.series(spark, sf_dir).drop("event_id", "scenario_id")
    s = s.select("Time", "f1", "f2", *LABELS, F.floor(F.col("Time") * 1e6).alias("_t"))
    folder = io.shared_scratch(spark, "read_roles")
    parts = {"a": F.col("_t") % 2 == 0, "b.v2": F.col("_t") % 2 == 1}
    for name, cond in parts.items():
        s.where(cond).drop("_t").write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
    df, _roles = io.read_scenarios(spark, folder)
    return df


# ---- models ----------------------------------------------------------------------------------
from scenaria.operators import model  # noqa: E402


def _emb_split(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings")
    sp = splitting.row_split(e, ["label"], "vec_id")
    return e.join(sp, "vec_id")


@query
def q_tree_fit(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=5, n_trees=100)
    s = model.score(models, e, ["embedding"], "vec_id")
    return s.select("row_id", "label", "y_true", "y_pred")


@query
def q_tree_cv(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    _best, table = model.cross_validate(e.where("split = 'train'"), ["embedding"], "label", n_trees=50)
    return table


@query
def q_seq_fit(spark, sf_dir):
    s = clean.interpolate(views.series(spark, sf_dir), SERIES_ROLES, ["f1"], back_fill=True)
    train = model.flatten_sequences(sequences.strided(s, SERIES_ROLES, 20, 15), "scenario_id", SEQ_FEATURES, ["C_label"], 20)
    test = model.flatten_sequences(sequences.even(s, SERIES_ROLES, 20, 10), "scenario_id", SEQ_FEATURES, ["C_label"], 20)
    m = model.fit_sequence_model(train, ["C_label"], n_inputs=20 * len(SEQ_FEATURES), max_iter=50)
    return model.score_sequences(m, test, "scenario_id").select("scenario_id", "seq_id", "label", "y_true", "y_pred")


@query
def q_importances(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=5, n_trees=100)
    return model.importances(models, [f"e{i}" for i in range(64)], 20)


@query
def q_scoring_time(spark, sf_dir):
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=5, n_trees=100)
    test = e.where("split = 'test'")
    return model.scoring_time({"tree": model.score(models, test, ["embedding"], "vec_id")})


def tree_scoring(spark, sf_dir, n_trees: int = 100, least_rows: int = 352_291):
    """Bench helper (the published scoring measurement): prepare the series, split by scenario and
    snapshot train/test (as the preparation step writes them), fit one model of ``n_trees`` trees for each of
    five labels on the train rows, then time scoring of the test rows, and of all rows, repeated until they
    are as many as the published run scored, with all models, after a warm-up.
    Returns fit seconds and, for the test rows and for all rows, scoring seconds and row counts."""
    labels = [*LABELS, "D_label", "E_label"]
    import time as _t
    from scenaria.session import cut_lineage
    from scenaria.operators import keyed
    s = clean.preprocess(keyed.with_position(views.series(spark, sf_dir), "scenario_id", SERIES_ROLES.order),
                         SERIES_ROLES)
    feats = windows.engineer_features(s, SERIES_ROLES, ttf_label=None, keep_pos=True)
    sp = splitting.scenario_split(s, "scenario_id", "C_label")
    # the snapshot the scoring reads is spread over the configured shuffle partitions (at least one per
    # core), as a written table is split into files, so scoring uses every core
    par = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    joined = splitting.assign(feats, sp, "scenario_id").withColumn("D_label", F.col("A_label") % 3).withColumn(
        "E_label", (F.col("B_label") + F.col("C_label")) % 4)
    table = cut_lineage(joined.repartition(par))
    fcols = [c for c in feats.columns if c not in ("scenario_id", "event_id", *LABELS) and not c.startswith("_")]
    train = table.where("split = 'train'")
    copies = -(-least_rows // table.count())
    many = cut_lineage(table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).repartition(par))
    test = cut_lineage(table.where("split = 'test'").repartition(par))
    t0 = _t.perf_counter()
    models = model.fit_per_label(train, fcols, labels, max_depth=5, n_trees=n_trees)
    fit = _t.perf_counter() - t0
    scored = {"warm-up": model.score(models, test, fcols, "event_id"), "test": model.score(models, test, fcols, "event_id"),
              "all": model.score(models, many, fcols, "event_id")}
    t = {r["model"]: r for r in model.scoring_time(scored).collect()}
    return {"fit_s": fit, "test_score_s": t["test"]["total_s"], "test_rows": t["test"]["rows"] // len(labels),
            "all_score_s": t["all"]["total_s"], "all_rows": t["all"]["rows"] // len(labels), "labels": len(labels), "trees": n_trees}


def sequence_scoring(spark, sf_dir, seq_len: int = 20):
    """Bench helper (the published sequence scoring measurement): per-label sequence models fitted on
    the strided windows of the train scenarios, then timed scoring of the evenly spaced windows of the
    test scenarios (standardisation is part of the fitted pipeline, so it is inside the timer)."""
    import time as _t
    from scenaria.operators import keyed
    from scenaria.session import cut_lineage
    s = clean.preprocess(keyed.with_position(views.series(spark, sf_dir), "scenario_id", SERIES_ROLES.order),
                         SERIES_ROLES)
    sp = splitting.scenario_split(s, "scenario_id", "C_label")
    rows = splitting.assign(s, sp, "scenario_id")
    train = cut_lineage(model.flatten_sequences(sequences.strided(rows.where("split = 'train'"), SERIES_ROLES, seq_len, 15),
                                                "scenario_id", SEQ_FEATURES, LABELS, seq_len))
    test = cut_lineage(model.flatten_sequences(sequences.even(rows.where("split = 'test'"), SERIES_ROLES, seq_len, 10),
                                               "scenario_id", SEQ_FEATURES, LABELS, seq_len))
    t0 = _t.perf_counter()
    models = model.fit_sequence_model(train, LABELS, n_inputs=seq_len * len(SEQ_FEATURES), max_iter=50)
    fit = _t.perf_counter() - t0
    t = model.scoring_time({"seq": model.score_sequences(models, test, "scenario_id")}).first()
    return {"fit_s": fit, "score_s": t["total_s"], "sequences": t["rows"] // len(LABELS)}


# ---- further inventory operators ---------------------------------------------------------------

@query
def q_min_class_count(spark, sf_dir):
    """Per label the smallest class count (decides whether a label is balanced)."""
    return stats.min_class_count(views.series(spark, sf_dir), LABELS)


@query
def q_null_total(spark, sf_dir):
    """Frame-wide count of missing cells."""
    return clean.null_total(views.series(spark, sf_dir))


@query
def q_sequences_keyless(spark, sf_dir):
    """Strided windows over the whole table as one series, in (Time, event_id) order."""
    s = views.series(spark, sf_dir).select("event_id", "Time", "f2")
    out = sequences.keyless(s, ["Time", "event_id"], 20, 15)
    return out.select("seq_id", "step", "event_id", r6("f2").alias("f2"))


# ---- edges: long gaps, many classes, headers, null labels, missing mass ---------------------------

@query
def q_ffill_only(spark, sf_dir):
    """N2 alone."""
    out = clean.fill_forward_backward(views.series(spark, sf_dir), SERIES_ROLES, ["f1"])
    return out.select("event_id", "scenario_id", r6("f1").alias("f1"))


@query
def q_ema_gap(spark, sf_dir):
    """W3 over the whole event table as one series whose values lie far apart: gaps of several chunks."""
    s = views.gappy(spark, sf_dir)
    out = windows.engineer_features(s, views.GAPPY_ROLES, kinds=("ema",), time_since_start=False)
    return out.select("event_id", r6("x_ema_10").alias("x_ema_10"))


@query
def q_blend_ten(spark, sf_dir):
    """F13/T7 with ten classes (the labels of ``embeddings``)."""
    j = views.ten_class_probs(spark, sf_dir)
    return ensemble.blended(j, 0.5).select("vec_id", "y_true", "y_pred", ensemble.predict(F.col("p1")).alias("y_first"))


@query
def q_truncate_no_mass(spark, sf_dir):
    """F14 where the cut classes hold all the mass: the rest stays zero."""
    lab = views.table(spark, sf_dir, "labels")
    q = F.col("quality").cast("double")
    j = lab.select("doc_id", F.array(q / 4, q * 0.5, F.lit(1.0) - q * 0.75).alias("p1"), F.array(F.lit(0.25), F.lit(0.75)).alias("p2"))
    return ensemble.truncate_common(j).select("doc_id", *[r6(F.get(p, F.lit(i))).alias(f"{p}_{i}") for p in ("p1", "p2") for i in (0, 1)])


@query
def q_combo_nulls(spark, sf_dir):
    """combined keys with missing labels, and back."""
    s = views.series(spark, sf_dir)
    e = F.col("event_id")
    s = s.select(F.when(e % 5 != 0, F.col("A_label")).alias("A_label"), F.when(e % 7 != 0, F.col("B_label")).alias("B_label"), "C_label")
    from scenaria.functions import combo_ints, combo_key
    t = s.groupBy(combo_key(LABELS).alias("combo")).agg(F.count(F.lit(1)).alias("n"))
    return t.select("combo", "n", *[c.alias(x) for x, c in zip(LABELS, combo_ints(F.col("combo"), 3), strict=True)])


@query
def q_read_headers(spark, sf_dir):
    """Files whose headers differ in order and columns, united by name."""
    s = views.series(spark, sf_dir)
    folder = io.shared_scratch(spark, "read_headers")
    s.where("event_id % 2 = 0").select("Time", "f1", "f2", "A_label").write.option("header", True).csv(f"{folder}/even.csv")
    s.where("event_id % 2 = 1").select("A_label", "f2", "Time", "C_label").write.option("header", True).csv(f"{folder}/odd.csv")
    df, _roles = io.read_scenarios(spark, folder)
    return df.select("scenario_id", "Time", "f1", "f2", "A_label", "C_label")


@query
def q_scenario_split_counts(spark, sf_dir):
    """Scenarios per label, modal class and split."""
    s, sp = series_split(spark, sf_dir)
    return splitting.scenario_split_counts(stats.scenario_modes(s, "scenario_id", LABELS), sp, "scenario_id", LABELS)


@query
def q_missing_in_splits(spark, sf_dir):
    """X4 where classes are missing: the only scenario of a class can be in one split alone."""
    s, sp = series_split(spark, sf_dir)
    own = s.withColumn("A_label", F.when(F.col("scenario_id") % 50 == 0, F.col("scenario_id").cast("int")).otherwise(F.col("A_label")))
    return splitting.missing_classes(own, sp, "scenario_id", ["A_label"])


@query
def q_before_after_report(spark, sf_dir):
    """A comparison written before, read back and set beside the present one."""
    pred = views.predictions(spark, sf_dir)
    now = ensemble.comparison(metrics.accuracy(pred), ["tree", "seq"])
    path = io.shared_scratch(spark, "before")
    io.write_report(now.where("label = 'C_label'").select("label", (F.col("tree") / 2).alias("tree"), (F.col("seq") / 4).alias("seq")), path)
    t = ensemble.before_after(io.read_report(spark, path, "label string, tree double, seq double"), now)
    return t.select("label", *[r6(c).alias(c) for c in t.columns if c != "label"])


@query
def q_blend_report(spark, sf_dir):
    """A12 with the blend as a third model."""
    j = views.aligned_probs(spark, sf_dir)
    blend = ensemble.blended(j, 0.5).select(F.lit("blend").alias("model"), "label", F.col("event_id").alias("row_id"), "y_true", "y_pred")
    r = metrics.class_report(metrics.counts(views.predictions(spark, sf_dir).unionByName(blend)))
    return r.select("model", "label", "cls", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score", "support")])


@query
def q_tree_fit_binary(spark, sf_dir):
    """M1/M3 on a binary label of classes 0 and 2: rows scored per split and class, predictions and probabilities."""
    lab = views.table(spark, sf_dir, "labels").join(views.table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double")), "doc_id")
    t = lab.select("doc_id", "n_chars", F.length(F.col("n_chars").cast("string")).cast("double").alias("digits"), (F.col("quality") * 2).alias("quality"))
    t = t.join(splitting.row_split(t, ["quality"], "doc_id"), "doc_id")
    models = model.fit_per_label(t.where("split = 'train'"), ["n_chars", "digits"], ["quality"], max_depth=3, n_trees=20)
    s = model.score(models, t, ["n_chars", "digits"], ["doc_id", "split"])
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return s.groupBy("split", "y_true").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("p")).cast("long").alias("classes"), r6(F.avg(total)).alias("mass"),
        F.bool_and(F.col("y_pred").isin(0, 2)).alias("known"))


def _fit_rows(scored, by):
    """What any fit must give: one prediction per row, of a known class, and probabilities that sum to 1."""
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return scored.groupBy(*by, "label", "y_true").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("p")).cast("long").alias("classes"), r6(F.avg(total)).alias("mass"),
        F.bool_and(F.col("y_pred").between(0, F.size("p") - 1)).alias("known"))


@query
def q_tree_fit_rows(spark, sf_dir):
    """M1/M3 on the ten classes of ``embeddings``: rows scored per split and class."""
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=5, n_trees=20)
    return _fit_rows(model.score(models, e, ["embedding"], ["vec_id", "split"]), ["split"])


@query
def q_seq_fit_rows(spark, sf_dir):
    """M4: evenly spaced windows scored per class of their last step."""
    s = clean.interpolate(views.series(spark, sf_dir), SERIES_ROLES, ["f1"], back_fill=True)
    flat = lambda x: model.flatten_sequences(x, "scenario_id", SEQ_FEATURES, ["C_label"], 20)
    m = model.fit_sequence_model(flat(sequences.strided(s, SERIES_ROLES, 20, 15)), ["C_label"], n_inputs=40, max_iter=20)
    return _fit_rows(model.score_sequences(m, flat(sequences.even(s, SERIES_ROLES, 20, 10)), "scenario_id"), [])


def _synthetic(out, by):
    return out.where("synthetic").select(*by, *[F.round(F.element_at("embedding", i + 1).cast("double"), 4).alias(f"v{i}") for i in range(4)])


@query
def q_smote_rows(spark, sf_dir):
    """The synthetic rows themselves."""
    e = views.table(spark, sf_dir, "embeddings")
    return _synthetic(balance.smote(e, "vec_id", "embedding", "label", k=5)[0], ["label"])


@query
def q_smote_equal_rows(spark, sf_dir):
    """X5/X7 where half of each class are equal rows."""
    e = views.table(spark, sf_dir, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 2 == 0, F.array(
        *[(F.col("label") + i).cast("float") for i in range(64)])).otherwise(F.col("embedding")))
    return _synthetic(balance.smote(e, "vec_id", "embedding", "label", k=5)[0], ["label"])


@query
def q_tree_flat(spark, sf_dir):
    """M3: flat scoring beside ``transform``, on every row, of a forest over the ten classes and of a binary booster:
    rows, and those whose class or any probability differs."""
    e = _emb_split(spark, sf_dir).withColumn("odd", F.col("vec_id") % 2)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label", "odd"], max_depth=5, n_trees=20)
    flat, slow = (model.score(models, e, ["embedding"], "vec_id", flat=x) for x in (True, False))
    slow = slow.select("row_id", "label", F.col("y_pred").alias("y2"), F.col("p").alias("p2"))
    far = F.array_max(F.transform(F.arrays_zip("p", "p2"), lambda z: F.abs(z["p"] - z["p2"]))) > 1e-12
    differ = (~F.col("y_pred").eqNullSafe(F.col("y2"))) | (F.size("p") != F.size("p2")) | F.coalesce(far, F.lit(True))
    return flat.join(slow, ["row_id", "label"], "full").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(differ.cast("long")).alias("differing"))


@query
def q_exact_weight(spark, sf_dir):
    """M7 without a grid: the best interval of weights per label, here one per label of the series."""
    j = views.aligned_probs(spark, sf_dir)
    j = j.unionByName(j.withColumn("label", F.lit("next")).withColumn("y_true", (F.col("y_true") + 1) % 6))
    e = ensemble.exact_weight(j)
    return e.select("label", r6("weight").alias("weight"), r6("upto").alias("upto"), "hits", r6("accuracy").alias("accuracy"))


@query
def q_accuracy_at(spark, sf_dir):
    """The blend's accuracy at each label's searched weight, and at the default where a label has none."""
    j = views.aligned_probs(spark, sf_dir)
    weights = ensemble.best_weight(_curve(spark, sf_dir))
    both = j.unionByName(j.withColumn("label", F.lit("next")).withColumn("y_true", (F.col("y_true") + 1) % 6))
    return ensemble.accuracy_at(both, weights).select("label", r6("accuracy").alias("accuracy"))


# ---- stores, folds, caps and invariants of fits ----------------------------------------------

@query
def q_snapshot_split(spark, sf_dir):
    """A snapshot by split is written and one split read back: rows and classes."""
    path = io.shared_scratch(spark, "snapshot")
    io.write_snapshot(_emb_split(spark, sf_dir).select("vec_id", "label", "split"), path)
    return io.read_snapshot(spark, path, "test").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))


@query
def q_sequence_snapshot(spark, sf_dir):
    """Strided windows as arrays of steps, written and read back: their sizes, sums and labels."""
    path = io.shared_scratch(spark, "sequences")
    s = sequences.to_arrays(sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 20, 15), "scenario_id", ["f2"], LABELS, 20)
    io.write_snapshot(s, path)
    step = lambda i: F.element_at(F.element_at("X", i), 1).cast("double")
    total = F.aggregate("X", F.lit(0.0), lambda a, x: a + F.coalesce(F.element_at(x, 1).cast("double"), F.lit(0.0)))
    return io.read_snapshot(spark, path).select("scenario_id", "seq_id", F.size("X").cast("long").alias("steps"), r6(step(1)).alias("first"),
                                                r6(step(20)).alias("last"), r6(total).alias("total"), *LABELS)


@query
def q_roles_round_trip(spark, sf_dir):
    """Column roles through a Parquet round trip."""
    path = io.shared_scratch(spark, "roles")
    s = views.series(spark, sf_dir)
    roles = [("feature", c) for c in SERIES_ROLES.features] + [("label", c) for c in SERIES_ROLES.labels]
    for role, c in roles:
        s = s.withMetadata(c, {"role": role})
    s.write.parquet(path)
    back = io.roles_from_metadata(spark.read.parquet(path))
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select("rows", F.lit(",".join(back.features)).alias("features"), F.lit(",".join(back.labels)).alias("labels"))


@query
def q_model_store(spark, sf_dir):
    """A stored and loaded model scores as the fitted one; a label without a stored model is absent."""
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=3, n_trees=10)
    path = io.shared_scratch(spark, "models")
    model.save(models, path)
    loaded = model.load(path, ["label", "other"])
    a = model.score(models, e, ["embedding"], "vec_id")
    b = model.score(loaded, e, ["embedding"], "vec_id").select("row_id", F.col("y_pred").alias("y2"), F.col("p").alias("p2"))
    same = F.col("y_pred").eqNullSafe(F.col("y2")) & F.col("p").eqNullSafe(F.col("p2"))
    return a.join(b, "row_id", "full").agg(F.count(F.lit(1)).alias("rows"), F.sum((~same).cast("long")).alias("differing"),
                                           F.lit(",".join(loaded)).alias("labels"))


@query
def q_importance_rows(spark, sf_dir):
    """Importances of a fit: one row a feature, ranked without gaps, falling, summing to 1."""
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=5, n_trees=20)
    names = [f"e{i}" for i in range(64)]
    t = model.importances(models, names, 64)
    from pyspark.sql import Window
    fall = F.coalesce(F.lag("importance").over(Window.partitionBy("label").orderBy("rank")) >= F.col("importance"), F.lit(True))
    return t.withColumn("fall", fall).groupBy("label").agg(
        F.countDistinct("feature").alias("features"), F.min("rank").cast("long").alias("first"), F.max("rank").cast("long").alias("last"), r6(F.sum("importance")).alias("mass"),
        F.bool_and(F.col("feature").isin(names)).alias("known"), F.bool_and("fall").alias("falling"))


@query
def q_cv_folds(spark, sf_dir):
    """M2: rows of every fold and class."""
    e = _emb_split(spark, sf_dir).where("split = 'train'")
    return model.fold_counts(model.hash_folds(e, "vec_id", 3), "label")


@query
def q_tree_cv_rows(spark, sf_dir):
    """M2: grid search over those folds: an accuracy per depth, and the best model's depth among them."""
    e = _emb_split(spark, sf_dir).where("split = 'train'")
    best, table = model.cross_validate(e, ["embedding"], "label", n_trees=10, id_col="vec_id")
    scored = model.score({"label": best}, e, ["embedding"], "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    return table.crossJoin(scored).select("max_depth", F.col("accuracy").between(0, 1).alias("valid"), "rows")


@query
def q_capped_sequences(spark, sf_dir):
    """The first 25 strided windows in (scenario, window) order."""
    out = sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 20, 15, max_sequences=25)
    return out.select(*SEQ_COLS, r6("f2").alias("f2"))


@query
def q_no_sequences(spark, sf_dir):
    """No series is long enough: an empty result with the columns of any other."""
    out = sequences.strided(views.series(spark, sf_dir), SERIES_ROLES, 1_000_000, 15)
    return out.select(*SEQ_COLS, r6("f2").alias("f2"))


@query
def q_name_keys(spark, sf_dir):
    """Series keys from file names, cut at the first dot and at the suffix."""
    from scenaria.functions import first_dot_key, strip_csv
    name = F.concat(F.lit("run."), F.col("scenario_id").cast("string"), F.lit(".v2.csv"))
    s = views.series(spark, sf_dir).select("scenario_id", name.alias("file"))
    return s.groupBy(first_dot_key(F.col("file")).alias("first"), strip_csv(F.col("file")).alias("stem")).agg(F.count(F.lit(1)).alias("n"))


@query
def q_epoch_mean(spark, sf_dir):
    """Mean over outputs per epoch, here over the two features per whole minute."""
    s = views.series(spark, sf_dir).select(F.floor(F.col("Time") / 60).alias("epoch"), F.explode(F.array("f1", "f2")).alias("value"))
    return metrics.epoch_mean(s).select("epoch", r6("value").alias("value"))


@query
def q_scoring_time_rows(spark, sf_dir):
    """A timing row per model: rows scored, and milliseconds a row from the total."""
    e = _emb_split(spark, sf_dir)
    models = model.fit_per_label(e.where("split = 'train'"), ["embedding"], ["label"], max_depth=2, n_trees=5)
    t = model.scoring_time({"tree": model.score(models, e.where("split = 'test'"), ["embedding"], "vec_id")})
    ok = F.abs(F.col("ms_per_sample") - F.col("total_s") / F.col("rows") * 1000) < 1e-9
    return t.select("model", "rows", (F.col("total_s") > 0).alias("timed"), ok.alias("formula"))


@query
def q_rebalance_rare(spark, sf_dir):
    """X2 where it has much to do: labels so rare that splits lack them."""
    s, sp = series_split(spark, sf_dir)
    k = F.col("scenario_id")
    rare = lambda a, b, c: F.when(k % a == 0, 1).when(k % b == 0, 2).when(k % c == 0, 3).otherwise(0).cast("int")
    modes = stats.scenario_modes(s, "scenario_id", ["C_label"]).withColumn("R_label", rare(61, 37, 23)).withColumn("S_label", rare(29, 53, 41))
    return splitting.rebalance(sp, modes, "scenario_id", ["C_label", "R_label", "S_label"], "C_label")[0]
