"""Evaluation plan (the reference's third script, the comprehensive evaluation and the weight
optimisation): one long prediction table, every report an aggregate of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria.operators import ensemble, metrics, model, stats
from scenaria.roles import Roles
from scenaria.session import cut_lineage
from scenaria.sources import io


def evaluate(table: DataFrame, seqs: DataFrame, roles: Roles, seq_features, trees: dict, seq_models: dict,
             weights: DataFrame | None, seq_len: int = 20, out: str | None = None,
             optimised: DataFrame | None = None, earlier: DataFrame | None = None) -> dict:
    """``weights`` and ``optimised`` are searched on validation rows by the training plan and only applied here;
    ``earlier`` is a comparison written before, if there is one."""
    key = roles.key
    labels = list(roles.labels)
    feats = list(roles.features)
    test = table.where(F.col("split") == "test")
    diverse = stats.diversity(test, labels)
    t_rows = model.score(trees, test, feats, roles.tie or roles.time)
    flat = model.flatten_sequences(seqs.where(F.col("split") == "test"), key, seq_features, labels, seq_len)
    s_rows = model.score_sequences(seq_models, flat, key)
    last = seqs.where((F.col("split") == "test") & (F.col("step") == seq_len - 1))
    t_last = model.score(trees, last, feats, [key, "seq_id"])
    j = ensemble.align(t_last, s_rows, [key, "seq_id", "label"])
    w = weights if weights is not None else j.select("label").distinct().withColumn("weight", F.lit(0.5))
    weighted = lambda t: j.join(t.select("label", F.col("weight").alias("_w")), "label", "left").select(
        "label", "y_true", ensemble.predict_blend(F.col("p1"), F.col("p2"), F.coalesce("_w", F.lit(0.5))).alias("y_pred"))
    pred = t_rows.select("model", "label", "y_true", "y_pred").unionByName(
        s_rows.select("model", "label", "y_true", "y_pred")).unionByName(
        weighted(w).select(F.lit("blend").alias("model"), "label", "y_true", "y_pred"))
    pred = cut_lineage(metrics.counts(pred))  # classes squared rows per model and label: every report reads these
    acc = metrics.accuracy(pred).select("model", "label", "accuracy")
    comparison = ensemble.comparison(acc, ["tree", "seq", "blend"], metrics.pooled_accuracy(pred))
    comparison = ensemble.best_model(comparison, ["tree", "seq", "blend"])
    tuned = ensemble.accuracy_at(j, optimised if optimised is not None else w).withColumnRenamed("accuracy", "optimized")
    change = ensemble.before_after(earlier, comparison.drop("best_model").join(tuned, "label", "left"))
    reports = metrics.class_report(pred)
    confusion = metrics.confusion(pred, union=True)
    importances = model.importances(trees, feats, 20)
    timing = model.scoring_time({"tree": t_rows, "seq": s_rows})
    result = {"diversity": diverse, "accuracy": acc, "comparison": comparison, "change": change, "optimized": tuned, "reports": reports, "confusion": confusion, "importances": importances,
              "timing": timing}
    if out:
        for name in ("comparison", "change", "reports", "confusion", "importances", "timing"):
            io.write_report(result[name], f"{out}/{name}")
    return result
