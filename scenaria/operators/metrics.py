"""Evaluation metrics over a long prediction table (model, label, y_true, y_pred).

Every metric is an aggregate of the (model, label, y_true, y_pred) count table, which has at
most models x labels x classes^2 rows however many predictions there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

G = ["model", "label"]


def counts(pred: DataFrame) -> DataFrame:
    """(model, label, y_true, y_pred, n); a table that has ``n`` is one already, so a plan can count once and
    derive every metric from that."""
    if "n" in pred.columns:
        return pred
    return pred.groupBy(*G, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(pred: DataFrame) -> DataFrame:
    """(model, label, n, correct, accuracy)."""
    right = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    return counts(pred).groupBy(*G).agg(F.sum("n").alias("n"), F.sum(right).alias("correct")) \
        .withColumn("accuracy", F.col("correct") / F.col("n"))


def pooled_accuracy(pred: DataFrame) -> DataFrame:
    """Total correct / total rows over all labels of a model."""
    return accuracy(pred).groupBy("model").agg((F.sum("correct") / F.sum("n")).alias("accuracy"))


def macro_accuracy(pred: DataFrame) -> DataFrame:
    """Unweighted mean of the per-label accuracies of a model."""
    return accuracy(pred).groupBy("model").agg(F.avg("accuracy").alias("accuracy"))


def class_recall(pred: DataFrame) -> DataFrame:
    """A10: per true class, the share predicted correctly."""
    right = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    return counts(pred).groupBy(*G, F.col("y_true").alias("class")).agg(
        F.sum("n").alias("n"), (F.sum(right) / F.sum("n")).alias("recall"))


def confusion(pred: DataFrame, union: bool = False) -> DataFrame:
    """A11a (classes of the truth; predictions outside them are dropped) or A11b (truth U prediction):
    long form (model, label, y_true, y_pred, n) with zero cells.  The cells of one (model, label), at most
    classes squared, are gathered once and its grid is looked up among them."""
    seen = F.array("y_true", "y_pred") if union else F.array("y_true")
    one = counts(pred).groupBy(*G).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(seen)))).alias("classes"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("y_true", "y_pred"), "n"))).alias("cells"))
    grid = one.select(*G, "cells", "classes", F.explode("classes").alias("y_true")).select(
        *G, "cells", "y_true", F.explode("classes").alias("y_pred"))
    n = F.coalesce(F.try_element_at("cells", F.struct("y_true", "y_pred")), F.lit(0))
    return grid.select(*G, "y_true", "y_pred", n.cast("long").alias("n"))


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_class(cnt: DataFrame) -> DataFrame:
    """tp, support and predicted count per class of truth U prediction, from the count table in one
    aggregate: every count cell is read once as truth and once as prediction."""
    roles = F.array(F.struct(F.col("y_true").alias("c"), F.lit(True).alias("truth")),
                    F.struct(F.col("y_pred").alias("c"), F.lit(False).alias("truth")))
    e = cnt.select(*G, "y_true", "y_pred", "n", F.explode(roles).alias("r"))
    t = F.col("r.truth")
    return e.groupBy(*G, F.col("r.c").alias("c")).agg(
        F.sum(F.when(t & (F.col("y_true") == F.col("y_pred")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(t, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~t, F.col("n")).otherwise(0)).alias("npred"))


def class_report(pred: DataFrame) -> DataFrame:
    """Per class precision, recall, f1-score, support over truth U prediction (0 on zero division),
    then 'accuracy' (value in every column), 'macro avg' and 'weighted avg' rows."""
    per = per_class(counts(pred))
    p = _safe_div(F.col("tp"), F.col("npred"))
    r = _safe_div(F.col("tp"), F.col("support"))
    per = per.select(*G, "c", "tp", p.alias("precision"), r.alias("recall"), "support")
    per = per.withColumn("f1_score", _safe_div(2 * F.col("precision") * F.col("recall"),
                                               F.col("precision") + F.col("recall")))
    classes = per.select(*G, F.col("c").cast("string").alias("cls"), "precision", "recall", "f1_score",
                         F.col("support").cast("double").alias("support"))
    tot = per.groupBy(*G).agg(
        F.sum("support").alias("n"), (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"))
    rows = tot.select(*G, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("cls"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"),
                 F.col("accuracy").alias("f1_score"), F.col("accuracy").alias("support")),
        _row("macro avg", "mp", "mr", "mf"), _row("weighted avg", "wp", "wr", "wf"))).alias("t")) \
        .select(*G, "t.*")
    return classes.unionByName(rows)


def _row(name, p, r, f):
    return F.struct(F.lit(name).alias("cls"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1_score"), F.col("n").cast("double").alias("support"))


def ms_per_sample(total_seconds: float, n: int) -> float:
    """F18."""
    return total_seconds / n * 1000.0 if n else float("nan")


def epoch_mean(history: DataFrame) -> DataFrame:
    """Mean of a metric over outputs per epoch, from a long (epoch, output, value) table."""
    return history.groupBy("epoch").agg(F.avg("value").alias("value"))
