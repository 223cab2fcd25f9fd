"""Scenario-shaped views derived by Spark from the driver's tables (FIXTURES.md §3).

``series``: one series per user of ``events``, ordered by (Time, event_id), with a gappy
feature f1, a full feature f2 and three labels.  ``probs``: two synthetic models' class
probabilities over the series rows, in long and array form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenaria.functions import epoch_seconds
from scenaria.roles import Roles

SERIES_ROLES = Roles(key="scenario_id", time="Time", features=("f1", "f2"),
                     labels=("A_label", "B_label", "C_label"), tie="event_id")
N_CLASSES = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ts_type = dict(ev.dtypes)["ts"]
    k = F.regexp_extract("props", "([0-9]+)", 1)
    et = F.col("event_type")
    return ev.select(
        F.col("user_id").alias("scenario_id"), "event_id",
        epoch_seconds(F.col("ts"), ts_type).alias("Time"),
        F.when(et == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("f1"),
        k.cast("double").alias("f2"),
        F.least(F.lit(5), F.floor(F.col("value") / 30)).cast("int").alias("A_label"),
        F.when(et == "view", 0).when(et == "click", 1).when(et == "signup", 2)
         .when(et == "purchase", 3).otherwise(4).cast("int").alias("B_label"),
        (k.cast("int") % 6).cast("int").alias("C_label"),
    )


def probs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, y, c, pt, ps): tree-like model pt and sequence-like model ps, c = 0..5."""
    r = probs_rows(spark, sf_dir)
    return r.selectExpr("event_id", "y", "posexplode(arrays_zip(p_tree, p_seq)) as (c, z)") \
        .selectExpr("event_id", "y", "c", "z.p_tree as pt", "z.p_seq as ps")


def probs_rows(spark: SparkSession, sf_dir: str, label: str = "C_label") -> DataFrame:
    """Array form without a shuffle: (event_id, y, p_tree array<double>, p_seq array<double>); the
    per-class scores are scalar expressions, normalised by their row sum."""
    s = series(spark, sf_dir).select("event_id", F.col("C_label").alias("y"))
    e, y = F.col("event_id"), F.col("y")
    a = [((e * 7 + c * 11) % 13 + 1 + F.when((F.lit(c) == y) & (e % 3 == 0), 6).otherwise(0)).cast("double")
         for c in range(N_CLASSES)]
    b = [((e * 5 + c * 3) % 11 + 1 + F.when((F.lit(c) == y) & (e % 3 == 1), 6).otherwise(0)).cast("double")
         for c in range(N_CLASSES)]
    s = s.select("event_id", "y", *[x.alias(f"_a{i}") for i, x in enumerate(a)],
                 *[x.alias(f"_b{i}") for i, x in enumerate(b)])

    def norm(prefix):
        tot = sum((F.col(f"{prefix}{i}") for i in range(1, N_CLASSES)), F.col(f"{prefix}0"))
        return F.array(*[F.col(f"{prefix}{i}") / tot for i in range(N_CLASSES)])

    return s.select("event_id", "y", norm("_a").alias("p_tree"), norm("_b").alias("p_seq"))


def aligned_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models scored in one pass over the rows: already aligned (event_id, label, y_true, p1, p2),
    so blending needs no join."""
    r = probs_rows(spark, sf_dir)
    return r.select("event_id", F.lit("C_label").alias("label"), F.col("y").alias("y_true"),
                    F.col("p_tree").alias("p1"), F.col("p_seq").alias("p2"))


def model_probs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two models as probability tables (event_id, label, y_true, p)."""
    r = probs_rows(spark, sf_dir)
    base = [F.col("event_id"), F.lit("C_label").alias("label"), F.col("y").alias("y_true")]
    return (r.select(*base, F.col("p_tree").alias("p")), r.select(*base, F.col("p_seq").alias("p")))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table (model, label, row_id, y_true, y_pred): both models on C_label, and the
    ``labels`` table read as truth ``quality`` vs prediction ``toxic``."""
    from scenaria.operators.ensemble import predict
    tree, seq = model_probs(spark, sf_dir)
    out = [m.select(F.lit(name).alias("model"), "label", F.col("event_id").alias("row_id"), "y_true",
                    predict(F.col("p")).alias("y_pred")) for name, m in (("tree", tree), ("seq", seq))]
    lab = table(spark, sf_dir, "labels").select(F.lit("tree").alias("model"), F.lit("quality").alias("label"),
                                                F.col("doc_id").alias("row_id"), F.col("quality").cast("int").alias("y_true"),
                                                F.col("toxic").cast("int").alias("y_pred"))
    return out[0].unionByName(out[1]).unionByName(lab)


GAPPY_ROLES = Roles(key="scenario_id", time="Time", features=("x",), labels=(), tie="event_id")


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one series in event order; x is there for the first ten of every 7,000 events only."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.lit("all").alias("scenario_id"), "event_id", F.col("event_id").cast("double").alias("Time"),
                     F.when(F.col("event_id") % 7000 < 10, F.col("value")).alias("x"))


def ten_class_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, y_true, p1, p2): two synthetic models over the ten classes of ``embeddings``."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("y_true"))
    v, y = F.col("vec_id"), F.col("y_true")
    score = lambda a, b, m, k: F.array(*[((v * a + c * b) % m + 1 + F.when((F.lit(c) == y) & (v % 3 == k), 6).otherwise(0)).cast("double") / 64
                                         for c in range(10)])
    return e.select("vec_id", "y_true", score(7, 11, 13, 0).alias("p1"), score(5, 3, 11, 1).alias("p2"))
