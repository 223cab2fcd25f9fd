"""A series holding a third of all rows is split across tasks and still computed exactly."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scenaria.operators import keyed, windows
from scenaria.roles import Roles

ROLES = Roles(key="sid", time="Time", features=("x",), labels=(), tie="rid")


def skewed(spark, hot=6000, cold=12000, n_cold_keys=400):
    rng = np.random.default_rng(7)
    sid = np.concatenate([np.zeros(hot, dtype=int), rng.integers(1, n_cold_keys + 1, size=cold)])
    pdf = pd.DataFrame({"sid": sid, "rid": np.arange(hot + cold), "Time": rng.random(hot + cold) * 1e6,
                        "x": rng.normal(size=hot + cold)})
    return spark.createDataFrame(pdf.sample(frac=1, random_state=3)), pdf


def test_hot_series_spreads_over_range_partitions(spark):
    df, pdf = skewed(spark)
    pos = keyed.with_position(df, "sid", ["Time", "rid"], num_partitions=12)
    parts = pos.where("sid = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 3                                  # the hot third is not one task
    got = pos.where("sid = 0").orderBy("_pos").select("rid").toPandas().rid.tolist()
    assert got == pdf[pdf.sid == 0].sort_values(["Time", "rid"]).rid.tolist()


def test_hot_series_features_exact_across_chunks(spark):
    df, pdf = skewed(spark, hot=5000, cold=3000, n_cold_keys=50)
    got = windows.engineer_features(df, ROLES, chunk_rows=700).where("sid = 0").toPandas()
    g = pdf[pdf.sid == 0].sort_values(["Time", "rid"])
    exp = pd.DataFrame({"rid": g.rid.values,
                        "ema": g.x.ewm(span=10, min_periods=1).mean().values,
                        "std": g.x.rolling(10, min_periods=1).std().fillna(0).values})
    m = got.merge(exp, on="rid")
    assert len(m) == 5000
    np.testing.assert_allclose(m["x_ema_10"], m["ema"], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(m["x_rolling_std_10"], m["std"], rtol=1e-9, atol=1e-12)


def test_positions_of_any_key_and_many_ranges(spark):
    """Null keys and times, texts, timestamps, rows of equal order; few ranges and more than are compared one by one."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("k'"), F.col("id") % 5)).alias("k"),
        F.when(F.col("id") % 17 != 0, F.timestamp_micros((F.xxhash64("id") % 700 + 10 ** 15 + F.col("id") % 3))).alias("t"),
        F.to_date(F.lit("2020-01-01")).alias("d"), F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 31).alias("x"), "id")
    order = ["t", "d", "x"]
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("lo", F.rank().over(w)).withColumn("hi", F.rank().over(w) + F.count("id").over(
        Window.partitionBy("k", *order)) - 1).select("id", "lo", "hi")
    for parts in (1, 7, 600):
        got = keyed.with_position(df, "k", order, num_partitions=parts)
        both = got.join(want, "id")
        assert both.count() == 4000 and both.where("_pos < lo or _pos > hi").count() == 0
        assert got.groupBy("k", "_pos").count().where("count > 1").count() == 0


def test_positions_write_nothing(spark, monkeypatch):
    from scenaria import session
    df, _ = skewed(spark, hot=300, cold=300, n_cold_keys=9)
    monkeypatch.setattr(session, "cut_lineage", None)
    pos = keyed.with_position(df, "sid", ["Time", "rid"])
    assert "Checkpoint" not in pos._jdf.queryExecution().optimizedPlan().toString() and pos.count() == 600
