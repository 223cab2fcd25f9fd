import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scenaria.operators import keyed, windows
from scenaria.roles import Roles

ROLES = Roles(key="sid", time="Time", features=("x",), labels=("lab_label",), tie="rid")


def frame(spark, sizes=(1, 5, 37, 250), seed=0):
    rng = np.random.default_rng(seed)
    rows, rid = [], 0
    for s, n in enumerate(sizes):
        t = np.sort(rng.choice(10_000, size=n, replace=False)).astype(float)
        for i in range(n):
            rows.append((f"s{s}", rid, float(t[i]), float(rng.normal()), int(rng.integers(0, 3))))
            rid += 1
    pdf = pd.DataFrame(rows, columns=["sid", "rid", "Time", "x", "lab_label"]).sample(frac=1, random_state=1)
    return spark.createDataFrame(pdf), pdf


def expected(pdf):
    out = []
    for sid, g in pdf.sort_values(["sid", "Time", "rid"]).groupby("sid"):
        e = pd.DataFrame({"rid": g.rid.values})
        e["x_rolling_mean_10"] = g.x.rolling(10, min_periods=1).mean().values
        e["x_rolling_std_10"] = g.x.rolling(10, min_periods=1).std().fillna(0).values
        e["x_ema_10"] = g.x.ewm(span=10, min_periods=1).mean().values
        e["x_diff"] = g.x.diff().fillna(0).values
        e["time_since_start"] = (g.Time - g.Time.min()).values
        ml = g.lab_label.max()
        rng = g.Time.max() - g.Time.min()
        if ml > 0 and rng > 0:
            tm = g.loc[g.lab_label == ml, "Time"].max()
            e["lab_time_to_failure"] = (1 - ((tm - g.Time) / rng).clip(0, 1)).values
        else:
            e["lab_time_to_failure"] = np.nan
        out.append(e)
    return pd.concat(out).set_index("rid").sort_index()


@pytest.mark.parametrize("chunk_rows", [keyed.DEFAULT_CHUNK_ROWS, 7, 200])
def test_features_match_pandas(spark, chunk_rows):
    df, pdf = frame(spark)
    got = windows.engineer_features(df, ROLES, ttf_label="lab_label", chunk_rows=chunk_rows).toPandas()
    got = got.set_index("rid").sort_index()
    exp = expected(pdf)
    assert len(got) == len(pdf)
    for c in exp.columns:
        np.testing.assert_allclose(got[c].astype(float).values, exp[c].astype(float).values, rtol=1e-9, atol=1e-9,
                                   err_msg=c)


def test_positions_exact_under_many_partitions(spark):
    df, pdf = frame(spark, sizes=(3000, 10, 1))
    got = keyed.with_position(df, "sid", ["Time", "rid"], num_partitions=13).toPandas()
    exp = pdf.sort_values(["sid", "Time", "rid"]).copy()
    exp["_pos"] = exp.groupby("sid").cumcount() + 1
    m = got.merge(exp[["rid", "_pos"]], on="rid", suffixes=("", "_e"))
    assert len(m) == len(pdf) and (m["_pos"] == m["_pos_e"]).all()


def test_ema_reach_is_below_double_precision():
    k = windows.ema_reach(10)
    assert (9 / 11) ** k < 2 ** -53 <= (9 / 11) ** (k - 1)


def test_one_row_series(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 2.0, 3)], "sid string, rid long, Time double, x double, lab_label int")
    r = windows.engineer_features(df, ROLES, ttf_label="lab_label").first()
    assert r["x_rolling_std_10"] == 0.0 and r["x_diff"] == 0.0 and r["time_since_start"] == 0.0
    assert r["lab_time_to_failure"] is None


def test_features_with_gaps_match_pandas(spark):
    rng = np.random.default_rng(5)
    n = 300
    x = rng.normal(size=n)
    x[rng.random(n) < 0.3] = np.nan
    x[:4] = np.nan
    pdf = pd.DataFrame({"sid": "a", "rid": np.arange(n), "Time": np.arange(n, dtype=float), "x": x,
                        "lab_label": 0})
    df = spark.createDataFrame(pdf.astype({"x": object}).where(pdf.notna(), None),
                               "sid string, rid long, Time double, x double, lab_label long")
    got = windows.engineer_features(df, ROLES, chunk_rows=50).toPandas().set_index("rid").sort_index()
    s = pdf.x
    exp = {"x_rolling_mean_10": s.rolling(10, min_periods=1).mean(),
           "x_rolling_std_10": s.rolling(10, min_periods=1).std().fillna(0),
           "x_ema_10": s.ewm(span=10, min_periods=1).mean(),
           "x_diff": s.diff().fillna(0)}
    for c, e in exp.items():
        np.testing.assert_allclose(got[c].astype(float).values, e.values, rtol=1e-9, atol=1e-12, equal_nan=True,
                                   err_msg=c)
