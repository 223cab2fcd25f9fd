"""Property test: chunked windows, halos and carries equal pandas for random series shapes."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scenaria.operators import clean, windows
from scenaria.roles import Roles

ROLES = Roles(key="sid", time="Time", features=("x",), labels=(), tie="rid")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(min_value=1, max_value=120), min_size=1, max_size=4),
       chunk=st.integers(min_value=2, max_value=40), gap=st.floats(min_value=0.0, max_value=0.6),
       seed=st.integers(min_value=0, max_value=10_000))
def test_chunked_features_and_fills_match_pandas(spark, sizes, chunk, gap, seed):
    rng = np.random.default_rng(seed)
    rows, rid = [], 0
    for k, n in enumerate(sizes):
        t = np.sort(rng.choice(100_000, size=n, replace=False)).astype(float)
        for i in range(n):
            x = None if rng.random() < gap else float(rng.normal())
            rows.append((f"s{k}", rid, float(t[i]), x))
            rid += 1
    df = spark.createDataFrame(rows, "sid string, rid long, Time double, x double")
    pdf = pd.DataFrame(rows, columns=["sid", "rid", "Time", "x"]).astype({"x": float})
    got = windows.engineer_features(df, ROLES, chunk_rows=chunk, time_since_start=False).toPandas().set_index("rid")
    filled = clean.interpolate(df, ROLES, ["x"], back_fill=True, chunk_rows=chunk).toPandas().set_index("rid")
    for _sid, g in pdf.sort_values(["sid", "Time", "rid"]).groupby("sid"):
        s = g.set_index("rid").x
        exp = {"x_rolling_mean_10": s.rolling(10, min_periods=1).mean(),
               "x_rolling_std_10": s.rolling(10, min_periods=1).std().fillna(0),
               "x_ema_10": s.ewm(span=10, min_periods=1).mean(),
               "x_diff": s.diff().fillna(0)}
        for c, e in exp.items():
            np.testing.assert_allclose(got.loc[e.index, c].astype(float).values, e.values, rtol=1e-9, atol=1e-12,
                                       equal_nan=True, err_msg=c)
        f = s.interpolate(method="linear").ffill().bfill()
        np.testing.assert_allclose(filled.loc[f.index, "x"].astype(float).values, f.values, equal_nan=True)
