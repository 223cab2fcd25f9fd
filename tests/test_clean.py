import math

import numpy as np
import pandas as pd
import pytest

from scenaria.operators import clean
from scenaria.roles import Roles

ROLES = Roles(key="sid", time="Time", features=("x",), labels=("y_label",), tie="rid")
SCHEMA = "sid string, rid long, Time double, x double, y_label int"


def rows():
    n = float("nan")
    data = {
        "lead_trail": [n, n, 1.0, n, n, 4.0, n, n],
        "all_null": [n] * 5,
        "inner": [0.0, n, n, n, 8.0, 9.0],
        "single": [5.0],
    }
    out, rid = [], 0
    for sid, xs in data.items():
        for i, x in enumerate(xs):
            out.append((sid, rid, float(i), None if math.isnan(x) else x, rid % 3 if rid % 4 else None))
            rid += 1
    return out


@pytest.mark.parametrize("chunk_rows", [1 << 20, 2, 3])
def test_interpolate_then_fill_matches_pandas(spark, chunk_rows):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = clean.interpolate(df, ROLES, ["x"], back_fill=True, chunk_rows=chunk_rows).toPandas().set_index("rid").sort_index()
    pdf = pd.DataFrame(rows(), columns=["sid", "rid", "Time", "x", "y_label"])
    exp = pdf.groupby("sid", group_keys=False)["x"].apply(
        lambda x: x.astype(float).interpolate(method="linear").ffill().bfill())
    np.testing.assert_allclose(got["x"].astype(float).values, exp.sort_index().values, equal_nan=True)


def test_interpolate_leaves_leading_gap(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = clean.interpolate(df, ROLES, ["x"]).where("sid = 'lead_trail'").orderBy("Time").toPandas()
    assert got.x.isna().tolist()[:2] == [True, True]
    assert got.x.tolist()[2:] == [1.0, 2.0, 3.0, 4.0, 4.0, 4.0]


def test_mode_fill_lowest_on_tie(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, None), (4, 2), (5, 1)], "id int, y_label int")
    got = {r.id: r.y_label for r in clean.mode_fill(df, ["y_label"]).collect()}
    assert got[3] == 1


def test_nonfinite_to_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (2.5,), (None,)], "x double")
    assert [r.x for r in clean.nonfinite_to_zero(df, ["x"]).collect()] == [0.0, 0.0, 0.0, 2.5, 0.0]


def test_null_audit_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 1), (None, 2)], "x double, y int")
    got = {r.column_name: r.null_count for r in clean.null_audit(df).collect()}
    assert got == {"x": 2, "y": 1}


def test_mean_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert [r.x for r in clean.mean_fill(df, ["x"]).collect()] == [1.0, 2.0, 3.0]
