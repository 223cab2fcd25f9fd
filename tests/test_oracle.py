"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "events embeddings labels documents".split()
FAST = ["rolling_std", "ema", "time_to_failure", "ffill_bfill", "mode_fill", "scenario_modes", "split_scenarios",
        "row_split", "sequences_strided", "sequences_even", "standardize", "class_report", "weight_curve",
        "before_after", "blend_truncated", "knn_in_class", "smote_counts"]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "f2_ema_10" in df.columns


ALT_CONF = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3",
            "spark.sql.session.timeZone": "Asia/Kolkata", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", ["ema", "ffill_bfill", "split_scenarios", "sequences_even", "knn_in_class",
                                  "read_roles"])
def test_results_do_not_depend_on_session_conf(spark, con, name):
    old = {k: spark.conf.get(k, None) for k in ALT_CONF}
    try:
        for k, v in ALT_CONF.items():
            spark.conf.set(k, v)
        test_query_matches_oracle(spark, con, name)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
