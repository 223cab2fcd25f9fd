import pytest
from pyspark.sql import functions as F

from scenaria.operators import split as splitting


def modes_frame(spark, per_class):
    rows, sid = [], 0
    for cls, n in per_class.items():
        for _ in range(n):
            rows.append((sid, cls))
            sid += 1
    return spark.createDataFrame(rows, "sid long, P_label int")


@pytest.mark.parametrize("n,sizes", [(1, (1, 0, 0)), (2, (1, 0, 1)), (3, (2, 0, 1)), (10, (7, 1, 2)), (4, (2, 1, 1))])
def test_split_sizes(spark, n, sizes):
    m = modes_frame(spark, {0: n})
    sp = splitting.scenario_split(m, "sid", "P_label", modes=m)
    got = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert tuple(got.get(s, 0) for s in ("train", "val", "test")) == sizes


def test_split_disjoint_and_complete(spark):
    m = modes_frame(spark, {0: 13, 1: 7, 2: 1, 5: 30})
    sp = splitting.scenario_split(m, "sid", "P_label", modes=m)
    assert sp.count() == 51 and sp.select("sid").distinct().count() == 51


def test_rebalance_moves_missing_class(spark):
    # primary P: 10 scenarios of class 0; secondary S: class 1 only on scenarios that land in train
    m = modes_frame(spark, {0: 10})
    sp = splitting.scenario_split(m, "sid", "P_label", modes=m)
    train_ids = [r.sid for r in sp.where("split = 'train'").collect()]
    modes = m.withColumn("S_label", F.when(F.col("sid").isin(train_ids[:3]), 1).otherwise(0))
    out, moves = splitting.rebalance(sp, modes, "sid", ["P_label", "S_label"], "P_label")
    assert moves and moves[0]["from"] == "train" and moves[0]["to"] == "val"
    s1 = {r.split for r in out.join(modes, "sid").where("S_label = 1").collect()}
    assert {"train", "val"} <= s1


def test_row_split_stratified(spark):
    df = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "id long, a int, b int")
    sp = splitting.row_split(df, ["a", "b"], "id")
    got = {(r.split): r["count"] for r in sp.groupBy("split").count().collect()}
    assert got == {"train": 140, "val": 30, "test": 30}


def _sizes(n, test_size=0.3, val_size=0.5):
    n_train = max(int(n * (1 - test_size)), 1)
    rest = n - n_train
    n_val = max(int(rest * val_size), 1) if rest > 1 else 0
    if n - n_train - n_val == 0 and n_val > 1:
        n_val -= 1
    return n_train, n_val


def test_split_sizes_sweep(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 301)], "n long")
    tr, va = splitting.split_sizes(F.col("n"))
    got = {r.n: (r.tr, r.va) for r in df.select("n", tr.alias("tr"), va.alias("va")).collect()}
    assert all(got[n] == _sizes(n) for n in range(1, 301))
