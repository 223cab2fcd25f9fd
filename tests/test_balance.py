from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenaria.operators import balance


def emb(spark, n=120, dim=8, classes=(0, 1, 2), seed=3, sizes=None):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in classes:
        m = sizes[c] if sizes else n // len(classes)
        centre = rng.normal(size=dim) * 3
        for _ in range(m):
            rows.append((i, c, [float(v) for v in centre + rng.normal(size=dim)]))
            i += 1
    return spark.createDataFrame(rows, "id long, c int, v array<double>"), rows


def brute(rows, k):
    out = {}
    for i, c, v in rows:
        ds = sorted((float(np.sum((np.array(v) - np.array(w)) ** 2)), j) for j, c2, w in rows if c2 == c and j != i)
        out[i] = [j for _, j in ds[:k]]
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_knn_exact(spark, k):
    df, rows = emb(spark, 90, dim=16)
    got = balance.knn_in_class(df, "id", "v", "c", k=k).orderBy("id", "rank").collect()
    g = {}
    for r in got:
        g.setdefault(r.id, []).append(r.nbr_id)
    assert g == brute(rows, k)


def test_knn_small_class_takes_all(spark):
    df, rows = emb(spark, dim=4, sizes={0: 3, 1: 30}, classes=(0, 1))
    got = balance.knn_in_class(df, "id", "v", "c", k=5)
    assert got.where("id < 3").count() == 3 * 2


def test_smote_counts_and_between(spark):
    df, rows = emb(spark, dim=4, sizes={0: 40, 1: 12, 2: 1}, classes=(0, 1, 2))
    out, plan = balance.smote(df, "id", "v", "c", k=5)
    counts = {r.c: r["count"] for r in out.groupBy("c").count().collect()}
    assert counts[0] == 40 and counts[1] == 40 and counts[2] == 1
    p = {r.c: r for r in plan.collect()}
    assert p[2].skipped and p[1].k_used == 5 and p[1].need == 28
    # synthetic rows lie inside the bounding box of their class
    arr = {c: np.array([v for _, c2, v in rows if c2 == c]) for c in (1,)}
    syn = np.array([r.v for r in out.where("synthetic and c = 1").collect()])
    assert (syn >= arr[1].min(axis=0) - 1e-9).all() and (syn <= arr[1].max(axis=0) + 1e-9).all()


def test_smote_deterministic(spark):
    df, _ = emb(spark, dim=4, sizes={0: 30, 1: 6}, classes=(0, 1))
    a = sorted(tuple(r.v) for r in balance.smote(df, "id", "v", "c")[0].where("synthetic").collect())
    b = sorted(tuple(r.v) for r in balance.smote(df, "id", "v", "c")[0].where("synthetic").collect())
    assert a == b and len(a) == 24


def near_pairs(rows, k):
    """(id, rank, nbr_id, d2) of every row, term by term; a row that comes twice asks and answers twice."""
    found = {}
    for i, c, v in rows:
        for j, e, w in rows:
            if None not in (i, j, c, e, v, w) and c == e and i != j and None not in v and None not in w:
                found.setdefault(i, []).append((reduce(lambda a, t: a + (t[0] - t[1]) * (t[0] - t[1]), zip(v, w), 0.0), j))
    order = lambda t: (np.isnan(t[0]), 0 if np.isnan(t[0]) else t[0], t[1])
    return sorted((i, r + 1, j, "nan" if np.isnan(d) else d) for i, t in found.items() for r, (d, j) in enumerate(sorted(t, key=order)[:k]))


@pytest.mark.parametrize("block", [7, 40, 8192])
def test_knn_blocks_equal_all_pairs(spark, block):
    """Blocks of any size; copies of vectors, equal distances, rows that come twice, missing and infinite values."""
    _, rows = emb(spark, 90, dim=3)
    grid = [(200 + i, 5, [float(i % 4), float(i // 4 % 3), 1e6]) for i in range(40)]
    copies = [(300 + i, 6, [1.0, 2.0, 3.0 + i // 30]) for i in range(40)]
    odd = [(400, 0, [float("nan"), 1.0, 1.0]), (401, 0, [float("inf"), 1.0, 1.0]), (402, 0, None), (403, 0, [None, 1.0, 1.0]),
           (404, None, [1.0, 1.0, 1.0]), (None, 0, [1.0, 1.0, 1.0]), (405, 7, [1.0, 1.0, 1.0])]
    rows = rows + rows[:5] + [rows[9]] * 7 + grid + copies + copies[:3] + odd
    df = spark.createDataFrame(rows, "id long, c int, v array<double>")
    got = balance.knn_in_class(df, "id", "v", "c", k=5, dim=3, block_rows=block).collect()
    assert sorted((r.id, r["rank"], r.nbr_id, "nan" if np.isnan(r.d2) else r.d2) for r in got) == near_pairs(rows, 5)


def test_knn_of_some_rows_and_text_ids(spark):
    df, rows = emb(spark, 90, dim=4)
    some = df.where("id % 7 = 0").select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("id"))
    text = df.withColumn("id", F.concat(F.lit("n"), F.col("id").cast("string")))
    got = balance.knn_in_class(text, "id", "v", "c", k=3, query_ids=some, block_rows=10).collect()
    want = near_pairs([(f"n{i}", c, v) for i, c, v in rows], 3)
    assert sorted((r.id, r["rank"], r.nbr_id, r.d2) for r in got) == [t for t in want if int(t[0][1:]) % 7 == 0]


def test_knn_of_vectors_that_cannot_hold_nulls(spark):
    df = spark.range(20).select("id", F.lit(1).alias("c"), F.array(F.coalesce(F.col("id").cast("double"), F.lit(0.0)), F.lit(1.0)).alias("v"))
    assert not df.schema["v"].dataType.containsNull
    got = {(r.id, r["rank"]): r.nbr_id for r in balance.knn_in_class(df, "id", "v", "c", k=2, block_rows=6).collect()}
    assert got == {(i, r): j for i in range(20) for r, j in ((1, i - 1 if i else 1), (2, 2 if i == 0 else i + 1 if i < 19 else 17))}
