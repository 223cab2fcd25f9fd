import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from scenaria.llm import topk
from scenaria.llm.topk import top_k

VECTORS = "vec_id long, embedding array<float>, label int, v string, code string, no string"


def brute(rows, k=20):
    """Every row but the query's own is a candidate; query rows equal in id and numbers are one query."""
    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, tuple(max(min(math.floor(64 * float(np.float32(x))), 2 ** 62), -2 ** 62) for x in v)))
    out = Counter()
    for q in {r for r in ok if r[0] % 20 == 0}:
        others = list(ok)
        others.remove(q)
        found = [(sum(a * b for a, b in zip(q[1], w, strict=False)), j) for j, w in others]
        found = sorted((-max(min(s, 2 ** 63 - 1), 1 - 2 ** 63), j) for s, j in found)
        out.update((q[0], r, j, -s) for r, (s, j) in enumerate(found[:k], 1))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], VECTORS)
    return Counter(tuple(r) for r in top_k(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding").collect())


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk, "BATCH", 7)
    monkeypatch.setattr(topk, "PACK", 3)
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(12, 16))
    rows = [(i, (middle[i % 12] + rng.normal(scale=0.05, size=16)).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 16) for i in range(300)]  # a third of all rows is one vector
    rows += [(2000, None), (2020, []), (2040, [float("nan")] * 16), (2041, [1.0, None]), (2042, [float("inf")]), (None, [1.0] * 16),
             (2060, [0.0] * 16), (2080, [3.0] * 5), (2100, [-2.5] * 20), (20, rows[20][1]), (40, [0.5] * 16), (41, [2.0] * 16), (2101, [1e6] * 16)]
    assert run(spark, rows) == brute(rows)


def test_large_values_are_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(scale=2e6, size=9)]) for i in range(120)]
    assert run(spark, rows) == brute(rows)


def test_large_values_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BATCH", 3)
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(4, 5))
    rows = [(i, [float(np.float32(x)) for x in (middle[i % 4] + rng.normal(scale=1e-4, size=5)) * 1e7]) for i in range(300)]
    rows += [(400 + i, [1e18, 1.0]) for i in range(30)] + [(440, [-1e30] * 3), (441, [3e38]), (460, [1e16, -1e16]), (461, [-3e38])]
    assert run(spark, rows) == brute(rows)


def test_every_row_is_a_candidate(spark):
    rows = [(20, [1.0, 2.0]), (1, [1.0, 1.0]), (1, [3.0, 1.0]), (20, [0.5, 0.5]), (2, [1.0, 2.0])]
    got = run(spark, rows)
    assert got[(20, 1, 1, 20480)] == got[(20, 3, 1, 12288)] == 1 and got == brute(rows)
    rows += [(20, [1.0, 2.0])] * 3 + [(5, [2.0, 2.0])] * 50 + [(40, [9.0, 9.0])] * 30
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_empty(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(0, [1.0])]) == Counter()
    assert run(spark, [(1, [1.0])]) == Counter()
    rows = [(i, [0.25, -1.0]) for i in range(0, 60, 4)]
    assert run(spark, rows) == brute(rows)


def test_pruning_leaves_blocks_out(monkeypatch):
    calls = []
    real = topk.product
    rng = np.random.default_rng(1)
    d = np.floor(np.sort(rng.normal(size=(3200, 1)) * 1000, axis=0)) @ np.ones((1, 4))
    starts = np.arange(0, 3200, topk.BLOCK)
    high, low = np.maximum.reduceat(d, starts), np.minimum.reduceat(d, starts)
    monkeypatch.setattr(topk, "product", lambda a, b: calls.append(len(b)) or real(a, b))
    topk.search(d[:1], np.array([0]), d, np.arange(3200), high, low, 20, np.array([-np.inf]), np.array([0]))
    assert sum(calls[2:]) < 200


def test_query_set_apart(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ask = df.where("vec_id < 3").select((F.col("vec_id") + 1000).alias("vec_id"), "embedding")
    got = top_k(df, ask, "vec_id", "embedding", k=5).collect()
    assert len(got) == 15 and {r.query_id for r in got} == {1000, 1001, 1002}
