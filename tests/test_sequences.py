import numpy as np
import pytest
from pyspark.sql import functions as F

from scenaria.operators import sequences
from scenaria.roles import Roles

ROLES = Roles(key="sid", time="Time", features=("x",), labels=("y",), tie=None)


def series(spark, n, sid="s"):
    return spark.createDataFrame([(sid, float(i), float(i) * 10, i % 6) for i in range(n)],
                                 "sid string, Time double, x double, y int")


@pytest.mark.parametrize("n,count", [(19, 0), (20, 1), (34, 1), (35, 2), (50, 3)])
def test_strided_counts(spark, n, count):
    out = sequences.strided(series(spark, n), ROLES, 20, 15)
    assert out.select("seq_id").distinct().count() == count
    assert out.count() == 20 * count
    if count:
        r = out.where("seq_id = 1 and step = 0").collect() if count > 1 else []
        assert not r or r[0]["Time"] == 15.0


@pytest.mark.parametrize("n,starts", [(20, [0]), (24, [0, 1, 2, 3, 4]), (100, None)])
def test_even_starts_match_numpy(spark, n, starts):
    out = sequences.even(series(spark, n), ROLES, 20, 10).where("step = 0").orderBy("seq_id")
    got = [int(r["Time"]) for r in out.collect()]
    m = n - 20 + 1
    exp = list(np.linspace(0, m - 1, min(m, 10)).astype(int)) if m > 1 else [0]
    assert got == exp
    if starts is not None:
        assert got == starts


def test_even_starts_expression_many_lengths(spark):
    from scenaria.functions import even_starts
    ns = list(range(20, 600, 7))
    df = spark.createDataFrame([(n,) for n in ns], "n long")
    got = {r.n: list(r.s) for r in df.select("n", even_starts(F.col("n"), 20, 10).alias("s")).collect()}
    for n in ns:
        m = n - 19
        exp = list(np.linspace(0, m - 1, min(m, 10)).astype(int)) if m > 1 else [0]
        assert got[n] == exp, n


def test_last_step_and_arrays(spark):
    seqs = sequences.strided(series(spark, 35), ROLES, 20, 15)
    last = sequences.last_step(seqs, 20).orderBy("seq_id").collect()
    assert [r["Time"] for r in last] == [19.0, 34.0]
    arr = sequences.to_arrays(seqs, "sid", ["x"], ["y"], 20).orderBy("seq_id").collect()
    assert len(arr[1]["X"]) == 20 and arr[1]["X"][0][0] == 150.0 and arr[1]["y"] == 34 % 6


def test_cap_keeps_first_sequences(spark):
    df = series(spark, 50, "a").unionByName(series(spark, 50, "b"))
    out = sequences.strided(df, ROLES, 20, 15, max_sequences=4)
    ids = sorted({(r.sid, r.seq_id) for r in out.select("sid", "seq_id").collect()})
    assert ids == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]


def test_even_per_series_cap(spark):
    out = sequences.even(series(spark, 100), ROLES, 20, 10, max_per_series=3)
    assert sorted(r.seq_id for r in out.select("seq_id").distinct().collect()) == [0, 1, 2]


def test_even_windows_of_every_length(spark):
    """Series of 1 to 140 rows against NumPy, and no copy of a row beyond the windows that hold it."""
    import numpy as np
    from scenaria.operators import sequences
    from scenaria.roles import Roles
    lengths = list(range(1, 60)) + [99, 100, 101, 140]
    df = spark.createDataFrame([(n, i) for n in lengths for i in range(n)], "sid int, t int")
    for seq_len, n_starts in ((20, 10), (7, 25), (1, 3), (5, 1)):
        got = {}
        for r in sequences.even(df, Roles(key="sid", time="t"), seq_len, n_starts).collect():
            got.setdefault(r.sid, set()).add((r.seq_id, r.step, r.t))
        for n in lengths:
            m = n - seq_len + 1
            starts = [int(x) for x in np.linspace(0, m - 1, min(m, n_starts)).astype(int)] if m > 0 else []
            assert got.get(n, set()) == {(k, s, a + s) for k, a in enumerate(starts) for s in range(seq_len)}, (n, seq_len, n_starts)
