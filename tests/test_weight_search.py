"""The interval form of the weight search against blending at every weight."""

import itertools
import math
from fractions import Fraction

import numpy as np
import pytest

from scenaria.operators import ensemble


def blend_class(p, q, w):
    """Lowest class of the largest blend, in floating point as the blend operator computes it."""
    best, at = None, None
    for c in range(max(len(p), len(q))):
        if c < len(p) and c < len(q) and p[c] is not None and q[c] is not None:
            v = w * p[c] + (1.0 - w) * q[c]
            if best is None or v > best or (math.isnan(v) and not math.isnan(best)):
                best, at = v, c
    return at


def rows(seed=1, n=400):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        k = int(rng.integers(1, 6))
        a, b = rng.integers(0, 5, k) + 1, rng.integers(0, 5, k) + 1  # few values: many ties, also at grid weights
        out.append((i, "ab"[i % 2], int(rng.integers(0, k)), (a / a.sum()).tolist(), (b / b.sum()).tolist()))
    out += [(1000, "a", None, [0.5, 0.5], [0.1, 0.9]), (1001, "a", 1, [0.5], [0.1, 0.9]), (1002, "b", 1, [0.3, 0.3, 0.4], [0.3, 0.3, 0.4]),
            (1003, "b", 0, [0.1 + 0.2, 0.3], [0.3, 0.1 + 0.2]), (1004, "b", 1, [0.1 + 0.2, 0.3], [0.3, 0.1 + 0.2]), (1005, "b", 7, [1.0], [1.0]),
            (1006, "b", 0, [], []), (1007, "c", 0, [None, 0.2], [0.5, 0.5]), (1008, "b", -1, [0.5, 0.5], [0.5, 0.5]),
            (1009, "b", 1, [math.nan, 0.2], [0.5, 0.4]), (1010, "b", 0, [math.nan, 0.2], [0.5, 0.4])]
    return out


SCHEMA = "id int, label string, y_true int, p1 array<double>, p2 array<double>"


@pytest.mark.parametrize("steps", [1, 10, 20, 37])
def test_grid_counts_equal_blending_at_every_weight(spark, steps):
    data = rows(steps)
    got = {r.label: r for r in ensemble.grid_counts(spark.createDataFrame(data, SCHEMA), steps).collect()}
    assert got.keys() == {"a", "b", "c"}
    for lab, r in got.items():
        mine = [x for x in data if x[1] == lab]
        assert r["_n"] == len(mine)
        for i in range(steps + 1):
            want = sum(y is not None and blend_class(p, q, i / float(steps)) == y for _, _, y, p, q in mine)
            assert r[f"_c{i}"] == want, (lab, i)


def test_exact_weight_is_the_best_of_all(spark):
    data = [(i, lab, y, [x / 64 for x in p], [x / 64 for x in q]) for i, lab, y, p, q in
            [(i, lab, y, np.round(np.array(p) * 64).tolist(), np.round(np.array(q) * 64).tolist()) for i, lab, y, p, q in rows(5, 300) if i < 1000]]
    got = {r.label: r for r in ensemble.exact_weight(spark.createDataFrame(data, SCHEMA), pieces=7).collect()}
    for lab, r in got.items():
        mine = [(y, [Fraction(x) for x in p], [Fraction(x) for x in q]) for _, l2, y, p, q in data if l2 == lab]

        def hits(w, mine=mine):
            return sum(max(range(len(p)), key=lambda c: (w * p[c] + (1 - w) * q[c], -c)) == y for y, p, q in mine)
        ends = {Fraction(0), Fraction(1)}
        for _, p, q in mine:
            for c, d in itertools.combinations(range(len(p)), 2):
                slope = (p[c] - q[c]) - (p[d] - q[d])
                if slope:
                    w = (q[d] - q[c]) / slope
                    if 0 <= w <= 1:
                        ends.add(w)
        ends = sorted(ends)
        tries = sorted(ends + [(x + y) / 2 for x, y in itertools.pairwise(ends)])
        best = max(hits(w) for w in tries)
        assert r.hits == best and math.isclose(r.accuracy, best / len(mine))
        first = next(w for w in tries if hits(w) == best)
        assert hits(Fraction(r.weight).limit_denominator(10 ** 9)) == best and abs(r.weight - float(first)) < 0.02 and r.upto >= r.weight


def test_no_row_is_right(spark):
    none = spark.createDataFrame([(1, "a", 1, [0.9, 0.1], [0.8, 0.2])], SCHEMA)
    r = ensemble.exact_weight(none).first()
    assert (r.weight, r.hits, r.accuracy) == (0.5, 0, 0.0)
    assert ensemble.exact_weight(none.where("id < 0")).collect() == [] and ensemble.grid_counts(none.where("id < 0"), 4).collect() == []
