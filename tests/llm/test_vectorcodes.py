import math
from fractions import Fraction

import numpy as np
import pytest

from scenaria.llm.balltree import LEAF, BallTree, anchors, nearest, owners
from scenaria.llm.vectorcodes import LIMIT, LONG, compress, whole


def slow(rows, parts, entries, rounds):
    """Codes, errors and codebooks with Python's whole numbers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    step = width // parts
    pts = [[max(-LIMIT, min(LIMIT, math.floor(Fraction(x) * 1024))) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[pts[k][p * step:(p + 1) * step] for k in first] for p in range(parts)]

    def assign(p):
        out = []
        for x in pts:
            d = [sum((a - b) ** 2 for a, b in zip(x[p * step:(p + 1) * step], e, strict=True)) for e in books[p]]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        for p in range(parts):
            own = assign(p)
            for k in range(len(books[p])):
                mine = [x[p * step:(p + 1) * step] for x, (o, _) in zip(pts, own, strict=True) if o == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    own = [assign(p) for p in range(parts)]
    error = [min(LONG, sum(min(LONG, own[p][i][1]) for p in range(parts))) for i in range(len(kept))]
    total = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        total[lab] = min(LONG, total.get(lab, 0) + e)
    return sorted(((i, lab, "".join(f"{own[p][k][0]:02x}" for p in range(parts)), error[k], total[lab]) for k, (i, _, lab) in enumerate(kept)), key=str), books


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.selectExpr("*", "1 AS id", "2 AS code", "3 AS v", "4 AS hot")


def clusters(n, dim, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(7, dim))
    return (centre[rng.integers(0, 7, n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


def test_anchors_part_the_points_by_the_nearest():
    x = clusters(400, 5, 1, 0.3).astype(float)
    owned = anchors(x, 20)
    assert sorted(np.concatenate(owned).tolist()) == list(range(400)) and len(owned) == 20


@pytest.mark.parametrize("seed,spread", [(1, 0.01), (2, 0.3), (3, 0.0)])
def test_balls_hold_their_points_and_sums(seed, spread):
    x = np.floor(1024 * clusters(700, 6, seed, spread)).astype(np.int64)
    t = BallTree(x)
    assert sorted(t.order.tolist()) == list(range(700))
    for i, (a, b) in enumerate(zip(t.first, t.past, strict=True)):
        mine = x[t.order[a:b]]
        assert (mine.sum(axis=0) == t.sums[i]).all()
        assert np.sqrt(((mine - t.centre[i]) ** 2).sum(axis=1)).max() <= t.radius[i] + 1e-6
        c, d = t.children[i]
        if c < d:
            assert t.first[c] == a and t.past[d - 1] == b and (t.first[c + 1:d] == t.past[c:d - 1]).all()
        elif spread:
            assert b - a <= LEAF


def test_owners_equal_all_distances_and_whole_balls_are_used():
    x = np.floor(1024 * clusters(900, 4, 4)).astype(np.int64)
    entries = np.vstack([x[:40], x[:3]])  # equal entries: the first owns
    t, got, balls = BallTree(x), np.full(900, -1), []

    def ball(i, entry):
        balls.append(i)
        got[t.order[t.first[i]:t.past[i]]] = entry

    def each(at, entry, d):
        got[at] = entry
    owners(t, x, entries, ball, each)
    assert (got == nearest(x, entries)[0]).all()
    far = np.floor(1024 * np.random.default_rng(4).normal(size=(7, 4)) * 50).astype(np.int64)
    balls.clear()
    owners(t, x, np.vstack([x[:1], far]), ball, each)
    assert balls and (got == nearest(x, np.vstack([x[:1], far]))[0]).all()


def test_against_brute_force(spark):
    x = clusters(260, 12, 6, 0.2)
    rows = [(int(i * 7 % 1000), v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    rows += [(5000, None, 1), (5001, [None] * 12, 1), (5002, [math.nan] * 12, 1), (5003, [math.inf] * 12, 1), rows[0], rows[1], (rows[2][0], rows[3][1], 1),
             (None, rows[4][1], None), (6000, rows[5][1][:7], None), (6001, [], 2), (6002, rows[6][1], None)]
    got, books = compress(frame(spark, rows), "vec_id", "embedding", "label", parts=4, entries=20, rounds=3)
    want, want_books = slow([(i, None if v is None else [None if a is None else float(np.float32(a)) for a in v], lab) for i, v, lab in rows], 4, 20, 3)
    assert [b.tolist() for b in books] == want_books
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_large_components(spark):
    x = clusters(60, 8, 9).astype(float)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(100, [1e18] * 8, 0), (101, [1e300] + [0.5] * 7, 1), (102, [-3e15] * 8, 2), (3, [1e18] * 8, 3)]
    got, books = compress(frame(spark, rows, "double"), "vec_id", "embedding", "label", parts=2, entries=10, rounds=2)
    want, want_books = slow(rows, 2, 10, 2)
    assert [[[int(x) for x in e] for e in b] for b in books] == want_books
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert whole(1e308, 1024) == LIMIT and whole(-0.0001, 1024) == -1


def test_empty_table_and_equal_vectors(spark):
    got, books = compress(frame(spark, []), "vec_id", "embedding", "label")
    assert got.collect() == [] and all(len(b) == 0 for b in books)
    got, books = compress(frame(spark, [(i, [0.25] * 8, i % 2) for i in range(100)]), "vec_id", "embedding", "label")
    assert {(r.code, r.error, r.label_error) for r in got.collect()} == {("00000000", 0, 0)}
