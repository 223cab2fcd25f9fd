import random

import numpy as np

from conftest_llm import docs_frame
from scenaria.llm import substrings
from scenaria.llm.fmindex import FMIndex, WaveletMatrix
from scenaria.llm.substrings import remove_repeats


def brute(rows, window):
    first = {}
    words = [(t or "").encode().split() for _, t, _ in rows]
    for (i, _, _), w in zip(rows, words, strict=True):
        d = i if i is not None else 2 ** 63
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for (i, _, _), w in zip(rows, words, strict=True):
        d, gone = i if i is not None else 2 ** 63, set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < d:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(500)] + ["é", "ünï\x1c"]
    passages = [rng.choices(vocabulary, k=rng.randint(15, 90)) for _ in range(12)]
    rows = []
    for i in rng.sample(range(10_000), n):
        w = rng.choices(vocabulary, k=rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(passages)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w), "s"))
    base = rng.choices(vocabulary, k=150)
    for i in range(20_000, 20_060):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, " ".join(w), "s"))
    rows += [(30_000 + i, rows[5][1], "s") for i in range(20)]
    rows += [(40_000, "x " * 300, "s"), (40_001, "x " * 120, "s"), (40_002, "ab cd " * 80, "s"), (40_003, "cd ab " * 60, "s")]
    rows += [(50_000, None, "s"), (50_001, "", "s"), (50_002, " \n ", "s"), (None, rows[3][1], "s"), (rows[7][0], rows[7][1], "s"), (rows[8][0], "other text", "s")]
    rows += [(60_000, " ".join(rng.choices(vocabulary, k=30_000)), "s")]
    rows += [(60_001, rows[-1][1], "s")]
    return rows


def got(spark, rows, window):
    return sorted((tuple(r) for r in remove_repeats(docs_frame(spark, rows, extra=True), "doc_id", "text", window).collect()), key=str)


def test_against_all_windows(spark):
    rows = corpus(1)
    assert got(spark, rows, 20) == brute(rows, 20)


def test_wide_anchors_and_large_windows(spark, monkeypatch):
    rows = corpus(2, 60)
    monkeypatch.setattr(substrings, "WIDE", 5)
    assert got(spark, rows, 50) == brute(rows, 50)


def test_empty_table(spark):
    assert got(spark, [], 50) == []
    assert got(spark, [(1, "a b", "s")], 50) == [(1, 2, 0, "a b")]


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    for top in (0, 1, 5, 700):
        x = rng.integers(0, top + 1, 1000)
        tree = WaveletMatrix(x)
        for c in {0, top, top // 2}:
            at = np.arange(1001)
            s = np.full(1001, c)
            rank = tree.place(s, at) - tree.place(s, np.zeros(1001, np.int64))
            assert (rank == np.r_[0, np.cumsum(x == c)]).all()


def test_matching_statistics_against_plain_search():
    rng = np.random.default_rng(1)
    for longest, symbols in ((5, 3), (8, 2), (50, 4), (3, 40)):
        text = np.r_[rng.integers(1, symbols + 1, 200), 0, rng.integers(1, symbols + 1, 100), 0]
        index = FMIndex(text, longest)
        queries = [rng.integers(1, symbols + 1, rng.integers(0, 60)) for _ in range(6)] + [text[20:90], np.array([-1, 1, 2, -1, 1]), np.zeros(0, np.int64)]
        plain = lambda q: any((text[i:i + len(q)] == q).all() for i in range(len(text) - len(q) + 1))
        for q, (length, row) in zip(queries, index.matching_statistics(queries), strict=True):
            for i in range(len(q)):
                most = 0
                while most < longest and i + most < len(q) and plain(q[i:i + most + 1]):
                    most += 1
                assert length[i] == most
                if most:
                    at = index.order[row[i]]
                    assert (text[at:at + most] == q[i:i + most]).all()
