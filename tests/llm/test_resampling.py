import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from conftest_llm import docs_frame
from scenaria.llm.bytewords import Words, slices, text_bytes
from scenaria.llm.resampling import buckets, crcs, drawn_documents, resample


def slow_words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


def slow(docs, target, longest, n_buckets, share, least):
    """(id, n_features, weight, score, rank) of each document, one word at a time."""
    def features(t):
        w = slow_words(t)
        return [zlib.crc32(b" ".join(w[i:i + k])) % n_buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x))
    for x in target:
        t.update(features(x))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for d, x in docs:
        f = features(x)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (S + n_buckets) / ((s[b] + 1) * (T + n_buckets)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(slow_words(x))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(fit[:share * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


TEXTS = ["The Quick brown FOX jumps over it", "", None, "   \n", "naïve Ünïcode 中文 word 12 a12b", "a-b_c.d,e", "x" * 3000 + " y",
         "z" * 131 + " " + "é" * 100, "same words same words same words same words", "\x00nul\x7fdel"]


def test_words_are_those_of_the_pattern():
    column = pa.array(TEXTS)
    got = [None] * len(TEXTS)
    for size in (1, 40, 1 << 20):
        for first, past, w in slices(column, size):
            for i in range(first, past):
                a, b = w.first[i - first], w.first[i - first + 1]
                got[i] = [w.data[w.at[k]:w.at[k + 1]].tobytes() for k in range(a, b)]
        assert got == [slow_words(t) for t in TEXTS]


def test_crc_matrices_equal_crc32():
    rng = np.random.default_rng(3)
    sizes = np.r_[0:140, 1000, 4097, 64, 65, 64]
    data = rng.integers(0, 256, sizes.sum(), dtype=np.uint8)
    data[:50] = 0
    start = np.cumsum(sizes) - sizes
    assert crcs(data, start, sizes).tolist() == [zlib.crc32(data[s:s + n].tobytes()) for s, n in zip(start, sizes, strict=True)]


def test_buckets_of_longer_runs():
    texts = ["one two three two", "", "two three", "four"]
    words = Words(*text_bytes(pa.array(texts)))
    for k, (found, runs) in enumerate(buckets(words, 3, 97), 1):
        split = [t.split() for t in texts]
        assert runs.tolist() == [max(0, len(w) - k + 1) for w in split]
        assert found.tolist() == [zlib.crc32(" ".join(w[i:i + k]).encode()) % 97 for w in split for i in range(len(w) - k + 1)]


def test_resample_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünder", "中文", "q" * 90]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 40)))) for i in range(300)]
    rows += [(300 + i, t) for i, t in enumerate(TEXTS)] + [rows[5], rows[5], (None, rows[7][1])]
    target = [" ".join(rng.choice(vocabulary[:9], 30)) for _ in range(5)] + [None, ""]
    docs = docs_frame(spark, [(i, t, "s") for i, t in rows], extra=True).selectExpr("*", "1 AS fit", "2 AS place", "3 AS at", "4 AS part", "5 AS weight")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for longest, share in ((1, 10), (2, 50)):
        out = resample(docs, bench, "doc_id", "text", "text", longest=longest, n_buckets=500, share=share, least_words=20)
        got = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=str)
        want = slow(rows, target, longest, 500, share, 20)
        assert [g[:4] for g in got] == [w[:4] for w in want]
        assert sorted(g[4] for g in got if g[4]) == sorted(w[4] for w in want if w[4])
        assert {g[4]: g[3] for g in got if g[4]} == {w[4]: w[3] for w in want if w[4]}
        assert "size" in out.columns  # extra columns are carried along


def test_empty_tables_and_drawn_rows(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert resample(docs_frame(spark, []), bench, "doc_id", "text", "text").collect() == []
    docs = docs_frame(spark, [(i, " ".join(f"w{j}" for j in range(i)), "s") for i in range(40)])
    out = resample(docs, bench, "doc_id", "text", "text", share=50)
    assert [r[0] for r in out.where("rank is not null").orderBy("rank").select("rank").collect()] == list(range(1, 11))
    whole = drawn_documents(docs, out, "doc_id").collect()
    assert len(whole) == 10 and all(len(r.text.split()) >= 20 for r in whole)
