import re

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import docs_frame
from scenaria.llm import decontamination
from scenaria.llm.decontamination import contamination, decontaminated
from scenaria.llm.wordindex import WordIndex, suffix_order


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def slow(docs, items, window):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("text", [[0], [1, 0], [1, 1, 1, 0, 1, 1, 0], [0, 0, 0], [2, 1, 2, 1, 2, 1, 0, 2, 1, 2, 1, 0]])
def test_suffix_order_of_small_texts(text):
    assert suffix_order(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_index_finds_and_locates_every_pattern():
    rng = np.random.default_rng(5)
    for top in (2, 40, 70_000):
        docs = [rng.integers(1, top + 1, rng.integers(0, 60)).tolist() for _ in range(40)]
        docs += [docs[3] * 3, docs[3] * 3]
        text = np.array([x for d in docs for x in [*d, 0]])
        index = WordIndex.from_bytes(WordIndex(text).to_bytes())
        starts = rng.integers(0, len(text) - 4, 60)
        patterns = np.unique([text[s:s + 3] for s in starts if (text[s:s + 3] > 0).all()] + [[1, 2, 1], [1, -1, 1]], axis=0)
        low, high = index.search(patterns)
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            want = [i for i in range(len(text)) if text[i:i + 3].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def case():
    rng = np.random.default_rng(2)
    v = [f"w{i}" for i in range(25)] + ["Ä", "中"]
    items = [(i, " ".join(rng.choice(v, n))) for i, n in enumerate([3, 1, 0, 12, 25, 10, 40, 9, 2])]
    items += [(3, "another text of the same item with more words than ten of them"), (100, items[4][1]), (None, "lone item"), (7, None)]
    docs = [(i, " ".join(rng.choice(v, rng.integers(0, 60)))) for i in range(120)]
    for i in range(0, 60, 3):
        at = rng.integers(0, 10)
        docs[i] = (i, docs[i][1] + " . " + " ".join(items[4][1].upper().split()[at:at + rng.integers(8, 16)]) + ", " + docs[i + 1][1])
    docs += [(200, None), (201, ""), (202, "Lone, ITEM"), docs[0], docs[0], (None, items[6][1]), (203, " ".join(["w1"] * 3000)), (204, (items[3][1] + " ") * 200)]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = case()
    frame = docs_frame(spark, [(i, t, "s") for i, t in docs], extra=True).selectExpr("*", "1 AS shard", "2 AS spans", "3 AS items", "4 AS doc")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS name", "2 AS piece")
    want = slow(docs, items, 10)
    for shard, block, piece in ((1 << 20, 1 << 20, 1 << 14), (300, 30, 7)):
        monkeypatch.setattr(decontamination, "SHARD", shard)
        monkeypatch.setattr(decontamination, "BLOCK", block)
        monkeypatch.setattr(decontamination, "PIECE", piece)
        out = contamination(frame, bench, "doc_id", "text", "item_id", "text", window=10)
        rows = out.collect()
        assert sorted(((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows), key=str) == want
        for r in rows:
            spans = list(zip(r.spans[::2], r.spans[1::2], strict=True))
            assert sum(b - a for a, b in spans) == r.n_hit and all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
    clean = decontaminated(frame, out, "doc_id")
    assert {r.doc_id for r in clean.collect()} == {d for d, _, hit, _ in want if not hit}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = docs_frame(spark, [(1, "some words", "s"), (2, None, "s")])
    assert [(r.id, r.n_words, r.n_hit) for r in contamination(docs, none, "doc_id", "text", "item_id", "text").orderBy("id").collect()] == [(1, 2, 0), (2, 0, 0)]
    some = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert contamination(docs_frame(spark, []), some, "doc_id", "text", "item_id", "text").collect() == []


def test_short_items_are_whole_windows():
    phrases = decontamination.Phrases([("a", "x y"), ("b", "x y z"), ("a", "x y z")], 10)
    assert [m.shape for m, _, _ in phrases.groups] == [(1, 2), (1, 3)]
    assert phrases.vocabulary.equals(pa.array([b"x", b"y", b"z"], pa.binary()))
