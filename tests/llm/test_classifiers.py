import itertools
import random
import zlib

import numpy as np

from conftest_llm import docs_frame
from scenaria.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int, id string, label string, text string"


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(5, 120))
        toxic, bad = i % 7 == 0, i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["zorgle", "Zorgle!", "zorglette", "quux"]))
        text = " ".join(w)
        if bad:
            text = "!! ".join(w).upper() if i % 2 else "\n".join([" | ".join(w[:9])] * 8)
        rows.append((i, text, "s"))
        if i % 3:
            labels.append((i, int(not bad), int(toxic), "x", "y", "z"))
    return rows, labels


def odd_rows():
    return [(10_000, None, "s"), (10_001, "", "s"), (10_002, " \n\t ", "s"), (10_003, "zorgle " * 60_000, "s"), (None, "a b", None),
            (10_004, "tie", "s"), (10_004, "tie", "s"), (10_005, " é zorgle\x1c.", "s")]


def check(out, rows, truth, threshold):
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    for r in got:
        assert r.held_out == (r.id is not None and zlib.crc32(str(r.id).encode()) % 4 == 2)
    tested = [r for r in got if r.held_out and r.id in truth]
    return np.mean([r.predicted == truth[r.id] for r in tested])


def test_quality(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels + [labels[0], (None, 1, 1, "", "", ""), (77_777, None, None, "", "", "")], LABELS)
    docs = docs_frame(spark, rows + odd_rows(), extra=True)
    out = quality.classify(docs, quality.fit(docs, lab))
    assert check(out, rows + odd_rows(), {i: int(i % 5 > 0) for i, _, _ in rows}, 0.7) > 0.95


def test_toxicity(spark):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, LABELS)
    docs = docs_frame(spark, rows + odd_rows(), extra=True)
    out = toxicity.classify(docs, toxicity.fit(docs, lab))
    assert check(out, rows + odd_rows(), {i: int(i % 7 == 0) for i, _, _ in rows}, 0.3) > 0.97
    spans = {r.id: r.spans for r in out.collect()}
    text = dict((i, t) for i, t, _ in rows)
    for i in (7, 14, 21, 28):
        cut = [text[i][s.start:s.end].lower() for s in spans[i]]
        assert cut and all("zorgl" in x or "quux" in x for x in cut)
    assert [(s.start, s.end) for s in spans[10_003]] == [(0, 7 * 60_000 - 1)]


def test_no_labels_and_empty_tables(spark):
    docs, none = docs_frame(spark, odd_rows()), spark.createDataFrame([], LABELS)
    for m, t in ((quality, 0.7), (toxicity, 0.3)):
        assert {r.score for r in m.classify(docs, m.fit(docs, none)).collect()} == {0.5}
        empty = docs_frame(spark, [])
        assert m.classify(empty, m.fit(empty, none)).count() == 0
        one = spark.createDataFrame([(10_001, 1, 1, "", "", ""), (10_000, 1, 1, "", "", "")], LABELS)
        assert m.classify(docs, m.fit(docs, one)).count() == len(odd_rows())


def test_filter_without_a_model_keeps_every_row(spark):
    docs = docs_frame(spark, odd_rows(), extra=True)
    for labels in ([], [(10_001, 0, 0, "", "", ""), (10_000, 0, 0, "", "", "")]):
        kept = quality.keep_good(docs, quality.fit(docs, spark.createDataFrame(labels, LABELS)))
        assert kept.columns == docs.columns and kept.count() == len(odd_rows())


def test_held_out_labels_have_no_influence(spark):
    rows, labels = corpus(400)
    docs = docs_frame(spark, rows)
    flipped = [(i, 1 - q, 1 - t, *x) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t, *x) for i, q, t, *x in labels]
    assert flipped != labels
    for m in (quality, toxicity):
        a, b = ({r.id: r.score for r in m.classify(docs, m.fit(docs, spark.createDataFrame(x, LABELS))).collect()} for x in (labels, flipped))
        assert a == b


def test_marginals_against_all_taggings():
    rng = np.random.default_rng(2)
    lengths = np.array([5, 1, 3, 7])
    starts = np.cumsum(lengths) - lengths
    r, moves = np.exp(rng.normal(size=lengths.sum())), rng.normal(size=5)
    ahead, back = toxicity.halves(r, starts, lengths, moves)
    odds = ahead * back
    for s, n in zip(starts, lengths, strict=True):
        mass = np.zeros((n, 2))
        for tags in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(moves[4]) if tags[0] else 1.0
            for t, y in enumerate(tags):
                w *= r[s + t] if y else 1.0
                if t:
                    w *= np.exp(moves[2 * tags[t - 1] + y])
            for t, y in enumerate(tags):
                mass[t, y] += w
        assert np.allclose(odds[s:s + n], mass[:, 1] / mass[:, 0])


def test_pieces_give_the_marginals_of_the_whole_chain(monkeypatch):
    """A long text's marginals, computed in pieces with their surroundings, are those of one unbroken chain."""
    import numpy as np

    from scenaria.llm import toxicity
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    for moves in ([1.1, -1.2, -1.1, -0.8, -3.0], [2.5, -2.0, -2.0, 2.5, -1.0], [0.0, 0.0, 0.0, 0.0, -1.0]):
        emit = {f: float(rng.normal(scale=2)) for w in words for f in toxicity.features(w)}
        model = toxicity.Model(emit, moves, [1.0, 1.0, 0.0], 0.5)
        texts = [list(rng.choice(words, n)) for n in (3000, 0, 1, 17, 700, 255, 256, 257)]
        got = toxicity.marginals(texts, model, toxicity.Odds(emit))
        monkeypatch.setattr(toxicity, "CHAIN", 10 ** 9)
        want = toxicity.marginals(texts, model, toxicity.Odds(emit))
        monkeypatch.undo()
        assert [len(x) for x in got] == [len(x) for x in texts]
        assert all(np.allclose(a, b, rtol=0, atol=1e-11) for a, b in zip(got, want, strict=True))


def test_copies_are_texts_that_share_their_words():
    from scenaria.llm.toxicity import one_of_copies
    base = [f"word{i}" for i in range(60)]
    other = [f"thing{i}" for i in range(60)]
    texts = [" ".join(base), " ".join(base[:55] + other[:4]), " ".join(reversed(base)), " ".join(other), " ".join(base[:10] + other[10:50]), "", ""]
    assert one_of_copies(texts) == [texts[0], texts[3], ""]
