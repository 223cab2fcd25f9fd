import random
import re

import xxhash

from conftest_llm import docs_frame
from scenaria.llm.components import components
from scenaria.llm.simhash import keep_first, links, near_duplicates


def slow_fingerprint(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    if not w:
        return 0
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(ids, fps):
    """Smallest reachable id, by comparing all pairs."""
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [least[find(i)] for i in range(len(ids))]


def test_documents_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(300)] + ["Ünï", "É", "ABC"]
    texts = [None, "", "  \n\t", "one", "one two", " ", "long " * 30000]
    for _ in range(150):
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(1, 300))))
    for t in list(texts[10:60]):
        for _ in range(rng.randint(1, 6)):
            w = t.split(" ")
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    texts += [texts[20]] * 50
    ids = rng.sample(range(10**6), len(texts))
    out = near_duplicates(docs_frame(spark, [(i, t, "s") for i, t in zip(ids, texts, strict=True)], extra=True), "doc_id", "text")
    got = {r.id: (r.fp, r.component) for r in out.collect()}
    fps = [slow_fingerprint(t) for t in texts]
    want = reach(ids, fps)
    for i, f, c in zip(ids, fps, want, strict=True):
        assert got[i][0] & (2**64 - 1) == f
        assert got[i][1] == c


def test_links_at_every_distance(spark):
    rng = random.Random(5)
    for words in (5, 22):  # a full filter drops nothing
        fps = []
        for _ in range(60):
            f = rng.getrandbits(64)
            fps.append(f)
            for d in (1, 2, 3, 3, 4, 5):
                g = f
                for b in rng.sample(range(64), d):
                    g ^= 1 << b
                fps.append(g)
        fps = list(dict.fromkeys(fps))
        rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)]
        pairs = links(spark.createDataFrame(rows, "fp long, node long"), words=words)
        for r in pairs.collect():
            assert (fps[r.a] ^ fps[r.b]).bit_count() <= 3
        got = {r.node: r.component for r in components(pairs, "a", "b").collect()}
        assert [got.get(i, i) for i in range(len(fps))] == reach(list(range(len(fps))), fps)


def test_edges(spark):
    assert near_duplicates(docs_frame(spark, []), "doc_id", "text").count() == 0
    rows = [(7, "a b c", "s"), (7, "a b c", "s"), (None, "a b c", "s"), (None, "only here, and nowhere else at all", "s")]
    got = near_duplicates(docs_frame(spark, rows), "doc_id", "text").collect()
    assert len(got) == 4 and sorted(str(r.component) for r in got) == ["7", "7", "7", "None"]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5), (None, 3), (9, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{k: 1000 for k in range(1000, 1400)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_one_row_of_each_group_stays_where_ids_repeat(spark):
    texts = [" ".join(f"w{k}x{j}" for j in range(30)) for k in range(6)]
    rows = [(1, texts[0], "s"), (1, texts[1], "s"), (2, texts[1], "s"), (3, texts[0], "s"), (3, texts[2], "s"), (3, texts[2], "t"),
            (3, texts[3], "s"), (None, texts[4], "s"), (None, texts[4], "s"), (None, texts[3], "s"), (None, None, "s"), (9, "", "s"),
            (None, texts[5], "s"), (4, "alone", "s")]
    out = keep_first(docs_frame(spark, rows, extra=True), "doc_id", "text").collect()
    got = sorted((r.doc_id or 0, r.text) for r in out)
    assert got == sorted([(1, texts[0]), (1, texts[1]), (3, texts[2]), (3, texts[3]), (0, texts[4]), (9, ""), (0, texts[5]), (4, "alone")])


def test_rounds_give_the_links_of_one(spark):
    rng = random.Random(8)
    fps = list({f ^ sum(1 << b for b in rng.sample(range(64), d)) for f in (rng.getrandbits(64) for _ in range(30)) for d in (0, 1, 2, 3)})
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    one, many = ({(r.a, r.b) for r in links(nodes, words=8, per_round=n).collect()} for n in (1 << 24, 3000))
    assert one == many


def test_clashing_column_names_are_carried(spark):
    rows = [(1, "a b c d", "s"), (2, "a b c d", "t"), (3, "other words in here", "s"), (3, "other words in here", "s"), (None, "null id", "s")]
    names = ["__first", "__fp", "__text", "__row", "__key", "odd_id", "several", "hash", "i", "f", "least", "kept_id", "o"]
    docs = docs_frame(spark, rows, extra=True).selectExpr("*", *[f"'x' AS `{c}`" for c in names])
    out = keep_first(docs, "doc_id", "text")
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted((r.doc_id or 0, r.source) for r in got) == [(0, "s"), (1, "s"), (3, "s")] and all(r[c] == "x" for r in got for c in names)
