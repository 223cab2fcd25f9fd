import re

from pyspark.sql import functions as F

from conftest_llm import docs_frame
from scenaria.llm import mixing
from scenaria.llm.mixing import mix_sources, mixed_documents, route, share, word_count


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_share_stops_at_three_times_and_reshares():
    t = share({"a": 10, "b": 1000, "c": 5}, (5, 2, 1), 1015, 3)
    assert t["a"] == 30 and abs(sum(t.values()) - 1015) < 1e-9 and t["c"] <= 15
    assert share({}, (5, 2, 1), 0, 3) == {}


def test_flow_spreads_repeats_over_overlapping_patterns():
    # a document of both sources serves either; convex costs use each pattern once before repeating one
    taken = route({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 100, "b": 110}, 3)
    assert taken == {("a",): 100, ("a", "b"): 100, ("b",): 10}
    assert sum(route({("a",): 10, ("a", "b"): 10}, {"a": 60, "b": 60}, 3).values()) == 60


def test_whole_mix_against_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 7}" if i % 11 else None) for i in range(3000)]
    rows += [(5000 + i, "x " * 20, "hot") for i in range(1500)] + [(9000, None, "s1"), (9001, "", "s1"), (9002, "long " * 3000, "s2")]
    df = docs_frame(spark, rows, extra=True)
    mix = lambda d: mix_sources(d, "doc_id", word_count("text"), F.array("source"))
    out = {r.id: r for r in mix(df).collect()}
    assert len(out) == len(rows)
    by = {}
    for i, t, s in rows:
        r = out[i]
        assert r.size == words(t) and r.sources == [s] and r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by.setdefault(s, []).append(r)
    for s, rs in by.items():
        assert rs[0].source_size[0] == sum(r.size for r in rs)
        assert abs(sum(r.taken for r in rs) - rs[0].target[0]) <= 0.01 * rs[0].target[0] + 2, s
    again = {r.id: r.taken for r in mix(df.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in out.items()}


def test_sizes(spark):
    texts = ["a b\tc\nd", "x20 x09-x0D", "", None, " \x0b\x0c\r ", "é\x1cü \u00a0", "9 w x y z 0", "one"]
    df = docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r.n for r in df.select("doc_id", word_count("text").alias("n")).collect()}
    assert got == {i: words(t) for i, t in enumerate(texts)}


def test_empty_and_repeated_rows(spark):
    assert mix_sources(docs_frame(spark, []), "doc_id", word_count("text"), F.array("source")).count() == 0
    out = mix_sources(docs_frame(spark, [(1, "a b", "s")] * 3 + [(None, "c", "t")]), "doc_id", word_count("text"), F.array("source")).collect()
    assert len(out) == 4 and len({r.taken for r in out if r.id == 1}) == 1


def test_a_source_that_one_document_dominates(spark):
    # the rest after whole rounds is 35 % and 70 % of a source of one document of 1,200 words and 400 of 1 to 8
    sizes = [1200] + [1 + i * 5 % 8 for i in range(400)]
    rows = [(i, "w " * n, "a") for i, n in enumerate(sizes)] + [(1000 + i, "x " * 10, "b") for i in range(600)]
    df = docs_frame(spark, rows, extra=True).repartition(2).cache()
    for part, seeds in ((0.35, (1, 2, 3)), (0.7, (1, 2, 3)), (1.35, (4,))):
        for seed in seeds:
            first = part * sum(sizes)
            out = mix_sources(df, "doc_id", word_count("text"), F.array("source"), (first, sum(sizes) + 6000 - first), seed=seed).collect()
            mine = [r for r in out if r.sources == ["a"]]
            assert abs(mine[0].target[0] - first) < 1
            assert abs(sum(r.taken for r in mine) - first) <= 2, (part, seed)
            assert all(r.taken in (int(part) * r.size, (int(part) + 1) * r.size) for r in mine)


def test_long_documents_alone_and_repeated_ids(spark):
    rows = [(i, "w " * 600, "a") for i in range(3)] + [(7, "w " * 5, "b")] * 40 + [(None, "x", "b")] * 30 + [(8, "w " * 90, "b"), (9, None, "b")]
    out = mix_sources(docs_frame(spark, rows), "doc_id", word_count("text"), F.array("source"), (1000, 1120)).collect()
    a, b = ([r for r in out if r.sources == [s]] for s in "ab")
    assert len(a) == 3 and len(b) == 72
    assert abs(sum(r.taken for r in a) - a[0].target[0]) <= 300
    assert len({r.taken for r in b if r.id == 7}) == 1 and all(r.taken <= 3 * r.size for r in out)
    assert abs(sum(r.taken for r in b) - b[0].target[0]) <= 100


def test_columns_of_any_name_come_back(spark):
    names = ["__doc", "__pattern", "__size", "__id", "__h", "__times", "__copy", "__plan", "__rounds", "__rest", "__Steps", "a.b", "col", "pattern", "id", "h"]
    df = docs_frame(spark, [(i, "w " * (i % 9), f"s{i % 3}") for i in range(60)])
    more = df.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    take = lambda d: mixed_documents(d, "doc_id", word_count("text"), F.array("source"))
    out = take(more)
    assert out.schema == more.schema
    rows = out.collect()
    assert all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in take(df).collect())
    assert take(more.limit(0)).columns == more.columns


def test_every_pattern_goes_through_the_flow(spark, monkeypatch):
    seen, real = [], mixing._flow
    monkeypatch.setattr(mixing, "_flow", lambda patterns, *rest: seen.extend(patterns) or real(patterns, *rest))
    df = docs_frame(spark, [(i, "w " * (1 + i % 9), f"s{i % 4}" if i % 5 else None) for i in range(200)])
    mix_sources(df, "doc_id", word_count("text"), F.array("source")).count()
    assert sorted(seen) == [("ss0",), ("ss1",), ("ss2",), ("ss3",), ("~",)]
    assert route({("a",): 10, ("b",): 0}, {"a": 25, "b": 0}, 3) == {("a",): 25, ("b",): 0}
