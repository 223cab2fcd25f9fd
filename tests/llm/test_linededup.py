import random
import re

from pyspark.sql import functions as F

from conftest_llm import docs_frame
from scenaria.llm import linededup
from scenaria.llm.linededup import dedup_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, t=0.8):
    """(id, text less removed lines, lines with words, removed lines) by comparing all pairs of lines."""
    lines = []
    for i, text, _ in rows:
        for k, x in enumerate(text.split("\n") if text is not None else []):
            w = frozenset(WORD.findall(x))
            if w:
                lines.append(((i if i is not None else 2 ** 70, k), w))
    first = {}
    for p, w in lines:
        first[w] = min(first.get(w, p), p)
    sets = sorted(first, key=first.get)
    near = {}
    for j, w in enumerate(sets):
        near[w] = any(first[v] < first[w] and len(v & w) >= t * len(v | w) - 1e-9 for v in sets[:j])
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        keep, n = [], 0
        parts = text.split("\n")
        for k, x in enumerate(parts):
            w = frozenset(WORD.findall(x))
            n += bool(w)
            p = (i if i is not None else 2 ** 70, k)
            if not w or not near[w] and p <= first[w]:
                keep.append(x)
        out.append((i, "\n".join(keep), n, len(parts) - len(keep)))
    return sorted(out, key=str)


def got(spark, rows):
    out = dedup_lines(docs_frame(spark, rows, extra=True), "doc_id", "text")
    assert out.columns == [*docs_frame(spark, [], extra=True).columns, "n_lines", "n_removed"]
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(150)] + ["the", "of", "é", "ünï"]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(60)]
    rows = []
    for i in rng.sample(range(-500, 5000), n):
        text = []
        for _ in range(rng.randint(0, 8)):
            x = rng.choice(lines).split()
            for _ in range(rng.randint(0, 4)):
                x[rng.randrange(len(x))] = rng.choice(words)
            text.append(rng.choice(["", " ", "\t"]) + " ".join(x) + rng.choice(["", "\r", "  "]))
        rows.append((i, "\n".join(text), "s"))
    rows += [(7000, None, "s"), (7001, "", "s"), (7002, "\n \n\t\n", "s"), (None, lines[0], "s"), (7003, "hot line here", "s"),
             (rows[3][0], rows[3][1], "s"), (rows[4][0], "w1 w2 w3 w4 w5 w6\nother words", "s")]
    rows += [(8000 + i, "a line that very many documents share\n" + " ".join(rng.choices(words, k=12)), "s") for i in range(60)]
    base = rng.choices(words, k=25)
    for i in range(60):  # a large group of near copies of one line
        x = list(base)
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(25)] = rng.choice(words)
        rows.append((9000 + i, " ".join(x), "s"))
    rows.append((9999, "\n".join(" ".join(rng.choices(words, k=40)) for _ in range(300)) + "\n" + " ".join("u%d" % i for i in range(5000)), "s"))
    return rows


def test_against_all_pairs(spark):
    rows = corpus(1)
    assert got(spark, rows) == brute(rows)


def test_long_posting_lists(spark, monkeypatch):
    monkeypatch.setattr(linededup, "LIST", 3)
    monkeypatch.setattr(linededup, "SPREAD", 2)
    rows = corpus(2, 60)
    assert got(spark, rows) == brute(rows)


def test_empty_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, "s"), (2, "", "s")]) == [(1, None, 0, 0), (2, "", 0, 0)]


def test_no_python_in_the_plan(spark):
    text = dedup_lines(docs_frame(spark, [(1, "a b\nc d", "s"), (2, "a b", "s")]), "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_columns_of_any_name_come_back(spark):
    names = ["own_hash", "hit_id", "Hit_Hash", "lines_gone", "rest", "_rest", "__ld_hash", "gone", "id", "text_hash", "line", "place", "a.b"]
    df = docs_frame(spark, corpus(3))
    more = df.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    out = dedup_lines(more, "doc_id", "text")
    assert out.columns == [*more.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert all(r[n] == (None if r.doc_id is None else f"{n} {r.doc_id}") for r in rows for n in names)
    plain = dedup_lines(df, "doc_id", "text").select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(str, plain)) == sorted(str(r) for r in out.select("doc_id", "text", "n_lines", "n_removed").collect())


def wide_corpus(seed):
    """Near copies of about 64 words, where sets get a second sketch, and of many more."""
    rng = random.Random(seed)
    words = ["v%d" % i for i in range(400)]
    rows = []
    for k, n in enumerate([54, 60, 62, 64, 65, 66, 70, 80, 130, 200]):
        base = rng.sample(words, n)
        for i in range(8):
            x = list(base)
            for _ in range(rng.randint(0, n // 8)):
                if rng.random() < 0.5:
                    x.pop(rng.randrange(len(x)))
                else:
                    x.append(rng.choice(words))
            rng.shuffle(x)
            rows.append((100 * k + i, "\r\n".join([" ".join(x), "\t".join(rng.sample(words, 5))]), "s"))
    return rows


def test_sets_about_the_size_of_a_second_sketch(spark):
    rows = wide_corpus(5)
    assert got(spark, rows) == brute(rows)


def test_only_wanted_lines_have_their_words_looked_at_again(spark, monkeypatch):
    """However full the bit tables are: a large corpus fills them."""
    seen, keys_of = [], linededup.keys_of

    def counted(lines, table):
        seen.append(lines.count())
        return keys_of(lines, table)

    monkeypatch.setattr(linededup, "keys_of", counted)
    monkeypatch.setattr(linededup, "bit_table", lambda *a, **b: lambda c: F.lit(True))
    rng = random.Random(6)
    near = "one line of several words that has a copy with a word more"
    rows = [(i, "\n".join(" ".join(rng.choices(["u%d" % k for k in range(9999)], k=9)) for _ in range(10)), "s") for i in range(30)]
    rows += [(100, near, "s"), (101, near + " here", "s")]
    assert got(spark, rows) == brute(rows)
    assert seen[0] == 302 and max(seen[1:]) == 2


def test_long_lists_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(linededup, "LIST", 3)
    monkeypatch.setattr(linededup, "SENT", 0)
    rows = corpus(4, 60)
    assert got(spark, rows) == brute(rows)
