import random

from pyspark.sql import functions as F

import corpus_pipeline
from conftest_llm import DOCS
from scenaria.llm import quality
from scenaria.llm.common import scratch_path
from test_linededup import brute as brute_lines
from test_simhash import reach, slow_fingerprint


def tables(spark, rows, labels):
    d = scratch_path(spark, "tables")
    spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(600)]
    rows, labels = [], []
    for i in range(500):
        lines = [" ".join(rng.choices(words, k=rng.randint(4, 30))) for _ in range(rng.randint(1, 6))]
        if i % 9 == 0 and rows:
            lines = rows[-1][1].split("\n")  # a copy, or one with a changed word
            if i % 2:
                lines[0] += " " + rng.choice(words)
        text = "\n".join(lines)
        if i % 6 == 0:
            text = "!! ".join(text.upper().split())
        rows.append((i, text, f"src{i % 5}" if i % 2 else "hot"))
        if i % 2:
            labels.append((i, int(i % 6 > 0), 0))
        elif i % 6 == 0:
            labels.append((i, 0, 0))
    rows += [(900, None, "hot"), (901, "", None), (902, "\n \n", "hot"), (None, rows[1][1], "hot"), (None, "a text of no id at all", None),
             rows[1], (903, "long word " * 150, "src1")]
    return rows, labels


def test_stages_against_brute_force(spark):
    rows, labels = corpus()
    d = tables(spark, rows, labels)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    take = lambda df: sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)
    stages = [f for _, f in corpus_pipeline.STAGES]

    good = stages[0](spark, docs, d)
    model = quality.fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    tools = quality.compressors(model)
    score = lambda t: sum(a * b for a, b in zip(quality.features(t, *tools), model.weights, strict=True))
    assert good.columns == docs.columns and take(good) == sorted(((i, t, s) for i, t, s in rows if score(t) >= 0.8472978603872037), key=str)
    clean = [i for i, t, _ in rows if i is not None and i < 500 and i % 6]
    assert len({r.doc_id for r in good.collect()} & set(clean)) >= 0.97 * len(set(clean))

    kept = take(good)
    lined = stages[1](spark, good, d)
    assert lined.columns == docs.columns
    want = brute_lines(kept)
    assert sorted(((r.doc_id, r.text) for r in lined.collect()), key=str) == sorted(((i, t) for i, t, _, _ in want), key=str)
    assert lined.where(~F.col("n_chars").eqNullSafe(F.length("text"))).count() == 0

    lines = take(lined)
    single = take(stages[2](spark, lined, d))
    ids = [i if i is not None else 10_000 + k for k, (i, _, _) in enumerate(lines)]
    group = reach(ids, [slow_fingerprint(t) for _, t, _ in lines])
    assert len(single) == len(set(group))
    assert {i for i, _, _ in single if i is not None} == {g for g in group if g < 10_000}
    assert all(x in lines for x in single)

    mixed = take(stages[3](spark, spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in single], DOCS), d))
    assert set(mixed) <= set(single)
    n = lambda xs, s: sum(len((t or "").split()) for _, t, x in xs if x == s)
    total, sources = sum(n(single, s) for s in {x for _, _, x in single}), sorted({x for _, _, x in single if x is not None}) + [None]
    assert abs(sum(n(mixed, s) for s in sources) - total) <= 0.03 * total
    for s in sources:
        assert n(mixed, s) <= 3 * n(single, s)

    final = stages[4](spark, spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in mixed], DOCS), d)
    assert final.where("piece = 0").count() == len(mixed)


def test_run_and_empty(spark):
    rows, labels = corpus()
    d = tables(spark, rows[:120], labels)
    out = corpus_pipeline.run(spark, d)
    assert out.count() > 0 and {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)
    assert corpus_pipeline.run(spark, tables(spark, [], [])).count() == 0
