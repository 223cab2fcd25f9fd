"""The registered queries of the numbered operators, with production parameters."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fertility, quality, toxicity
from .common import find_package, read_table
from .decontamination import contamination
from .linededup import dedup_lines
from .mixing import mix_sources, word_count
from .packing import pack, pieces
from .resampling import resample
from .simhash import near_duplicates
from .substrings import remove_repeats
from .topk import top_k
from .vectorcodes import book_digest, compress
from .warc import round_trip

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    """Register a query; its Python workers find this package where the driver found it."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), "vec_id", "embedding")


ORACLE["op1_exact_topk"] = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(d.e AS DOUBLE[])) AS BIGINT) AS score
           FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
     r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    mixed = mix_sources(docs, "doc_id", word_count("text"), F.array("source"))
    return mixed.select(F.col("id").alias("doc_id"), "size", F.element_at("source_size", 1).alias("source_size"),
                        F.element_at("target", 1).alias("target"), "taken")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, "doc_id", "text", threshold=0.8)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op3_line_dedup"] = r"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
     l AS (SELECT doc_id, unnest(range(len(parts))) AS line, unnest(parts) AS x FROM cut),
     t AS (SELECT doc_id, line, x, list_sort(list_distinct(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS w FROM l),
     s AS (SELECT w, len(w) AS n, min((doc_id, line)) AS first, row_number() OVER (ORDER BY min((doc_id, line))) AS k
           FROM t WHERE len(w) > 0 GROUP BY w),
     tok AS (SELECT k, n, unnest(w) AS tok FROM s),
     df AS (SELECT tok, count(*) AS df FROM tok GROUP BY tok),
     ranked AS (SELECT k, n, tok, row_number() OVER (PARTITION BY k ORDER BY df, tok) AS r FROM tok JOIN df USING (tok)),
     p AS (SELECT k, n, tok FROM ranked WHERE r <= n - ceil(0.8 * n - 1e-9) + 1),
     c AS (SELECT DISTINCT a.k AS a, b.k AS b FROM p a JOIN p b ON a.tok = b.tok AND a.k < b.k AND a.n >= 0.8 * b.n - 1e-9 AND b.n >= 0.8 * a.n - 1e-9),
     near AS (SELECT DISTINCT c.b AS k FROM c JOIN s x ON x.k = c.a JOIN s y ON y.k = c.b
              WHERE len(list_intersect(x.w, y.w)) >= 0.8 * (x.n + y.n - len(list_intersect(x.w, y.w))) - 1e-9),
     d AS (SELECT t.doc_id, t.line, t.x, len(t.w) > 0 AS has_word,
                  coalesce(len(t.w) > 0 AND (near.k IS NOT NULL OR (t.doc_id, t.line) > s.first), false) AS gone
           FROM t LEFT JOIN s ON t.w = s.w LEFT JOIN near ON near.k = s.k)
SELECT documents.doc_id, coalesce(count(*) FILTER (has_word), 0) AS n_lines, coalesce(count(*) FILTER (gone), 0) AS n_removed,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM documents LEFT JOIN d USING (doc_id) GROUP BY documents.doc_id
"""


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).withColumnRenamed("id", "doc_id")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).withColumnRenamed("id", "doc_id")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text", window=50)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fertility.judge(read_table(spark, sf_dir, "documents"))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(F.col("id").alias("doc_id"), *first, *[c for c in out.columns if c not in ("id", "lang", *first)])


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_duplicates(read_table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3)
    return near.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                       F.col("component").alias("component_id"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"), "page_id", "url", "html").drop("archive", "offset")


ORACLE["op10_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first IS NULL OR p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = resample(docs, read_table(spark, sf_dir, "benchmark"), "doc_id", "text", "text", longest=1, n_buckets=10_000, share=10, least_words=20, seed=2024)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op11_importance_resampling"] = r"""
WITH RECURSIVE bits AS (
       SELECT i AS byte, CAST(i AS BIGINT) AS crc, 0 AS step FROM range(256) t(i)
       UNION ALL SELECT byte, CASE WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8),
     crcs AS (SELECT list(crc ORDER BY byte) AS c FROM bits WHERE step = 8),
     d AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     q AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS x FROM benchmark),
     u AS (SELECT row, unnest(w) AS x FROM d),
     dw AS (SELECT x, count(*) AS n FROM u GROUP BY x), qw AS (SELECT x, count(*) AS n FROM q GROUP BY x),
     v AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM dw UNION SELECT x FROM qw)),
     b AS (SELECT x, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) FOR i IN range(len(h) // 2)]),
                                     lambda a, y: xor(a >> 8, c[xor(a & 255, y) + 1])), 4294967295) % 10000 AS bucket FROM v, crcs),
     s AS (SELECT bucket, sum(n) AS n FROM dw JOIN b USING (x) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS n FROM qw JOIN b USING (x) GROUP BY bucket),
     sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s, coalesce((SELECT sum(n) FROM t), 0) AS t),
     g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(sums.s + 10000 AS DOUBLE))
                                               / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * CAST(sums.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
           FROM s FULL JOIN t USING (bucket), sums),
     wd AS (SELECT row, sum(gain) AS weight FROM u JOIN b USING (x) JOIN g USING (bucket) GROUP BY row),
     z AS (SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM d LEFT JOIN wd USING (row)),
     r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM r
"""


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contamination(docs, read_table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text", window=10)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE["op12_decontamination"] = r"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     p AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
           FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
     d AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     places AS (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM d),
     o AS (SELECT row, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM places, (SELECT DISTINCT n FROM p) WHERE i + n - 1 <= len(w)),
     f AS (SELECT row, i, o.n, item FROM o JOIN p USING (n, win)),
     h AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM f) GROUP BY row),
     t AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, item FROM f) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN t USING (row)
"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    out, books = compress(vectors, "vec_id", "embedding", "label", parts=4, entries=256, rounds=4, scale=1024)
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def _rounds(n: int) -> str:
    """SQL of the rounds: assignments a1, a2 ... and codebooks c1, c2 ..."""
    out = ""
    for i in range(1, n + 2):
        out += f"""
     a{i} AS (SELECT row, p, min(256 * CAST(list_dot_product(pt.x, pt.x) - 2 * list_dot_product(pt.x, c.x) + list_dot_product(c.x, c.x) AS BIGINT) + k) AS dk
           FROM pt JOIN c{i - 1} c USING (p) GROUP BY row, p),"""
        out += f"""
     c{i} AS MATERIALIZED (SELECT p, k, coalesce(m.x, c.x) AS x FROM c{i - 1} c LEFT JOIN
           (SELECT p, k, list(mean ORDER BY j) AS x FROM (SELECT p, dk % 256 AS k, j, floor(sum(y) / count(*)) AS mean
            FROM (SELECT p, dk, unnest(x) AS y, unnest(range(len(x))) AS j FROM a{i} JOIN pt USING (row, p)) GROUP BY p, dk % 256, j) GROUP BY p, k) m USING (p, k)),""" if i <= n else ""
    return out


ORACLE["op13_vector_codes"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     pt AS MATERIALIZED (SELECT row, p, e[p * (len(e) // 4) + 1:(p + 1) * (len(e) // 4)] AS x FROM v, range(4) t(p)),
     c0 AS MATERIALIZED (SELECT p, k - 1 AS k, x FROM pt JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, e) AS k FROM v) USING (row) WHERE k <= 256),{_rounds(4)}
     z AS (SELECT row, string_agg(printf('%02x', dk % 256), '' ORDER BY p) AS code, CAST(sum(dk // 256) AS BIGINT) AS error FROM a5 GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, j)) FROM (SELECT p, k, unnest(x) AS y, unnest(range(len(x))) AS j FROM c4)) AS codebooks_sha256
FROM v JOIN z USING (row)
"""
