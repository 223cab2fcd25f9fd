"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import itertools
import os
import uuid
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenaria.session import checkpoint_dir

#: A word is a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a bit table, as a power of two.
BIT_BITS = 18


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's folder, where they see it (a cluster that
    ships the package with the job needs no more than that)."""
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scenaria-llm-{uuid.uuid4().hex}/{name}"


#: While a scratch table is written: its shuffle files go when the write has ended, rather than when the driver
#: happens to collect its garbage; plans that hold constant tables are not spelled out in full; and tables that grow
#: with the corpus are not broadcast while they happen to be small, so a job takes the same way at every size (tables
#: of a proven bound are marked for it).
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxPlanStringLength": "10000",
           "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: later steps read
    one fixed copy, and a lost executor re-reads files instead of re-running what came before."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    try:
        for k, v in WRITING.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def free_names(taken, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column has, whatever the case."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def ranked(rows: DataFrame, order: list[Column], place: str) -> DataFrame:
    """``rows`` with ``place``, their number from 1 on by ``order``: rows are cut into ranges, which are written
    once, numbered, and moved on by the sizes of the ranges before (one number a partition)."""
    at, part = free_names([*rows.columns, place], "at", "part")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    cut = written(cut, "ranked").withColumn(part, F.shiftright(at, 33).cast("int"))
    shift, total = [], 0
    for p, n in sorted((r[0], r[1]) for r in cut.groupBy(part).count().collect()):
        shift.append((p, total - (p << 33) + 1))
        total += n
    shifts = rows.sparkSession.createDataFrame(shift, f"`{part}` int, `{place}` long")
    return cut.join(F.broadcast(shifts), part).withColumn(place, F.col(at) + F.col(place)).drop(at, part)


def met(rows: DataFrame, table: DataFrame, key: str, times: str, total: int) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has every key once and how many of the ``total`` rows have it in
    ``times``.  Keys of more than one row in 256, at most 256 of them, are sent to all tasks, so none is hot; the
    others are joined by a shuffle.  ``rows`` is read twice: it should be written already."""
    hot = table.where(F.col(times) > total / 256).drop(times)
    few = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(F.col(times) <= total / 256).drop(times), key)
    return few.unionByName(rest)


def label_sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, text_col: str, per_label: int) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """What a classifier may learn from: up to ``per_label`` whole (text, label) rows for either label, and the number of
    usable labels of each kind.

    A label is usable if crc32 of its id as text, mod 4, is not 2 and it is 0 or 1; an id with both counts as
    1.  Ids are drawn by seeded hash, so at most 2 * per_label rows are broadcast and come to the driver.  Rows
    without a text are left out; an id's repeated rows count once."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
           .where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
           .groupBy("id").agg(F.max("label").alias("label")))
    counts = {r[0]: r[1] for r in lab.groupBy("label").count().collect()}
    drawn = None
    for k in (0, 1):
        some = lab.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_label)
        drawn = some if drawn is None else drawn.unionByName(some)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
            .join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect())
    rows.sort(key=lambda r: (zlib.crc32(str(r.id).encode()), r.id))
    return [(r.text, r.label) for r in rows], counts


def held_out(id_col):
    """True for ids whose labels are kept for testing; an id that is null counts as not held out."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic model by Newton's method; the last column of ``x`` should be all ones."""
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(docs: DataFrame, id_col: str, text_col: str, score, threshold: float, more: str = "") -> DataFrame:
    """(id, held_out, score, predicted, further columns) for every row; ``score(batches of texts)`` runs in the tasks and
    yields a list of Arrow arrays for each batch, the scores first."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["id", "score", *[c.strip().split(" ")[0] for c in more.split(";") if c]]

    def run(batches):
        batches, ids = itertools.tee(batches)
        for batch, cols in zip(ids, score(b.column(1) for b in batches), strict=True):
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    schema = f"id {src.schema['id'].dataType.simpleString()}, score double" + "".join(f", {c.strip()}" for c in more.split(";") if c)
    out = src.mapInArrow(run, schema)
    return out.select("id", held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), *names[2:])


def small_number(table: Column, at: Column) -> Column:
    """The byte (0 to 127) at a place, from 0, of a binary constant."""
    return F.ascii(F.substring(table, at + 1, F.lit(1)).cast("string"))


def bit_table(keys: DataFrame, name: str, log_bits: int = BIT_BITS):
    """A test that is true for every key of ``keys``, and false for most others while they are few against
    2**log_bits.  Keys that are null are not in the table, a constant of the plan, seven bits a byte."""
    slots = 1 << log_bits
    place = lambda c: F.xxhash64(c).bitwiseAND(F.lit(slots - 1)).cast("int")
    rows = (keys.where(F.col(name).isNotNull()).select(place(F.col(name)).alias("s"))
            .groupBy(F.floor(F.col("s") / 7).cast("int").alias("byte"))
            .agg(F.bit_or(F.expr("shiftleft(1, s % 7)")).alias("bits"))
            .agg(F.concat_ws(",", F.collect_list(F.concat_ws(":", "byte", "bits")))).first()[0])
    table = bytearray(slots // 7 + 1)
    for pair in rows.split(",") if rows else []:
        byte, bits = pair.split(":")
        table[int(byte)] = int(bits)
    constant = F.lit(bytes(table))

    def test(col: Column) -> Column:
        s = place(col)
        byte = small_number(constant, F.floor(s / 7).cast("int"))
        return F.coalesce(F.getbit(byte, s % 7) == 1, F.lit(False))
    return test


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit hash of 64-bit numbers."""
    h = (values ^ (values >> np.uint64(33))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class BloomFilter:
    """Bloom filter of 2**log_words 64-bit words, three bits a value in one word, for use inside Python tasks.

    It is built by Spark: tasks hash the values, 32 tasks each own a range of the words, and the driver gets
    the filter once, of a size that does not depend on the data.  What it lets through by chance must be
    sorted out later; as it fills up, it lets through more and never loses a value."""

    def __init__(self, spark: SparkSession, words: np.ndarray, log_words: int):
        self.log_words, self.words = log_words, spark.sparkContext.broadcast(words.tobytes())

    def __getstate__(self):
        return {"log_words": self.log_words, "words": self.words}

    @classmethod
    def of(cls, rows: DataFrame, cols: str | tuple[str, ...], log_words: int, values=None) -> BloomFilter:
        """Filter of the values (64-bit numbers) that ``values`` makes of the arrays of a batch's columns."""
        if not 5 <= log_words <= 22:
            raise ValueError("a filter has from 2**5 to 2**22 words")
        own = log_words - 5
        cols = (cols,) if isinstance(cols, str) else cols

        def hashed(batches):
            for b in batches:
                arrays = [c.to_numpy(zero_copy_only=False) for c in b.columns]
                v = values(*arrays) if values else arrays[0].astype(np.int64).view(np.uint64)
                h = np.unique(mixed(v.ravel()) >> np.uint64(64 - 15 - log_words))
                cut = np.searchsorted(h, np.arange(33, dtype=np.uint64) << np.uint64(own + 15))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(32), pa.int32()),
                     pa.array([h[x:y].astype("<u4").tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                    names=["part", "hashed"])

        def fill(batches):
            parts: dict[int, np.ndarray] = {}
            for b in batches:
                for part, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    h = np.frombuffer(data.as_buffer(), dtype="<u4").astype(np.uint64) & np.uint64((1 << (own + 15)) - 1)
                    if h.size:  # sorted: each word's bits lie together
                        word = (h >> np.uint64(15)).astype(np.int64)
                        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                        parts.setdefault(part, np.zeros(1 << own, np.uint64))[word[first]] |= np.bitwise_or.reduceat(cls.bits(h), first)
            for part, m in parts.items():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["part", "words"])

        out = np.zeros(1 << log_words, dtype=np.uint64)
        dealt = rows.select(*cols).mapInArrow(hashed, "part int, hashed binary").repartition(32, "part")
        for r in dealt.mapInArrow(fill, "part int, words binary").toLocalIterator():
            out[r.part << own:(r.part + 1) << own] |= np.frombuffer(r.words, dtype="<u8")
        return cls(rows.sparkSession, out, log_words)

    @staticmethod
    def bits(hashed: np.ndarray) -> np.ndarray:
        one, low = np.uint64(1), np.uint64(31)
        return (one << (hashed & low)) | (one << (np.uint64(16) + (hashed >> np.uint64(5) & low))) | \
            (one << (np.uint64(32) + (hashed >> np.uint64(10) & low)))

    def tester(self):
        """A function from an array of 64-bit numbers to an array of booleans."""
        words, shift = np.frombuffer(self.words.value, dtype="<u8"), np.uint64(64 - 15 - self.log_words)

        def test(values: np.ndarray) -> np.ndarray:
            h = mixed(values) >> shift
            bits = self.bits(h)
            return (words[h >> np.uint64(15)] & bits) == bits
        return test
