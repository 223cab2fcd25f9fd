"""Vector code compression: product quantisation with codebooks fitted to all vectors by exact rounds.

Vectors are cut into blocks as they are read; every part of a block gets a metric tree (``balltree``), written once.
Each round sends the codebooks, of a fixed size, to the tasks; balls with one owner add their cached sum and count,
and the rest is settled at the leaves.  Sums come together by (part, entry): the driver sees one row for each.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .balltree import PLAIN, BallTree, nearest, owners
from .common import written

BLOCK = 4096
#: Scaled components are held between -LIMIT and LIMIT.
LIMIT = 10 ** 27
LONG = 2 ** 63 - 1


def whole(x: float, scale: int) -> int:
    """floor(scale * x), held at LIMIT; exact for any double, as the product of a large one is whole already."""
    y = scale * x
    if not -LIMIT < y < LIMIT:
        return LIMIT if y > 0 else -LIMIT
    return int(np.floor(y))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """Scaled components as whole numbers: 64-bit, or Python's own where some are large."""
    with np.errstate(over="ignore"):
        y = np.floor(values * float(scale))
    if np.abs(y).max(initial=0) < 2.0 ** 62:
        return y.astype(np.int64)
    return np.array([[whole(x, scale) for x in row] for row in values.tolist()], object).reshape(values.shape)


def usable(v: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return v.isNotNull() & F.forall(v, lambda x: F.coalesce(fine(x), F.lit(False)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of doubles, shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def blocks(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """(ids, labels, data): one row for about ``BLOCK`` rows as they are read, with the points and the tree of every part."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    step = width // parts

    def run(batches):
        kept: list[pa.RecordBatch] = []

        def flush():
            t = pa.Table.from_batches(kept).combine_chunks()
            ids, labels, v = (t.column(i).chunk(0) for i in range(3))
            x = integers(matrix(v, width), scale)
            data = pickle.dumps([(small(p), BallTree(p)) for p in (x[:, k * step:(k + 1) * step] for k in range(parts))], protocol=5)
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(ids)], ids), pa.ListArray.from_arrays([0, len(labels)], labels),
                                               pa.array([data], pa.binary())], names=["ids", "labels", "data"])

        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                some = b.slice(at, BLOCK)
                if kept and sum(k.num_rows for k in kept) + some.num_rows > BLOCK:
                    yield flush()
                    kept = []
                kept.append(some)
        if kept and sum(k.num_rows for k in kept):
            yield flush()

    return rows.select("id", "label", "v").mapInArrow(run, f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, data binary")


def small(p: np.ndarray) -> np.ndarray:
    return p.astype(np.int32) if p.dtype != object and np.abs(p).max(initial=0) < 2 ** 31 else p


def _totals(trees: DataFrame, books: list[np.ndarray], step: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(count, sums) of the points that each entry owns, by (part, entry)."""
    sent = trees.sparkSession.sparkContext.broadcast(books)
    columns = [f"s{i}" for i in range(step)]

    def run(batches):
        total: dict[tuple[int, int], list] = {}
        for b in batches:
            for data in b.column(0):
                for part, (points, tree) in enumerate(pickle.loads(data.as_buffer())):
                    book = sent.value[part]
                    counts, sums = np.zeros(len(book), np.int64), np.zeros((len(book), step), np.int64 if points.dtype != object else object)

                    def ball(i, entry, counts=counts, sums=sums, tree=tree):
                        counts[entry] += tree.past[i] - tree.first[i]
                        sums[entry] += tree.sums[i]

                    def each(at, entry, d, counts=counts, sums=sums, points=points):
                        np.add.at(counts, entry, 1)
                        np.add.at(sums, entry, points[at])

                    owners(tree, points, book, ball, each)
                    for k in np.flatnonzero(counts).tolist():
                        t = total.setdefault((part, k), [0, [0] * step])
                        t[0] += int(counts[k])
                        t[1] = [x + int(y) for x, y in zip(t[1], sums[k], strict=True)]
        keys = list(total)
        decimal = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array([total[k][0] for k in keys], pa.int64()),
                                          *[pa.array([total[k][1][i] for k in keys], decimal) for i in range(step)]],
                                         names=["part", "entry", "n", *columns])

    schema = "part int, entry int, n long" + "".join(f", {c} decimal(38,0)" for c in columns)
    rows = trees.select("data").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).collect()
    return {(r.part, r.entry): (r.n, [int(r[c]) for c in columns]) for r in rows}


def fit(trees: DataFrame, start: np.ndarray, parts: int, rounds: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` rounds, from the rows of ``start``."""
    step = start.shape[1] // parts
    books = [start[:, k * step:(k + 1) * step] for k in range(parts)]
    for _ in range(rounds):
        for (part, entry), (n, sums) in _totals(trees, books, step).items():
            mean = [s // n for s in sums]
            if books[part].dtype != object and max(map(abs, mean), default=0) >= 2 ** 62:
                books[part] = books[part].astype(object)
            books[part][entry] = mean
    return books


def encoded(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error) of every vector."""
    sent = trees.sparkSession.sparkContext.broadcast(books)
    kinds = [trees.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]

    def run(batches):
        for b in batches:
            for ids, labels, data in zip(b.column(0), b.column(1), b.column(2), strict=True):
                n = len(ids)
                codes, error = np.zeros((n, len(sent.value)), np.uint8), np.zeros(n, np.int64)
                for part, (points, tree) in enumerate(pickle.loads(data.as_buffer())):
                    book, mine = sent.value[part], np.zeros(n, np.int64)

                    def ball(i, entry, codes=codes, part=part, points=points, tree=tree, book=book, mine=mine):
                        at = tree.order[tree.first[i]:tree.past[i]]
                        codes[at, part] = entry
                        mine[at] = held(nearest(points[at], book[[entry]])[1])

                    def each(at, entry, d, codes=codes, part=part, mine=mine):
                        codes[at, part] = entry
                        mine[at] = held(d)

                    owners(tree, points, book, ball, each)
                    error = np.where(error > LONG - mine, LONG, error + mine)
                text = codes.tobytes().hex()
                width = 2 * codes.shape[1]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array([text[i:i + width] for i in range(0, n * width, width)], pa.string()), pa.array(error)],
                                                 names=["id", "label", "code", "error"])

    return trees.mapInArrow(run, f"id {kinds[0]}, label {kinds[1]}, code string, error long")


def held(d: np.ndarray) -> np.ndarray:
    """Squared distances as longs, held at the largest one."""
    return d.astype(np.int64) if d.dtype != object else np.array([min(int(x), LONG) for x in d], np.int64)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` (id, label, code, error) with the sum of ``error`` over equal labels (nulls together).  Labels of more
    than one row in 256 are at most 256 and met without a shuffle; the others are joined."""
    sums = written(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("s")), "label-sums")
    total = sums.agg(F.sum("n")).first()[0] or 0
    sums = sums.select("label", "n", F.least("s", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    common = sums.where(F.col("n") > total / 256).select(F.col("label").alias("l"), "label_error", F.lit(True).alias("hot"))
    met = rows.join(F.broadcast(common), F.col("label").eqNullSafe(F.col("l")), "left").drop("l")
    rare = sums.where(F.col("n") <= total / 256).select(F.col("label").alias("l"), F.col("label_error").alias("e"))
    rest = met.where("hot is null").drop("hot", "label_error").join(rare, F.col("label").eqNullSafe(F.col("l")))
    names = ["id", "label", "code", "error", "label_error"]
    return met.where("hot").select(*names).unionByName(rest.withColumnRenamed("e", "label_error").select(*names))


def compress(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int = 4, entries: int = 256, rounds: int = 4,
             scale: int = 1024) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error, label_error) of every usable vector, and the codebooks, one array of entries a part.

    Vectors that are null or hold null, NaN or infinite components are dropped.  Components become
    floor(scale * x), held between -10**27 and 10**27; squared distances and sums beyond a long are held at the
    largest one.  Vectors shorter than the longest, or than a multiple of ``parts``, are filled with zeros.  A
    codebook starts as the parts of the vectors of the ``entries`` smallest ids (fewer, if there are fewer); ids may
    repeat, and null ids come last: equal ids are ordered by their vectors.  Codes are the entries' numbers, two
    hex digits a part; ties go to the smaller number, and entries that own nothing stay as they are.  An empty
    table gives an empty result and empty codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("a code digit pair tells 256 entries apart")
    src = vectors.where(usable(F.col(vec_col))).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.transform(vec_col, lambda x: x.cast("double")).alias("v"))
    width = -(-(src.agg(F.max(F.size("v"))).first()[0] or 0) // parts) * parts
    trees = written(blocks(src, width, parts, scale), "trees")
    first = src.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = integers(np.array([[*r.v, *[0.0] * (width - len(r.v))] for r in first], np.float64).reshape(len(first), width), scale)
    books = fit(trees, start, parts, rounds)
    return with_label_error(written(encoded(trees, books), "codes")), books


def book_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()
