"""Exact top-k inner product search by block-at-a-time pruning.

Vectors of whole numbers are laid out so that near ones lie together, and cut into shards and blocks (ranges
of that order).  A block keeps the largest and smallest value of every dimension (a signed dimension is two
terms, one for either sign), so the sum of a query's term maxima bounds every score in it.

For each query the shard of the highest bound is searched first, which gives a first k-th score; then the
shards whose bound reaches that score.  Inside a shard, blocks are visited by falling bound and scored
through their forward index until the bounds fall below the k-th score.  Queries meet shards in batches of
bounded size, paired only where a bound calls for it; nothing is broadcast but a fixed number of pivots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

K = 20
BLOCK = 32
SHARD_ROWS = 4096
BATCH = 2048
PACK = 1024
PIVOTS = 32
#: Components are held at this size, scores at LIMIT.
WIDEST = 2.0 ** 62
LIMIT = 2 ** 63 - 1
FOUND = "query long, query_id long, vec_id long, copies long, score long"


def whole(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """(vec_id, dim, v, copies): floor(scale * component) as little-endian numbers, 4 bytes each where they fit, else 8.
    A row whose id or vector is null, or that holds a null or a value that is not finite, is left out; rows of equal
    id and numbers come as one with their count.  Numbers beyond 2^62 are held there.  Shorter vectors count as
    filled up with zeros."""
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        "vec_id is not null and v is not null")

    def run(batches):
        for b in batches:
            col = b.column(1)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(float)
            ends = np.cumsum(np.asarray(pa.compute.list_value_length(col)))
            keep, out, dims = [], [], []
            for i, (a, e) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
                x = flat[a:e]  # nulls read as NaN
                if not np.isfinite(x).all():
                    continue
                with np.errstate(over="ignore"):
                    y = np.clip(np.floor(scale * x), -WIDEST, WIDEST)
                small = not len(y) or np.abs(y).max() < 2 ** 31
                keep.append(i), dims.append(e - a), out.append(y.astype("<i4" if small else "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array(dims, pa.int32()),
                                              pa.array(out, pa.binary())], names=["vec_id", "dim", "v"])

    rows = src.mapInArrow(run, "vec_id long, dim int, v binary")
    return rows.groupBy("vec_id", "dim", "v").agg(F.count(F.lit(1)).alias("copies"))


def matrix(dims: list[int], vectors: list[bytes], width: int | None = None) -> np.ndarray:
    out = np.zeros((len(dims), max(dims, default=0) if width is None else width))
    exact = None
    for i, (n, v) in enumerate(zip(dims, vectors, strict=True)):
        x = np.frombuffer(v, dtype="<i8" if len(v) == 8 * n else "<i4")
        if len(v) == 8 * n and n and np.abs(x).max() >= 2 ** 53 and exact is None:
            exact = out = out.astype(object)
        out[i, :n] = x if exact is None else x.astype(object)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of whole numbers, exactly: in floating point while no sum can pass 2**52, else in Python's."""
    n = min(a.shape[1], b.shape[1])
    a, b = a[:, :n], b[:, :n]
    wide = a.dtype == object or b.dtype == object
    if wide or n and a.size and b.size and np.abs(a).max() * np.abs(b).max() * n >= 2.0 ** 52:
        a, b = (x if x.dtype == object else x.astype(np.int64).astype(object) for x in (a, b))
    return a @ b.T


def held(scores: np.ndarray) -> np.ndarray:
    """Scores that pass a 64-bit number are held at its end; order is kept, so bounds stay bounds."""
    return np.minimum(np.maximum(scores, -LIMIT), LIMIT) if scores.dtype == object else scores


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Summed term maxima; what a range lacks of the query's dimensions, or the query of the range's, is 0."""
    return held(product(np.maximum(q, 0), high) + product(np.minimum(q, 0), low))


def search(q, own, d, d_ids, high, low, k, least, past, d_rows=None):
    """(query position, vec_id, score, position in the shard) of each query's k best in one shard that beat ``least``,
    or reach it with an id below ``past``, ties to the smaller id, without the row that is the query's own (``own``,
    a number of ``d_rows``, or of the ids where these are not given)."""
    d_rows = d_ids if d_rows is None else d_rows
    u = bounds(q, high, low)
    order = np.argsort(-u, axis=1, kind="stable")
    kth = least.copy()
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, u.dtype), np.zeros(0, np.int64))
    at, width, n = 0, 1, u.shape[1]
    while at < n:
        act = np.flatnonzero(u[np.arange(len(q)), order[:, at]] >= kth)
        if not act.size:
            break
        blocks = order[act, at:at + width]
        r, c = np.nonzero(u[act[:, None], blocks] >= kth[act][:, None])
        b, qi = blocks[r, c], act[r]
        by = np.argsort(b, kind="stable")
        new = [found]
        for part in np.split(by, np.flatnonzero(np.diff(b[by])) + 1):
            g, rows = qi[part], slice(b[part[0]] * BLOCK, (b[part[0]] + 1) * BLOCK)
            s = held(product(q[g], d[rows]))
            better = (s > least[g][:, None]) | (s == least[g][:, None]) & (d_ids[rows][None, :] < past[g][:, None])
            i, j = np.nonzero((s >= kth[g][:, None]) & better & (d_rows[rows][None, :] != own[g][:, None]))
            new.append((g[i], d_ids[rows][j], s[i, j], rows.start + j))
        found = tuple(np.concatenate(x) for x in zip(*new, strict=True))
        by = np.lexsort((found[1], -found[2], found[0]))
        found = tuple(x[by] for x in found)
        first = np.searchsorted(found[0], found[0])
        keep = np.arange(len(by)) - first < k
        found = tuple(x[keep] for x in found)
        last = np.flatnonzero((np.arange(len(by)) - first == k - 1))
        if last.size:
            full = np.flatnonzero(np.bincount(found[0], minlength=len(q)) == k)
            ends = np.searchsorted(found[0], full, side="right") - 1
            if found[2].dtype == object:  # a float would round the k-th score
                kth = kth.astype(object)
            kth[full] = np.maximum(kth[full], found[2][ends])
        at, width = at + width, min(2 * width, 32)
    return found


def _order(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """With ``code``, by the two nearest of the pivots, so that near vectors have codes in common."""

    def run(batches):
        for b in batches:
            x = matrix(b.column(1).to_pylist(), b.column(2).to_pylist()).astype(float)
            n = min(x.shape[1], pivots.shape[1])
            s = x[:, :n] @ pivots[:, :n].T
            two = np.argsort(-s, axis=1, kind="stable")[:, :2]
            code = two @ np.array([PIVOTS, 1])[:two.shape[1]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code.astype(np.int32))], names=["vec_id", "dim", "v", "row", "copies", "code"])

    return rows.select("vec_id", "dim", "v", "row", "copies").mapInArrow(run, "vec_id long, dim int, v binary, row long, copies long, code int")


def _cut(rows: DataFrame, most: int, parts: int, name: str) -> DataFrame:
    """One row for every run of at most ``most`` vectors in code order: its number, ids, row numbers, copies, vectors
    and, of each block, the largest and smallest value per dimension."""

    def run(batches):
        no, ids, dims, vectors, numbers, copies = TaskContext.get().partitionId() << 32, [], [], [], [], []

        def row():
            width = max(dims)
            x = matrix(dims, vectors)
            starts = np.arange(0, len(ids), BLOCK)
            high, low = (f.reduceat(x, starts, axis=0) for f in (np.maximum, np.minimum))
            if x.dtype == object:
                high, low, x = (z.astype(np.int64) for z in (high, low, x))
            pack = lambda z: z.astype("<i8" if z.size and np.abs(z).max() >= 2 ** 31 else "<i4").tobytes()
            return pa.RecordBatch.from_pydict({"no": [no], "dim": [width], "ids": [np.array(ids, "<i8").tobytes()],
                                               "rows": [np.array(numbers, "<i8").tobytes()], "copies": [np.array(copies, "<i8").tobytes()], "v": [pack(x)],
                                               "high": [pack(high)], "low": [pack(low)], "top": [pack(high.max(axis=0))],
                                               "bottom": [pack(low.min(axis=0))]}, schema=RUN)
        for b in batches:
            for i, n, v, r, c in zip(*(c.to_pylist() for c in b.columns[:5]), strict=True):
                ids.append(i), dims.append(n), vectors.append(v), numbers.append(r), copies.append(c)
                if len(ids) == most:
                    yield row()
                    no, ids, dims, vectors, numbers, copies = no + 1, [], [], [], [], []
        if ids:
            yield row()

    dealt = rows.repartitionByRange(parts, "code", "vec_id").sortWithinPartitions("code", "vec_id")
    return written(dealt.mapInArrow(run, "no long, dim int, ids binary, rows binary, copies binary, v binary, high binary, low binary, "
                                    "top binary, bottom binary"), name)


RUN = pa.schema([("no", pa.int64()), ("dim", pa.int32()), *((n, pa.binary()) for n in ("ids", "rows", "copies", "v", "high", "low", "top", "bottom"))])


def _rows(data: bytes, dim: int, count: int) -> np.ndarray:
    x = np.frombuffer(data, dtype="<i8" if dim and len(data) == 8 * dim * count else "<i4").reshape(count, dim)
    return x.astype(object) if x.size and x.dtype == np.dtype("<i8") and np.abs(x).max() >= 2 ** 53 else x.astype(float)


def _visit(pairs: DataFrame, k: int) -> DataFrame:
    """Search each row's shard for the row's queries, those at ``at`` of the batch."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                q_ids, q_rows, d_ids, d_rows, copies = (np.frombuffer(r[c], "<i8") for c in ("q_ids", "q_rows", "ids", "rows", "copies"))
                q = _rows(r["q_v"], r["q_dim"], len(q_ids))
                at = np.frombuffer(r["at"], "<i4")
                n = -(-len(d_ids) // BLOCK)
                least, past = np.frombuffer(r["least"], "<f8"), np.frombuffer(r["past"], "<i8")
                # copies of the query's own row are other rows
                others = np.where(copies > 1, np.iinfo(np.int64).min, d_rows)
                i, vec, score, j = search(q[at], q_rows[at], _rows(r["v"], r["dim"], len(d_ids)), d_ids, _rows(r["high"], r["dim"], n),
                                          _rows(r["low"], r["dim"], n), k, least, past, others)
                asking = q_rows[at][i]
                yield pa.RecordBatch.from_arrays([pa.array(asking), pa.array(q_ids[at][i]), pa.array(vec), pa.array(copies[j] - (d_rows[j] == asking)),
                                                  pa.array(score.astype(np.int64))], names=["query", "query_id", "vec_id", "copies", "score"])

    return pairs.select("at", "least", "past", "q_ids", "q_rows", "q_dim", "q_v", "ids", "rows", "copies", "dim", "v", "high", "low").mapInArrow(run, FOUND)


def _meet(which: DataFrame, queries: DataFrame, shards: DataFrame) -> DataFrame:
    q = queries.select(F.col("no").alias("batch"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("dim").alias("q_dim"), F.col("v").alias("q_v"))
    return which.join(shards.withColumnRenamed("no", "shard"), "shard").join(q, "batch")


def _grid(queries: DataFrame, packs: DataFrame, n_packs: int) -> DataFrame:
    """Query batches beside packs of shard bounds; both sides in bounded rows."""
    spread = queries.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(n_packs - 1))))
    return spread.join(packs.withColumnRenamed("top", "p_top").withColumnRenamed("bottom", "p_bottom"), "pack").select(
        F.col("no").alias("batch"), "dim", "ids", "v", "least", "shards", "p_dim", "p_top", "p_bottom")


def _aims(grid: DataFrame, best: bool) -> DataFrame:
    """(batch, shard, at, bound): for each query the one shard of the pack with the highest bound (``best``), or
    all shards whose bound reaches the query's ``least``."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, shards = np.frombuffer(r["ids"], "<i8"), np.array(r["shards"], np.int64)
                high = np.zeros((len(shards), max(r["p_dim"])))
                low = high.copy()
                for i, (n, t, m) in enumerate(zip(r["p_dim"], r["p_top"], r["p_bottom"], strict=True)):
                    x, y = _rows(t, n, 1)[0], _rows(m, n, 1)[0]
                    if x.dtype == object or y.dtype == object:
                        high, low = high.astype(object), low.astype(object)
                    high[i, :n], low[i, :n] = x, y
                u = bounds(_rows(r["v"], r["dim"], len(ids)), high, low).astype(float)
                if best:
                    top = u.argmax(axis=1)
                    q, s = np.arange(len(ids)), top
                else:
                    u = u + np.abs(u) * 1e-12  # never below the exact bound
                    q, s = np.nonzero(u >= np.frombuffer(r["least"], "<f8")[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), r["batch"])), pa.array(shards[s]), pa.array(q.astype(np.int32)),
                                                  pa.array(u[q, s])], names=["batch", "shard", "at", "bound"])

    return grid.mapInArrow(run, "batch long, shard long, at int, bound double")


def _gather(aims: DataFrame) -> DataFrame:
    """One row per (batch, shard): its queries' positions and what they must beat, as numbers in bytes."""

    def run(batches):
        for b in batches:
            at = [np.array(x, "<i4") for x in b.column(2).to_pylist()]
            low = [np.array([-np.inf if y is None else y for y in x], "<f8") for x in b.column(3).to_pylist()]
            ids = [np.array([0 if y is None else y for y in x], "<i8") for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in (at, low, ids))],
                                             names=["batch", "shard", "at", "least", "past"])

    got = aims.groupBy("batch", "shard").agg(F.collect_list(F.struct("at", "least", "past")).alias("x"))
    return got.select("batch", "shard", "x.at", "x.least", "x.past").mapInArrow(run, "batch long, shard long, at binary, least binary, past binary")


def _positions(batches: DataFrame) -> DataFrame:
    """(batch, at, query) of every query."""

    def run(parts):
        for b in parts:
            for no, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                q = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), no)), pa.array(np.arange(len(q), dtype=np.int32)), pa.array(q)],
                                                 names=["batch", "at", "query"])

    return batches.select("no", "rows").mapInArrow(run, "batch long, at int, query long")


def _flat(least: DataFrame) -> DataFrame:
    """(no, least): the least scores of a batch in order of position; no bound is minus infinity."""

    def run(parts):
        for b in parts:
            rows = [np.array([-np.inf if y is None else y for y in x], "<f8").tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["no", "least"])

    got = least.groupBy(F.col("batch").alias("no")).agg(F.array_sort(F.collect_list(F.struct("at", "least"))).alias("x"))
    return got.select("no", "x.least").mapInArrow(run, "no long, least binary")


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = K, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (columns as in ``vectors``) the k rows of
    ``vectors`` but its own with the highest inner product of floor(scale * component), ties to the smaller
    id; all of them if there are fewer.

    A query's own row is one row of its id and numbers; more rows of that id are candidates like others, and every
    repeated row counts for itself.  Query rows of equal id and numbers are one query; those that share an id alone
    are answered each.  Rows that cannot take part (see ``whole``) are left out on either side.  A score beyond a
    64-bit number is held at its end.  Empty tables give an empty result."""
    spark = vectors.sparkSession
    data = written(whole(vectors, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    ask = written(whole(queries, id_col, vector_col, scale).withColumn("other", -1 - F.monotonically_increasing_id()), "asked")
    ask = ask.drop("copies").join(data.select("vec_id", "dim", "v", "row"), ["vec_id", "dim", "v"], "left")
    ask = written(ask.select("vec_id", "dim", "v", F.coalesce("row", "other").alias("row"), F.lit(1).cast("long").alias("copies")), "queries")
    drawn = data.orderBy(F.xxhash64("vec_id"), "vec_id", "dim", "v").limit(PIVOTS).collect()
    n, m = data.count(), ask.count()
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = matrix([r.dim for r in drawn], [bytes(r.v) for r in drawn]).astype(float)
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-9)
    shards = _cut(_order(data, pivots), SHARD_ROWS, -(-n // SHARD_ROWS), "shards")
    asked = _cut(_order(ask, pivots), BATCH, -(-m // BATCH), "batches")
    n_packs = -(-shards.count() // PACK)
    packs = (shards.select("no", "dim", "top", "bottom").withColumn("pack", F.pmod(F.xxhash64("no"), F.lit(n_packs)).cast("int"))
             .groupBy("pack").agg(F.collect_list(F.struct("no", "dim", "top", "bottom")).alias("x"))
             .select("pack", F.col("x.no").alias("shards"), F.col("x.dim").alias("p_dim"), F.col("x.top").alias("top"), F.col("x.bottom").alias("bottom")))
    nothing = asked.withColumn("least", F.lit(None).cast("binary"))
    best = (_aims(_grid(nothing, packs, n_packs), True).groupBy("batch", "at")
            .agg(F.max(F.struct("bound", "shard")).alias("b")).select("batch", "at", F.col("b.shard").alias("shard"))
            .withColumn("least", F.lit(None).cast("double")).withColumn("past", F.lit(None).cast("long")))
    first = written(_visit(_meet(_gather(best), asked, shards), k), "first")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = F.col("score").cast("double")
    below = F.when(F.abs(near) >= 2.0 ** 53, near - F.abs(near) * 2.0 ** -52).otherwise(near)  # never above the exact score
    kth = (first.withColumn("r", F.row_number().over(order)).where(F.col("r") == k)
           .select("query", below.alias("least"), F.col("vec_id").alias("past")))
    least = written(_positions(asked).join(kth, "query", "left").select("batch", "at", "least", "past"), "least")
    known = asked.join(_flat(least), "no")
    seen = best.select("batch", "at", "shard")
    aims = _aims(_grid(known, packs, n_packs), False).join(seen, ["batch", "at", "shard"], "left_anti").join(least, ["batch", "at"])
    more = _visit(_meet(_gather(aims), asked, shards), k)
    best = first.unionByName(more).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    upto = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    best = best.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("copies") + 1).where(F.col("from") <= k)
    rank = F.explode(F.sequence(F.col("from"), F.least("upto", F.lit(k).cast("long"))))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").withColumn("rank", F.col("rank").cast("int"))
