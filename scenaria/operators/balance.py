"""Class balancing by synthetic neighbours (X5-X7, A15) and exact k nearest neighbours inside a class.

k-NN by blocks: every class is ordered by a projection on a seeded random unit direction and cut into blocks of
bounded size.  A block's rows first meet each other; the k-th distance found there bounds the row's k-th distance
overall.  A projection never exceeds the true distance, so every nearer row lies in the band of that bound around
the row's own projection: only blocks that the band reaches are visited.  Where projections prune little (many
dimensions, no clusters) that is all blocks of the class: exact k-NN is quadratic there.

Two blocks meet in one task, by one matrix product; it says which pairs may be among the k nearest, within the
product's rounding, and the distances of those few are computed anew, term by term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.operators import keyed
from scenaria.session import cut_lineage

BLOCK = 8192
STEP = 512
VECTOR = pa.list_(pa.field("element", pa.float64()))


def _direction(dim: int, seed: int) -> list[float]:
    v = np.random.default_rng(seed).standard_normal(dim)
    return (v / np.linalg.norm(v)).tolist()


def _dot(vec: Column, u: list[float]) -> Column:
    lit = F.array(*[F.lit(float(x)) for x in u])
    return F.aggregate(F.zip_with(vec, lit, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def _codes(queries: pa.Array, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Both id columns as numbers that order alike."""
    both = np.concatenate([queries.to_numpy(zero_copy_only=False), ids.to_numpy(zero_copy_only=False)])
    code = np.unique(both, return_inverse=True)[1]
    return code[:len(queries)], code[len(queries):]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _of_use(w: np.ndarray, nbr: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k nearest of any row: of equal vectors, k rows of an id and 2k of all
    ids, the smallest ids first, for a row may be neighbour to none of one id."""
    order = np.lexsort((nbr, np.unique(w, axis=0, return_inverse=True)[1].ravel()))
    for most, same in ((k, lambda o: (w[o[1:]] == w[o[:-1]]).all(axis=1) & (nbr[o[1:]] == nbr[o[:-1]])),
                       (2 * k, lambda o: (w[o[1:]] == w[o[:-1]]).all(axis=1))):
        begin = np.concatenate([[True], ~same(order)]) if len(order) else np.zeros(0, bool)
        at = np.arange(len(order))
        order = order[at - np.maximum.accumulate(np.where(begin, at, 0)) < most] if len(order) else order
    return order


def _nearest(v: np.ndarray, own: np.ndarray, bound: np.ndarray, w: np.ndarray, nbr: np.ndarray, k: int) -> tuple:
    """(row of v, row of w, squared distance) of the k nearest rows of w to each row of v that have another id and
    may lie within ``bound``; in order of v, distance (NaN last), id."""
    use = _of_use(w, nbr, k)
    w, nbr = w[use], nbr[use]
    vv, ww = np.einsum("ij,ij->i", v, v), np.einsum("ij,ij->i", w, w)
    by_id = np.argsort(nbr, kind="stable")
    first, last = (np.searchsorted(nbr[by_id], own, side=s) for s in ("left", "right"))
    found: list[tuple] = []
    for a in range(0, len(v) if len(w) else 0, STEP):
        x = v[a:a + STEP]
        d = vv[a:a + STEP, None] + ww - 2.0 * (x @ w.T)
        d[~np.isfinite(d)] = np.inf
        for i in np.flatnonzero(last[a:a + STEP] > first[a:a + STEP]):
            d[i, by_id[first[a + i]:last[a + i]]] = np.inf
        kth = bound[a:a + STEP]
        if not np.isfinite(kth).all() or (d <= kth[:, None]).sum() > 8 * k * len(x):
            kth = np.fmin(kth, np.partition(d, k - 1, axis=1)[:, k - 1] if len(w) > k else np.inf)
        slack = 8.0 * (w.shape[1] + 16) * np.finfo(float).eps * (vv[a:a + STEP] + ww.max())
        near = np.where(np.isfinite(kth + slack), kth + slack, np.inf)
        rows, places = np.nonzero((d <= near[:, None]) | np.isinf(d))
        other = own[a + rows] != nbr[places]
        rows, places = rows[other], places[other]
        exact = np.zeros(len(rows))
        for j in range(w.shape[1]):  # term by term, as ``sq_dist`` adds
            t = x[rows, j] - w[places, j]
            exact += t * t
        order = np.lexsort((nbr[places], exact, rows))
        rows, places, exact = rows[order], places[order], exact[order]
        at = np.arange(len(rows))
        begin = np.maximum.accumulate(np.where(np.concatenate([[True], rows[1:] != rows[:-1]]), at, 0)) if len(rows) else at
        keep = at - begin < k
        found.append((a + rows[keep], use[places[keep]], exact[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _inside(k: int, dim: int):
    """Task: the k nearest of each row of a block inside the block.  A row's first line of the result also has its
    vector, its bound (the k-th squared distance, infinite if there are fewer) and its band; a row without
    neighbours has that line alone."""
    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        column = lambda c: block.column(c).combine_chunks()
        w = _matrix(column("v"), dim)
        asks = np.flatnonzero(column("asks").to_numpy(zero_copy_only=False))
        own, nbr = _codes(column("id").take(pa.array(asks)), column("id"))
        v, t = w[asks], column("t").to_numpy(zero_copy_only=False)[asks]
        with np.errstate(all="ignore"):
            rows, places, d2 = _nearest(v, own, np.full(len(v), np.inf), w, nbr, k)
            n = np.bincount(rows, minlength=len(v))
            bound = np.full(len(v), np.inf)
            bound[n >= k] = d2[(np.cumsum(n) - 1)[n >= k]]
            r = np.sqrt(bound)
            r = r + 1e-9 * (r + np.sqrt(np.einsum("ij,ij->i", v, v))) + 1e-12
            known = np.isfinite(r) & np.isfinite(t)
            lo, hi = np.where(known, t - r, -np.inf), np.where(known, t + r, np.inf)
        bound[~known] = np.inf
        row = np.concatenate([rows, np.flatnonzero(n == 0)])
        place = np.concatenate([places, np.zeros((n == 0).sum(), np.int64)])
        d2 = np.concatenate([d2, np.zeros((n == 0).sum())])
        none = np.arange(len(row)) >= len(rows)
        head = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
        head |= none
        return pa.table({
            "cls": column("cls").take(pa.array(asks[row])), "blk": column("blk").take(pa.array(asks[row])),
            "id": column("id").take(pa.array(asks[row])), "nbr_id": column("id").take(pa.array(place, mask=none)),
            "d2": pa.array(d2, mask=none), "v": column("v").take(pa.array(asks[row], mask=~head)).cast(VECTOR),
            "bound": pa.array(bound[row], mask=~head), "lo": pa.array(lo[row], mask=~head), "hi": pa.array(hi[row], mask=~head)})
    return run


def _across(k: int, dim: int):
    """Task: the k nearest of each asking row among the rows of another block, within the row's bound."""
    def run(asking: pa.Table, block: pa.Table) -> pa.Table:
        asking, block = asking.combine_chunks(), block.combine_chunks()
        ids, others = asking.column("id").combine_chunks(), block.column("id").combine_chunks()
        own, nbr = _codes(ids, others)
        with np.errstate(all="ignore"):
            rows, places, d2 = _nearest(_matrix(asking.column("v").combine_chunks(), dim), own, asking.column("bound").to_numpy(),
                                        _matrix(block.column("v").combine_chunks(), dim), nbr, k)
        return pa.table({"id": ids.take(pa.array(rows)), "nbr_id": others.take(pa.array(places)), "d2": pa.array(d2)})
    return run


def knn_in_class(df: DataFrame, id_col: str, vec: str, cls: str, k: int = D.SMOTE_K, seed: int = D.SEED,
                 dim: int | None = None, query_ids: DataFrame | None = None, block_rows: int = BLOCK) -> DataFrame:
    """For every row (or only the rows in ``query_ids``) its k nearest rows of the same class by
    squared Euclidean distance (double), ties by id.  Returns (id, rank, nbr_id, d2).  Rows without an id, a class or
    a vector of ``dim`` values take no part."""
    if dim is None:
        dim = len(df.select(vec).where(F.col(vec).isNotNull()).first()[0])
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    pts = df.select(F.col(id_col).alias("id"), F.col(cls).alias("cls"), v.alias("v")) \
        .where(F.col("id").isNotNull() & F.col("cls").isNotNull() & (F.size("v") == dim) & ~F.exists("v", lambda x: x.isNull())) \
        .withColumn("t", _dot(F.col("v"), _direction(dim, seed)))
    # (1) blocks of about equal size along the projection, inside a class
    sizes = pts.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    pos = keyed.with_position(pts, "cls", ["t", "id"], pos="p").join(sizes, "cls")
    n_blocks = F.ceil(F.col("n") / F.lit(block_rows))
    pos = pos.withColumn("blk", F.floor((F.col("p") - 1) * n_blocks / F.col("n")).cast("long")).drop("p", "n")
    if query_ids is None:
        pos = pos.withColumn("asks", F.lit(True))
    else:
        asked = query_ids.select(F.col(id_col).alias("id")).distinct().withColumn("asks", F.lit(True))
        pos = pos.join(asked, "id", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
    pos = cut_lineage(pos)   # read by both passes
    types = {c: pos.schema[c].dataType.simpleString() for c in ("id", "cls")}
    # (2) every block by itself
    own = pos.groupBy("cls", "blk").applyInArrow(_inside(k, dim), schema=(
        f"cls {types['cls']}, blk long, id {types['id']}, nbr_id {types['id']}, d2 double, v array<double>, bound double, lo double, hi double"))
    own = cut_lineage(own)
    # (3) the other blocks that a row's band reaches: a span per block, one task per two blocks
    span = pos.groupBy("cls", "blk").agg(F.min(F.nanvl("t", F.lit(float("-inf")))).alias("from"), F.max("t").alias("to"))
    span = span.select("cls", F.col("blk").alias("other"), "from", "to")
    reach = (F.col("from") <= F.col("hi")) & (F.col("to") >= F.col("lo")) & (F.col("other") != F.col("blk"))
    asking = own.where("v is not null").select("cls", "blk", "id", "v", "bound", "lo", "hi")
    bands = asking.groupBy("cls", "blk").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    pairs = bands.join(span, "cls").where(reach).select("cls", F.col("blk").alias("of"), "other")
    asking = asking.join(F.broadcast(span), "cls").where(reach).select("cls", F.col("blk").alias("of"), "other", "id", "v", "bound")
    data = pos.select("cls", F.col("blk").alias("other"), "id", "v").join(F.broadcast(pairs), ["cls", "other"])
    far = asking.groupBy("cls", "of", "other").cogroup(data.groupBy("cls", "of", "other")).applyInArrow(
        _across(k, dim), schema=f"id {types['id']}, nbr_id {types['id']}, d2 double")
    near = own.where("nbr_id is not null").select("id", "nbr_id", "d2").unionByName(far)
    w = Window.partitionBy("id").orderBy("d2", "nbr_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select(F.col("id").alias(id_col), "rank", F.col("nbr_id"), "d2")


def _draw(*parts: Column) -> Column:
    """Seeded whole number below 2^32 from an md5 of the parts: the same on every re-execution and in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("long")


def _u01(*parts: Column) -> Column:
    """Seeded uniform in [0, 1)."""
    return _draw(*parts).cast("double") / float(1 << 32)


def _pick(n: Column, *parts: Column) -> Column:
    return F.pmod(_draw(*parts), n).cast("long")


def smote(df: DataFrame, id_col: str, vec: str, cls: str, k: int = D.SMOTE_K, seed: int = D.SEED,
          target: str = "max", block: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """Raise every class below the largest to its size with rows x + u (nbr - x), x a seeded
    random row of the class, nbr one of its k nearest same-class rows, u in [0, 1).
    Returns (balanced rows with ``synthetic`` flag, plan table (class, n, need, k_used, skipped)).
    A class of one row cannot interpolate and is reported as skipped (R27)."""
    counts = df.groupBy(F.col(cls).alias("_c")).agg(F.count(F.lit(1)).alias("n"))
    # one row per class: written once, so the counts are not recomputed by every branch below
    counts = cut_lineage(counts)
    mx = counts.agg(F.max("n")).first()[0] or 0
    plan = counts.select(F.col("_c").alias(cls), "n", (F.lit(mx) - F.col("n")).alias("need"),
                         F.least(F.lit(k), F.col("n") - 1).alias("k_used"), (F.col("n") < 2).alias("skipped"))
    todo = plan.where((F.col("need") > 0) & ~F.col("skipped"))
    # spread the synthetic rows: blocks first (one row per block), then rows inside a block
    blocks = todo.select(cls, "n", "need", "k_used",
                         F.explode(F.sequence(F.lit(0), F.floor((F.col("need") - 1) / block).cast("long"))).alias("_b"))
    blocks = blocks.repartition(cls, "_b")
    j = blocks.select(cls, "n", "k_used", F.explode(F.sequence(F.col("_b") * block,
                      F.least(F.col("need"), (F.col("_b") + 1) * block) - 1)).alias("_j"))
    sd = F.lit(seed)
    spec = j.select(cls, "_j", (_pick(F.col("n"), sd, F.col(cls), F.col("_j")) + 1).alias("_bp"),
                    (_pick(F.col("k_used"), sd + 1, F.col(cls), F.col("_j")) + 1).alias("_nr"),
                    _u01(sd + 2, F.col(cls), F.col("_j")).alias("_u"))
    # only classes that grow need neighbours, and only for the base rows actually drawn
    grow = df.join(todo.select(cls), cls, "left_semi")
    base = keyed.with_position(grow, cls, [id_col], pos="_bp")
    b = cut_lineage(spec.join(base, [cls, "_bp"]))        # the drawn rows: read by the k-NN and the join
    knn = knn_in_class(grow, id_col, vec, cls, k, seed, query_ids=b.select(id_col))
    b = b.join(knn.select(F.col(id_col), F.col("rank").alias("_nr"), "nbr_id"), [id_col, "_nr"])
    nb = df.select(F.col(id_col).alias("nbr_id"), F.col(vec).alias("_nv"))
    b = b.join(nb, "nbr_id")
    et = dict(df.dtypes)[vec]
    newv = F.zip_with(F.col(vec), F.col("_nv"), lambda x, y: x + F.col("_u") * (y - x))
    synth = b.select(*[newv.cast(et).alias(vec) if c == vec else
                       (F.lit(None).cast(dict(df.dtypes)[c]).alias(c) if c == id_col else F.col(c))
                       for c in df.columns], F.lit(True).alias("synthetic"))
    return df.withColumn("synthetic", F.lit(False)).unionByName(synth), plan


def smote_if_rare(df: DataFrame, id_col: str, vec: str, cls: str, min_required: int = D.MIN_CLASS_ROWS, **kw):
    """Stage 1 rule: balance a label only if its smallest class has fewer than ``min_required`` rows."""
    mn = df.groupBy(cls).count().agg(F.min("count")).first()[0]
    if mn is None or mn >= min_required:
        return df.withColumn("synthetic", F.lit(False)), None
    return smote(df, id_col, vec, cls, **kw)


def smote_combos(df: DataFrame, id_col: str, vec: str, labels, k: int = D.SMOTE_K, seed: int = D.SEED,
                 min_rows: int = D.MIN_COMBO_ROWS, sep: str = ","):
    """SMOTE over the combined label key (F5), run only when the rarest combination has at least
    ``min_rows`` rows; the key is split back into the labels (F7).  Returns (rows, ran)."""
    from scenaria.functions import combo_ints, combo_key
    labels = list(labels)
    t = df.withColumn("_combo", combo_key(labels, sep))
    mn = t.groupBy("_combo").count().agg(F.min("count")).first()[0]
    if mn is None or mn < min_rows:
        return df, False
    base = t.drop("synthetic") if "synthetic" in t.columns else t
    out, _plan = smote(base, id_col, vec, "_combo", k=k, seed=seed)
    types = dict(df.dtypes)
    parts = combo_ints(F.col("_combo"), len(labels), sep)
    out = out.select(*[parts[labels.index(c)].cast(types[c]).alias(c) if c in labels else F.col(c)
                       for c in out.columns if c != "_combo"])
    return out, True
