"""Skew-safe building blocks for per-series work.

A series (scenario) may hold a third of all rows, so nothing here partitions by the
series key alone.  Rows get an exact 1-based position inside their series from explicit
ranges of (key, order) (a hot series lies in many of them) plus the sizes of the ranges
before; bounded look-back windows then run over fixed-size chunks of a series with
a copied halo of preceding rows, and unbounded scans (fills) run as a two-level
prefix scan: inside a chunk, then a carry across the small per-chunk summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, MapType, StringType, TimestampNTZType, TimestampType, VariantType

from scenaria.session import shuffle_partitions

POS = "_pos"
RANGE = "_range"
CHUNK = "_chunk"
HALO = "_halo"
DEFAULT_CHUNK_ROWS = 1 << 20


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _comparable(df: DataFrame, c: str) -> str:
    """SQL of a column as a value that orders alike and has a plain literal."""
    kind = df.schema[c].dataType
    if isinstance(kind, TimestampType):
        return f"unix_micros({_quoted(c)})"
    if isinstance(kind, TimestampNTZType):
        return f"unix_micros(cast({_quoted(c)} AS timestamp))"
    return f"unix_date({_quoted(c)})" if isinstance(kind, DateType) else _quoted(c)


def _literal(v, kind) -> str:
    if v is None:
        return f"cast(NULL AS {kind.simpleString()})"
    if isinstance(kind, StringType):
        return f"cast(X'{v.encode('utf-8', 'surrogatepass').hex()}' AS string)"
    if isinstance(kind, BinaryType):
        return f"X'{bytes(v).hex()}'"
    return f"cast('{v!r}' AS {kind.simpleString()})" if isinstance(v, float) else f"cast('{v}' AS {kind.simpleString()})"


def splitters(df: DataFrame, cols: list[str], parts: int, per_range: int = 20) -> tuple[list, list]:
    """At most ``parts - 1`` rows that cut ``df``, ordered by ``cols``, into ranges of about equal size, and their types:
    quantiles of a sample by hash, of about ``per_range`` rows a range (all rows, if there are fewer).  A row's
    hash decides whether it is in, so the sample is the same however the table is dealt.  Small samples are the
    rows of the least hashes, found in one job; a large one, for thousands of ranges, takes the rows below a
    bound."""
    want, some = per_range * parts, df.selectExpr(*[f"{_comparable(df, c)} AS c{i}" for i, c in enumerate(cols)])
    names = some.columns
    if want <= 1 << 14:
        some = some.orderBy(F.xxhash64(*names)).limit(want)
    else:
        total = df.count()
        if total > want:
            some = some.where(F.xxhash64(*names) < F.lit(int((2 * want / total - 1) * 2 ** 63)))
    rows = some.orderBy(*names).collect()
    cuts = [rows[i * len(rows) // parts] for i in range(1, parts)] if rows else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]], [f.dataType for f in some.schema]


def range_number(df: DataFrame, cols: list[str], cuts: list, types: list) -> Column:
    """How many of ``cuts`` (ascending) are at most the row's ``cols``.  Up to 512 are compared in generated code,
    halving each time; more are searched in an array.  One SQL text, as thousands of column objects are slow to
    make."""
    def struct(values) -> str:
        return "named_struct(" + ", ".join(f"'c{i}', {v}" for i, v in enumerate(values)) + ")"

    row = struct([_comparable(df, c) for c in cols])
    known = [struct([_literal(v, t) for v, t in zip(cut, types, strict=True)]) for cut in cuts]

    def below(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {row} < {known[mid]} THEN {below(lo, mid)} ELSE {below(mid + 1, hi)} END"

    if len(cuts) <= 512:
        return F.expr(below(0, len(cuts)))
    steps = ", ".join(str(1 << i) for i in range(len(cuts).bit_length() - 1, -1, -1))
    return F.expr(f"aggregate(array({steps}), 0, (at, step) -> CASE WHEN at + step <= {len(cuts)} AND "
                  f"get(array({', '.join(known)}), at + step - 1) <= {row} THEN at + step ELSE at END)")


def with_position(df: DataFrame, key: str, order: list[str], pos: str = POS,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``pos``: the row's 1-based rank inside its ``key`` by ``order``, rows of equal order by a hash of the rest.

    Rows get the number of their range, cut by explicit ``splitters`` of (key, order), and their rank inside (key,
    range) from one shuffle by both: a hot key lies in as many ranges as it fills.  Only keys that a splitter
    belongs to lie in several ranges; those are counted by range, and what lies before is looked up by range, as
    at most one key goes on from one range into the next.  Nothing is written: ``df`` is read for the sample, for
    the counts (few columns each) and for the rows, so it should be cheap to read or written already."""
    cols = [key, *order]
    cuts, types = splitters(df, cols, num_partitions or shuffle_partitions(df.sparkSession))
    number, mine = range_number(df, cols, cuts, types), _comparable(df, key)
    of, before = ["NULL"] * (len(cuts) + 1), [0] * (len(cuts) + 1)
    if cuts:
        keys = sorted({"NULL" if c[0] is None else _literal(c[0], types[0]) for c in cuts})
        several = f"{mine} IN ({', '.join(keys)})" + (f" OR {mine} IS NULL" if "NULL" in keys else "")
        sizes = df.where(several).select(F.expr(mine).alias("k"), number.alias("r")).groupBy("k", "r").count().collect()
        found: dict = {}
        for k, r, n in sorted(sizes, key=lambda x: x[1]):
            if found.get(k):  # the first key of its range, as ranges are contiguous
                of[r], before[r] = _literal(k, types[0]), found[k]
            found[k] = found.get(k, 0) + n
    others = [f.name for f in df.schema if f.name not in cols and not isinstance(f.dataType, (MapType, VariantType))]
    same = [F.xxhash64(*others)] if others else []  # rows of one place keep their order in every plan that asks for it
    rank = F.row_number().over(Window.partitionBy(key, RANGE).orderBy(*order, *same))
    shift = f"CASE WHEN get(array({', '.join(of)}), {RANGE}) <=> {mine} THEN get(array({', '.join(f'{n}L' for n in before)}), {RANGE}) ELSE 0L END" \
        if any(before) else "0L"
    out = df.withColumn(RANGE, number)
    if num_partitions:  # as many tasks as asked for; else AQE may join small ones
        out = out.repartition(num_partitions, key, RANGE)
    out = out.withColumn(pos, rank)
    return out.select(*df.columns, F.expr(f"{_quoted(pos)} + {shift}").alias(pos))


def ensure_position(df: DataFrame, key: str, order: list[str], pos: str = POS) -> DataFrame:
    return df if pos in df.columns else with_position(df, key, order, pos)


def chunk_of(pos: str, chunk_rows: int) -> Column:
    return F.floor((F.col(pos) - 1) / F.lit(chunk_rows)).cast("long")


def chunked(df: DataFrame, pos: str = POS, chunk_rows: int = DEFAULT_CHUNK_ROWS,
            halo: int = 0) -> DataFrame:
    """Assign each row to its chunk and copy it, flagged ``_halo``, into every later chunk whose
    first ``halo`` preceding rows include it."""
    own = chunk_of(pos, chunk_rows)
    last = F.floor((F.col(pos) - 1 + F.lit(halo)) / F.lit(chunk_rows)).cast("long")
    if halo <= 0:
        return df.withColumn(CHUNK, own).withColumn(HALO, F.lit(False))
    out = df.withColumn("_own", own).withColumn(CHUNK, F.explode(F.sequence(F.col("_own"), last)))
    return out.withColumn(HALO, F.col(CHUNK) != F.col("_own")).drop("_own")


def chunk_window(key: str, pos: str = POS):
    return Window.partitionBy(key, CHUNK).orderBy(pos)


def carried_fill(df: DataFrame, key: str, cols: list[str], pos: str = POS,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """For each column c add ``_prev_c`` / ``_next_c``: struct(pos, value) of the last non-null row at
    or before / first non-null row at or after the current row inside its series.  Exact for any
    gap length: in-chunk window scan plus a carry over the per-chunk summary."""
    d = chunked(df, pos, chunk_rows, 0).drop(HALO)
    w = chunk_window(key, pos)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # the next value is the last one seen from behind: a frame that grows is linear, one that shrinks is not
    after = Window.partitionBy(key, CHUNK).orderBy(F.desc(pos)).rowsBetween(Window.unboundedPreceding, 0)
    pt = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).alias("v"))) for c in cols}
    d = d.select("*", *[F.last(pt[c], True).over(upto).alias(f"_ip_{c}") for c in cols],
                 *[F.last(pt[c], True).over(after).alias(f"_in_{c}") for c in cols])
    summ = df.select(F.col(key).alias("_k"), chunk_of(pos, chunk_rows).alias("_c"),
                     *[pt[c].alias(f"_pt_{c}") for c in cols]) \
        .groupBy("_k", "_c").agg(*[F.max(f"_pt_{c}").alias(f"_hi_{c}") for c in cols],
                                  *[F.min(f"_pt_{c}").alias(f"_lo_{c}") for c in cols])
    cw = Window.partitionBy("_k").orderBy("_c")
    behind = Window.partitionBy("_k").orderBy(F.desc("_c"))
    summ = summ.select("_k", "_c",
                       *[F.last(f"_hi_{c}", True).over(cw.rowsBetween(Window.unboundedPreceding, -1))
                         .alias(f"_cp_{c}") for c in cols],
                       *[F.last(f"_lo_{c}", True).over(behind.rowsBetween(Window.unboundedPreceding, -1))
                         .alias(f"_cn_{c}") for c in cols])
    # equi-join on exactly (key, chunk): the rows keep the window's partitioning, only the summary moves
    summ = summ.withColumnRenamed("_k", key).withColumnRenamed("_c", CHUNK)
    j = d.join(summ, [key, CHUNK], "left")
    return j.select(*df.columns,
                    *[F.coalesce(F.col(f"_ip_{c}"), F.col(f"_cp_{c}")).alias(f"_prev_{c}") for c in cols],
                    *[F.coalesce(F.col(f"_in_{c}"), F.col(f"_cn_{c}")).alias(f"_next_{c}") for c in cols])


def attach_chunk_stats(df: DataFrame, stats: DataFrame, key: str, count_col: str, chunk_rows: int) -> DataFrame:
    """Join one-row-per-key statistics onto rows that carry ``_chunk`` and are partitioned by
    (key, chunk) (the output of a chunked window): the statistics are copied to one row per chunk of
    their key and joined on (key, chunk), so the rows are not shuffled again and no key is hot."""
    n_chunks = F.ceil(F.col(count_col) / F.lit(chunk_rows)).cast("long")
    per_chunk = stats.withColumn(CHUNK, F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)))
    return df.join(per_chunk, [key, CHUNK], "left")


def attach_key_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Join one-row-per-key statistics back onto the rows.  The stats side is an aggregate, so
    AQE sees its real size and broadcasts it when small; otherwise a sort-merge join whose
    hot-key partitions AQE's skew-join handling splits."""
    s = stats.withColumnRenamed(key, "_k")
    j = df.join(s, df[key].eqNullSafe(s["_k"]), "left")
    return j.drop("_k")
