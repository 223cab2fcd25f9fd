"""Fixed-length sequences cut from each series.

Sequences are produced in long form (key, seq_id, step, row...) by exploding each row into the
windows that contain it: no group holds more than one sequence, and no series is gathered
into one task.  ``to_arrays`` builds the tensor form (one row per sequence) with groups of
exactly ``seq_len`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.operators import keyed
from scenaria.operators.keyed import POS
from scenaria.operators.split import seeded_order
from scenaria.roles import Roles


def _with_length(df: DataFrame, roles: Roles, one_series: bool = False) -> DataFrame:
    base = keyed.ensure_position(df, roles.key, roles.order)
    n = df.groupBy(roles.key).agg(F.count(F.lit(1)).alias("_n"))
    if one_series:   # a single series: the length table is one row, broadcast by construction
        return base.join(F.broadcast(n), roles.key, "left")
    return keyed.attach_key_stats(base, n, roles.key)


def strided(df: DataFrame, roles: Roles, seq_len: int = D.SEQ_LEN, step: int = D.TRAIN_STEP,
            max_sequences: int | None = None, one_series: bool = False) -> DataFrame:
    """Windows starting at 0, step, 2*step, ... that fit entirely; label = last step.
    Series shorter than ``seq_len`` give none (P9)."""
    b = _with_length(df, roles, one_series)
    i = F.col(POS) - 1
    lo = F.greatest(F.ceil((i - seq_len + 1) / F.lit(step)), F.lit(0)).cast("long")
    hi = F.least(F.floor(i / F.lit(step)), F.floor((F.col("_n") - seq_len) / F.lit(step))).cast("long")
    out = b.where(F.col("_n") >= seq_len).withColumn("seq_id", F.explode(F.when(lo <= hi, F.sequence(lo, hi))))
    out = out.withColumn("step", (i - F.col("seq_id") * step).cast("long")).drop("_n")
    return cap_sequences(out, roles.key, max_sequences) if max_sequences else out


def even(df: DataFrame, roles: Roles, seq_len: int = D.SEQ_LEN, n_starts: int = D.EVAL_STARTS,
         max_per_series: int | None = None) -> DataFrame:
    """Up to ``n_starts`` evenly spaced starts trunc(linspace(0, m-1, min(m, n_starts))),
    m = n - seq_len + 1 (a single start 0 when m = 1).  Starts rise with their number, so the windows that hold a
    row are consecutive: their first and last number come from the inverse of the starts, moved by one where
    rounding asks for it.  A row is copied into its own windows alone (at most ceil(seq_len / spacing) + 1)."""
    b = _with_length(df, roles).where(F.col("_n") >= seq_len)
    m = F.expr(f"_n - {seq_len} + 1L")
    b = b.withColumn("_m", m).withColumn("_k", F.least("_m", F.lit(n_starts).cast("long"))).withColumn("_i", F.col(POS) - 1)
    step = "(cast(_m - 1 AS double) / cast(_k - 1 AS double))"

    def start(k: str) -> str:
        return f"CASE WHEN _k <= 1 THEN 0L WHEN {k} = _k - 1 THEN _m - 1 ELSE cast(floor({k} * {step}) AS bigint) END"

    b = b.withColumn("_g", F.expr(f"CASE WHEN _k <= 1 THEN 0L ELSE least(_k - 1, cast(floor(_i / {step}) AS bigint)) END"))
    b = b.withColumn("_h", F.expr(f"CASE WHEN _k <= 1 OR _i < {seq_len} THEN 0L ELSE least(_k - 1, cast(ceil((_i - {seq_len} + 1) / {step}) AS bigint)) END"))
    # the last start at most i is at _g - 1, _g or _g + 1; the first start behind i - seq_len is at _h - 1, _h or _h + 1
    last = f"CASE WHEN _g + 1 < _k AND {start('(_g + 1)')} <= _i THEN _g + 1 WHEN {start('_g')} <= _i THEN _g ELSE _g - 1 END"
    first = f"CASE WHEN _h > 0 AND {start('(_h - 1)')} > _i - {seq_len} THEN _h - 1 WHEN {start('_h')} > _i - {seq_len} THEN _h ELSE _h + 1 END"
    if max_per_series is not None:   # W11 per series
        last = f"least({last}, {max_per_series - 1}L)"
    b = b.withColumn("_first", F.expr(first)).withColumn("_last", F.expr(last))
    out = b.withColumn("seq_id", F.explode(F.expr("CASE WHEN _first <= _last THEN sequence(_first, _last) END")))
    return out.select(*[c for c in b.columns if c not in ("_n", "_m", "_k", "_i", "_g", "_h", "_first", "_last")], "seq_id",
                      F.expr(f"_i - ({start('seq_id')})").cast("long").alias("step"))


def random_subset(df: DataFrame, roles: Roles, seq_len: int = D.SEQ_LEN, n_samples: int = D.RANDOM_SEQUENCES,
                  seed: int = D.SEED) -> DataFrame:
    """``n_samples`` series drawn without replacement by a seeded hash, one window each at a
    seeded start in [0, n - seq_len]; series shorter than ``seq_len`` are skipped after the draw."""
    n = df.groupBy(roles.key).agg(F.count(F.lit(1)).alias("_n"))
    pick = n.orderBy(seeded_order(F.col(roles.key), seed), roles.key).limit(n_samples)
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}s"), F.col(roles.key).cast("string"))), 1, 8), 16, 10)
    pick = pick.where(F.col("_n") >= seq_len).select(
        roles.key, F.pmod(h.cast("long"), F.col("_n") - seq_len + 1).alias("_s"))
    base = keyed.ensure_position(df, roles.key, roles.order)
    j = base.join(pick, roles.key)
    i = F.col(POS) - 1
    out = j.where((i >= F.col("_s")) & (i < F.col("_s") + seq_len))
    return out.select(*base.columns, F.lit(0).cast("long").alias("seq_id"), (i - F.col("_s")).cast("long").alias("step"))


def last_step(seqs: DataFrame, seq_len: int = D.SEQ_LEN) -> DataFrame:
    """The last row of every sequence (its labels are the sequence's labels)."""
    return seqs.where(F.col("step") == seq_len - 1)


def cap_sequences(seqs: DataFrame, key: str, cap: int) -> DataFrame:
    """Keep the first ``cap`` sequences in (key, seq_id) order; the cap is a parameter and
    the ordering runs on the (key, seq_id) table, not the rows."""
    ids = seqs.select(key, "seq_id").distinct().orderBy(key, "seq_id").limit(cap)
    return seqs.join(ids, [key, "seq_id"], "left_semi")


def to_arrays(seqs: DataFrame, key: str, features, labels, seq_len: int) -> DataFrame:
    """Tensor form: one row per sequence, ``X`` array<array<float>> by step, labels of the last step."""
    g = seqs.groupBy(key, "seq_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("step"), F.array(*[F.col(c).cast("float") for c in features])
                                             .alias("x"), *[F.col(l).alias(l) for l in labels]))).alias("_s"))
    g = g.where(F.size("_s") == seq_len)
    return g.select(key, "seq_id", F.transform("_s", lambda t: t["x"]).alias("X"),
                    *[F.element_at("_s", -1)[l].alias(l) for l in labels])


def keyless(df: DataFrame, order: list[str], seq_len: int = D.SEQ_LEN, step: int = D.TRAIN_STEP) -> DataFrame:
    """Strided windows over the whole table in ``order`` (one global series)."""
    d = df.withColumn("_all", F.lit(0))
    r = Roles(key="_all", time=order[0], tie=order[1] if len(order) > 1 else None)
    return strided(d, r, seq_len, step, one_series=True).drop("_all")
