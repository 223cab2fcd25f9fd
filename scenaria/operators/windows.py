"""Per-series window features (rolling mean/std, EMA, difference, time since start,
time-to-failure progress) computed over chunked windows: see ``keyed``."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.functions import clip01
from scenaria.operators import keyed
from scenaria.operators.keyed import CHUNK, HALO, POS
from scenaria.roles import Roles

EXP = "_e"
EMA_CHUNK_ROWS = 2048   # (11/9)^2048 ~ 1e178: running weights stay finite for |x| < 1e130


def ema_reach(span: int) -> int:
    """Number of lags before a value after which another one weighs less than double precision (2^-53) beside it."""
    beta = 1.0 - 2.0 / (span + 1.0)
    return int(math.ceil(53 * math.log(2) / -math.log(beta)))


def ema_carry(base: DataFrame, key: str, cols, span: int, chunk_rows: int) -> DataFrame:
    """(key, chunk, _ema_<c>): for each chunk of a series the state left by the last earlier one that has a value:
    struct(p, v, w), the position of that value, the mean there and the weights' sum beside its own 1.

    The mean is the same at any distance behind its last value, so a gap of any length carries it unchanged.  A
    chunk's own state comes from its rows alone; chunks before it are added as far as they lie within
    ``ema_reach`` of it (one chunk, unless chunks are tiny)."""
    beta = 1.0 - 2.0 / (span + 1.0)
    own = base.withColumn(CHUNK, keyed.chunk_of(POS, chunk_rows))
    e = (F.col(POS) - F.col(CHUNK) * chunk_rows).cast("double")
    wgt = F.pow(F.lit(beta), -e)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.sum(wgt * x).alias(f"_n_{c}"), F.sum(F.when(x.isNotNull(), wgt)).alias(f"_d_{c}"),
                 F.max(F.when(x.isNotNull(), F.col(POS))).alias(f"_l_{c}")]
    ends = own.groupBy(key, CHUNK).agg(*aggs)
    at = {c: F.when(F.col(f"_l_{c}").isNotNull(), F.struct(
        F.col(f"_l_{c}").alias("p"), (F.col(f"_n_{c}") / F.col(f"_d_{c}")).alias("v"),
        (F.col(f"_d_{c}") * F.pow(F.lit(beta), (F.col(f"_l_{c}") - F.col(CHUNK) * chunk_rows).cast("double"))).alias("w"))) for c in cols}
    ends = ends.select(key, CHUNK, *[at[c].alias(f"_s_{c}") for c in cols])
    order = Window.partitionBy(key).orderBy(CHUNK)
    near = range(1, (ema_reach(span) - 1) // chunk_rows + 2)
    ends = ends.select("*", *[F.lag(f"_s_{c}", j).over(order).alias(f"_s{j}_{c}") for c in cols for j in near])
    state = {}
    for c in cols:
        mine = F.col(f"_s_{c}")
        w, wv = mine["w"], mine["w"] * mine["v"]
        for j in near:
            old = F.col(f"_s{j}_{c}")
            there = F.coalesce(old["w"] * F.pow(F.lit(beta), mine["p"] - old["p"]), F.lit(0.0))
            w, wv = w + there, wv + there * F.coalesce(old["v"], F.lit(0.0))
        state[c] = F.when(mine.isNotNull(), F.struct(mine["p"].alias("p"), (wv / w).alias("v"), w.alias("w")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(key, CHUNK, *[state[c].alias(f"_t_{c}") for c in cols]) \
        .select(key, CHUNK, *[F.last(f"_t_{c}", True).over(before).alias(f"_ema_{c}") for c in cols])


def ema_expr(col: str, running, span: int) -> Column:
    """Adjusted exponential mean sum beta^(t-j) x_j / sum beta^(t-j) over non-null x_j (decay by position across
    gaps), null before the first value.  Inside the chunk two running sums weighted beta^-e (e: the position
    inside the chunk; the beta^t factors cancel) give it in O(1) per row; what lies before the chunk comes in
    as the state carried from there."""
    beta = 1.0 - 2.0 / (span + 1.0)
    x = F.when(~F.col(HALO), F.col(col).cast("double"))
    wgt = F.pow(F.lit(beta), -F.col(EXP))
    num = F.coalesce(F.sum(F.when(x.isNotNull(), wgt * x)).over(running), F.lit(0.0))
    den = F.coalesce(F.sum(F.when(x.isNotNull(), wgt)).over(running), F.lit(0.0))
    now = F.pow(F.lit(beta), F.col(EXP))
    st = F.col(f"_ema_{col}")
    old = F.coalesce(st["w"] * F.pow(F.lit(beta), F.col(POS) - st["p"]), F.lit(0.0))
    both = (num * now + old * F.coalesce(st["v"], F.lit(0.0))) / (den * now + old)
    return F.when(den > 0, both).otherwise(st["v"])


def feature_exprs(roles: Roles, w, window: int = D.WINDOW, span: int = D.EMA_SPAN,
                  kinds=("rolling_mean", "rolling_std", "ema", "diff")) -> list[Column]:
    roll = w.rowsBetween(-(window - 1), 0)
    ema_frame = w.rowsBetween(Window.unboundedPreceding, 0)
    out = []
    for c in roles.features:
        x = F.col(c).cast("double")
        if "rolling_mean" in kinds:
            out.append(F.avg(x).over(roll).alias(f"{c}_rolling_mean_{window}"))
        if "rolling_std" in kinds:
            out.append(F.coalesce(F.stddev_samp(x).over(roll), F.lit(0.0)).alias(f"{c}_rolling_std_{window}"))
        if "ema" in kinds:
            out.append(ema_expr(c, ema_frame, span).alias(f"{c}_ema_{span}"))
        if "diff" in kinds:
            out.append(F.coalesce(x - F.lag(x).over(w), F.lit(0.0)).alias(f"{c}_diff"))
    return out


def series_stats(df: DataFrame, roles: Roles, ttf_label: str | None) -> DataFrame:
    """One row per series: row count, min/max time and (max label, last time at it).  Rows are first aggregated by
    (series, label), in a hash aggregate of plain numbers; only that small table meets the maximum of a struct."""
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.min(roles.time).alias("_t0"), F.max(roles.time).alias("_t1")]
    if not ttf_label:
        return df.groupBy(roles.key).agg(*aggs)
    per = df.groupBy(roles.key, F.col(ttf_label).alias("_lab")).agg(*aggs)
    return per.groupBy(roles.key).agg(F.sum("_cnt").alias("_cnt"), F.min("_t0").alias("_t0"), F.max("_t1").alias("_t1"),
                                      F.max(F.when(F.col("_lab").isNotNull(), F.struct(F.col("_lab").alias("l"), F.col("_t1").alias("t")))).alias("_mx"))


def engineer_features(df: DataFrame, roles: Roles, window: int = D.WINDOW, span: int = D.EMA_SPAN,
                      time_since_start: bool = True, ttf_label: str | None = None,
                      kinds=("rolling_mean", "rolling_std", "ema", "diff"),
                      chunk_rows: int = keyed.DEFAULT_CHUNK_ROWS, keep_pos: bool = False,
                      narrow: bool = False) -> DataFrame:
    """All window features in one select over one chunked window spec.
    ``ttf_label`` adds ``<component>_time_to_failure`` (null where undefined); ``narrow`` stores the
    engineered columns as float (P2), halving their shuffle and snapshot bytes."""
    if roles.features and kinds:
        base = keyed.ensure_position(df, roles.key, roles.order)
        halo = max(window - 1, 1)
        if "ema" in kinds:
            chunk_rows = min(chunk_rows, EMA_CHUNK_ROWS)
        ch = keyed.chunked(base, POS, chunk_rows, halo)
        # exponent base: position of the chunk's first halo row
        ch = ch.withColumn(EXP, (F.col(POS) - (F.col(CHUNK) * chunk_rows - halo + 1)).cast("double"))
        if "ema" in kinds:
            ch = ch.join(ema_carry(base, roles.key, roles.features, span, chunk_rows), [roles.key, CHUNK], "left")
        feats = feature_exprs(roles, keyed.chunk_window(roles.key), window, span, kinds)
        out = ch.select(*base.columns, CHUNK, HALO, *feats).where(~F.col(HALO)).drop(HALO)
    else:
        out = df
    if time_since_start or ttf_label:
        st = series_stats(df, roles, ttf_label)
        if CHUNK in out.columns:
            out = keyed.attach_chunk_stats(out, st, roles.key, "_cnt", chunk_rows)
        else:
            out = keyed.attach_key_stats(out, st, roles.key)
        extra = []
        if time_since_start:
            extra.append((F.col(roles.time) - F.col("_t0")).alias("time_since_start"))
        if ttf_label:
            extra.append(time_to_failure_expr(roles.time, ttf_label).alias(f"{Roles.component(ttf_label)}_time_to_failure"))
        keep = [c for c in out.columns if not c.startswith("_") or (keep_pos and c == POS)]
        out = out.select(*keep, *extra)
    else:
        out = out.drop(*[c for c in (CHUNK, "_e") if c in out.columns])
        if not keep_pos and POS in out.columns:
            out = out.drop(POS)
    if narrow:
        eng = [c for c in out.columns if c not in df.columns and not c.startswith("_")]
        out = out.select(*[F.col(c).cast("float").alias(c) if c in eng else F.col(c) for c in out.columns])
    return out


def time_to_failure_expr(time: str, label: str) -> Column:
    """1 - clip((t_max - Time) / range, 0, 1) where t_max is the last time at the series' maximum
    label; null when that maximum is 0 or the time range is 0."""
    rng = F.col("_t1") - F.col("_t0")
    ok = (F.col("_mx.l") > 0) & (rng > 0) & F.col("_mx.t").isNotNull()
    return F.when(ok, 1.0 - clip01((F.col("_mx.t") - F.col(time)) / rng))


def time_since_start(df: DataFrame, roles: Roles) -> DataFrame:
    st = df.groupBy(roles.key).agg(F.min(roles.time).alias("_t0"))
    j = keyed.attach_key_stats(df, st, roles.key)
    return j.withColumn("time_since_start", F.col(roles.time) - F.col("_t0")).drop("_t0")
