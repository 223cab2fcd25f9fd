"""Imputation and null audits (N1-N5, P6, A19), per series in time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenaria.functions import finite_or_zero
from scenaria.operators import keyed
from scenaria.operators.keyed import POS
from scenaria.roles import Roles


def _interp(c: str, hold_last: bool, back_fill: bool) -> Column:
    p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    x = F.col(c).cast("double")
    lin = p["v"] + (n["v"] - p["v"]) * (F.col(POS) - p["p"]) / (n["p"] - p["p"])
    out = F.when(x.isNotNull(), x).when(p.isNotNull() & n.isNotNull(), lin)
    if hold_last:
        out = out.when(p.isNotNull(), p["v"])        # trailing gap keeps the last value
    if back_fill:
        out = out.when(n.isNotNull(), n["v"])        # leading gap takes the first value
    return out


def interpolate(df: DataFrame, roles: Roles, cols=None, back_fill: bool = False,
                chunk_rows: int = keyed.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Linear by row position over interior gaps, trailing gap holds the last value, leading
    gap left null.  ``back_fill`` adds N2 (forward then backward fill of what is left)."""
    cols = list(cols if cols is not None else roles.features)
    base = keyed.ensure_position(df, roles.key, roles.order)
    filled = keyed.carried_fill(base, roles.key, cols, POS, chunk_rows)
    out = filled.select(*[_interp(c, True, back_fill).cast(dict(df.dtypes).get(c, "double")).alias(c)
                          if c in cols else F.col(c) for c in base.columns])
    return out if POS in df.columns else out.drop(POS)


def fill_forward_backward(df: DataFrame, roles: Roles, cols=None,
                          chunk_rows: int = keyed.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """N2 alone: forward fill, then backward fill inside each series."""
    cols = list(cols if cols is not None else roles.features)
    base = keyed.ensure_position(df, roles.key, roles.order)
    filled = keyed.carried_fill(base, roles.key, cols, POS, chunk_rows)
    out = filled.select(*[F.coalesce(F.col(c), F.col(f"_prev_{c}.v"), F.col(f"_next_{c}.v")).alias(c)
                          if c in cols else F.col(c) for c in base.columns])
    return out if POS in df.columns else out.drop(POS)


def column_modes(df: DataFrame, cols) -> DataFrame:
    """One row: the most frequent non-null value of each column, lowest on ties.  Counted per
    (column, value) with partial aggregation, so a dominant value costs nothing extra."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("long").alias("v"))
                                         for c in cols])).alias("t")).select("t.*").where(F.col("v").isNotNull())
    cnt = long.groupBy("col", "v").count()
    best = cnt.groupBy("col").agg(F.min(F.struct((-F.col("count")).alias("nc"), F.col("v").alias("v"))).alias("b"))
    return best.groupBy().pivot("col", list(cols)).agg(F.first("b.v"))


def mode_fill(df: DataFrame, cols) -> DataFrame:
    """Nulls of each label take the column's mode.  The modes are one aggregate row, read to the
    driver as fitted values (as Spark ML's Imputer does) and applied as literals."""
    cols = list(cols)
    row = column_modes(df, cols).first()
    types = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(row[c]).cast(types[c])).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def mean_fill(df: DataFrame, cols, stats: DataFrame | None = None) -> DataFrame:
    """Nulls (and NaN) of each feature take the column mean; ``stats`` (one row of ``_mean_<c>``)
    lets a mean fitted on the training rows be applied to other rows.  The fitted means are read to
    the driver and applied as literals."""
    cols = list(cols)
    row = (stats if stats is not None else mean_stats(df, cols)).first()
    return df.select(*[F.coalesce(F.when(~F.isnan(F.col(c)), F.col(c)), F.lit(row[f"_mean_{c}"])).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def mean_stats(df: DataFrame, cols) -> DataFrame:
    return df.agg(*[F.avg(F.when(~F.isnan(F.col(c)), F.col(c))).alias(f"_mean_{c}") for c in cols])


def nonfinite_to_zero(df: DataFrame, cols) -> DataFrame:
    """NaN, +Inf, -Inf (and null) become 0."""
    cols = set(cols)
    return df.select(*[finite_or_zero(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def null_audit(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, null_count) for every column, in one aggregate pass."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def missing(c):
        x = F.col(c)
        return x.isNull() | F.isnan(x) if types[c] in ("double", "float") else x.isNull()

    one = df.agg(*[F.count_if(missing(c)).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(f"`{c}`").cast("long").alias("null_count"))
                                          for c in cols])).alias("t")).select("t.*")


def null_total(df: DataFrame, cols=None) -> DataFrame:
    """One row with the frame-wide number of missing cells."""
    return null_audit(df, cols).agg(F.sum("null_count").cast("long").alias("null_total"))


def preprocess(df: DataFrame, roles: Roles, chunk_rows: int = keyed.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Reference preprocessing: NaN normalised to null at the boundary; features with a missing value
    interpolated, then forward/backward filled per series; labels with a missing value mode-filled.
    One aggregate pass finds which columns have gaps (as the reference checks each column first), so
    complete columns cost nothing."""
    types = dict(df.dtypes)
    df = df.select(*[F.when(~F.isnan(F.col(c)), F.col(c)).alias(c) if types[c] in ("double", "float") else F.col(c)
                     for c in df.columns])
    cols = list(roles.features) + list(roles.labels)
    if not cols:
        return df
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    feats = [c for c in roles.features if gaps[c]]
    labels = [c for c in roles.labels if gaps[c]]
    out = interpolate(df, roles, feats, back_fill=True, chunk_rows=chunk_rows) if feats else df
    return mode_fill(out, labels) if labels else out
