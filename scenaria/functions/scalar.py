"""Scalar and array column helpers used across the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["clip01", "finite_or_zero", "argmax_first", "argmax_cols", "blend_cols", "blend", "renormalize", "truncate_renormalize",
           "one_hot", "combo_key", "combo_ints", "first_dot_key", "strip_csv", "ms_per_sample",
           "epoch_seconds", "even_starts", "nan_to_null"]


def clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def finite_or_zero(x: Column) -> Column:
    """NaN, +Inf, -Inf and null become 0."""
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0)).otherwise(x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def argmax_first(p: Column) -> Column:
    """0-based index of the largest element, the first one on ties."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def argmax_cols(cols) -> Column:
    """0-based index of the largest of some scalar columns, the first one on ties; nulls are passed over, and
    all null gives null."""
    cols = list(cols)
    top = F.greatest(*cols) if len(cols) > 1 else cols[0]
    out = F.when(cols[0] == top, 0)
    for i, c in enumerate(cols[1:], 1):
        out = out.when(c == top, i)
    return out.cast("int")


def blend_cols(p1: Column, p2: Column, w, n: int) -> list[Column]:
    """Element-wise weight * p1 + (1 - weight) * p2 of ``n`` elements, as scalars (null past a vector's end)."""
    w = w if isinstance(w, Column) else F.lit(float(w))
    return [w * F.get(p1, F.lit(i)) + (F.lit(1.0) - w) * F.get(p2, F.lit(i)) for i in range(n)]


def blend(p1: Column, p2: Column, w) -> Column:
    w = w if isinstance(w, Column) else F.lit(float(w))
    return F.zip_with(p1, p2, lambda a, b: w * a + (F.lit(1.0) - w) * b)


def renormalize(p: Column) -> Column:
    """Divided by the sum; a vector without mass stays as it is."""
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(p, lambda x: F.coalesce(F.try_divide(x, total), x))


def truncate_renormalize(p: Column, k) -> Column:
    k = k if isinstance(k, Column) else F.lit(int(k))
    return renormalize(F.slice(p, 1, k))


def one_hot(y: Column, n_classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda c: (c == y).cast("int"))


NULL_MARK = "null"


def combo_key(cols, sep: str = ",") -> Column:
    """Labels as one key; a null label keeps its place."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("int").cast("string"), F.lit(NULL_MARK)) for c in cols])


def combo_ints(key: Column, n: int, sep: str = ",") -> list[Column]:
    parts = F.split(key, sep)
    return [F.nullif(parts.getItem(i), F.lit(NULL_MARK)).cast("int") for i in range(n)]


def first_dot_key(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def strip_csv(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*)\.csv$", 1)


def ms_per_sample(total_s: Column, n: Column) -> Column:
    return total_s / n * 1000.0


def epoch_seconds(ts: Column, dtype: str) -> Column:
    """Seconds since 1970 as double.  TIMESTAMP is absolute; TIMESTAMP_NTZ is read as wall clock
    from its own fields (days, hours, minutes, exact decimal seconds), so no session time zone enters."""
    if dtype.startswith("timestamp_ntz"):
        whole = (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts).cast("long") * 3600
                 + F.minute(ts).cast("long") * 60)
        secs = F.expr(f"date_part('SECOND', {ts._jc.toString()})")       # decimal(8,6), exact micros
        return (whole.cast("decimal(20,6)") + secs).cast("double")
    return F.unix_micros(ts).cast("double") / 1e6


def even_starts(n: Column, seq_len: int, n_starts: int) -> Column:
    """trunc(linspace(0, m-1, min(m, n_starts))) with m = n - L + 1, as an int array."""
    m = n - F.lit(seq_len) + 1
    k = F.least(m, F.lit(n_starts))
    return F.when(m <= 1, F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), k - 1),
                    lambda i: F.when(i == k - 1, m - 1).otherwise(
                        F.floor(i * ((m - 1).cast("double") / (k - 1).cast("double"))).cast("int"))))
