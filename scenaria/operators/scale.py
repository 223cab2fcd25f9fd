"""Normalisation statistics and encodings for sequence inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.functions import finite_or_zero, one_hot

EPS = D.STD_EPS


def fit_scaler(long_seqs: DataFrame, features) -> DataFrame:
    """One row with mean and population std + 1e-8 of each feature over all rows x steps
    (nulls ignored, so only missing cells are affected later)."""
    aggs = []
    for c in features:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.avg(x).alias(f"_mean_{c}"), (F.stddev_pop(x) + F.lit(EPS)).alias(f"_std_{c}")]
    return long_seqs.agg(*aggs)


def scaler_table(scaler: DataFrame, features) -> DataFrame:
    """The fitted scaler as (feature, mean, std) rows."""
    return scaler.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_mean_{c}").alias("mean"),
                                                      F.col(f"_std_{c}").alias("std")) for c in features]))
                         .alias("t")).select("t.*")


def standardize(df: DataFrame, features, scaler: DataFrame) -> DataFrame:
    """F11 + N5: (x - mean) / std, then NaN/Inf/null to 0.  The fitted scaler is one row, read to the
    driver and applied as literals (as a fitted Spark ML scaler holds its statistics)."""
    feats = set(features)
    row = scaler.first()

    def z(c):
        m, sd = row[f"_mean_{c}"], row[f"_std_{c}"]
        if m is None or sd is None:
            return F.lit(0.0)
        return finite_or_zero((F.col(c) - F.lit(m)) / F.lit(sd))

    return df.select(*[z(c).alias(c) if c in feats else F.col(c) for c in df.columns])


def one_hot_long(df: DataFrame, label: str, n_classes: int, keep=()) -> DataFrame:
    """F12 in long form: (keep..., class, hot)."""
    return df.select(*keep, F.posexplode(one_hot(F.col(label), n_classes)).alias("class", "hot"))
