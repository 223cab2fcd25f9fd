"""Label statistics (A2-A4, A13-A17, U2-U4, T2, T4): all partial aggregates over long (label, class) form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.functions import combo_key


def long_labels(df: DataFrame, labels, keep=()) -> DataFrame:
    """Unpivot label columns to (keep..., label, class)."""
    return df.select(*keep, F.explode(F.array(*[F.struct(F.lit(l).alias("label"), F.col(l).cast("int").alias("class"))
                                                for l in labels])).alias("_t")).select(*keep, "_t.*")


def scenario_modes(df: DataFrame, key: str, labels) -> DataFrame:
    """A2: per series, the most frequent class of every label, lowest on ties.  Counted per
    (series, label, class) first, so a hot series is split by partial aggregation."""
    cnt = long_labels(df, labels, [key]).where(F.col("class").isNotNull()).groupBy(key, "label", "class").count()
    best = cnt.groupBy(key, "label").agg(F.min(F.struct((-F.col("count")).alias("nc"), F.col("class").alias("c")))
                                         .alias("b"))
    return best.groupBy(key).pivot("label", list(labels)).agg(F.first("b.c"))


def class_counts(df: DataFrame, labels, by=()) -> DataFrame:
    """A3: (by..., label, class, n) sorted by class."""
    return long_labels(df, labels, list(by)).groupBy(*by, "label", "class") \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(*by, "label", "class")


def combo_counts(df: DataFrame, labels, sep: str = ",") -> DataFrame:
    """Counts of the combined label key."""
    return df.groupBy(combo_key(labels, sep).alias("combo")).agg(F.count(F.lit(1)).alias("n"))


def top_combos(df: DataFrame, labels, k: int = D.TOP_COMBOS) -> DataFrame:
    """T4: the k most frequent label combinations (key ascending on ties)."""
    return combo_counts(df, labels).orderBy(F.desc("n"), "combo").limit(k)


def diversity(df: DataFrame, labels, by=()) -> DataFrame:
    """Number of distinct classes per label and whether it exceeds one."""
    d = long_labels(df, labels, list(by)).where(F.col("class").isNotNull()) \
        .groupBy(*by, "label").agg(F.countDistinct("class").alias("n_classes"))
    return d.withColumn("diverse", F.col("n_classes") > 1)


def all_diverse(df: DataFrame, labels) -> bool:
    """A13 as a check: false if any label has a single class (one tiny aggregate row)."""
    return bool(diversity(df, labels).agg(F.bool_and("diverse").alias("ok")).first()["ok"])


def min_class_count(df: DataFrame, labels) -> DataFrame:
    """Per label the smallest class count."""
    return class_counts(df, labels).groupBy("label").agg(F.min("n").alias("min_n"))


def class_union(*frames: DataFrame) -> DataFrame:
    """Distinct (label, class) over several long-form frames."""
    out = frames[0].select("label", "class")
    for f in frames[1:]:
        out = out.unionByName(f.select("label", "class"))
    return out.distinct()
