"""Scenario-level stratified split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenaria import defaults as D

from scenaria.operators import keyed, stats

SPLITS = ("train", "val", "test")


def seeded_order(key: Column, seed: int = D.SEED) -> Column:
    """Deterministic pseudo-random order key, identical in Spark and SQL engines."""
    return F.md5(F.concat(F.lit(str(seed)), key.cast("string")))


def split_sizes(n: Column, test_size: float = D.TEST_SIZE, val_size: float = D.VAL_SIZE):
    """Per-class sizes: train = max(int(n*(1-test)), 1); val = max(int(rest*val), 1) if rest > 1 else 0;
    if no test remains and val > 1, one val goes to test."""
    train_frac = 1.0 - test_size
    n_train = F.greatest(F.floor(n * F.lit(train_frac)), F.lit(1)).cast("long")
    rest = n - n_train
    n_val0 = F.when(rest > 1, F.greatest(F.floor(rest * F.lit(val_size)), F.lit(1))).otherwise(0).cast("long")
    n_test0 = n - n_train - n_val0
    n_val = F.when((n_test0 == 0) & (n_val0 > 1), n_val0 - 1).otherwise(n_val0)
    return n_train, n_val


def scenario_split(df: DataFrame, key: str, primary: str, test_size: float = D.TEST_SIZE,
                   val_size: float = D.VAL_SIZE, seed: int = D.SEED, modes: DataFrame | None = None) -> DataFrame:
    """X1 stage 1: scenarios grouped by the modal class of ``primary``, shuffled by a seeded hash,
    cut into train/val/test per class.  Returns (key, split, cls, rank)."""
    if modes is None:
        modes = stats.scenario_modes(df, key, [primary])
    m = modes.select(key, F.col(primary).alias("cls"), seeded_order(F.col(key), seed).alias("_h"))
    ranked = keyed.with_position(m, "cls", ["_h", key], pos="rank")
    sizes = m.groupBy("cls").agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(sizes, "cls")
    n_train, n_val = split_sizes(F.col("_n"), test_size, val_size)
    split = F.when(F.col("rank") <= n_train, "train").when(F.col("rank") <= n_train + n_val, "val").otherwise("test")
    return j.select(key, split.alias("split"), "cls", "rank")


def rebalance(split: DataFrame, modes: DataFrame, key: str, labels, primary: str,
              n_classes: int = D.N_CLASSES) -> tuple[DataFrame, list[dict]]:
    """For each secondary label and class 0..n-1 missing from a split, move one scenario
    (train<-val,test; val<-train,test; test<-train,val; donor needs > 1; one move per (label, class)).
    Moves are decided by a fold over a bounded table on the driver: per (split, label, class)
    the count and the first scenarios in list order.  Each (label, class) moves at most one scenario, so one
    candidate more than there are (label, class) pairs suffices in every cell; labels outside 0..n-1 move
    none and stay in Spark.  Returns the new split table and the moves."""
    secondary = [l for l in labels if l != primary]
    per_cell = len(secondary) * n_classes + 1
    j = split.join(modes, key)
    lst = j.select(key, "split", "cls", "rank", *[F.col(l).cast("int").alias(l) for l in secondary])
    cnt = {(r["split"], r["label"], r["class"]): r["n"] for r in
           stats.long_labels(lst, secondary, ["split"]).groupBy("split", "label", "class").count()
           .withColumnRenamed("count", "n").where(F.col("class").between(0, n_classes - 1)).collect()}
    from pyspark.sql import Window
    cand = stats.long_labels(lst, secondary, [key, "split", "cls", "rank"]).where(F.col("class").between(0, n_classes - 1))
    w = Window.partitionBy("split", "label", "class").orderBy("cls", "rank")
    cand = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_cell)
    rows = cand.select(key).distinct().join(lst, key).collect()
    info = {r[key]: r.asDict() for r in rows}
    order = {s: sorted([r for r in info.values() if r["split"] == s], key=lambda r: (r["cls"], r["rank"]))
             for s in SPLITS}
    lists = {s: [r[key] for r in order[s]] for s in SPLITS}
    donors = {"train": ("val", "test"), "val": ("train", "test"), "test": ("train", "val")}
    moves = []
    for label in secondary:
        for c in range(n_classes):
            cur = {s: cnt.get((s, label, c), 0) for s in SPLITS}
            if sum(cur.values()) == 0 or all(cur[s] > 0 for s in SPLITS):
                continue
            for target in SPLITS:
                if cur[target] != 0:
                    continue
                done = False
                for d in donors[target]:
                    if cur[d] > 1:
                        for sid in lists[d]:
                            if info[sid][label] == c:
                                lists[d].remove(sid)
                                lists[target].append(sid)
                                for l2 in secondary:
                                    v = info[sid][l2]
                                    cnt[(d, l2, v)] = cnt.get((d, l2, v), 0) - 1
                                    cnt[(target, l2, v)] = cnt.get((target, l2, v), 0) + 1
                                info[sid]["split"] = target
                                moves.append({key: sid, "label": label, "class": c, "from": d, "to": target})
                                done = True
                                break
                        break  # the reference tries the first donor with > 1 only
                if done:
                    break
    spark = split.sparkSession
    if not moves:
        return split.select(key, "split"), moves
    last = {m[key]: m["to"] for m in moves}  # a scenario may move twice: its last place counts
    mv = spark.createDataFrame(list(last.items()), f"{key} {dict(split.dtypes)[key]}, _to string")
    out = split.join(mv, key, "left")
    return out.select(key, F.coalesce("_to", "split").alias("split")), moves


def assign(df: DataFrame, split: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Rows of the scenarios in a split (inner join carries ``split``)."""
    s = split.select(key, "split")
    if name:
        s = s.where(F.col("split") == name)
    return df.join(s, key)


def _class_rows(df: DataFrame, split: DataFrame, key: str, labels) -> DataFrame:
    """(split, label, class, n, key): rows are counted per (scenario, label, class) first, so only that small
    table meets the split and a hot scenario costs nothing."""
    counts = stats.long_labels(df, labels, [key]).groupBy(key, "label", "class").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(split.select(key, "split"), key)


def split_report(df: DataFrame, split: DataFrame, key: str, labels) -> DataFrame:
    """Rows per class and split."""
    return _class_rows(df, split, key, labels).groupBy("split", "label", "class").agg(F.sum("n").alias("n"))


def scenario_split_counts(modes: DataFrame, split: DataFrame, key: str, labels) -> DataFrame:
    """Scenarios per label, modal class and split."""
    lng = stats.long_labels(modes.join(split.select(key, "split"), key), labels, ["split"])
    return lng.where(F.col("class").isNotNull()).groupBy("label", "class", "split").agg(F.count(F.lit(1)).alias("n"))


def missing_classes(df: DataFrame, split: DataFrame, key: str, labels) -> DataFrame:
    """(label, class, split) where a class seen in some split is absent from this one: one
    aggregate collects the splits of each (label, class), ``array_except`` names the missing ones."""
    seen = (_class_rows(df, split, key, labels).where(F.col("class").isNotNull())
            .groupBy("label", "class").agg(F.collect_set("split").alias("_in")))
    allsp = F.array(*[F.lit(s) for s in SPLITS])
    return seen.select("label", "class", F.explode(F.array_except(allsp, F.col("_in"))).alias("split"))


def verify(df: DataFrame, split: DataFrame, key: str, labels) -> bool:
    """X4 as a check: every class of every label present in every split."""
    return missing_classes(df, split, key, labels).isEmpty()


def row_split(df: DataFrame, labels, id_col: str, test_size: float = D.TEST_SIZE, val_size: float = D.VAL_SIZE,
              seed: int = D.SEED) -> DataFrame:
    """Row-level split stratified by the combined label key, seeded hash order inside a stratum.
    Ranks come from range-partitioned positions, so a dominant stratum is not one task."""
    from scenaria.functions import combo_key
    s = df.select(id_col, combo_key(labels, "_").alias("_stratum"), seeded_order(F.col(id_col), seed).alias("_h"))
    ranked = keyed.with_position(s, "_stratum", ["_h", id_col], pos="_rank")
    sizes = s.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(sizes, "_stratum", "left")
    n_train = F.floor(F.col("_n") * F.lit(1.0 - test_size)).cast("long")
    n_val = F.floor((F.col("_n") - n_train) * F.lit(val_size)).cast("long")
    split = F.when(F.col("_rank") <= n_train, "train").when(F.col("_rank") <= n_train + n_val, "val").otherwise("test")
    return j.select(id_col, split.alias("split"))
