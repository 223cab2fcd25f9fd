"""Preparation plan (the reference's first script): read -> clean -> window features -> scenario split
-> check -> balance the training rows -> sequences -> Parquet snapshots.

Every step is a DataFrame transformation; the only driver work is the bounded rebalancing fold and
one-row checks.  Snapshots are partitioned by split so later plans prune to the split they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria.operators import balance, clean, keyed, sequences, split as splitting, stats, windows
from scenaria import defaults as D
from scenaria.roles import Roles
from scenaria.session import cut_lineage
from scenaria.sources import io


@dataclass
class PrepareConfig:
    primary: str | None = None        # label that stratifies the split (R16: a parameter)
    seq_len: int = D.SEQ_LEN
    train_step: int = D.TRAIN_STEP
    eval_starts: int = D.EVAL_STARTS
    test_size: float = D.TEST_SIZE
    val_size: float = D.VAL_SIZE
    seed: int = D.SEED
    min_class_rows: int = D.MIN_CLASS_ROWS   # balance a label only below this class size
    balance_vectors: bool = True
    ttf: bool = True                  # <component>_time_to_failure of the first label (kept out of X)
    narrow: bool = True               # engineered columns stored as float (P2)


def prepare(df: DataFrame, roles: Roles, cfg: PrepareConfig = PrepareConfig(), out: str | None = None) -> dict:
    """Returns the tables of the preparation (and writes them under ``out`` when given)."""
    key = roles.key
    # positions once (range partitioned, checkpointed); cleaning, features and sequences reuse them
    base = keyed.with_position(df, key, roles.order)
    clean_df = clean.preprocess(base, roles)
    feats = windows.engineer_features(clean_df, roles, ttf_label=roles.labels[0] if cfg.ttf else None,
                                      keep_pos=True, narrow=cfg.narrow)
    feats = cut_lineage(feats)                       # the wide table is reused by every split
    primary = cfg.primary or roles.labels[-1]
    modes = cut_lineage(stats.scenario_modes(feats, key, list(roles.labels)))
    sp = splitting.scenario_split(feats, key, primary, cfg.test_size, cfg.val_size, cfg.seed, modes=modes.select(key, primary))
    sp, moves = splitting.rebalance(sp, modes, key, list(roles.labels), primary)
    sp = cut_lineage(sp)
    table = splitting.assign(feats, sp, key)
    missing = splitting.missing_classes(feats, sp, key, list(roles.labels))
    eng = [c for c in feats.columns if c not in (key, roles.tie, *roles.labels)
           and not c.endswith("_time_to_failure") and not c.startswith("_")]
    x_roles = Roles(key=key, time=roles.time, features=tuple(eng), labels=roles.labels, tie=roles.tie)
    train_rows = table.where(F.col("split") == "train")
    # balancing on the training rows: one feature vector per row, per label, then label combinations
    balanced = clean.mean_fill(train_rows, eng)          # N4 before balancing, as the reference
    plans = []
    if cfg.balance_vectors:
        vec = balanced.withColumn("_x", F.array(*[F.col(c).cast("double") for c in eng])) \
            .withColumn("_rid", F.monotonically_increasing_id())
        vec = cut_lineage(vec)
        for lab in roles.labels:
            mn = vec.groupBy(lab).count().agg(F.min("count")).first()[0]
            if mn is not None and mn < cfg.min_class_rows:
                vec, plan = balance.smote(vec.drop("synthetic") if "synthetic" in vec.columns else vec,
                                          "_rid", "_x", lab, k=D.SMOTE_K, seed=cfg.seed)
                vec = cut_lineage(vec.withColumn("_rid", F.coalesce("_rid", F.monotonically_increasing_id() + (1 << 40))))
                plans.append(plan.withColumn("label", F.lit(lab)))
        # stage 2: label combinations, when the rarest one has enough rows
        vec, _ran = balance.smote_combos(vec.drop("synthetic") if "synthetic" in vec.columns else vec,
                                         "_rid", "_x", list(roles.labels), k=D.SMOTE_K, seed=cfg.seed)
        # the models learn from the vector: a synthetic row's features are there
        balanced = vec.select(*[c for c in vec.columns if c not in (*eng, "_x", "_rid")],
                              *[F.get("_x", F.lit(i)).alias(c) for i, c in enumerate(eng)])
    seq_train = sequences.strided(train_rows, roles, cfg.seq_len, cfg.train_step)
    seq_val = sequences.even(table.where(F.col("split") == "val"), roles, cfg.seq_len, cfg.eval_starts)
    seq_test = sequences.even(table.where(F.col("split") == "test"), roles, cfg.seq_len, cfg.eval_starts)
    long = seq_train.withColumn("split", F.lit("train")).unionByName(seq_val.withColumn("split", F.lit("val"))) \
        .unionByName(seq_test.withColumn("split", F.lit("test")))
    result = {"features": feats, "split": sp, "moves": moves, "table": table, "missing": missing,
              "balanced": balanced, "balance_plans": plans, "sequences": long, "roles": x_roles}
    if out:
        io.write_snapshot(table, f"{out}/table")
        io.write_snapshot(long, f"{out}/sequences")
        sp.write.mode("overwrite").parquet(f"{out}/split")
        if cfg.balance_vectors:
            balanced.write.mode("overwrite").parquet(f"{out}/balanced")
    return result
