"""Training plan (the reference's second script): per-label tree models with grid search, a sequence
model per label, and blend weights searched on the validation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenaria.operators import ensemble, metrics, model
from scenaria.roles import Roles


def train(table: DataFrame, seqs: DataFrame, roles: Roles, seq_features, seq_len: int = 20,
          n_trees: int = 100, depths=(3, 5), cv: bool = True, out: str | None = None,
          balanced: DataFrame | None = None) -> dict:
    """``balanced``: the balanced training rows of the preparation (features, labels), which the trees learn from; the
    plain training rows if not given.  Validation accuracies come with the models."""
    key = roles.key
    labels = list(roles.labels)
    feats = list(roles.features)
    tr = table.where(F.col("split") == "train") if balanced is None else balanced
    if cv:
        trees, cv_tables = {}, {}
        for lab in labels:
            trees[lab], cv_tables[lab] = model.cross_validate(tr, feats, lab, depths=depths, n_trees=n_trees)
    else:
        trees = {lab: model.fit_per_label(tr, feats, [lab], max_depth=max(depths), n_trees=n_trees)[lab]
                 for lab in labels}
        cv_tables = {}
    flat = model.flatten_sequences(seqs, key, seq_features, labels, seq_len).join(
        seqs.select(key, "seq_id", "split").distinct(), [key, "seq_id"])
    seq_models = model.fit_sequence_model(flat.where(F.col("split") == "train"), labels,
                                          n_inputs=seq_len * len(seq_features))
    # blend weights on validation sequences: tree scores the last step, the sequence model the window
    val = flat.where(F.col("split") == "val")
    last = seqs.where((F.col("split") == "val") & (F.col("step") == seq_len - 1))
    t_probs = model.score(trees, last, feats, [key, "seq_id"])
    s_probs = model.score_sequences(seq_models, val, key)
    j = ensemble.align(t_probs, s_probs, [key, "seq_id", "label"])
    weights = ensemble.tuned_weight(j, 10)
    optimised = ensemble.tuned_weight(j, 20)
    v_rows = model.score(trees, table.where(F.col("split") == "val"), feats, roles.tie or roles.time)
    accuracy = metrics.accuracy(v_rows.select("model", "label", "y_true", "y_pred").unionByName(
        s_probs.select("model", "label", "y_true", "y_pred")))
    if out:
        model.save(trees, f"{out}/trees")
        model.save(seq_models, f"{out}/sequence")
        weights.write.mode("overwrite").parquet(f"{out}/weights")
        optimised.write.mode("overwrite").parquet(f"{out}/optimised_weights")
    return {"trees": trees, "sequence": seq_models, "weights": weights, "optimised": optimised, "cv": cv_tables,
            "validation": accuracy}
