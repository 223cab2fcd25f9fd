"""Fitted tree ensembles as flat arrays, scored without node objects.

Every feature is cut once, for all trees of all labels, into the ranges between the thresholds that any tree asks for.
In a tree of at most 64 leaves each range of a feature leaves a set of leaves open, a bit mask known beforehand; the
masks of a row's ranges, one per feature of the tree, have the row's leaf as the lowest common bit (QuickScorer,
Lucchese et al., SIGIR 2015).  Larger trees are walked level by level.  Leaf votes are added in the order of the
trees, as Spark ML adds them, so classes and probabilities are those of ``transform``.

The rows stay in Spark: one Arrow function takes the feature columns and returns every label's class and
probabilities; all other columns pass it by.  The arrays are broadcast: their size is the model's.
"""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenaria.session import checkpoint_dir

STEP = 10_000
_known: WeakKeyDictionary = WeakKeyDictionary()


def trees_of(spark: SparkSession, fitted) -> list[list]:
    """The nodes of each tree, by id, from the model's stored form (its own size, whatever the data)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/scenaria-trees-{uuid.uuid4().hex}"
    fitted.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: list[list] = [[] for _ in range(fitted.getNumTrees if isinstance(fitted, RandomForestClassificationModel) else len(fitted.treeWeights))]
    for r in rows:
        trees[r.treeID].append(r)
    return trees


def _flat_tree(nodes: list, value) -> dict | None:
    """One tree: split feature and threshold of every node (-1: a leaf), its children, its leaves from left to
    right, ``value`` of each; None if a split is not a threshold."""
    at = {n.id: k for k, n in enumerate(nodes)}
    leaf = [n.leftChild < 0 for n in nodes]
    if any(not end and n.split.numCategories != -1 for n, end in zip(nodes, leaf, strict=True)):
        return None
    feature = np.array([-1 if end else n.split.featureIndex for n, end in zip(nodes, leaf, strict=True)])
    cut = np.array([0.0 if end else n.split.leftCategoriesOrThreshold[0] for n, end in zip(nodes, leaf, strict=True)])
    left = np.array([k if leaf[k] else at[n.leftChild] for k, n in enumerate(nodes)])
    right = np.array([k if leaf[k] else at[n.rightChild] for k, n in enumerate(nodes)])
    number, span = np.zeros(len(nodes), np.int64), [(0, 0)] * len(nodes)
    leaves: list[int] = []

    def visit(k: int) -> None:  # as deep as the tree, which Spark bounds by 30
        begin = len(leaves)
        if leaf[k]:
            number[k] = begin
            leaves.append(k)
        else:
            visit(left[k]), visit(right[k])
        span[k] = (begin, len(leaves))

    visit(0)
    return {"feature": feature, "cut": cut, "left": left, "right": right, "number": number, "span": span,
            "value": np.array([value(nodes[k]) for k in leaves], dtype=np.float64)}


def _share(node) -> list[float]:
    total = 0.0
    for x in node.impurityStats:
        total += x
    return [x / total if total else 0.0 for x in node.impurityStats]


def _ensemble(spark: SparkSession, fitted) -> dict | None:
    if fitted in _known:
        return _known[fitted]
    if isinstance(fitted, RandomForestClassificationModel):
        trees = [_flat_tree(t, _share) for t in trees_of(spark, fitted)]
        out = {"kind": "votes", "width": fitted.numClasses, "trees": trees}
    elif isinstance(fitted, GBTClassificationModel):
        weights = list(fitted.treeWeights)
        trees = [_flat_tree(t, lambda n, w=w: [n.prediction * w]) for t, w in zip(trees_of(spark, fitted), weights, strict=True)]
        out = {"kind": "margin", "width": 1, "trees": trees}
    else:
        return None
    _known[fitted] = out if all(t is not None for t in trees) else None
    return _known[fitted]


def _classes(stage) -> list[int]:
    """The class values that the last stage of a label's pipeline adds."""
    inside = stage.getStatement().split("array(", 1)[1].split(")", 1)[0]
    return [int(x) for x in inside.split(",")] if inside.strip() else []


class FlatModels:
    """The models of some labels, ready to score: ``column(df, features)`` is a struct of (y, p) per label."""

    def __init__(self, labels: dict[str, tuple[list[int], list[dict]]]):
        cuts: dict[int, set] = {}
        for _, models in labels.values():
            for tree in (t for m in models for t in m["trees"]):
                for f, c in zip(tree["feature"], tree["cut"], strict=True):
                    if f >= 0:
                        cuts.setdefault(int(f), set()).add(float(c))
        self.used = sorted(cuts)
        self.cuts = [np.array(sorted(cuts[f])) for f in self.used]
        place = {f: i for i, f in enumerate(self.used)}
        self.labels = [(lab, classes, [{"kind": m["kind"], "width": m["width"], "trees": [self._table(t, place) for t in m["trees"]]} for m in models])
                       for lab, (classes, models) in labels.items()]

    def _table(self, tree: dict, place: dict[int, int]) -> tuple:
        n = len(tree["value"])
        inner = np.flatnonzero(tree["feature"] >= 0)
        at = {int(k): (place[int(tree["feature"][k])], int(np.searchsorted(self.cuts[place[int(tree["feature"][k])]], tree["cut"][k]))) for k in inner}
        if n > 64:
            feature = np.array([at.get(k, (0, 0))[0] for k in range(len(tree["feature"]))])
            cut = np.array([at.get(k, (0, 0))[1] for k in range(len(tree["feature"]))])
            return "walk", (feature, cut, tree["left"], tree["right"], tree["number"]), tree["value"]
        kind = np.uint32 if n <= 32 else np.uint64
        masks: dict[int, np.ndarray] = {}
        for k, (f, c) in at.items():
            a, b = tree["span"][tree["left"][k]]
            lost = kind(((1 << (b - a)) - 1) << a)
            masks.setdefault(f, np.full(len(self.cuts[f]) + 1, np.iinfo(kind).max, kind))[c + 1:] &= ~lost
        return "masks", sorted(masks.items()), tree["value"]

    def column(self, spark: SparkSession, features: list[Column] | Column) -> Column:
        """Struct with a field per label, in their order: (y, p), class value and probabilities by class value."""
        sent, step = spark.sparkContext.broadcast((self.used, self.cuts, self.labels)), STEP
        one = isinstance(features, Column)

        def leaves(tree, bins):
            how, data, _ = tree
            if how == "masks":
                if not data:
                    return np.zeros(bins.shape[1], np.int64)
                m = data[0][1].take(bins[data[0][0]])
                for f, table in data[1:]:
                    m &= table.take(bins[f])
                return np.bitwise_count((m & (~m + m.dtype.type(1))) - m.dtype.type(1))
            feature, cut, left, right, number = data
            node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
            while True:
                below = np.where(bins[feature[node], rows] <= cut[node], left[node], right[node])
                if (below == node).all():
                    return number[node]
                node = below

        def total(model, bins):
            out = np.zeros((bins.shape[1], model["width"]))
            for tree in model["trees"]:
                out += tree[2].take(leaves(tree, bins), axis=0)
            return out

        def label(models, classes, bins):
            if len(models) == 1 and models[0]["kind"] == "votes":
                p = total(models[0], bins)
                best = p.argmax(axis=1)
                rows = p[:, 0].copy()
                for k in range(1, p.shape[1]):
                    rows += p[:, k]
                p /= rows[:, None]
            elif len(models) == 1:
                margin = total(models[0], bins)[:, 0]
                best = (margin > 0).astype(np.int64)
                first = 1 / (1 + np.exp(2 * margin))
                p = np.stack([first, 1 - first], axis=1)
            else:  # one booster per class
                p = np.stack([1 - 1 / (1 + np.exp(2 * total(m, bins)[:, 0])) for m in models], axis=1)
                rows = p[:, 0].copy()
                for k in range(1, p.shape[1]):
                    rows += p[:, k]
                p /= rows[:, None]
                best = p.argmax(axis=1)
            wide = np.zeros((len(p), max(classes) + 1))
            wide[:, classes] = p[:, :len(classes)]
            return np.array(classes, np.int32)[np.minimum(best, len(classes) - 1)], wide

        def run(*columns: pa.Array) -> pa.Array:
            used, cuts, labels = sent.value
            n = len(columns[0])
            if one:
                x = columns[0].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
                values = [x[:, f] for f in used]
            else:
                values = [columns[f].to_numpy(zero_copy_only=False) for f in used]
            found = [([], []) for _ in labels]
            for a in range(0, n, step):
                bins = np.empty((max(1, len(used)), min(step, n - a)), np.int64)
                for i, (v, c) in enumerate(zip(values, cuts, strict=True)):
                    bins[i] = np.searchsorted(c, v[a:a + step], side="left")
                for (y, p), (_, classes, models) in zip(found, labels, strict=True):
                    for out, part in zip((y, p), label(models, classes, bins), strict=True):
                        out.append(part)
            fields = []
            for (y, p), (_, classes, _) in zip(found, labels, strict=True):
                width = max(classes) + 1
                flat = np.concatenate([x.ravel() for x in p]) if p else np.zeros(0)
                fields.append(pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(y) if y else np.zeros(0, np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(flat))], names=["y", "p"]))
            return pa.StructArray.from_arrays(fields, names=[f"l{i}" for i in range(len(labels))])

        schema = "struct<" + ",".join(f"l{i}:struct<y:int,p:array<double>>" for i in range(len(self.labels))) + ">"
        udf = F.arrow_udf(run, schema)
        return udf(features) if one else udf(*features)


def flatten(spark: SparkSession, models: dict) -> FlatModels | None:
    """Flat form of the pipelines of ``fit_per_label``, ``cross_validate`` or a store; None if any holds another model."""
    out = {}
    for lab, m in models.items():
        if not isinstance(m, PipelineModel) or not hasattr(m.stages[-1], "getStatement"):
            return None
        parts = [_ensemble(spark, s) for s in m.stages[:-1]]
        if not parts or any(p is None for p in parts):
            return None
        classes = _classes(m.stages[-1])
        if not classes or min(classes) < 0 or len(parts) > 1 and any(p["kind"] != "margin" for p in parts):
            return None
        out[lab] = (classes, parts)
    return FlatModels(out) if out else None


def feature_columns(df: DataFrame, features) -> list[Column] | Column:
    """Numeric columns, or one array column, as doubles."""
    features = list(features)
    if len(features) == 1 and dict(df.dtypes)[features[0]].startswith("array"):
        return F.transform(features[0], lambda x: x.cast("double"))
    return [F.col(c).cast("double") for c in features]
