"""Quality by compression: two zstandard dictionaries, one built from good and one from bad labelled text.

A text is compressed in blocks with either dictionary.  The difference of the compressed sizes over the
text's size says which kind of text it resembles; a logistic model over that difference, the compressed
share itself (text that repeats itself shrinks with any dictionary) and the length turns it into a
calibrated score.  Half of the labelled sample builds the dictionaries, the other half fits the scale.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import label_sample, logistic, scored

BLOCK = 2048
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    trained: tuple[bool, bool]
    weights: list[float] | None
    prior: float


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def dictionary(texts: list[str], size: int) -> tuple[bytes, bool]:
    """A trained dictionary, or plain content where there are too few samples to train one."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(samples)[-size:], False


def compressors(model: Model):
    out = []
    for data, trained in zip((model.good, model.bad), model.trained, strict=True):
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d))
    return out


def features(text: str | None, good, bad) -> list[float]:
    parts = blocks(text)
    n = sum(map(len, parts))
    g = sum(len(good.compress(b)) for b in parts)
    b = sum(len(bad.compress(b)) for b in parts)
    return [max(-2.0, min(2.0, 20 * (b - g) / max(n, 1))), min(1.0, g / max(n, 1)), math.log1p(n), 1.0]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text",
        per_label: int = 4000, size: int = 112_640) -> Model:
    """Learn from at most ``per_label`` whole texts of either label, drawn by a hash of their ids.  Without labels of both kinds the model is their share."""
    rows, counts = label_sample(docs, labels, id_col, label_col, text_col, per_label)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    by = {k: [t for t, y in rows if y == k] for k in (0, 1)}
    if min(len(x) for x in by.values()) < 2:
        return Model(b"", b"", (False, False), None, prior)
    (good, a), (bad, b) = (dictionary(by[k][::2], size) for k in (1, 0))
    model = Model(good, bad, (a, b), None, prior)
    tools = compressors(model)
    x = np.array([features(t, *tools) for k in (0, 1) for t in by[k][1::2]])
    y = np.repeat([0, 1], [len(by[0][1::2]), len(by[1][1::2])])
    share = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    model.weights = logistic(x, y, share).tolist()
    return model


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, held_out, score, predicted) for every row, from its whole text alone; null and empty texts are
    scored as empty ones."""

    def score(batches):
        tools = compressors(model) if model.weights else None
        for texts in batches:
            if tools is None:
                yield [pa.array(np.full(len(texts), model.prior))]
                continue
            x = np.array([features(t.as_py(), *tools) for t in texts]).reshape(-1, 4)
            yield [pa.array(1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))))]

    return scored(docs, id_col, text_col, score, threshold)


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns; every row where no
    model could be fitted, for the labels' share says nothing about a text."""
    if not model.weights:
        return docs
    at = docs.columns.index(text_col)

    def run(batches):
        tools = compressors(model)
        for b in batches:
            x = np.array([features(t.as_py(), *tools) for t in b.column(at)]).reshape(-1, 4)
            good = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))) >= threshold
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
