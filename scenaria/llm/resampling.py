"""Target-distribution importance resampling: draw the documents whose words look like a target's.

Features are runs of words, hashed by crc32 into buckets.  A bucket's gain is the logarithm of how much commoner it
is in the target than in the corpus; a document weighs the sum of its features' gains, and seeded Gumbel noise on
the weight makes the highest scores a sample without replacement.

CRCs are taken of distinct features only: those of equal length lie in one two-dimensional uint8 matrix, whose
columns update all its rows' CRCs at once, and the buckets are scattered back to the occurrences.  Rare long
features share a matrix by length class, flush right: zero bytes in front leave a zero CRC register as it is, and
the usual start of all ones is the same as flipping a feature's first four bytes.

Both passes read every document.  The corpus leaves one count a bucket, the target too; the driver sees these alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import Words, slices
from .common import free_names, ranked, written

#: Bytes of text handled together in a task.
SLICE = 1 << 22
#: Features up to this length share a matrix with those of their own length, longer ones with their length class.
EXACT = 64
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def crc_matrix(rows: np.ndarray, register: int) -> np.ndarray:
    """CRC registers of the rows of a uint8 matrix, column by column."""
    crc = np.full(len(rows), register, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _CRC[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of every feature, ``size`` bytes of ``data`` from ``start`` on."""
    out = np.zeros(len(start), np.uint32)
    if not len(start):
        return out
    classes = np.where(size <= EXACT, size, np.int64(1) << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    by = np.argsort(classes, kind="stable")
    lengths, first = np.unique(classes[by], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(by, first[1:]), strict=True):
        step = max(1, SLICE // max(length, 1))
        for i in range(0, len(rows), step):
            some = rows[i:i + step]
            if length <= EXACT:
                matrix = np.lib.stride_tricks.sliding_window_view(data, length)[start[some]] if length else np.zeros((len(some), 0), np.uint8)
                out[some] = crc_matrix(matrix, 0xFFFFFFFF)
                continue
            matrix = np.zeros((len(some), length), np.uint8)
            for row, s, n in zip(matrix, start[some].tolist(), size[some].tolist(), strict=True):
                row[length - n:] = data[s:s + n]
                row[length - n:length - n + 4] ^= 0xFF
            out[some] = crc_matrix(matrix, 0)
    return out


def buckets(words: Words, longest: int, n_buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every run length up to ``longest``: (bucket of each run, text by text; runs of each text)."""
    out = []
    for size in range(1, longest + 1):
        if size == 1:
            data, start, past = words.data, words.at[:-1], words.at[1:]
        else:
            data, start, past = words.runs(size)
        column = _column(data, start, past).dictionary_encode()
        distinct = column.dictionary
        at = np.frombuffer(distinct.buffers()[1], np.int64)[:len(distinct) + 1] if len(distinct) else np.zeros(1, np.int64)
        content = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.zeros(0, np.uint8)
        bucket = (crcs(content, at[:-1], np.diff(at)) % np.uint32(n_buckets)).astype(np.int64)
        out.append((bucket[column.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, np.int64),
                    np.maximum(np.diff(words.first) - size + 1, 0)))
    return out


def _column(data: np.ndarray, start: np.ndarray, past: np.ndarray) -> pa.Array:
    if len(start) and (start[1:] == past[:-1]).all() and start[0] == 0:
        at, content = np.r_[start, past[-1:]].astype(np.int64), data
    else:
        sizes = past - start
        at = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        content = data[np.arange(at[-1]) + np.repeat(start - at[:-1], sizes)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(content))])


def bucket_counts(texts: DataFrame, text_col: str, longest: int, n_buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts; the driver gets at most one row a bucket."""

    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for _, _, words in slices(b.column(0), SLICE):
                for found, _ in buckets(words, longest, n_buckets):
                    total += np.bincount(found, minlength=n_buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(n_buckets, np.int64)
    for r in texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket of B, S and T being the sums."""
    b, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((y + 1.0) * (s + b)) / ((x + 1.0) * (t + b))))
                     for x, y in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_col: Column, seed: int) -> Column:
    """Whole Gumbel noise, 1000 to the unit, of an id; a null id counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, target: DataFrame, text_col: str, target_text_col: str, longest: int = 1, n_buckets: int = 10_000) -> DataFrame:
    """``docs`` without ``text_col``, with ``n_words``, ``n_features`` and ``weight`` in place of columns called so."""
    names = ["n_words", "n_features", "weight"]
    gain = gains(bucket_counts(docs, text_col, longest, n_buckets), bucket_counts(target, target_text_col, longest, n_buckets))
    carried = [c for c in docs.columns if c != text_col and c not in names]
    src = docs.select(*carried, F.col(text_col))

    def run(batches):
        for b in batches:
            n = np.zeros((3, b.num_rows), np.int64)
            for first, past, words in slices(b.column(b.num_columns - 1), SLICE):
                n[0, first:past] = np.diff(words.first)
                for found, runs in buckets(words, longest, n_buckets):
                    ends = np.r_[0, np.cumsum(runs)]
                    sums = np.r_[0, np.cumsum(gain[found])]
                    n[1, first:past] += runs
                    n[2, first:past] += sums[ends[1:]] - sums[ends[:-1]]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *map(pa.array, n)], names=[*carried, *names])

    schema = src.select(*carried).schema
    for c in names:
        schema = schema.add(c, "long")
    return src.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_text_col: str, longest: int = 1,
             n_buckets: int = 10_000, share: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """The columns of ``docs`` but ``text_col``, with n_words, n_features, weight, score and rank (all long).

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII; features are runs of 1 to
    ``longest`` words of a text, repeats counted.  Of the N rows with at least ``least_words`` words the
    floor(share * N / 100) highest scores are drawn, ties to the smaller id: ``rank`` is 1, 2, 3 ... in that
    order, and null for rows that are not drawn.

    A null or empty text has no features and weighs 0.  A null id is hashed as an empty one and comes after
    all others among ties; rows that repeat an id share their noise, and tie in any order if their scores are
    equal.  An empty target leaves the corpus counts alone; an empty table gives an empty result.  Columns of
    ``docs`` that are called like an added one make room for it."""
    added = ["n_words", "n_features", "weight", "score", "rank"]
    docs = docs.select(*[c for c in docs.columns if c in (id_col, text_col) or c not in added])
    fit, place = free_names(docs.columns, "fit", "place")
    rows = weighed(docs, target, text_col, target_text_col, longest, n_buckets)
    rows = rows.withColumn("score", F.col("weight") + noise(F.col(id_col), seed)).withColumn(fit, F.col("n_words") >= least_words)
    rows = written(rows, "weighed")  # read by the count, the range bounds and the ranks
    drawn = rows.where(fit).count() * share // 100
    order = [F.col(fit).desc(), F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    return ranked(rows, order, place).withColumn("rank", F.when(F.col(place) <= drawn, F.col(place))).drop(fit, place)


def drawn_documents(docs: DataFrame, resampled: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id, which may be null, was drawn, whole."""
    (drawn,) = free_names(docs.columns, "drawn")
    ids = resampled.where("rank is not null").select(F.col(id_col).alias(drawn)).distinct()
    return docs.join(ids, F.col(id_col).eqNullSafe(F.col(drawn)), "left_semi")
