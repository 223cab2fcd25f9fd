"""Benchmark decontamination: find every window of the benchmark's words in the documents.

 1. Each task cuts the documents that it reads into shards of consecutive ones and writes an FM-index per shard:
    the words as numbers of the shard's own vocabulary, 0 after every document.
 2. The benchmark's distinct windows are searched for in every shard, backwards through wavelet-tree ranks; their
    occurrences are located by sampled suffix positions.
 3. Occurrences are merged into spans of each document.

A benchmark of any size is searched for in blocks of at most about ``BLOCK`` words, one after another, each of
which is small enough to be sent to every task; what the blocks found of a document comes together by its place in
the shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Words, slices, text_bytes
from .common import free_names, written
from .wordindex import WordIndex

#: Bytes of text of a shard (a longer document is a shard of its own).
SHARD = 1 << 23
#: Words of the benchmark searched for at once.
BLOCK = 1 << 20
#: Words of a piece of a benchmark item; longer items are dealt to blocks by piece.
PIECE = 1 << 14


def build_index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(shard, ids, ends, vocabulary, index): the FM-index of consecutive documents; ``ends`` are the places of the
    zeros after each, ``vocabulary`` the words by number, from 1 on."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    kind = src.schema["id"].dataType

    def run(batches):
        number = 0
        for b in batches:
            ids, part = b.column(0), b.column(2)[0].as_py() if b.num_rows else 0
            for first, past, words in slices(b.column(1), SHARD):
                codes, vocabulary = words.encoded()
                sizes = np.diff(words.first)
                ends = np.cumsum(sizes + 1) - 1
                text = np.zeros(len(codes) + len(sizes), np.int64)
                text[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)] = codes + 1
                one = lambda x: pa.array([x])
                yield pa.RecordBatch.from_arrays(
                    [one(part << 32 | number), pa.ListArray.from_arrays([0, past - first], ids[first:past]),
                     pa.ListArray.from_arrays([0, len(ends)], pa.array(ends)),
                     pa.ListArray.from_arrays([0, len(vocabulary)], vocabulary), pa.array([WordIndex(text).to_bytes()], pa.binary())],
                    names=["shard", "ids", "ends", "vocabulary", "index"])
                number += 1

    return src.mapInArrow(run, f"shard long, ids array<{kind.simpleString()}>, ends array<long>, vocabulary array<binary>, index binary")


class Phrases:
    """Distinct windows of some benchmark items: a matrix of word numbers for each size, and who has them."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        column = pa.array([t for _, t in items], pa.string())
        words = Words(*text_bytes(column))
        codes, self.vocabulary = words.encoded()
        sizes = np.diff(words.first)
        names = {s: i for i, s in enumerate(sorted({s for s, _ in items}))}
        self.names = list(names)
        owner = np.array([names[s] for s, _ in items], np.int64)
        self.groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (windows, bounds of owners, owners)
        for size in sorted({min(int(n), window) for n in sizes} - {0}):
            mine = sizes >= window if size == window else sizes == size
            room = np.where(mine, sizes - size + 1, 0)
            start = np.arange(room.sum()) + np.repeat(words.first[:-1] - (np.cumsum(room) - room), room)
            matrix, which = np.unique(codes.astype(np.int32)[start[:, None] + np.arange(size)], axis=0, return_inverse=True)
            pairs = np.unique(np.c_[which.ravel(), np.repeat(owner, room)], axis=0)
            self.groups.append((matrix, np.searchsorted(pairs[:, 0], np.arange(len(matrix) + 1)), pairs[:, 1]))


def phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int):
    """The benchmark's windows in blocks of bounded size, one after another: long items are cut into pieces that
    overlap by a window less a word, and pieces are dealt to blocks by a hash."""

    def run(batches):
        for b in batches:
            names, pieces, sizes = [], [], []
            for i in range(b.num_rows):
                words = Words(*text_bytes(b.column(1).slice(i, 1)))
                n = len(words)
                for at in range(0, max(n - window, 0) + 1 if n else 0, PIECE):
                    past = min(n, at + PIECE + window - 1)
                    size = np.diff(words.at[at:past + 1])
                    spaced = np.full(size.sum() + past - at, 0x20, np.uint8)
                    spaced[np.arange(size.sum()) + np.repeat(np.arange(past - at), size)] = words.data[words.at[at]:words.at[past]]
                    names.append(b.column(0)[i].as_py()), pieces.append(spaced.tobytes()), sizes.append(past - at)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(pieces, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64())],
                                             names=["name", "piece", "n"])

    src = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).alias("text"))
    pieces = written(src.mapInArrow(run, "name string, piece string, n long"), "phrases").dropDuplicates(["name", "piece"])
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    for k in range(blocks):
        rows = pieces.where(F.pmod(F.xxhash64("name", "piece"), F.lit(blocks)) == k).select("name", "piece").collect()
        if rows or not k:
            yield Phrases([(r[0], r[1]) for r in rows], window)


def search_shard(index: WordIndex, vocabulary: pa.Array, ends: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(marks that cover the shard's words, (document, number of an item's name) pairs)."""
    cover, pairs = np.zeros(index.n + 1, np.int64), [np.zeros((0, 2), np.int64)]
    known = pc.index_in(phrases.vocabulary, value_set=vocabulary)
    number = known.fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64) + 1  # -1: not in this shard
    for matrix, bounds, owners in phrases.groups:
        low, high = index.search(number[matrix])
        times = high - low
        hit = np.flatnonzero(times)
        if not len(hit):
            continue
        which = np.repeat(hit, times[hit])
        rows = np.arange(len(which)) + np.repeat(low[hit] - (np.cumsum(times[hit]) - times[hit]), times[hit])
        at = index.locate(rows)
        cover[:-1] += np.bincount(at, minlength=index.n)
        cover -= np.bincount(at + matrix.shape[1], minlength=index.n + 1)
        found = np.unique(np.searchsorted(ends, at) * len(matrix) + which)
        doc, which = found // len(matrix), found % len(matrix)
        n = (bounds[1:] - bounds[:-1])[which]
        mine = owners[np.arange(n.sum()) + np.repeat(bounds[which] - (np.cumsum(n) - n), n)]
        pairs.append(np.unique(np.c_[np.repeat(doc, n), mine], axis=0))
    return np.cumsum(cover[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


FOUND = "shard long, doc int, id {}, n_words long, spans array<int>, items array<string>"


def _search(index: DataFrame, phrases: Phrases) -> DataFrame:
    """A row per document: its spans of hit words (from, past the last, ...) and the items they come from."""
    sent = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard, ids, ends, vocabulary, data = (b.column(k)[i] for k in range(5))
                ends = ends.values.to_numpy(zero_copy_only=False)
                hit, pairs = search_shard(WordIndex.from_bytes(data.as_buffer()), vocabulary.values, ends, sent.value)
                begin = np.r_[0, ends[:-1] + 1]
                edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))  # zeros part the documents
                first, past = edge[::2], edge[1::2]
                doc = np.searchsorted(ends, first)
                spans = np.c_[first - begin[doc], past - begin[doc]].astype(np.int32).ravel()
                names = pa.array([sent.value.names[k] for k in pairs[:, 1].tolist()], pa.string())
                docs = np.arange(len(ends) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), shard.as_py(), np.int64)), pa.array(np.arange(len(ends)), pa.int32()), ids.values, pa.array(ends - begin),
                     pa.ListArray.from_arrays(pa.array(2 * np.searchsorted(doc, docs), pa.int32()), pa.array(spans)),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], docs), pa.int32()), names)],
                    names=["shard", "doc", "id", "n_words", "spans", "items"])

    return index.mapInArrow(run, FOUND.format(index.schema["ids"].dataType.elementType.simpleString()))


def _merged(found: DataFrame) -> DataFrame:
    """One row per document of the rows that several blocks gave."""
    some = found.where(F.size("spans") > 0).groupBy("shard", "doc").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def run(batches):
        for b in batches:
            spans = []
            for s in b.column(4):
                s = s.values.to_numpy(zero_copy_only=False).reshape(-1, 2) if s.is_valid else np.zeros((0, 2), np.int32)
                s = s[np.argsort(s[:, 0], kind="stable")]
                reach = np.maximum.accumulate(s[:, 1]) if len(s) else s[:, 1]
                new = np.flatnonzero(np.r_[True, s[1:, 0] > reach[:-1]]) if len(s) else np.zeros(0, np.int64)
                spans.append(np.c_[s[new, 0], reach[np.r_[new[1:] - 1, len(s) - 1]] if len(s) else s[new, 1]].ravel())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(spans, pa.list_(pa.int32())), b.column(5)], names=b.schema.names)

    every = found.groupBy("shard", "doc").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words")).join(some, ["shard", "doc"], "left")
    every = every.select("shard", "doc", "id", "n_words", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return every.mapInArrow(run, found.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int = 10) -> DataFrame:
    """(id, n_words, n_hit, spans, items) of every row of ``docs``: its words, those inside an occurrence of a
    window, the merged spans of these (first word, word past the last, one after another), and the sorted ids of the
    items whose windows occur.

    Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII.  A window is ``window``
    consecutive words of an item; an item of fewer words, but not none, is one window.  Item ids are compared
    as texts, a null one being the empty text; rows that repeat an item's id are one item with the windows of
    all of them, and one without words has none.  Null and empty texts have no words; rows of ``docs`` that
    repeat an id each have a row of their own, and null ids stay null.  An empty benchmark hits nothing, an
    empty table gives an empty result."""
    if window < 1:
        raise ValueError("a window has a word at least")
    index = written(build_index(docs, id_col, text_col), "index")
    found = [_search(index, p) for p in phrase_blocks(benchmark, item_col, item_text_col, window)]
    if len(found) > 1:
        union = found[0]
        for f in found[1:]:
            union = union.unionByName(f)
        found = [_merged(written(union, "found"))]
    odd = F.filter("spans", lambda x, i: i % 2 == 1)
    even = F.filter("spans", lambda x, i: i % 2 == 0)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return found[0].select("id", "n_words", (total(odd) - total(even)).alias("n_hit"), "spans", "items")


def decontaminated(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` without those whose id, which may be null, has a hit."""
    (gone,) = free_names(docs.columns, "gone")
    return docs.join(found.where("n_hit > 0").select(F.col("id").alias(gone)).distinct(), F.col(id_col).eqNullSafe(F.col(gone)), "left_anti")
