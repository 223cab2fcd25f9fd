"""Passages that an earlier document has: FM-indexes over what documents may share.

A window of 50 words is identified by its anchor, the least hash among its runs of 10 words; equal windows
have equal anchors.  Windows that lie side by side and share an anchor form a segment of at
most 91 words, and only segments whose anchor occurs in two documents can hold a shared window.

 1. Anchors are counted per document; those of two documents or more go into a filter of fixed size.
 2. Documents are read again for the segments of such anchors; equal segments collapse to their least id.
 3. The document of that id gives the segment's words.  Segments are dealt to shards by anchor, so a window's
    occurrences meet in one shard.  Each shard builds an FM-index over its segments and streams them through
    it: backward search gives matching statistics, and where these reach 50 words, the least id among the
    suffixes of the interval.
 4. Every occurrence of a segment takes the runs of windows with a smaller id than its own, and documents
    drop the words these cover.

An anchor with more than ``WIDE`` different segments (a large group of near copies) would make a large shard:
its windows are compared by 128-bit hashes in an aggregation instead.  The filters only save work: what they
let through by chance is sorted out by exact keys later.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BloomFilter, bit_table, written
from .fmindex import FMIndex

RUN = 10
WIDE = 512
SHARD_WORDS = 300_000
LAST = 2 ** 63 - 1
_ODD = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((_ODD, pow(_ODD, -1, 2 ** 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of every word of a text, all at once."""
    byte = np.frombuffer(data, dtype=np.uint8)
    edge = np.diff(np.r_[True, _SPACE[byte], True].astype(np.int8))
    start, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    up, down = powers(len(byte) + 1)
    sums = np.zeros(len(byte) + 1, np.uint64)
    np.cumsum((byte.astype(np.uint64) + np.uint64(1)) * up[:len(byte)], out=sums[1:])
    return start, end, _mix((sums[end] - sums[start]) * down[start])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width`` values."""
    n = len(values)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[:n] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word past the last, anchor) of every segment of a text; one of more windows than an anchor
    has places is cut."""
    n, width = len(hashes), window - RUN + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])
    anchor = least_of(_mix((sums[RUN:] - sums[:-RUN]) * down[:n - RUN + 1]), width)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[first, len(anchor)])
    pieces = -(-size // width)
    again = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + again * width
    past = np.r_[first[1:], len(anchor)] + window - 1
    return first, past, anchor[first]


def two_longs(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text, hash): a null id comes last."""
    return docs.select(F.coalesce(F.col(id_col), F.lit(LAST)).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"))


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """(anchor) of at least two documents."""

    def run(batches):
        for b in batches:
            ids, found = b.column(0).to_numpy(zero_copy_only=False), []
            for t in b.column(1):
                found.append(np.unique(segments(hashed_words(raw(t.as_py()))[2], window)[2]).view(np.int64))
            sizes = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.int64)])), pa.array(np.repeat(ids, sizes))],
                                             names=["anchor", "doc"])

    rows = docs.select("doc", "text").mapInArrow(run, "anchor long, doc long")
    return rows.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor")


def _occurrences(docs: DataFrame, window: int, shared: BloomFilter) -> DataFrame:
    """(doc, hash, anchor, s1, s2, starts) of each document's segments whose anchor may be shared."""

    def run(batches):
        test = shared.tester()
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for i, t in enumerate(b.column(1)):
                h = hashed_words(raw(t.as_py()))[2]
                first, past, anchor = segments(h, window)
                mine: dict[bytes, tuple[int, list[int]]] = {}
                for k in np.flatnonzero(test(anchor)):
                    key = xxhash.xxh3_128_digest(h[first[k]:past[k]].tobytes())
                    mine.setdefault(key, (int(anchor.view(np.int64)[k]), []))[1].append(int(first[k]))
                out[0] += [i] * len(mine)
                out[1] += [a for a, _ in mine.values()]
                out[2] += mine.keys()
                out[3] += [np.array(s, "<i4").tobytes() for _, s in mine.values()]
            take = pa.array(out[0], pa.int64())
            s1, s2 = two_longs(out[2])
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(2).take(take), pa.array(out[1], pa.int64()), pa.array(s1), pa.array(s2),
                                              pa.array(out[3], pa.binary())], names=["doc", "hash", "anchor", "s1", "s2", "starts"])

    return docs.mapInArrow(run, "doc long, hash long, anchor long, s1 long, s2 long, starts binary")


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64).view(np.uint64) * np.uint64(_ODD) ^ b.astype(np.int64).view(np.uint64)


def _contents(docs: DataFrame, window: int, shared: BloomFilter, chosen: BloomFilter, wide: BloomFilter, shards: int) -> DataFrame:
    """(wide, shard, s1, s2, doc, words): the words of each segment, from the document of the least id that has it (by
    chance from others, too)."""

    def run(batches):
        is_shared, is_chosen, is_wide = shared.tester(), chosen.tester(), wide.tester()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            rows: list[list] = [[] for _ in range(5)]
            for d, t in zip(ids, b.column(1), strict=True):
                data = raw(t.as_py())
                start, end, h = hashed_words(data)
                first, past, anchor = segments(h, window)
                some = np.flatnonzero(is_shared(anchor))
                if not some.size:
                    continue
                keys = [xxhash.xxh3_128_digest(h[first[k]:past[k]].tobytes()) for k in some]
                s1 = two_longs(keys)[0]
                seen = set()
                flag = is_wide(anchor[some])
                for j in np.flatnonzero(is_chosen(_pair(s1, np.full(len(s1), d)))):
                    if keys[j] not in seen:
                        seen.add(keys[j])
                        k = some[j]
                        for r, x in zip(rows, (bool(flag[j]), int(anchor[k] % np.uint64(shards)), keys[j], int(d),
                                               b" ".join(data[start[first[k]]:end[past[k] - 1]].split())), strict=True):
                            r.append(x)
            s1, s2 = two_longs(rows[2])
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.bool_()), pa.array(rows[1], pa.int32()), pa.array(s1), pa.array(s2),
                                              pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.binary())],
                                             names=["wide", "shard", "s1", "s2", "doc", "words"])

    return docs.select("doc", "text").mapInArrow(run, "wide boolean, shard int, s1 long, s2 long, doc long, words binary")


def runs(least: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(first window, windows, least id) of the runs of windows with one least id; LAST: no document."""
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    size = np.diff(np.r_[first, len(least)])
    use = least[first] < LAST
    return first[use].tolist(), size[use].tolist(), least[first][use].tolist()


FOUND = "s1 long, s2 long, first array<int>, windows array<int>, least array<long>"


def _found(rows) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["s1", "s2", "first", "windows", "least"])


def search_shard(texts: list[bytes], docs: np.ndarray, window: int) -> list[np.ndarray]:
    """The least document id of every window of every text among all the texts, by streaming them through one
    FM-index."""
    number: dict[bytes, int] = {}
    coded = [np.array([number.setdefault(w, len(number) + 1) for w in t.split(b" ")], dtype=np.int64) for t in texts]
    sizes = np.array([len(c) + 1 for c in coded])
    whole = np.concatenate([x for c in coded for x in (c, np.zeros(1, np.int64))])  # 0 parts the texts
    index = FMIndex(whole, window)
    owner = np.repeat(docs, sizes)[index.order]
    least = np.minimum.reduceat(owner, index.starts)
    out = []
    for length, row in index.matching_statistics(coded):
        hit = length[:len(length) - window + 1] >= window
        out.append(np.where(hit, least[index.group[np.maximum(row[:len(hit)], 0)]], LAST))
    return out


def _by_index(contents: DataFrame, window: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        s1, s2, ids = (table.column(c).to_numpy() for c in ("s1", "s2", "doc"))
        by = np.lexsort((ids, s2, s1))  # the least id of a segment first
        by = by[np.r_[True, (s1[by][1:] != s1[by][:-1]) | (s2[by][1:] != s2[by][:-1])]]
        words = table.column("words").to_pylist()
        found = search_shard([words[i] for i in by], ids[by], window)
        return _found([(s1[i], s2[i], *runs(x)) for i, x in zip(by, found, strict=True)])

    return contents.groupBy("shard").applyInArrow(run, FOUND)


def _by_hash(contents: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for s1, s2, d, words in zip(*(b.column(c).to_pylist() for c in ("s1", "s2", "doc", "words")), strict=True):
                h = hashed_words(words)[2]
                n = len(h) - window + 1
                w1, w2 = two_longs([xxhash.xxh3_128_digest(h[i:i + window].tobytes()) for i in range(n)])
                yield pa.RecordBatch.from_arrays([pa.array([x] * n, pa.int64()) for x in (s1, s2, d)] + [pa.array(range(n), pa.int32()), pa.array(w1), pa.array(w2)],
                                                 names=["s1", "s2", "doc", "i", "w1", "w2"])

    rows = written(contents.mapInArrow(run, "s1 long, s2 long, doc long, i int, w1 long, w2 long"), "windows")
    least = rows.groupBy("w1", "w2").agg(F.min("doc").alias("least"))
    per = rows.join(least, ["w1", "w2"]).groupBy("s1", "s2").agg(F.array_sort(F.collect_set(F.struct("i", "least"))).alias("x"))

    def collapse(batches):
        for b in batches:
            out = []
            for s1, s2, least in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out.append((s1, s2, *runs(np.array(least, dtype=np.int64))))
            yield from _found(out).combine_chunks().to_batches()

    return per.select("s1", "s2", "x.least").mapInArrow(collapse, FOUND)


def _covered(occurrences: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(doc, hash, words): ranges of words (from, past the last) of each document that an earlier one has."""

    def run(batches):
        for b in batches:
            ids, hashes, spans = [], [], []
            for d, h, starts, first, windows, least in zip(*(c.to_pylist() for c in b.columns), strict=True):
                use = [(f, f + n - 1 + window) for f, n, m in zip(first, windows, least, strict=True) if m < d]
                if use:
                    at = np.frombuffer(starts, "<i4").astype(np.int64)
                    spans.append((at[:, None, None] + np.array(use)[None, :, :]).reshape(-1, 2).astype("<i4").tobytes())
                    ids.append(d), hashes.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(spans, pa.binary())],
                                             names=["doc", "hash", "words"])

    met = occurrences.join(found, ["s1", "s2"]).select("doc", "hash", "starts", "first", "windows", "least")
    return met.mapInArrow(run, "doc long, hash long, words binary").groupBy("doc", "hash").agg(F.collect_list("words").alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, window: int = 50) -> DataFrame:
    """(id, n_words, n_removed, kept): every row's number of words (runs of anything but ASCII white space), of words
    covered by a window that also starts in a row with a smaller id, and the other words joined by spaces.

    Windows are judged on the input.  Ids are longs; a null id comes after all others; rows of equal id are
    not earlier than each other.  A null or empty text, or one shorter than a window, keeps all it has.  An
    empty table gives an empty result."""
    if window <= RUN:
        raise ValueError(f"a window has more than {RUN} words")
    spark = docs.sparkSession
    src = _documents(docs, id_col, text_col)
    shared = BloomFilter.of(_anchors(src, window), "anchor", 20)
    seen = written(_occurrences(src, window, shared), "occurrences")
    classes = written(seen.groupBy("anchor", "s1", "s2").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")), "classes")
    # without what the filter let through by chance
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("a"), F.max("last").alias("b")).where("a < b")
    wide = BloomFilter.of(several.where(F.col("n") > WIDE), "anchor", 16)
    chosen = BloomFilter.of(classes.join(several.select("anchor"), "anchor", "left_semi"), ("s1", "doc"), 20, _pair)
    size = several.agg(F.sum("n")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * 60 // SHARD_WORDS))
    contents = written(_contents(src, window, shared, chosen, wide, shards), "contents")
    found = _by_index(contents.where("not wide"), window).unionByName(_by_hash(contents.where("wide"), window))
    ranges = written(_covered(seen, found, window), "ranges")
    test = bit_table(ranges.select("hash"), "hash")
    every = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col), F.lit(LAST)).alias("doc"),
                        F.xxhash64(text_col).alias("hash"))
    hit = test(F.col("hash"))
    cut = every.where(hit).join(ranges, ["doc", "hash"], "left").select("id", "text", "ranges")
    same = every.where(~hit).select("id", "text", F.lit(None).cast("array<binary>").alias("ranges"))

    def keep(batches):
        for b in batches:
            n, gone, kept = [], [], []
            for t, r in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                words = raw(t.as_py()).split()
                mark = np.zeros(len(words) + 1, dtype=np.int64)
                if r:
                    spans = np.frombuffer(b"".join(r), "<i4").reshape(-1, 2)
                    np.add.at(mark, spans[:, 0], 1)
                    np.add.at(mark, spans[:, 1], -1)
                stay = np.cumsum(mark)[:-1] == 0
                n.append(len(words)), gone.append(int(len(words) - stay.sum()))
                kept.append(b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])

    return cut.unionByName(same).mapInArrow(keep, "id long, n_words long, n_removed long, kept string")
