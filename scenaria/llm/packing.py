"""Best-fit packing of token sequences by exact complements.

Lengths are whole numbers up to ``room``, so the work splits in two: a histogram of lengths (at most
``room`` rows, whatever the corpus) is packed on the driver into patterns of lengths with a
multiplicity, and Spark then deals the pieces of each length out to the places the patterns hold for
that length.  Ranks inside a length are dealt per salted bucket, so a length that very many pieces share
is no hot task.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

BUCKET_ROWS = 256
PIECES = "doc_id {id_type}, piece int, start long, length long, ids_crc32 long"


#: White space as the pattern's \s has it (Python's own takes in \x1c to \x1f as well).  A run of this length or
#: more is cut out before the pattern sees it: tiktoken's matcher stacks every character of a run.
LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


@functools.lru_cache(maxsize=8)
def encoder(vocabulary: str, pattern: str | None = None):
    """The byte-level BPE of ``vocabulary`` (a rank file of public_tokenizers), text being split by ``pattern``
    (none: the pattern of the rank files)."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary.replace(".json", ".tiktoken")), "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    return tiktoken.Encoding(vocabulary, pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, vocabulary: str) -> list[int]:
    """The ids of ``text`` without added tokens, white space of any length included.  The pattern takes a run of white space as one
    piece, but for its last character where other text follows."""
    enc, ids, at = encoder(vocabulary), [], 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += enc.encode_ordinary(text[at:run.start()])
        ids += encoder(vocabulary, r"\s+").encode_ordinary(text[run.start():end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


@functools.lru_cache(maxsize=4)
def added_tokens(vocabulary: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """The tokens that a JSON vocabulary adds to its merges, with a pattern that finds them in text; the longest
    of those that start at a place wins.  A rank file has none."""
    import public_tokenizers

    if not vocabulary.endswith(".json"):
        return None, {}
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{vocabulary} has added tokens that look at the text around them")
    ids = {t["content"]: t["id"] for t in added}
    return (re.compile("|".join(map(re.escape, sorted(ids, key=len, reverse=True)))) if ids else None), ids


def encode_added(text: str, vocabulary: str) -> list[int]:
    """The ids that the tokenizers library gives with add_special_tokens=False: an added token in the text is one
    id, and the text on either side is encoded by itself."""
    found, ids_of = added_tokens(vocabulary)
    ids, at = [], 0
    for m in found.finditer(text) if found else ():
        ids += encode(text[at:m.start()], vocabulary)
        ids.append(ids_of[m.group()])
        at = m.end()
    return ids + encode(text[at:], vocabulary)


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2,
           room: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and ``end_id``, whole if at most
    ``room`` long, else cut so that every piece but the first is full.  A null text is empty (one piece
    of ``end_id`` alone); any id value, null too, is carried along."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            take, start, length, crc, no = [], [], [], [], []
            for i in range(batch.num_rows):
                tokens = np.array(encode_added(texts[i].as_py() or "", vocabulary) + [end_id], dtype="<u4")
                n, k, at = len(tokens), 0, 0
                while at < n:
                    end = at + ((n - at - 1) % room + 1 if k == 0 else room)
                    take.append(i), no.append(k), start.append(at), length.append(end - at)
                    crc.append(zlib.crc32(tokens[at:end].tobytes()))
                    k, at = k + 1, end
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(take, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return src.mapInArrow(run, PIECES.format(id_type=src.schema["doc_id"].dataType.simpleString()))


def pack_lengths(counts: dict[int, int], room: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths that share a sequence, how many such sequences) for a histogram of lengths: the
    shortest of the packings whose exact complements have up to three, two, one or no parts."""
    return min((_pack(counts, room, parts) for parts in (3, 2, 1, 0)), key=lambda p: sum(k for _, k in p))


def _pack(counts: dict[int, int], room: int, parts: int) -> list[tuple[tuple[int, ...], int]]:
    """From the longest length down, a gap is filled exactly by up to ``parts`` further lengths while their
    counts last; what has no exact complement is packed best-fit, longest first."""
    left = np.zeros(room + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    out: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...]) -> None:
        times = min(int(left[n]) // k for n, k in Counter(lengths).items())
        for n in lengths:
            left[n] -= times
        out.append((lengths, times))

    def fits(lengths: tuple[int, ...]) -> bool:
        return all(left[n] >= k for n, k in Counter(lengths).items())

    def exact(first: int) -> tuple[int, ...] | None:
        gap = room - first
        if gap == 0:
            return (first,)
        if parts and fits((first, gap)):
            return first, gap
        have = [int(n) for n in np.flatnonzero(left[:gap])[::-1]]
        for a in have:
            if parts < 2 or 2 * a < gap:
                break
            if fits((first, a, gap - a)):
                return first, a, gap - a
        for a in have:
            if parts < 3 or 3 * a < gap:
                break
            for b in have:
                c = gap - a - b
                if b > a or c > b:
                    if c > b:
                        break
                    continue
                if c > 0 and fits((first, a, b, c)):
                    return first, a, b, c
        return None

    for first in range(room, 0, -1):
        while left[first] and (found := exact(first)):
            use(found)
    while left.any():
        lengths, gap = [], room
        spare = left.copy()
        while (have := np.flatnonzero(spare[:gap + 1])).size:
            n = int(have[-1])
            times = min(int(spare[n]), gap // n)
            lengths += [n] * times
            spare[n] -= times
            gap -= n * times
        use(tuple(lengths))
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): rank r of a length goes to sequence
    first sequence + r - first rank, at the offset."""
    used: Counter = Counter()
    rows, base = [], 0
    for lengths, times in patterns:
        at = 0
        for n in lengths:
            rows.append((n, used[n], used[n] + times, base, at))
            used[n] += times
            at += n
        base += times
    return rows


def pack(items: DataFrame, length_col: str = "length", room: int = 1024) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: every row gets a place of its own length in a
    sequence of at most ``room``, gapless from offset 0.  Lengths must be from 1 to ``room`` (anything
    else is an error).  Equal rows get places of their own.  An empty table stays empty."""
    spark = items.sparkSession
    cols = items.columns
    fixed = written(items.withColumn("_salt", F.xxhash64(*[F.col(f"`{c}`") for c in cols])), "items")
    n = F.col(length_col)
    histogram = {r[0]: r[1] for r in fixed.groupBy(n).count().limit(room + 2).collect()}
    if any(k is None or not 1 <= k <= room for k in histogram):
        raise ValueError(f"a length is null or not from 1 to {room}")
    table = places(pack_lengths(histogram, room))
    slots = spark.createDataFrame(table or [(0, 0, 0, 0, 0)],
                                  "_length long, _from long, _end long, _base long, _offset long")
    # at most `room` rows, and a few thousand: both tables are bounded by the histogram, not by the corpus
    salts = spark.createDataFrame([(k, max(1, -(-c // BUCKET_ROWS))) for k, c in histogram.items()] or [(0, 1)],
                                  "_length long, _salts long")
    dealt = (fixed.join(F.broadcast(salts), n == F.col("_length")).drop("_length")
             .withColumn("_bucket", F.pmod("_salt", "_salts")))
    sizes = dealt.groupBy(n.alias("_length"), F.col("_bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    # running totals over buckets: first inside blocks of buckets, then over the blocks
    block = F.expr("_b div 1024")
    inner = Window.partitionBy("_length", block).orderBy("_b")
    sizes = sizes.withColumn("_before", F.sum("_n").over(inner) - F.col("_n")).withColumn("_block", block)
    blocks = sizes.groupBy("_length", "_block").agg(F.sum("_n").alias("_m"))
    blocks = blocks.select("_length", "_block", (F.sum("_m").over(
        Window.partitionBy("_length").orderBy("_block")) - F.col("_m")).alias("_blocks_before"))
    starts = sizes.join(blocks, ["_length", "_block"]).select(
        "_length", "_b", (F.col("_before") + F.col("_blocks_before")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(n, "_bucket").orderBy("_salt")) - 1
    ranked = (dealt.withColumn("_rank", rank)
              .join(starts, (n == F.col("_length")) & (F.col("_bucket") == F.col("_b")))
              .withColumn("_rank", F.col("_rank") + F.col("_start")).drop("_length"))
    placed = ranked.join(F.broadcast(slots), (n == F.col("_length")) & (F.col("_rank") >= F.col("_from"))
                         & (F.col("_rank") < F.col("_end")))
    return placed.select(*[F.col(f"`{c}`") for c in cols],
                         (F.col("_base") + F.col("_rank") - F.col("_from")).alias("sequence_id"),
                         F.col("_offset").alias("offset"))
