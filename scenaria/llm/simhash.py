"""SimHash near-duplicates by meeting in the middle of two balls.

Two fingerprints at distance 3 or less have a midpoint at distance at most 1 from one and at most 2 from
the other.  Every distinct fingerprint emits its near variants (itself and each single flip) and its far
variants (two flips), and a shuffle brings equal variants together.  Far variants need flips inside one
half of the word only: of any three differing bits, two lie in the same half (32 bits each), those two
make the far side and the third the near side.  That is 65 + 992 variants a fingerprint.

A far variant matters only where some near variant meets it.  A Bloom filter of fixed size over the near
variants drops most others before the shuffle; as it fills up it drops fewer, never a true one.

At a variant, near members are within 2 bits of each other and far members within 3 of each near one, so
linking every member to the variant's first near member keeps the components whole without all pairs.  A
variant has at most 1 + 64 + 2016 distinct fingerprints by geometry.  Every link is verified.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BloomFilter, bit_table, free_names, met, mixed, written
from .components import components

HALF = 32
#: Near variants met at once: four for each word of the filter.
PER_ROUND = 1 << 24


def text_fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for a in range(0, n, 65536):  # a very long text never expands to more bits than this at once
        b = min(n, a + 65536)
        h = np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts[a:b], ends[a + shingle - 1:b + shingle - 1], strict=True)],
                        dtype="<u8", count=b - a)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, fp long): SimHash of the text with A-Z lower-cased, words split at ASCII white space, XXH64
    (seed 42) of word shingles.  A text of fewer words is one shingle; a null or empty text has 0."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fp long")


@functools.lru_cache(maxsize=1)
def masks() -> tuple[np.ndarray, np.ndarray]:
    """Flips of the near and of the far variants."""
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    a, b = np.triu_indices(64, 1)
    same = a // HALF == b // HALF
    return np.concatenate([[np.uint64(0)], bit]), bit[a[same]] | bit[b[same]]


def links(nodes: DataFrame, words: int = 22, per_round: int = PER_ROUND) -> DataFrame:
    """(a, b): links between the ``node`` ids of distinct fingerprints ``fp`` within distance 3 that keep
    the components whole.  ``node`` is a long and neither it nor ``fp`` repeats.

    Variants are met in rounds, each of a share of all variants by their hash and of about ``per_round`` near ones, so
    that what a round shuffles is bounded and the filter never gets full."""
    rounds = max(1, -(-nodes.count() * masks()[0].size // per_round))
    if rounds == 1:
        return _met(nodes, words, 0, 1).distinct()
    found = None
    for r in range(rounds):
        some = written(_met(nodes, words, r, rounds), f"links-{r}")
        found = some if found is None else found.unionByName(some)
    return found.distinct()


def _met(nodes: DataFrame, words: int, turn: int, rounds: int) -> DataFrame:
    """Links at the variants of one round; a link may come back at several variants."""
    turns = np.uint64(rounds)

    def mine(variant: np.ndarray) -> np.ndarray:
        return (mixed(variant) >> np.uint64(20)) % turns == np.uint64(turn)

    def near_values(fp: np.ndarray) -> np.ndarray:
        v = (fp.view(np.uint64)[:, None] ^ masks()[0][None, :]).ravel()
        return v[mine(v)] if rounds > 1 else v

    bloom = BloomFilter.of(nodes, "fp", words, near_values)

    def emit(batches):
        near, far = masks()
        test = bloom.tester()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for a in range(0, len(fps), 512):
                fp, node = fps[a:a + 512], ids[a:a + 512]
                variant = fp[:, None] ^ near[None, :]
                i, k = np.nonzero(mine(variant))
                yield _rows(variant[i, k], node[i], k)
                variant = fp[:, None] ^ far[None, :]
                i, k = np.nonzero(mine(variant) if rounds > 1 else np.ones(variant.shape, bool))
                some = test(variant[i, k])
                i, k = i[some], k[some]
                yield _rows(variant[i, k], node[i], near.size + k)

    def meet(batches):
        near, far = masks()
        flips = np.concatenate([near, far])
        kept = None
        for batch in _then_none(batches):
            if batch is not None:
                cols = [batch.column(j).to_numpy(zero_copy_only=False) for j in range(3)]
                if kept is not None:
                    cols = [np.concatenate([x, y]) for x, y in zip(kept, cols, strict=True)]
                if not cols[0].size:
                    continue
                cut = np.searchsorted(cols[0] == cols[0][-1], True)  # the last variant may go on in the next batch
                kept, cols = [c[cut:] for c in cols], [c[:cut] for c in cols]
            else:
                cols = kept
            if cols is None or not cols[0].size:
                continue
            variant, node, kind = cols
            first = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]])
            size = np.diff(np.r_[first, variant.size])
            is_near = kind[first] < near.size  # rows of a variant come with near ones, then small nodes, first
            lead = np.repeat(first, size)
            use = np.repeat(is_near & (size > 1), size) & (np.arange(variant.size) != lead)
            a, b = node[use], node[lead[use]]
            close = np.bitwise_count(flips[kind[use]] ^ flips[kind[lead[use]]]) <= 3
            pair = np.unique(np.stack([a[close], b[close]]), axis=1) if close.any() else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    rows = (nodes.select("fp", "node").mapInArrow(emit, "variant long, node long, kind int")
           .repartition("variant").sortWithinPartitions("variant", F.col("kind") >= masks()[0].size, "node"))
    return rows.mapInArrow(meet, "a long, b long")


def _then_none(batches):
    yield from batches
    yield None


def _rows(variant: np.ndarray, node: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(variant.view(np.int64)), pa.array(node), pa.array(kind.astype(np.int32))],
                                      names=["variant", "node", "kind"])


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, words: int = 22) -> DataFrame:
    """(id, fp, component, root): the fingerprint of every row, the smallest id that can be reached over links
    of at most 3 differing bits, itself included, and a fingerprint that names the group.

    Ids must be longs.  A row whose id is null joins its group but is never its smallest; a group of null
    ids alone has a null component.  Equal texts share a fingerprint, so copies are never expanded into
    pairs.  Empty and null texts all have fingerprint 0.  An empty table gives an empty result."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")), "classes")
    # links run between fingerprints, so that classes whose ids are all null take part as well
    nodes = classes.select("fp", F.col("fp").alias("node"))
    comp = components(links(nodes, words), "a", "b")
    named = classes.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", "rows", F.coalesce("component", "fp").alias("root"))
    named = written(named, "named")
    least = named.groupBy("root").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("n"))
    label = written(met(named, least, "root", "n", named.count()).select("fp", "component", "root", "rows"), "labelled")
    total = label.agg(F.sum("rows")).first()[0] or 0
    return met(fps, label, "fp", "rows", total).select("id", "fp", "component", "root")


def keep_first(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: that of the smallest id.  Where the id repeats, or
    all ids of a group are null, the row of the group whose fingerprint, then text hash, is the smallest stays;
    of equal rows one.  Columns may have any names.  Rows that a fixed bit table says are not to be dropped stay
    where they are; only the others meet the decisions."""
    near = written(near_duplicates(docs, id_col, text_col, shingle), "groups")
    first = near.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("f"))
    ids = near.groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    chosen = written(first.select("f.id", "f.fp"), "chosen")
    keep = chosen.select(F.col("id").alias("kept_id")).distinct()
    # ids that need a decision: of one row that goes, or of several rows
    odd = written(ids.join(keep, F.col("id").eqNullSafe(F.col("kept_id")), "left").where("rows > 1 or id is null or kept_id is null")
                  .select("id", (F.col("id").isNull() | (F.col("rows") > 1)).alias("several")), "odd")
    test = bit_table(odd.select("id"), "id")
    odd_id, several = free_names(docs.columns, "odd_id", "several")
    maybe = F.col(id_col).isNull() | test(F.col(id_col))
    asked = docs.where(maybe).join(odd.select(F.col("id").alias(odd_id), F.col("several").alias(several)), F.col(id_col).eqNullSafe(F.col(odd_id)), "left")
    out = docs.where(~maybe).unionByName(asked.where(F.col(several).isNull()).select(*[F.col(_quoted(c)) for c in docs.columns]))
    if odd.where("several").isEmpty():
        return out
    # rows of these ids are told apart by their texts
    rows = asked.where(several).select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"), F.col(_quoted(id_col)).alias("id"),
                                       F.xxhash64(_quoted(text_col)).alias("hash"), F.col(_quoted(text_col)).alias("text"))
    prints = fingerprints(rows.select(F.struct("id", "hash").alias("key"), "text"), "key", "text", shingle)
    texts = prints.select("id.id", "id.hash", "fp").withColumnsRenamed({"id": "i", "fp": "f"})
    mine = chosen.join(odd.where("several").select(F.col("id").alias("o")), F.col("id").eqNullSafe(F.col("o")))
    least = (texts.join(mine, F.col("i").eqNullSafe(F.col("id")) & (F.col("f") == F.col("fp")))
             .groupBy("i", "f").agg(F.min("hash").alias("least")).select("i", "least").distinct())
    kept = (rows.join(least, F.col("id").eqNullSafe(F.col("i")) & (F.col("hash") == F.col("least")))
            .groupBy("id", "hash").agg(F.min("row").alias("row")))
    return out.unionByName(kept.select("row.*"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
