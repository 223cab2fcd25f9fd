"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations alone.

A line is the set of its words.  Words are ordered by rarity; two sets with a Jaccard similarity of at least
t then share a word in their first n - ceil(t * n) + 1 ones.  Lines meet on such words, pass a length filter,
a positional filter (what the remaining words can still have in common) and a parity filter (bits in which
the sets' parity sketches differ need a differing word each), and are verified on their whole sets.

Rarity comes from counts of all words in a table of fixed size, indexed by the word's hash: it only orders
the words, so words that share a count do no harm.  The table, and the bit tables that say which documents
matter at all, are constants of the plan, of a size that no corpus changes.

Long posting lists are not compared pair by pair.  A line is removed if any earlier one is similar, so lists
of more than ``LIST`` lines (more in a large corpus) first meet the earliest line of the list and the earliest ones of 16 parts of
it; only lines that found none of these similar meet the whole list.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_table, free_names, written

SPACES = " \t\n\x0b\x0c\r"
COUNT_BITS = 17
LIST = 64
LIST_SHARE = 6000
SPREAD = 16
#: Up to so many long lists' words (an int each) are sent to all tasks; more are joined.
SENT = 100_000
#: Sets of more words have a second sketch.
WIDE = 64


def blanks(text: Column) -> Column:
    """The text with blanks for white space other than line feeds, as Spark splits at a single plain character
    without a regular expression.  Few texts have any but line feeds and blanks."""
    other = text
    for c in "\t\x0b\x0c\r":
        other = F.replace(other, F.lit(c), F.lit(" "))
    return F.when(text.rlike(r"[\t\x0B\x0C\r]"), other).otherwise(text)


def rarity(docs: DataFrame, text_col: str) -> Column:
    """Constant table: by the low bits of a word's hash, four times the logarithm of the count, less 64, as the low 7
    bits of a signed number."""
    slot = F.xxhash64("word").bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")
    parts = F.split(F.replace(blanks(F.col(text_col)), F.lit("\n"), F.lit(" ")), " ")
    counts = docs.select(F.explode(parts).alias("word")).where("word <> ''").groupBy(slot.alias("slot")).count()
    line = counts.agg(F.concat_ws(",", F.collect_list(F.concat_ws(":", "slot", "count")))).first()[0]  # at most 2**COUNT_BITS
    table = bytearray([64]) * (1 << COUNT_BITS)
    for pair in line.split(",") if line else []:
        slot, count = pair.split(":")
        table[max(int(slot) - 1, 0)] = min(127, int(4 * math.log2(int(count)))) ^ 64
    return F.lit(bytes(table))


def keys_of(lines: DataFrame, table: Column) -> DataFrame:
    """``lines`` with ``keys`` for ``text``: its distinct words as numbers whose order is by rarity, 7 bits of rarity
    above 57 bits of the word's hash."""
    mask = F.lit((1 << COUNT_BITS) - 1)

    def key(h):
        at = h.bitwiseAND(mask).cast("int")  # substring counts from 1 and takes 0 for 1: two slots are one
        rare = F.ascii(F.substring(table, at, F.lit(1)).cast("string")).cast("bigint")
        return F.shiftleft(rare, 57).bitwiseOR(F.shiftrightunsigned(h, 7))

    hashes = F.transform(F.array_remove(F.split("text", " "), ""), lambda w: F.xxhash64(w))
    return lines.withColumn("keys", F.sort_array(F.transform(F.array_distinct(hashes), key))).drop("text")


def _hashes() -> list[Column]:
    return [F.xxhash64("keys").alias("set1"), F.xxhash64("keys", F.lit(1)).alias("set2")]


def parity(keys: str, half: bool = False) -> Column:
    """A 64-bit parity sketch: every key flips one bit, so the sketches of two sets differ in no more bits than the
    sets in keys; with ``half`` only the keys do that have an odd number above the 6 bits that choose the bit."""
    def flip(sketch, k):
        one = F.shiftright(k, 6).bitwiseAND(F.lit(1)) if half else F.lit(1).cast("bigint")
        return sketch.bitwiseXOR(F.call_function("shiftleft", one, k.bitwiseAND(F.lit(63)).cast("int")))
    return F.aggregate(keys, F.lit(0).cast("bigint"), flip)


def with_words(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``whole``, a text after ``blanks``) as rows (line, text) of every line that has a word."""
    others = [c for c in docs.columns if c != "whole"]
    lines = docs.select(*others, F.posexplode(F.split("whole", "\n")).alias("line", "text"))
    return lines.where(F.length(F.btrim("text")) > 0)


def _doc(id_col: Column) -> Column:
    """Ids as decimals; null is past all of them."""
    return F.coalesce(id_col.cast("decimal(20,0)"), F.lit("1" + "0" * 19).cast("decimal(20,0)"))


def _close(t: float) -> Column:
    """Can rows a and b of a posting list be similar?  Sizes, places in the list of words, parity sketches; first, as
    most pairs fail it, what one sketch says of the sizes alone."""
    need = F.ceil(F.lit(t / (1 + t)) * (F.col("a.n") + F.col("b.n")) - 1e-9)
    tail = F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    x, y = (F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}")) for w in "xy")
    apart = F.when((F.col("a.n") > WIDE) & (F.col("b.n") > WIDE), F.bit_count(x.bitwiseXOR(y)) + F.bit_count(y)).otherwise(F.bit_count(x))
    return ((F.bit_count(x) <= (F.col("a.n") + F.col("b.n")) * F.lit((1 - t) / (1 + t) + 1e-9) + 1e-6)
            & (F.col("a.n") >= F.lit(t) * F.col("b.n") - 1e-9) & (F.col("b.n") >= F.lit(t) * F.col("a.n") - 1e-9)
            & (tail >= need) & (apart <= F.col("a.n") + F.col("b.n") - 2 * need))


def _candidates(a: DataFrame, b: DataFrame, t: float) -> DataFrame:
    """(a, b): distinct pairs of a posting list that pass the filters, the earlier line first."""
    met = a.alias("a").join(b.alias("b"), (F.col("a.tok") == F.col("b.tok")) & _close(t) & (F.col("a.rid") < F.col("b.rid")))
    return met.select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b")).distinct()


def _whole_sets(rids: DataFrame, sets: DataFrame, docs: DataFrame, table: Column) -> DataFrame:
    """(rid, keys) of the given sets, from the lines they first occur in.  Bit tables of documents and of lines leave
    out what they can; the lines left meet the wanted ones before their words are looked at."""
    doc = F.floor(F.col("place") / F.lit(4294967296))
    ends = sets.join(rids.distinct(), "rid", "left_semi").withColumn("doc", doc.cast("decimal(20,0)")).select(
        "rid", "set1", "set2", F.xxhash64("doc").alias("doc"), (F.col("place") - F.col("doc") * F.lit(4294967296)).cast("int").alias("line"))
    at = F.xxhash64("doc", "line").alias("at")
    ends = written(ends.select("rid", "set1", "set2", "doc", at), "ends")
    in_doc, in_line = bit_table(ends, "doc"), bit_table(ends, "at")
    whole = docs.select(F.xxhash64(_doc(F.col("id"))).alias("doc"), F.col("text").alias("whole")).where(in_doc(F.col("doc")))
    some = with_words(whole.select("doc", blanks(F.col("whole")).alias("whole"))).select("text", at).where(in_line(F.col("at")))
    # the sets' hashes decide, in a join, as a filter on them would be moved below and work the keys out once more;
    # places that share a hash do no harm
    some = keys_of(some.join(ends.select("at").distinct(), "at", "left_semi"), table)
    full = some.select("at", *_hashes(), "keys").join(ends.select("rid", "at", "set1", "set2"), ["at", "set1", "set2"])
    return written(full.select("rid", "keys").dropDuplicates(["rid"]), "whole-sets")


def _similar(pairs: DataFrame, sets: DataFrame, docs: DataFrame, table: Column, t: float) -> DataFrame:
    """(rid): lines b of the pairs whose line a is similar.  Each first meets its earliest partner; only those
    that are not similar to it meet the others."""
    whole = _whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("rid")), sets, docs, table)
    a, b = whole.select(F.col("rid").alias("a"), F.col("keys").alias("x")), whole.select(F.col("rid").alias("b"), F.col("keys").alias("y"))
    common = F.size(F.array_intersect("x", "y"))

    def found(some):
        return some.join(a, "a").join(b, "b").where(common >= F.lit(t) * (F.size("x") + F.size("y") - common) - 1e-9).select("b").distinct()

    first = pairs.groupBy("b").agg(F.min("a").alias("a"))
    one = written(found(first), "similar")
    rest = pairs.join(one, "b", "left_anti").join(first, ["a", "b"], "left_anti")
    return one.unionByName(found(rest)).select(F.col("b").alias("rid"))


def similar_lines(lines: DataFrame, docs: DataFrame, table: Column, t: float) -> tuple[DataFrame, DataFrame]:
    """(rid, set1, set2, place, copies) of the distinct sets, and (rid) of those with an earlier similar one."""
    spark = lines.sparkSession
    sets = lines.groupBy("set1", "set2", "n", "x", "y", "prefix").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = sets.repartitionByRange(parts, "place", "set1").sortWithinPartitions("place", "set1")
    sets = written(ordered.withColumn("rid", F.monotonically_increasing_id()), "sets")  # ascends with the place
    posts = sets.select("rid", "n", "x", "y", F.posexplode("prefix").alias("i", "tok"))
    # posting lists grow with the number of sets, and so does what counts as a long one, up to a bound
    most = max(LIST, min(64 * LIST, sets.count() // LIST_SHARE))
    heavy = written(posts.groupBy("tok").count().where(F.col("count") > most).select("tok"), "heavy")
    if heavy.count() <= SENT:
        heavy = F.broadcast(heavy)
    light = posts.join(heavy, "tok", "left_anti")
    long = written(posts.join(heavy, "tok", "left_semi"), "long-lists")
    met = _candidates(light, light, t)
    for split in (1, SPREAD):
        lead = (long.groupBy("tok", F.pmod(F.xxhash64("rid"), F.lit(split)).alias("part"))
                .agg(F.min(F.struct("rid", "n", "x", "y", "i")).alias("r")).select("tok", "r.*"))
        met = met.unionByName(_candidates(lead, long, t))
    near = written(_similar(written(met.distinct(), "pairs"), sets, docs, table, t), "near")
    if not long.isEmpty():
        rest = written(_candidates(long, long.join(near, "rid", "left_anti"), t), "pairs")
        near = written(near.unionByName(_similar(rest, sets, docs, table, t)), "near")
    return sets, near


def dedup_lines(docs: DataFrame, id_col: str, text_col: str, threshold: float = 0.8) -> DataFrame:
    """``docs`` with ``text_col`` less every line that has an earlier similar one, and with ``n_lines``
    (lines of the text that have a word) and ``n_removed``.

    A line is a piece between line feeds; its words are runs of anything but ASCII white space.  Lines are
    similar at a Jaccard similarity of ``threshold`` or more of their sets of words; earlier is by (id, line
    number), judged on the input, removed lines included.  Lines without words stay.  Ids are longs; a null
    id comes after all others.  Lines at equal places (rows that repeat an id) are not earlier than each
    other, so equal rows share their fate.  A null text stays null with no lines; an empty table gives an
    empty result.  Other columns are carried along, but for any that
    are called n_lines or n_removed."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    table = rarity(src, "text")
    first = F.greatest(F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1, F.lit(1)).cast("int")
    least = math.ceil(threshold / (1 - threshold) - 1e-9)  # smaller sets are similar only if equal
    prefix = F.when(F.col("n") >= least, F.transform(F.slice("keys", F.lit(1), first), lambda k: F.xxhash64(k).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")))
    whole = src.select("id", F.xxhash64("text").alias("text_hash"), blanks(F.col("text")).alias("whole"))  # once a text, not once a line
    lines = keys_of(with_words(whole), table).withColumn("n", F.size("keys"))
    lines = written(lines.select("id", "text_hash", "line", "n", *_hashes(), parity("keys").alias("x"),
                                 F.when(F.col("n") > WIDE, parity("keys", half=True)).otherwise(F.lit(0).cast("bigint")).alias("y"),
                                 prefix.alias("prefix"), (_doc(F.col("id")) * 4294967296 + F.col("line")).alias("place")), "lines")
    sets, near = similar_lines(lines, src, table, threshold)
    drop = (sets.where("copies > 1").select("set1", "set2", "place", "rid").join(near, "rid", "left_anti")
            .select("set1", "set2", F.col("place").alias("stays")))
    drop = drop.unionByName(sets.join(near, "rid", "left_semi").select("set1", "set2", F.lit(None).cast(drop.schema["stays"].dataType).alias("stays")))
    gone = (lines.select("id", "text_hash", "line", "set1", "set2", "place").join(drop, ["set1", "set2"])
            .where("stays is null or place > stays"))
    word = F.expr("line div 64").alias("word")
    bits = F.bit_or(F.expr("shiftleft(1L, line % 64)")).alias("bits")
    gone = (gone.groupBy("id", "text_hash", word).agg(bits).groupBy("id", "text_hash")
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("gone")))
    gone = written(gone, "gone")
    test = bit_table(gone.select("text_hash"), "text_hash")
    own_hash, hit_id, hit_hash, lines_gone, rest = free_names(docs.columns, "own_hash", "hit_id", "hit_hash", "lines_gone", "rest")
    every = docs.withColumn(own_hash, F.xxhash64(F.col(text_col)))
    split = F.split(F.col(text_col), "\n")
    has_word = lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0
    out = every.withColumn("n_lines", F.coalesce(F.size(F.filter(split, has_word)), F.lit(0)).cast("long"))
    hit = F.col(text_col).isNotNull() & test(F.col(own_hash))
    same = out.where(~hit).withColumn("n_removed", F.lit(0).cast("long"))
    keep = lambda x, i: F.coalesce(F.getbit(F.element_at(lines_gone, F.floor(i / 64).cast("bigint")), F.pmod(i, F.lit(64))) == 0, F.lit(True))
    marks = gone.select(F.col("id").alias(hit_id), F.col("text_hash").alias(hit_hash), F.col("gone").alias(lines_gone))
    cut = out.where(hit).join(marks, F.col(id_col).eqNullSafe(F.col(hit_id)) & (F.col(own_hash) == F.col(hit_hash)), "left")
    left = F.filter(split, keep)
    cut = (cut.withColumn(rest, F.when(F.col(lines_gone).isNotNull(), left).otherwise(split))
           .withColumn("n_removed", (F.size(split) - F.size(rest)).cast("long"))
           .withColumn(text_col, F.array_join(rest, "\n")))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    columns = [*[F.col("`{}`".format(c.replace("`", "``"))) for c in kept], "n_lines", "n_removed"]
    return same.select(*columns).unionByName(cut.select(*columns))
