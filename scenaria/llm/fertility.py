"""Quality rules: plain text counts, and how tokenizers with public vocabularies see the text.

For each vocabulary a text has its characters per token, the share of its tokens that are pieces of a
character (byte fallback) and the entropy of its tokens over the largest it could have.  Per language the
corpus gives each measure a band around its median; the shorter a text, the wider its band.  A text is
rejected if the plain rules fail it or any measure leaves its band.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .packing import encode, encoder

VOCABULARIES = ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken")
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Measure: (spreads below the median, spreads above it, least spread); none: no bound on that side.
BANDS = {"chars_per_token": (4.0, 5.0, 0.05), "fallback_share": (None, 5.0, 0.03), "entropy_share": (4.0, None, 0.03)}


@functools.lru_cache(maxsize=4)
def pieces_of_characters(vocabulary: str) -> np.ndarray:
    """True for the ids whose bytes are not whole UTF-8 characters."""
    enc = encoder(vocabulary)
    out = np.zeros(enc.n_vocab, dtype=bool)
    for i in range(enc.n_vocab):
        try:
            enc.decode_single_token_bytes(i).decode()
        except UnicodeDecodeError:
            out[i] = True
        except KeyError:  # an id that the vocabulary leaves free
            pass
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 words that the text has twice or more, the first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    rank = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(words):
        return 0
    span = 1
    while span < WINDOW:  # equal ranks: equal windows of twice the length
        pair = rank[:-span] * (len(words) + 1) + rank[span:]
        rank, span = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * span
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    mark = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(mark, again, 1)
    np.add.at(mark, again + WINDOW, -1)
    return int((np.cumsum(mark) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def token_measures(text: str, vocabulary: str) -> tuple[int, float, float, float]:
    """Number of tokens, characters per token, fallback share, entropy share (0, 0, 0, 1 for an empty text)."""
    ids = np.array(encode(text, vocabulary), dtype=np.int64)
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 1.0
    p = np.unique(ids, return_counts=True)[1] / n
    return n, len(text) / n, float(pieces_of_characters(vocabulary)[ids].mean()), \
        float(-(p * np.log2(p)).sum() / np.log2(n)) if n > 1 else 1.0


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str, vocabularies=VOCABULARIES) -> DataFrame:
    """(id, lang, base counts, measures of each vocabulary) of every row, from its whole text (null: empty)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = [f"{m}_{i}" for i in range(len(vocabularies)) for m in ("n_tokens", *BANDS)]

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(2):
                text = t.as_py() or ""
                rows.append([*base_counts(text), *(x for v in vocabularies for x in token_measures(text, v))])
            cols = list(zip(*rows, strict=True)) if rows else [[]] * (len(base) + len(more))
            types = [pa.int64() if k in base or k.startswith("n_tokens") else pa.float64() for k in base + more]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             names=["id", "lang", *base, *more])

    fields = ", ".join([f"{k} long" for k in base] + [f"{k} {'long' if k.startswith('n_tokens') else 'double'}" for k in more])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, lang string, {fields}")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabularies=VOCABULARIES,
          least_words: int = 20, most_repeated: int = 30, at_tokens: int = 200) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, measures, kept) of every row.

    Bands come from all rows of a language that pass the plain rules (null is a language of its own): the
    median less or plus a multiple of its distance to the lower or upper decile; a text of n tokens gets
    them wider by sqrt(1 + at_tokens / n).  A language none of whose texts passes has no bands, and needs
    none.  An empty table gives an empty result."""
    failed = (F.col("n_words") < least_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(most_repeated) * F.col("n_words"))
    table = written(measures(docs, id_col, text_col, lang_col, vocabularies).withColumn("base_failed", failed), "measures")
    names = [(f"{m}_{i}", m, i) for i in range(len(vocabularies)) for m in BANDS]
    bands = table.where("not base_failed").groupBy(F.col("lang").alias("_lang")).agg(
        *[F.percentile_approx(c, [0.1, 0.5, 0.9], 10_000).alias(f"_{c}") for c, _, _ in names])
    out = table.join(bands, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    bad = F.lit(False)
    for c, m, i in names:
        below, above, least = BANDS[m]
        low, mid, high = (F.element_at(f"_{c}", k) for k in (1, 2, 3))
        wide = F.sqrt(1 + F.lit(at_tokens) / F.greatest(F.col(f"n_tokens_{i}"), F.lit(1)))
        if below is not None:
            bad |= F.col(c) < mid - below * wide * F.greatest(mid - low, F.lit(least))
        if above is not None:
            bad |= F.col(c) > mid + above * wide * F.greatest(high - mid, F.lit(least))
    kept = ~F.col("base_failed") & ~F.coalesce(bad, F.lit(False))
    return out.select(*table.columns, kept.alias("kept"))
