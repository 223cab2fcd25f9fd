"""Toxicity by a linear-chain conditional random field over words.

Documents carry the labels, the chain needs labelled words: a greedy cover finds the words and word
beginnings that explain the toxic documents of a bounded sample and that clean ones hardly use, and a word
is labelled toxic if it is, or begins with, one of them.  The chain (two states) is then trained on
those documents, with the word, its beginnings and ends and its shape as features, by
gradient ascent on the exact likelihood.  Forward-backward gives every word its marginal; a logistic model
over a document's strongest marginals gives its score, and words over one half its offending offsets.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import label_sample, logistic, scored

CHAIN = 256  # words of a longer text that are computed together, with what lies around them
NEAR = 1e-12  # how far the surroundings' own ends may move a marginal
BITS = 18
STEMS = (3, 4, 5, 6, 7, 8)
EDGE = re.compile(r"^\W+|\W+$")
SPANS = "spans array<struct<start: int, end: int>>"


@dataclass
class Model:
    emit: dict[int, float]  # hashed feature: weight of the toxic state over the clean one
    moves: list[float]  # log potentials 0->0, 0->1, 1->0, 1->1, start in 1
    scale: list[float] | None
    prior: float


def core(word: str) -> str:
    return EDGE.sub("", word).lower() if not word.isalpha() else word.lower()


def keys(word: str) -> list[str]:
    """What may mark a word as toxic: itself and its beginnings of three to eight letters."""
    w = core(word)
    return ["=" + w, *["^" + w[:n] for n in STEMS if len(w) > n]] if w else []


_WORD, _BEGIN, _END, _SHAPE = (zlib.crc32(x) for x in (b"=", b"^", b"$", b"shape"))


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, its beginnings and ends, its shape.  A beginning's crc goes on from that of
    the one before it."""
    w = core(word)
    shift, crc, n = 32 - BITS, zlib.crc32, len(w)
    plain = word.isalpha()
    shape = word.isupper() * 32 + (not plain and any(map(str.isdigit, word))) * 16 + (w != (word if plain and word.islower() else word.lower())) * 8
    out = [crc(b"%d" % (shape + min(n, 7)), _SHAPE) >> shift]
    if not n:
        return out
    data = w.encode("utf-8", "surrogatepass")
    out.append(crc(data, _WORD) >> shift)
    at, h, ascii_ = 0, _BEGIN, len(data) == n
    for stem in STEMS:
        if at < n:
            h = crc(data[at:stem] if ascii_ else w[at:stem].encode("utf-8", "surrogatepass"), h)
            out.append(h >> shift)
            at = stem
    for size in (2, 3) if n > 2 else (2,):
        out.append(crc(data[-size:] if ascii_ else w[-size:].encode("utf-8", "surrogatepass"), _END) >> shift)
    return out


def text_keys(text: str) -> set[str]:
    return {k for w in set(text.split()) for k in keys(w)}


def one_of_copies(texts: list[str], share: float = 0.5, hashes: int = 64) -> list[str]:
    """The texts that do not share their words, to about ``share`` or more (Jaccard, by ``hashes`` min-hashes of the
    distinct words), with one kept before."""
    odd = np.array([zlib.crc32(b"%d" % i) << 32 | zlib.crc32(b"-%d" % i) | 1 for i in range(hashes)], np.uint64)
    kept, prints, n = [], np.zeros((len(texts), hashes), np.uint64), 0
    for t in texts:
        words = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) + 1 for w in set(t.split())] or [0], np.uint64)
        print_ = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(words), 4096):
            h = words[i:i + 4096, None] * odd[None, :]
            print_ = np.minimum(print_, ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)).min(axis=0))
        if not n or (prints[:n] == print_).mean(axis=1).max() < share:
            prints[n] = print_
            kept.append(t)
            n += 1
    return kept


def lexicon(toxic: list[str], clean: list[str], most_clean: float = 0.02, least: int = 3, common: float = 0.02) -> set[str]:
    """Keys that clean documents hardly use: all in at least ``common`` of the toxic documents, then, one by
    one, the key in most of the toxic documents not yet explained.  The other words of copies of one toxic
    document cannot come in: copies count once, and once explained no more."""
    toxic = one_of_copies(toxic)
    rough = np.zeros(1 << 20, dtype=np.int32)  # counts by hash first: most keys are too rare to be kept apart
    slot = lambda k: zlib.crc32(k.encode("utf-8", "surrogatepass")) >> 12
    for t in toxic:
        rough[[slot(k) for k in text_keys(t)]] += 1
    # so many documents that less than one key is expected to be in as many toxic ones, and no others, by chance
    share = min(0.9, max(0.01, len(toxic) / max(1, len(toxic) + len(clean))))
    least = max(least, math.ceil(math.log(0.5 / max(1, np.count_nonzero(rough))) / math.log(share)))
    in_toxic = Counter(k for t in toxic for k in text_keys(t) if rough[slot(k)] >= least)
    in_toxic = Counter({k: n for k, n in in_toxic.items() if n >= least})
    in_clean = Counter(k for t in clean for k in text_keys(t) if k in in_toxic)
    ratio = max(1e-9, len(toxic) / max(1, len(clean)))
    fine = {k for k, n in in_toxic.items() if in_clean[k] * ratio <= most_clean * n}
    where = defaultdict(set)
    for i, t in enumerate(toxic):
        for k in text_keys(t) & fine:
            where[k].add(i)
    found = {k for k, v in where.items() if len(v) >= max(least, common * len(toxic))}
    left = set(range(len(toxic))) - {i for k in found for i in where[k]}
    count = {k: len(v & left) for k, v in where.items()}
    while count:
        k = max(count, key=lambda x: (count[x], -len(x), x))
        hit = where[k] & left
        if len(hit) < count[k]:  # counts only fall: bring this one up to date and look again
            count[k] = len(hit)
            if len(hit) < least:
                del count[k]
            continue
        if len(hit) < max(least, 0.002 * len(toxic)):
            break
        found.add(k)
        left -= hit
        del count[k]
    return found


def halves(r: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves) -> tuple[np.ndarray, np.ndarray]:
    """For every word of all chains, the odds of the toxic state from what lies before it with the word
    itself, and from what lies behind it; ``r`` holds the words' own odds.  All chains advance together."""
    t00, t01, t10, t11, s1 = np.exp(np.asarray(moves, dtype=float))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    ahead, back = np.empty_like(r), np.ones_like(r)
    if not len(lengths):
        return ahead, back
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # chains longer than t
    ahead[starts] = s1 * r[starts]
    for t in range(1, lengths[0]):
        i = starts[:live[t]] + t
        a = ahead[i - 1]
        ahead[i] = np.clip(r[i] * (t01 + a * t11) / (t00 + a * t10), 1e-40, 1e40)
    for t in range(lengths[0] - 1, 0, -1):
        i = starts[:live[t]] + t
        b = r[i] * back[i]
        back[i - 1] = np.clip((t10 + t11 * b) / (t00 + t01 * b), 1e-40, 1e40)
    return ahead, back


def reach(moves) -> int:
    """Words after which what lies beyond changes the odds by less than ``NEAR``: a step along the chain brings any two
    odds nearer, by Birkhoff's factor at least, whatever the words say."""
    t00, t01, t10, t11 = np.exp(np.asarray(moves[:4], dtype=float))
    spread = math.sqrt(max(t00 * t11 / (t01 * t10), t01 * t10 / (t00 * t11)))
    factor = (spread - 1) / (spread + 1)
    return 1 if factor <= NEAR else min(1 << 20, math.ceil(math.log(NEAR / 200) / math.log(factor)))


def cut(n: int, more: int) -> list[tuple[int, int, int, int]]:
    """(from, to, first, past) of the pieces that a text of ``n`` words is computed in: words ``first`` to ``past`` are
    asked for, ``from`` to ``to`` are computed."""
    if n <= CHAIN + 2 * more:
        return [(0, n, 0, n)] if n else []
    return [(max(0, a - more), min(n, a + CHAIN + more), a, min(n, a + CHAIN)) for a in range(0, n, CHAIN)]


def train(chains: list[np.ndarray], tags: list[np.ndarray], vocabulary: list[str], rounds: int = 60, ridge: float = 1e-4,
          together: int = 200_000) -> tuple[dict[int, float], list[float]]:
    """Feature weights and moves by Adam on the mean log-likelihood of the labelled chains, given as word numbers; the
    slopes are summed over groups of chains of about ``together`` words, so memory does not grow with the chains."""
    feats = [features(w) for w in vocabulary]
    flat = np.array([f for x in feats for f in x], dtype=np.int32)
    of = np.repeat(np.arange(len(feats), dtype=np.int32), [len(x) for x in feats])
    groups, at, size = [], 0, 0
    for i, c in enumerate(chains):
        size += len(c)
        if size >= together or i == len(chains) - 1:
            groups.append((at, i + 1))
            at, size = i + 1, 0
    w, moves = np.zeros(1 << BITS), np.zeros(5)
    moves[4] = -3.0
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, moves)]
    for step in range(1, rounds + 1):
        odds = np.exp(np.clip(np.bincount(of, weights=w[flat], minlength=len(feats)), -30, 30))
        t = np.exp(moves)
        slope_moves, rest = np.zeros(5), np.zeros(len(feats))
        for a, b in groups:
            ids, y = np.concatenate(chains[a:b]), np.concatenate(tags[a:b]).astype(float)
            lengths = np.array([len(c) for c in chains[a:b]])
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            follows = np.ones(len(ids), bool)
            follows[starts] = False
            pairs = np.flatnonzero(follows)
            r = odds[ids]
            ahead, back = halves(r, starts, lengths, moves)
            p = ahead * back
            p /= 1 + p
            x, z = ahead[pairs - 1], (r * back)[pairs]  # marginals of neighbouring pairs
            whole = t[0] + t[1] * z + x * t[2] + x * t[3] * z
            before, now = y[pairs - 1], y[pairs]
            slope_moves += [((1 - before) * (1 - now) - t[0] / whole).sum(), ((1 - before) * now - t[1] * z / whole).sum(),
                            (before * (1 - now) - x * t[2] / whole).sum(), (before * now - x * t[3] * z / whole).sum(), (y[starts] - p[starts]).sum()]
            rest += np.bincount(ids, weights=y - p, minlength=len(feats))
        rest /= len(chains)
        slope = np.bincount(flat, weights=rest[of], minlength=len(w)) - ridge * w
        for v, g, (m, q) in zip((w, moves), (slope, slope_moves / len(chains)), state, strict=True):
            m += 0.1 * (g - m)
            q += 0.01 * (g * g - q)
            v += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.99 ** step)) + 1e-6)
    return {int(k): float(w[k]) for k in np.flatnonzero(np.abs(w) > 1e-6)}, moves.tolist()


class Odds(dict):
    """Each word's own odds, computed when first asked for; emptied when it holds very many words."""

    def __init__(self, emit: dict[int, float]):
        self.emit = emit

    def __missing__(self, word: str) -> float:
        if len(self) > 500_000:
            self.clear()
        get, total = self.emit.get, 0.0
        for f in features(word):
            total += get(f, 0.0)
        self[word] = x = math.exp(max(-30.0, min(30.0, total)))
        return x


def marginals(words: list[list[str]], model: Model, memory: Odds) -> list[np.ndarray]:
    """The probability of the toxic state for every word of every text."""
    own = [np.fromiter(map(memory.__getitem__, ws), dtype=float, count=len(ws)) for ws in words]
    if not own:
        return []
    r, begin, more = np.concatenate(own), np.cumsum([0] + [len(x) for x in own]), reach(model.moves)
    pieces = np.array([(at + f, at + t, at + a, at + b, f > 0) for at, x in zip(begin, own, strict=False) for f, t, a, b in cut(len(x), more)],
                      dtype=np.int64).reshape(-1, 5)
    lengths = pieces[:, 1] - pieces[:, 0]
    starts = np.cumsum(lengths) - lengths
    wide = r[np.arange(lengths.sum()) + np.repeat(pieces[:, 0] - starts, lengths)]
    ahead, back = halves(wide, starts, lengths, model.moves)
    p = ahead * back
    p /= 1 + p
    size = pieces[:, 3] - pieces[:, 2]
    out = np.empty(len(r))
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(pieces[:, 2], size) + inside] = p[np.repeat(starts + pieces[:, 2] - pieces[:, 0], size) + inside]
    return np.split(out, begin[1:-1])


def summary(p: np.ndarray) -> list[float]:
    """The strongest marginal as log odds and the expected number of words above one half."""
    top = float(p.max()) if len(p) else 0.0
    return [np.log((top + 1e-6) / (1 - top + 1e-6)) / 5, float(np.log1p(p[p >= 0.5].sum())), 1.0]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text",
        per_label: int = 2500) -> Model:
    """Learn from at most ``per_label`` whole texts of either label, drawn by a hash of their ids; texts of the same words
    count once.  The chains are the whole texts, as in scoring; the words of long ones are learned in pieces of
    ``CHAIN``.  Without labels of both kinds, or without any word that tells them apart, the model is the share of
    toxic ones."""
    rows, counts = label_sample(docs, labels, id_col, label_col, text_col, per_label)
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.5
    rows = list(dict.fromkeys(rows))  # copies count once
    by = {k: [t for t, y in rows if y == k] for k in (0, 1)}
    bad = lexicon(by[1], by[0])
    if not bad or not by[0]:
        return Model({}, [0.0] * 5, None, prior)
    number: dict[str, int] = {}  # words by number: their texts are kept once
    toxic: list[bool] = []
    chains, tags = [], []
    for k in (1, 0):
        for t in by[k]:
            ids = np.fromiter((number.setdefault(w, len(number)) for w in t.split()), np.int32)
            toxic += [not bad.isdisjoint(keys(w)) for w in itertools.islice(number, len(toxic), None)]
            mine = np.fromiter((toxic[i] for i in ids.tolist()), bool, len(ids)) if k else np.zeros(len(ids), bool)
            for i in range(0, len(ids), CHAIN):
                chains.append(ids[i:i + CHAIN]), tags.append(mine[i:i + CHAIN])
    if not chains:
        return Model({}, [0.0] * 5, None, prior)
    emit, moves = train(chains, tags, list(number))
    del chains, tags
    model = Model(emit, moves, None, prior)
    memory = Odds(emit)
    x = np.array([summary(p) for k in (0, 1) for t in by[k] for p in marginals([t.split()], model, memory)])
    y = np.repeat([0, 1], [len(by[0]), len(by[1])])
    share = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    model.scale = logistic(x, y, share).tolist()
    return model


def offsets(text: str, p: np.ndarray) -> list[dict[str, int]]:
    """Character ranges of the words whose marginal is one half or more; neighbours are joined."""
    out: list[dict[str, int]] = []
    last = -2
    for i, m in enumerate(re.finditer(r"\S+", text)):
        if i < len(p) and p[i] >= 0.5:
            if last == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = i
    return out


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted, spans) for every row, from its whole text alone; null and empty texts
    have no words and score as such."""

    def score(batches):
        memory = Odds(model.emit)
        for texts in batches:
            scores, spans, some, size = [], [], [], 0
            for i, t in enumerate(texts):
                some.append(t.as_py() or "")
                size += len(some[-1])
                if size < 1_000_000 and i < len(texts) - 1:
                    continue
                if model.scale is None:
                    scores += [model.prior] * len(some)
                    spans += [[]] * len(some)
                else:
                    probabilities = marginals([t.split() for t in some], model, memory)
                    x = np.array([summary(p) for p in probabilities]) @ np.array(model.scale)
                    scores += (1 / (1 + np.exp(-np.clip(x, -30, 30)))).tolist()
                    spans += [offsets(t, p) if len(p) and p.max() >= 0.5 else [] for t, p in zip(some, probabilities, strict=True)]
                some, size = [], 0
            yield [pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]

    return scored(docs, id_col, text_col, score, threshold, SPANS)
