"""Word-level FM-index of a shard of documents: full suffix order, wavelet ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

from .fmindex import WaveletMatrix

#: One suffix position is kept in so many words, and that of every document's first word, so no walk passes a 0.
SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``text`` (symbols from 0 up) in their order.

    By as many symbols as a number holds to begin with, then by doubling; each round sorts only what still ties."""
    n = len(text)
    bits = int(text.max(initial=0) + 1).bit_length()
    span = min(8, max(1, 63 // bits))
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(span, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(span):
        key = (key << bits) | padded[i:i + n]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)  # place of a suffix's group: the number of suffixes before it

    def regroup(places: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Set the ranks of the suffixes at ``places`` (ascending) where ``new`` marks first ones; the places left."""
        first = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        rank[order[places]] = first
        lone = new & np.r_[new[1:], True]
        return places[~lone]

    k = key[order]
    left = regroup(np.arange(n), np.r_[True, k[1:] != k[:-1]][:n])
    while len(left):
        at = order[left]
        group = rank[at]
        later = np.where(at + span < n, rank[np.minimum(at + span, n - 1)] + 1, 0)
        by = np.argsort(group * (n + 1) + later)  # n is far below 2**31: a text's bytes are
        order[left] = at[by]
        g, x = group[by], later[by]
        left = regroup(left, np.r_[True, (g[1:] != g[:-1]) | (x[1:] != x[:-1])])
        span *= 2
    return order


class WordIndex:
    """Backward search and location in ``text``, whose last symbol is 0, a symbol below all others."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        order = suffix_order(text)
        last = text[order - 1].astype(np.int64)
        self.tree = WaveletMatrix(last)
        top = int(text.max(initial=0))
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=top + 1))]
        self.origin = self.tree.place(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))
        # rows whose suffix starts at a multiple of SAMPLE or behind a 0: a bit for each, running counts, the positions
        kept = (order % SAMPLE == 0) | (last == 0)
        packed = np.packbits(kept, bitorder="little")
        self.marks = np.zeros(self.n // 64 + 1, dtype="<u8")
        self.marks.view(np.uint8)[:len(packed)] = packed
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)[:-1]]
        self.positions = order[kept]

    # -- as a row of a table ----------------------------------------------------------------------------------
    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.tree.bits, len(self.first), len(self.positions), *[z for _, _, z in self.tree.levels]], "<i8")
        parts = [np.array([len(head)], "<i8"), head, self.first.astype("<i8"), self.marks, self.positions.astype("<u4"),
                 *[words for words, _, _ in self.tree.levels]]
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data) -> WordIndex:
        at = 8 * (1 + int(np.frombuffer(data, "<i8", 1)[0]))
        n, bits, n_first, n_kept, *zeros = np.frombuffer(data, "<i8", at // 8 - 1, 8).tolist()
        self, words = cls.__new__(cls), n // 64 + 1

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.n, self.first, self.marks = n, take("<i8", n_first), take("<u8", words)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)[:-1]]
        self.positions = take("<u4", n_kept).astype(np.int64)
        tree = WaveletMatrix.__new__(WaveletMatrix)
        tree.bits, tree.size, tree.levels = bits, n, []
        for z in zeros:
            level = take("<u8", words)
            tree.levels.append((level, np.r_[0, np.cumsum(np.bitwise_count(level), dtype=np.int64)[:-1]].astype(np.uint32), z))
        self.tree = tree
        self.origin = tree.place(np.arange(n_first - 1), np.zeros(n_first - 1, dtype=np.int64))
        return self

    # -- search ---------------------------------------------------------------------------------------------
    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (from, past the last) of each pattern, a row of a matrix of symbols; -1 is a symbol the text lacks.
        All patterns advance together, from their last symbols on; one that no suffix starts with is left out."""
        low, high = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        live = np.flatnonzero((patterns >= 0).all(axis=1))
        a, b = np.zeros(len(live), np.int64), np.full(len(live), self.n, np.int64)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[live, column]
            move = self.first[symbol] - self.origin[symbol]
            a, b = self.tree.place(symbol, a) + move, self.tree.place(symbol, b) + move
            some = a < b
            live, a, b = live[some], a[some], b[some]
        low[live], high[live] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of the rows start: each walks back, word by word, to a kept position."""
        out, walk, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(walk):
            word, bit = rows >> 6, (rows & 63).astype(np.uint64)
            kept = (self.marks[word] >> bit & np.uint64(1)).astype(bool)
            w, low = word[kept], (np.uint64(1) << bit[kept]) - np.uint64(1)
            out[walk[kept]] = self.positions[self.before[w] + np.bitwise_count(self.marks[w] & low)] + steps
            walk, rows, steps = walk[~kept], self._back(rows[~kept]), steps + 1
        return out

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol, at = np.zeros(len(rows), np.int64), rows
        for words, before, zeros in self.tree.levels:
            bit = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)
            ones = WaveletMatrix._ones(words, before, at)
            at = np.where(bit, zeros + ones, at - ones)
            symbol = symbol << 1 | bit
        return at + self.first[symbol] - self.origin[symbol]
