"""FM-index over a sequence of symbols: a wavelet matrix under the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Symbols from 0 up, one packed bit vector a level, with running counts every 64 bits."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.size = len(symbols)
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, dtype="<u8")
            words.view(np.uint8)[:len(packed)] = packed
            before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]].astype(np.uint32)
            self.levels.append((words, before, int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[w].astype(np.int64) + np.bitwise_count(words[w] & low)

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` goes among the places of ``symbol`` (less the symbol's first place: its rank)."""
        for i, (words, before, zeros) in enumerate(self.levels):
            ones = self._ones(words, before, at)
            at = np.where(symbol >> (self.bits - 1 - i) & 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Backward search for patterns of up to ``longest`` symbols in ``text`` (symbols from 0 up).

    Suffixes are ordered by their first symbols, by doubling, as far as patterns reach: that is all that
    backward search needs."""

    def __init__(self, text: np.ndarray, longest: int):
        self.n, self.longest = len(text), longest
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        span, self.half = 1, (1, rank)
        while span <= longest and rank.max(initial=0) < self.n - 1 or span < 2:
            later = np.zeros(self.n, dtype=np.int64)
            later[:-span] = rank[span:] + 1
            rank = np.unique(rank * (self.n + 1) + later, return_inverse=True)[1].astype(np.int64)
            span *= 2
            if span <= longest:
                self.half = (span, rank)
        self.order = np.argsort(rank, kind="stable")
        last = text[self.order - 1]
        self.tree = WaveletMatrix(last.astype(np.int64))
        top = int(text.max(initial=0))
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=top + 1))]
        symbols = np.arange(top + 1)
        self.origin = self.tree.place(symbols, np.zeros(top + 1, dtype=np.int64))
        # suffixes that agree in their first ``longest`` symbols lie together; a suffix that is shorter is alone
        span, rank = self.half
        more = longest - span
        later = np.full(self.n, -1, dtype=np.int64)
        later[:self.n - more] = rank[more:]
        a, b = rank[self.order], later[self.order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (b[1:] < 0)]
        self.starts = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that start with ``symbol`` followed by those from ``low`` to ``high``."""
        move = self.first[symbol] - self.origin[symbol]
        return self.tree.place(symbol, low) + move, self.tree.place(symbol, high) + move

    def occurs(self, pattern: np.ndarray) -> bool:
        low, high = np.array([0]), np.array([self.n])
        for c in pattern[::-1]:
            if c < 0 or c >= len(self.origin):
                return False
            low, high = self.extend(np.array([c]), low, high)
            if low[0] >= high[0]:
                return False
        return True

    def matching_statistics(self, queries: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every position of every query, the length of the longest match that starts there, up to
        ``longest``, and a row of the index where it starts (-1: no match).  Symbols that the index lacks are
        negative.  All queries advance together, from their ends to their beginnings."""
        sizes = np.array([len(q) for q in queries], dtype=np.int64)
        flat = np.concatenate([*queries, np.zeros(0, np.int64)]).astype(np.int64)
        ends = np.cumsum(sizes)
        length, row = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        by = np.argsort(-sizes, kind="stable")
        low, high, now = np.zeros(len(by), np.int64), np.full(len(by), self.n, np.int64), np.zeros(len(by), np.int64)
        bounds = np.r_[self.starts, self.n]
        for step in range(int(sizes.max(initial=0))):
            k = int(np.searchsorted(-sizes[by], -step, side="left"))  # queries longer than step
            at = ends[by[:k]] - 1 - step
            symbol = flat[at]
            known = (symbol >= 0) & (symbol < len(self.origin))
            a, b = self.extend(np.where(known, symbol, 0), low[:k], high[:k])
            fits = known & (a < b)
            for j in np.flatnonzero(~fits):
                a[j], b[j], now[j] = self._shorter(flat[at[j]:at[j] + 1 + now[j]]) if known[j] else (0, self.n, -1)
            now[:k] += 1
            full = now[:k] > self.longest
            group = self.group[a[full]]
            a[full], b[full] = bounds[group], bounds[group + 1]
            now[:k][full] = self.longest
            low[:k], high[:k] = a, b
            length[at], row[at] = now[:k], np.where(now[:k] > 0, a, -1)
        cut = ends[:-1]
        return list(zip(np.split(length, cut), np.split(row, cut), strict=True)) if len(queries) else []

    def _shorter(self, pattern: np.ndarray) -> tuple[int, int, int]:
        """Interval of the longest beginning of ``pattern`` that occurs, and its length less one."""
        good, bad = 0, len(pattern)
        while bad - good > 1:
            middle = (good + bad) // 2
            if self.occurs(pattern[:middle]):
                good = middle
            else:
                bad = middle
        low, high = np.array([0]), np.array([self.n])
        for c in pattern[:good][::-1]:
            low, high = self.extend(np.array([c]), low, high)
        return int(low[0]), int(high[0]), good - 1
