"""An FM-index over word ids: a wavelet matrix of the Burrows-Wheeler transform,
and truncated matching statistics by backward search, many texts at a time.

Suffixes are sorted by their first ``depth`` symbols. That is enough for patterns
of up to ``depth`` symbols, which is the threshold that callers ask about, and
keeps the sort at a few rounds however long the repeats are.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


class WaveletMatrix:
    """Bit-packed levels of a sequence of small integers with rank support."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.n = len(seq)
        self.levels = max(1, int(symbols - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        for b in range(self.levels - 1, -1, -1):
            bit = ((seq >> b) & 1).astype(bool)
            packed = np.zeros(8 * (self.n // 64 + 1), dtype=np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[:len(raw)] = raw
            words = packed.view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(self.n - int(ones.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.start = self._walk(np.arange(1 << self.levels), np.zeros(1 << self.levels, dtype=np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            block = at >> 6
            low = self.words[k][block] & ((_ONE << (at & 63).astype(np.uint64)) - _ONE)
            ones = self.before[k][block] + np.bitwise_count(low)
            bit = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._walk(symbol, at) - self.start[symbol]


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


class FMIndex:
    """Index of texts given as one array of ids 1.., parted and ended by 0.

    ``value`` holds a number per symbol; ``least(groups)`` gives the smallest one
    over the places where a pattern of ``depth`` symbols begins.
    """

    def __init__(self, text: np.ndarray, depth: int, value: np.ndarray):
        self.text, self.depth, self.n = text.astype(np.int64), depth, len(text)
        self.symbols = int(text.max()) + 1
        self._groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        key, shorter = self._key(depth)
        self.sa = np.argsort(key, kind="stable")
        self._bound(depth, key)
        if shorter is not None:
            self._bound(depth - 1, shorter)
        self.wavelet = WaveletMatrix(text[self.sa - 1], self.symbols)
        self.first = np.cumsum(np.append(0, np.bincount(text, minlength=self.symbols)[:-1]))
        self._least = np.minimum.reduceat(value[self.sa], self.groups(depth)[1][:-1])

    def _ahead(self, rank: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(self.n, dtype=np.int64)
        out[:max(0, self.n - k)] = rank[k:]
        return out

    def _key(self, d: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Numbers that order all suffixes by their first ``d`` symbols, and those
        of ``d - 1`` symbols if they were made on the way."""
        if self.symbols ** d < 2 ** 62:  # d symbols fit into one number
            key = np.zeros(self.n, dtype=np.int64)
            for k in range(d):
                key = key * self.symbols + self._ahead(self.text, k)
            return key, None
        if d % 2:
            rank = _dense(self._key(d - 1)[0])
            return rank * self.symbols + self._ahead(self.text, d - 1), rank
        rank = _dense(self._key(d // 2)[0])
        return rank * (int(rank.max()) + 1) + self._ahead(rank, d // 2), None

    def _bound(self, d: int, key: np.ndarray) -> None:
        order = key[self.sa]
        new = np.append(True, order[1:] != order[:-1])
        self._groups[d] = (np.cumsum(new, dtype=np.int32) - 1, np.append(np.flatnonzero(new), self.n))

    def groups(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Each suffix's group among those that share ``d`` symbols, and the groups' bounds."""
        if d not in self._groups:
            self._bound(d, self._key(d)[0] if d else np.zeros(self.n, dtype=np.int64))
        return self._groups[d]

    def least(self, lo: np.ndarray) -> np.ndarray:
        return self._least[self.groups(self.depth)[0][lo]]

    def matching_statistics(self, query: np.ndarray, start: np.ndarray, length: np.ndarray):
        """For every symbol of the texts ``query[start:start + length]``: the length of
        the longest run from it on that the index holds, ``depth`` at most, and the
        first row of that run's interval. Ids that the index lacks match nothing.

        Each text is read backwards, one step a symbol: the interval is extended by
        the symbol on its left; at full length, or when that fails, it first gives up
        symbols on its right (the enclosing group of suffixes).
        """
        matched, row = np.zeros(len(query), dtype=np.int64), np.zeros(len(query), dtype=np.int64)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        lo, hi = np.zeros(len(start), dtype=np.int64), np.full(len(start), self.n, dtype=np.int64)
        m = np.zeros(len(start), dtype=np.int64)
        for step in range(int(length.max()) if len(length) else 0):
            live = int(np.searchsorted(-length, -step, side="left"))
            at = start[:live] + length[:live] - 1 - step
            c = query[at]
            self._shrink(np.flatnonzero(m[:live] == self.depth), lo, hi, m)
            todo = np.arange(live)
            known = (c > 0) & (c < self.symbols)
            dead = todo[~known]
            lo[dead], hi[dead], m[dead] = 0, self.n, 0
            todo = todo[known]
            while len(todo):
                s = c[todo]
                ends = self.wavelet.rank(np.tile(s, 2), np.concatenate([lo[todo], hi[todo]]))
                a, b = self.first[s] + ends[:len(todo)], self.first[s] + ends[len(todo):]
                ok = a < b
                done = todo[ok]
                lo[done], hi[done] = a[ok], b[ok]
                m[done] += 1
                todo = todo[~ok]
                todo = todo[m[todo] > 0]
                self._shrink(todo, lo, hi, m)
            matched[at], row[at] = m[:live], lo[:live]
        return matched, row

    def _shrink(self, lanes: np.ndarray, lo: np.ndarray, hi: np.ndarray, m: np.ndarray) -> None:
        """Drop the last symbol of these lanes' runs."""
        m[lanes] -= 1
        for d in np.unique(m[lanes]).tolist():
            i = lanes[m[lanes] == d]
            group, bound = self.groups(d)
            g = group[lo[i]]
            lo[i], hi[i] = bound[g], bound[g + 1]
