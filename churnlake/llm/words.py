"""Words of many texts at once as NumPy arrays, without a Python object a word.

A batch of texts is walked in pieces of bounded size. Long texts are cut between
words, and a piece begins with the last ``overlap`` words of the one before, so
that every run of ``overlap + 1`` words lies whole in exactly one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

PIECE_BYTES = 1 << 21


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Look-up table of the bytes that part words, given as inclusive ranges."""
    t = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


#: [^\x20\x09-\x0D]+
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, of texts in ASCII lower case
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Piece:
    """Words of several texts: bytes, each word's span and text (row of the
    batch), and each word's number within its text. ``last[i]`` says whether the
    i-th text of ``texts`` ends in this piece."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    number: np.ndarray
    texts: list[int]
    last: list[bool]


def views(col: pa.Array) -> Iterator[np.ndarray]:
    """Each text's bytes (null: none)."""
    data = col.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset:data.offset + len(data) + 1]
    body = np.frombuffer(data.buffers()[2] or b"", dtype=np.uint8)
    valid = np.ones(len(data), dtype=bool) if not data.null_count else np.asarray(data.is_valid())
    for a, b, v in zip(offsets[:-1].tolist(), offsets[1:].tolist(), valid.tolist()):
        yield body[a:b] if v else body[:0]


def spans(data: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~parts[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(data) and inside[0]:
        edge = np.append(0, edge)
    if len(data) and inside[-1]:
        edge = np.append(edge, len(data))
    return edge[0::2], edge[1::2]


def _cut(text: np.ndarray, parts: np.ndarray, overlap: int, size: int) -> Iterator[tuple[np.ndarray, int, bool]]:
    """A long text's pieces: bytes, the number of the first word, whether it is the last."""
    at, first = 0, 0
    while True:
        end = at + size
        if end >= len(text):
            yield text[at:], first, True
            return
        while True:  # the cut falls on a separator; a single giant word stays whole
            gap = np.flatnonzero(parts[text[end:end + size]])
            if len(gap):
                end += int(gap[0])
                break
            end += size
            if end >= len(text):
                yield text[at:], first, True
                return
        a, _ = spans(text[at:end], parts)
        if len(a) <= overlap:
            size *= 2
            continue
        yield text[at:end], first, False
        first += len(a) - overlap
        at += int(a[len(a) - overlap]) if overlap else end - at


def pieces(col: pa.Array, parts: np.ndarray, lower: bool = False, overlap: int = 0,
           size: int = PIECE_BYTES) -> Iterator[Piece]:
    """The words of a column of texts. Every text of the column is named in one
    piece at least, in order; null is the empty text."""
    chunk: list[tuple[int, np.ndarray, int, bool]] = []
    held = 0

    def made() -> Piece:
        gap = np.full(1, 0x20, dtype=np.uint8)  # texts are parted by a blank
        blocks = [x for _, t, _, _ in chunk for x in (t, gap)]
        data = np.concatenate(blocks)
        if lower:
            data = LOWER[data]
        start, end = spans(data, parts)
        ends = np.cumsum([len(t) + 1 for _, t, _, _ in chunk])
        of = np.searchsorted(ends, start, side="right")
        lead = np.searchsorted(of, np.arange(len(chunk)))  # each text's first word here
        number = np.arange(len(start)) - lead[of] + np.array([f for _, _, f, _ in chunk])[of]
        rows = [r for r, _, _, _ in chunk]
        return Piece(data, start, end, np.array(rows)[of], number, rows, [x for _, _, _, x in chunk])

    for r, text in enumerate(views(col)):
        for part, first, last in (_cut(text, parts, overlap, size) if len(text) > size else [(text, 0, True)]):
            if chunk and held + len(part) > size:
                yield made()
                chunk, held = [], 0
            chunk.append((r, part, first, last))
            held += len(part)
    if chunk:
        yield made()


def joined(p: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The piece's words with one blank after each: bytes, starts, ends."""
    n = p.end - p.start + 1
    end = np.cumsum(n)
    at = np.repeat(p.start - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)
    data = np.append(p.data, np.uint8(0x20))[np.minimum(at, len(p.data))]
    data[end - 1] = 0x20
    return data, end - n, end - 1


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_LANES_UP_TO = 256


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span for choosing places, eight bytes a step; spans of
    over 256 bytes go to the library whole."""
    data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    h = (end - start).astype(np.uint64) * _MIX[0]
    i, at, left = slice(None), start, end - start
    long = np.flatnonzero(left > _LANES_UP_TO)
    while True:
        keep = np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
        x = (_lane(data, at) << keep) * _MIX[1]
        h[i] = ((h[i] ^ x ^ (x >> np.uint64(29))) * _MIX[0])
        more = np.flatnonzero((left > 8) & (end[i] - start[i] <= _LANES_UP_TO))
        if not len(more):
            break
        i = more if isinstance(i, slice) else i[more]
        at, left = at[more] + 8, left[more] - 8
    for k in long.tolist():
        h[k] = xxhash.xxh64_intdigest(data[start[k]:end[k]].tobytes())
    return h ^ (h >> np.uint64(32))


# XXH64's fixed values
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LIBRARY_FROM = 32  # spans of so many bytes go to the library


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _lane(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a little-endian integer; ``data`` is padded."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].view("<u8").ravel()


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """XXH64 of each span of bytes."""
    data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    size = end - start
    h = np.uint64(seed) + _P5 + size.astype(np.uint64)
    at = start.copy()
    for _ in range(3):
        i = np.flatnonzero((end - at >= 8) & (size < _LIBRARY_FROM))
        if not len(i):
            break
        k = _rot(_lane(data, at[i]) * _P2, 31) * _P1
        h[i] = _rot(h[i] ^ k, 27) * _P1 + _P4
        at[i] += 8
    i = np.flatnonzero((end - at >= 4) & (size < _LIBRARY_FROM))
    if len(i):
        k = (_lane(data, at[i]) & np.uint64(0xFFFFFFFF)) * _P1
        h[i] = _rot(h[i] ^ k, 23) * _P2 + _P3
        at[i] += 4
    for _ in range(3):
        i = np.flatnonzero((end - at >= 1) & (size < _LIBRARY_FROM))
        if not len(i):
            break
        h[i] = _rot(h[i] ^ (data[at[i]].astype(np.uint64) * _P5), 11) * _P1
        at[i] += 1
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= _LIBRARY_FROM).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes(), seed=seed)
    return h


class InternTable:
    """Open-addressed table of byte strings with linear probing.

    ``add`` takes spans of a byte array with their XXH64 keys and returns each
    span's slot. A slot is shared only by spans whose bytes are the same: keys
    choose where to look, the bytes decide. The table grows before it is half
    full. Slots number the strings in order of arrival and stay the same when it
    does; ``place`` leads from table places to them.
    """

    def __init__(self, places: int = 1 << 12):
        self.place = np.full(places, -1, dtype=np.int64)  # slot or -1
        self.n = 0
        self.key = np.empty(places, dtype=np.uint64)
        self.first = np.empty(places, dtype=np.int64)   # span of the slot's bytes
        self.size = np.empty(places, dtype=np.int64)
        self.count = np.zeros(places, dtype=np.int64)
        self.data = np.zeros(1 << 12, dtype=np.uint8)
        self.used = 0

    def _same(self, data, start, size, slot) -> np.ndarray:
        """Whether the spans hold the bytes of the given slots."""
        same = self.size[slot] == size
        i = np.flatnonzero(same)
        n, a, b = size[i], start[i], self.first[slot[i]]
        off = 0
        while len(i):
            left = n - off
            x, y = _lane(data, a + off), _lane(self.data, b + off)
            short = left < 8
            cut = np.where(short, np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64), np.uint64(0))
            bad = ((x ^ y) << np.minimum(cut, np.uint64(63))) != 0
            bad &= left > 0
            same[i[bad]] = False
            go = ~bad & (left > 8)
            i, n, a, b = i[go], n[go], a[go], b[go]
            off += 8
        return same

    def _grow(self, need: int) -> None:
        if 2 * need > len(self.place):
            places = 1 << int(2 * need).bit_length()
            for name in ("key", "first", "size", "count"):
                old = getattr(self, name)
                new = np.zeros(places, dtype=old.dtype)
                new[:self.n] = old[:self.n]
                setattr(self, name, new)
            self.place = np.full(places, -1, dtype=np.int64)
            self._put(np.arange(self.n))

    def _put(self, slots: np.ndarray) -> None:
        """Give places to slots that are in none (all of different bytes)."""
        mask = len(self.place) - 1
        at = (self.key[slots] & np.uint64(mask)).astype(np.int64)
        while len(slots):
            free = self.place[at] < 0
            self.place[at[free]] = slots[free]  # of several for one place the last stays
            left = self.place[at] != slots
            slots, at = slots[left], (at[left] + 1) & mask

    def add(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Each span's slot; spans are counted in their slots."""
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        out = np.full(len(start), -1, dtype=np.int64)
        size = end - start
        todo = np.arange(len(start))
        probe = np.zeros(len(start), dtype=np.int64)
        while len(todo):
            mask = len(self.place) - 1
            at = ((key[todo] & np.uint64(mask)).astype(np.int64) + probe[todo]) & mask
            slot = self.place[at]
            new = slot < 0
            if new.any():
                # of the spans that meet a free place the last to sign takes it; all of them look again
                spot, who = at[new], todo[new]
                self.place[spot] = -2 - who
                took = self.place[spot] == -2 - who
                spot, who = spot[took], who[took]
                self.place[spot] = -1
                if 2 * (self.n + len(who)) > len(self.place):
                    self._grow(2 * (self.n + len(who)))
                    probe[todo] = 0
                    continue
                self._take(data, start, size, key, who, spot)
                slot = self.place[at]
            hit = self.key[slot] == key[todo]
            i = np.flatnonzero(hit)
            hit[i] = self._same(padded, start[todo[i]], size[todo[i]], slot[i])
            out[todo[hit]] = slot[hit]
            todo = todo[~hit]
            probe[todo] += 1
        if len(out):
            self.count[:self.n] += np.bincount(out, minlength=self.n)
        return out

    def _take(self, data, start, size, key, spans, places) -> None:
        slots = self.n + np.arange(len(spans))
        self.key[slots], self.size[slots] = key[spans], size[spans]
        n = size[spans]
        total = int(n.sum())
        if self.used + total + 8 > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(len(self.data) + total + 8, dtype=np.uint8)])
        before = np.cumsum(n) - n
        self.first[slots] = self.used + before
        self.data[self.used:self.used + total] = data[np.repeat(start[spans] - before, n) + np.arange(total)]
        self.used += total
        self.place[places] = slots
        self.n += len(spans)

    def strings(self, since: int = 0) -> list[bytes]:
        """The bytes of the slots from ``since`` on."""
        body = self.data.tobytes()
        return [body[a:a + n] for a, n in zip(self.first[since:self.n].tolist(), self.size[since:self.n].tolist())]
