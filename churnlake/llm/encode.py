"""Exact encoding with a ``tokenizers`` file, pre-token by pre-token.

Both public vocabularies used here merge bytes only inside white-space separated
segments, so the ids of a text are the ids of its segments in a row. The texts of
a batch are cut into segments by NumPy, numbered by Arrow's dictionary, and each
distinct segment is looked up once; a worker keeps the ids of the segments it has
met, each encoded once by the library. Texts with blanks or marks beyond ASCII are
cut by the patterns below one by one; texts that hold a special token's string go
to the library whole.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa

from churnlake.llm.common import give_back
from churnlake.llm.words import LOWER, WHITE, spans, views

# Unicode White_Space, the class that the vocabularies' patterns call \s
_WS = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SEGMENTS = {
    # a run of white space gives its last blank to the word that follows
    "byte": re.compile(f"[{_WS}]+(?![^{_WS}])| ?[^{_WS}]+|[{_WS}]+"),
    # white space only separates
    "word": re.compile(f"[^{_WS}]+"),
}
# marks that may join an ASCII letter into one character, differently by case
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
CACHE_SEGMENTS = 300_000  # of two generations each; results do not depend on it
KEPT_SEGMENTS = 150_000    # between two tasks
CACHE_CHARS = 48          # longer segments hardly repeat
_CHUNK_BYTES = 8 << 20
# UTF-8 of blanks and marks beyond ASCII, and the bytes that may begin one
_ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|"
                  rb"[\xcc\xcd]|\xe1\xaa[\xb0-\xbf]|\xe1\xab|\xe1\xb7|\xe2\x83[\x90-\xbf]|\xef\xb8[\xa0-\xaf]")
_MAYBE_ODD = np.zeros(256, dtype=bool)
_MAYBE_ODD[[0xC2, 0xCC, 0xCD, 0xE1, 0xE2, 0xE3, 0xEF]] = True


class Encoder:
    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        self.find = SEGMENTS[kind].findall
        self.kind = kind
        # a word of letters ends, or with its blank begins, at a token known by its mark
        mark = (lambda t: t.endswith("</w>")) if kind == "word" else (lambda t: t.startswith("\u0120"))
        self.marked = np.array([mark(self.tk.id_to_token(i) or "") for i in range(self.tk.get_vocab_size())])
        self.point = {c: np.array(self.tk.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes() for c in ".,"}
        self.separator = self.tk.encode("\n" if kind == "byte" else "|", add_special_tokens=False).ids[0]
        self.special = [t.content for t in self.tk.get_added_tokens_decoder().values()]
        self.special_bytes = [s.encode() for s in self.special]
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def vocab_size(self) -> int:
        return self.tk.get_vocab_size()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null is the empty text."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return np.array(self.tk.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if self.kind == "word" and (text.isascii() or not _MARKS.search(text)):
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        segs = self.find(text)
        own = list(dict.fromkeys(segs))
        return b"".join(map(dict(zip(own, self._looked_up(own))).get, segs))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of every text of a column."""
        out: list[bytes] = [b""] * len(texts)
        chunk, held = [], 0
        for i, t in enumerate(views(texts)):
            if not len(t):
                continue
            if len(t) > _CHUNK_BYTES or self._is_odd(t):
                out[i] = self.encode(t.tobytes().decode())
                continue
            if held + len(t) > _CHUNK_BYTES:
                self._encode_chunk(chunk, out)
                chunk, held = [], 0
            chunk.append((i, t))
            held += len(t)
        if chunk:
            self._encode_chunk(chunk, out)
        return out

    def _is_odd(self, t: np.ndarray) -> bool:
        body = t.tobytes()
        return (any(s in body for s in self.special_bytes)
                or bool(_MAYBE_ODD[t].any()) and _ODD.search(body) is not None)

    def _encode_chunk(self, chunk: list[tuple[int, np.ndarray]], out: list[bytes]) -> None:
        line = np.full(1, 0x0A, dtype=np.uint8)  # ends each text, and is no part of it
        data = np.concatenate([x for _, t in chunk for x in (t, line)])
        stop = np.cumsum([len(t) + 1 for _, t in chunk]) - 1
        if self.kind == "word":
            data = LOWER[data]
        start, end = spans(data, WHITE)
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[-1] = cut[0] = cut[end] = cut[stop] = cut[stop + 1] = True
        if self.kind == "word":
            cut[start] = True
        else:  # a blank goes with the word, another last white space stands alone
            head = np.zeros(len(data) + 1, dtype=bool)
            head[0] = head[stop + 1] = True
            head = head[start]
            cut[start[head]] = True
            inner = start[~head]
            cut[inner - 1] = True
            cut[inner[data[inner - 1] != 0x20]] = True
        at = np.flatnonzero(cut).astype(np.int32)  # a chunk has far fewer bytes and ids than 2**31
        items = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
        named = items.dictionary_encode()
        which, first, values = named.indices.to_numpy(), at[:-1], named.dictionary
        if self.kind == "word":
            kept = np.zeros(len(data), dtype=bool)
            kept[start] = True
        else:
            kept = np.ones(len(data), dtype=bool)
            kept[stop] = False
        kept = kept[first]
        which, first = which[kept], first[kept]
        upto = np.searchsorted(first, stop.astype(np.int32))  # segments up to the end of each text
        if self.kind == "word":  # without the separators
            used = np.zeros(len(values), dtype=bool)
            used[which] = True
            values = values.take(pa.array(np.flatnonzero(used)))
            which = (np.cumsum(used, dtype=np.int32) - 1)[which]
        del data, cut, at, items, named, kept, first
        parts = self._looked_up(values.to_pylist())
        size = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        n = size[which]
        total = np.cumsum(n, dtype=np.int32)
        place = np.repeat((np.cumsum(size, dtype=np.int32) - size)[which] - (total - n), n)
        place += np.arange(len(place), dtype=np.int32)
        ends = np.append(np.int32(0), total)[upto].tolist()
        body, a = flat[place].tobytes(), 0
        for (i, _), b in zip(chunk, ends):
            out[i], a = body[4 * a:4 * b], b

    def _looked_up(self, segs: list[str]) -> list[bytes]:
        """The ids of each distinct segment."""
        if len(self.cache) > CACHE_SEGMENTS:
            self.before, self.cache = self.cache, {}
        parts = list(map(self.cache.get, segs))
        at = [i for i, p in enumerate(parts) if p is None]
        if at:
            new = [segs[i] for i in at]
            self._learn(new)
            for i in at:
                parts[i] = self.cache[segs[i]]
            for s in new:
                if len(s) > CACHE_CHARS:
                    del self.cache[s]
        return parts

    def rest(self) -> None:
        """Give memory back at the end of a task: the segments met first, among them
        the frequent ones, stay for the worker's next task."""
        self.before = {}
        self.cache = dict(itertools.islice(self.cache.items(), KEPT_SEGMENTS))
        give_back()

    def _learn(self, new: list[str]) -> None:
        """Fill the cache. A comma or full stop after a letter that ends a segment
        is a pre-token of its own, so the segment's ids are those of its word and
        of the point. Words of letters are encoded in one text and cut at their
        marks, most other segments in one text with separators."""
        cache, before = self.cache, self.before
        todo, pointed = set(), []
        for s in new:
            ids = before.get(s)
            if ids is None and s[-1] in ".," and s[-2:-1].lower().isalpha():
                pointed.append(s)
                s = s[:-1]
                if s in cache:
                    continue
                ids = before.get(s)
            if ids is None:
                todo.add(s)
            else:
                cache[s] = ids
        byte = self.kind == "byte"
        words = [s for s in todo if (s[1:].isalpha() and s[0] == " " if byte else s.isalpha())]
        self._cut_at_marks(words, byte)
        rest = [s for s in todo if s not in cache]
        # a line feed stands alone before a blank or a word, a bar between blanks
        self._cut_at_separators([s for s in rest if not s.isspace() and (byte or "|" not in s)], byte)
        odd = [s for s in rest if s not in cache]
        for s, e in zip(odd, self.tk.encode_batch_fast(odd, add_special_tokens=False)):
            cache[s] = np.array(e.ids, dtype="<u4").tobytes()
        for s in pointed:
            cache[s] = cache[s[:-1]] + self.point[s[-1]]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tk.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _store(self, segs: list[str], ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        data = ids.tobytes()
        for s, a, b in zip(segs, (4 * begin).tolist(), (4 * end).tolist()):
            self.cache[s] = data[a:b]

    def _cut_at_marks(self, words: list[str], byte: bool) -> None:
        if not words:
            return
        ids = self._ids(("" if byte else " ").join(words))
        at = np.flatnonzero(self.marked[ids])
        cut = np.append(at, len(ids)) if byte else np.append(0, at + 1)
        if len(cut) == len(words) + 1:  # else a letter's lower case holds a mark that parts the word
            self._store(words, ids, cut[:-1], cut[1:])

    def _cut_at_separators(self, segs: list[str], byte: bool) -> None:
        if not segs:
            return
        ids = self._ids(("\n" if byte else " | ").join(segs))
        at = np.flatnonzero(ids == self.separator)
        if len(at) == len(segs) - 1:
            self._store(segs, ids, np.append(0, at + 1), np.append(at, len(ids)))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    key = (path, kind)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, kind)
    return _ENCODERS[key]
