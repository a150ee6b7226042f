"""Removal of word passages that an earlier document holds, by FM-index shards.

1. Every window of ``length`` words has an anchor, the least hash of its
   ``GRAM``-word runs. Windows of the same words have the same anchor, so only
   anchors that several documents hold matter. They are counted by a combined
   group count and joined back to (document, anchor); neither step moves text.
2. Documents with such anchors cut their texts into runs of neighbouring windows
   of one anchor. Equal runs of a batch are combined: the smallest document asks
   for all, the others already know that theirs are repeats.
3. Asking runs are dealt by anchor to shards of about ``SHARD_RUNS`` runs, a
   number that follows the count of step 1. An anchor of more than ``HOT``
   documents is dealt window by window instead, by the hash of the whole window,
   so that no anchor is one shard.
4. A shard builds an FM-index over its distinct runs, streams them backwards
   through it, and where the matching statistics reach ``length`` takes the
   smallest document that holds the window. Windows of an earlier document are
   reported as intervals of words.
5. Intervals go back to the documents, which drop the words and hash the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import materialise
from churnlake.llm.fm_index import FMIndex
from churnlake.llm.words import WHITE, Piece, joined, pieces, span_hash

GRAM = 4
SHARD_RUNS = 50_000
HOT = 5_000
RUN_WINDOWS = 32  # longer runs, of texts that repeat a few words, are cut; windows stay whole
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
ASKS = "place long, doc_id long, part int, digest long, at array<long>, words string, spans array<long>"


def _chained(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each on (the last k - 1 places mean nothing)."""
    g = np.zeros(len(h), dtype=np.uint64)
    for j in range(k):
        g = (g * _MIX[0]) ^ np.append(h[j:], np.zeros(min(j, len(h)), dtype=np.uint64))
        g = (g ^ (g >> np.uint64(29))) * _MIX[1]
    return g ^ (g >> np.uint64(32))


def _sliding_min(g: np.ndarray, k: int) -> np.ndarray:
    size, out = 1, g
    while size < k:
        step = min(size, k - size)
        out = np.minimum(out, np.append(out[step:], np.full(min(step, len(g)), np.uint64(2**64 - 1))))
        size += step
    return out


def windows(p: Piece, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words (indices into the piece) of its windows, their anchors, and all words' hashes."""
    h = span_hash(p.data, p.start, p.end)
    k = min(GRAM, length)
    anchor = _sliding_min(_chained(h, k), length - k + 1).view(np.int64)
    stop = np.searchsorted(p.row, p.row, side="right")
    first = np.flatnonzero(np.arange(len(h)) + length <= stop)
    return first, anchor[first], h


def _unique_pairs(row: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((anchor, row))
    row, anchor = row[order], anchor[order]
    new = np.append(True, (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]))[:len(row)]
    return row[new], anchor[new]


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, part, anchor``: the different anchors of every document."""

    def run(batches):
        for b in batches:
            ids, parts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for p in pieces(b.column(2), WHITE, overlap=length - 1):
                first, anchor, _ = windows(p, length)
                row, anchor = _unique_pairs(p.row[first], anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row], pa.int64()), pa.array(parts[row], pa.int32()), pa.array(anchor)],
                    ["doc_id", "part", "anchor"])

    return docs.mapInArrow(run, "doc_id long, part int, anchor long")


def _runs(p: Piece, length: int, wanted: np.ndarray, hot: np.ndarray):
    """The runs of wanted anchors: dealing key, first word, words."""
    first, anchor, h = windows(p, length)
    keep = np.isin(anchor, wanted)
    first, anchor = first[keep], anchor[keep]
    is_hot = np.isin(anchor, hot)
    n = len(first)
    cut = np.ones(n, dtype=bool)
    cut[1:] = (first[1:] != first[:-1] + 1) | (anchor[1:] != anchor[:-1]) | is_hot[1:]
    begin = np.flatnonzero(cut)
    since = np.arange(n) - begin[np.cumsum(cut) - 1] if n else begin
    begin = np.flatnonzero(since % RUN_WINDOWS == 0)
    count = np.diff(np.append(begin, n))
    key = np.where(is_hot, _chained(h, length).view(np.int64)[first], anchor)[begin] if n else anchor
    return key, first[begin], count + length - 1


def _digest(text: bytes) -> int:
    """Tells apart the texts of one doc_id."""
    h = xxhash.xxh64_intdigest(text, seed=42)
    return h - (1 << 64) if h >> 63 else h


def asks(docs: DataFrame, length: int) -> DataFrame:
    """Asking runs (``words``) and known repeats (``spans``) of documents with
    ``wanted`` and ``hot`` anchors."""

    def run(batches):
        for b in batches:
            col = {f: b.column(i) for i, f in enumerate(b.schema.names)}
            if not len(col["wanted"].flatten()):
                continue
            wanted = np.unique(col["wanted"].flatten().to_numpy(zero_copy_only=False))
            hot = np.unique(col["hot"].flatten().to_numpy(zero_copy_only=False))
            has = np.asarray(pa.compute.greater(pa.compute.list_value_length(col["wanted"]), 0).fill_null(False))
            texts = col["text"].filter(pa.array(has))
            ids = col["doc_id"].to_numpy(zero_copy_only=False)[has]
            part = col["part"].to_numpy(zero_copy_only=False)[has]
            digest = [_digest(t) for t in texts.cast(pa.binary()).to_pylist()]
            met: dict[bytes, tuple[int, list[tuple[int, int]]]] = {}
            for p in pieces(texts, WHITE, overlap=length - 1):
                key, at, size = _runs(p, length, wanted, hot)
                data, start, end = joined(p)
                body = data.tobytes()
                a, z = start[at].tolist(), end[at + size - 1].tolist()
                for k, x, y, r, n in zip(key.tolist(), a, z, p.row[at].tolist(), p.number[at].tolist()):
                    run_words = body[x:y]
                    own = met.get(run_words)
                    if own is None:
                        met[run_words] = own = (k, [])
                    own[1].append((r, n))
            out: list[tuple] = []
            known: dict[int, list[int]] = {}
            for run_words, (k, places) in met.items():
                least = min(int(ids[r]) for r, _ in places)
                mine: dict[tuple, list[int]] = {}
                for r, n in places:
                    if ids[r] == least:
                        mine.setdefault((digest[r], int(part[r])), []).append(n)
                    else:
                        known.setdefault(r, []).extend((n, n + run_words.count(b" ") + 1))
                for (d, q), at in mine.items():
                    out.append((k, least, q, d, sorted(set(at)), run_words.decode("utf-8", "surrogatepass"), None))
            for r, spans in known.items():
                out.append((digest[r], int(ids[r]), int(part[r]), digest[r], None, None, _merged(spans)))
            for i in range(0, len(out), 20_000):
                some = list(zip(*out[i:i + 20_000]))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.string(),
                         pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(some, kinds)],
                                                 ["place", "doc_id", "part", "digest", "at", "words", "spans"])

    return docs.mapInArrow(run, ASKS)


def _merged(spans: list[int]) -> list[int]:
    """Flat [start, end) pairs, overlapping ones joined, in order."""
    a, b = np.array(spans[0::2], dtype=np.int64), np.array(spans[1::2], dtype=np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.append(True, a[1:] > b[:-1])[:len(a)]
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1) if len(a) else []
    return np.stack([a[new], b[ends]], axis=1).ravel().tolist() if len(a) else []


def first_holders(texts: list[bytes], holder: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For distinct runs of words and the smallest document that has each: the
    smallest document that holds the window beginning at each word (the largest
    long where no window begins), and the runs' first words in that array."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 0x0A)
    stop = np.flatnonzero((data == 0x0A) | (data == 0x20)) + 1  # a word and the one byte after it
    n = np.diff(np.append(0, np.searchsorted(stop, ends + 1, side="right")))
    body = np.where(data == 0x0A, np.uint8(0x20), data)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stop), [
        None, pa.py_buffer(np.append(0, stop).astype(np.int64)), pa.py_buffer(body)])
    ids = words.dictionary_encode().indices.to_numpy() + 1
    start = np.cumsum(n + 1) - (n + 1)
    owner = np.repeat(np.arange(len(n)), n + 1)
    text = np.zeros(len(owner), dtype=np.int64)
    text[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
    begins = np.arange(len(text)) + length <= (start + n)[owner]
    first = np.where(begins, holder[owner], np.int64(2**63 - 1))
    # a run all of whose windows' hashes are met once here holds no other run's window
    at = np.flatnonzero(begins)
    _, of, met = np.unique(_chained(text.astype(np.uint64), length)[at], return_inverse=True, return_counts=True)
    shared = np.zeros(len(n), dtype=bool)
    shared[owner[at[met[of] > 1]]] = True
    if shared.any():
        into = shared[owner]
        text, n = text[into], n[shared]
        index = FMIndex(np.unique(text, return_inverse=True)[1], length, holder[owner][into])
        begin = np.cumsum(n + 1) - (n + 1)
        matched, row = index.matching_statistics(index.text, begin, n)
        first[into] = np.where(matched == length, index.least(row), np.int64(2**63 - 1))
    return first, start


def repeats(rows: pa.Table, length: int) -> pa.Table:
    """One shard: its asking runs' repeated intervals, and the known ones passed on."""
    col = {f: rows.column(f).combine_chunks() for f in rows.schema.names}
    words = [None if w is None else w.encode("utf-8", "surrogatepass") for w in col["words"].to_pylist()]
    ids, at, spans = col["doc_id"].to_pylist(), col["at"].to_pylist(), col["spans"].to_pylist()
    least: dict[bytes, int] = {}
    for w, d in zip(words, ids):
        if w is not None and d < least.get(w, 1 << 63):
            least[w] = d
    first, start = None, {}
    if least:
        texts = list(least)
        first, begin = first_holders(texts, np.array([least[t] for t in texts], dtype=np.int64), length)
        start = dict(zip(texts, begin.tolist()))
    found: list[list[int] | None] = []
    for w, d, places, known in zip(words, ids, at, spans):
        if w is None:
            found.append(known)
            continue
        n, s = w.count(b" ") + 1, start[w]
        again = np.flatnonzero(first[s:s + n] < d)
        found.append(_merged([x for p in places for i in again.tolist() for x in (p + i, p + i + length)])
                     if len(again) else None)
    keep = np.array([f is not None for f in found], dtype=bool)
    mask = pa.array(keep)
    return pa.table({"doc_id": col["doc_id"].filter(mask), "part": col["part"].filter(mask),
                     "digest": col["digest"].filter(mask),
                     "spans": pa.array([f for f in found if f is not None], pa.list_(pa.int64()))})


def _kept(text: bytes, spans: list[int], with_text: bool) -> tuple:
    """Words, removed words, the SHA-256 of the kept ones joined by blanks, and on
    request those themselves."""
    words = text.split()
    n, at, parts = len(words), 0, []
    for a, b in zip(spans[0::2], spans[1::2]):
        parts += words[at:a]
        at = b
    kept = b" ".join(parts + words[at:] if spans else words)
    got = (n, n - (len(parts) + n - at), hashlib.sha256(kept).hexdigest())
    return (*got, kept.decode("utf-8", "surrogatepass")) if with_text else got


def dedupe(docs: DataFrame, length: int = 13, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``; with
    ``with_text`` also ``kept``, the text that is left (words joined by a blank).

    A word goes if a window of ``length`` words of its document covers it whose
    words in a row also begin in a document of a smaller doc_id; all windows are
    judged on the input. A null or empty text has no words. A row whose doc_id is
    null loses nothing and makes no other row lose anything, having no place in
    the order; rows of the same doc_id do not count as smaller than each other,
    and each is judged by its own text. Texts of fewer words than a window stay
    whole. Very long texts are walked in overlapping pieces. An empty table gives
    no rows; other columns are not read.
    """
    if length < 1:
        raise ValueError("length must be at least 1")
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 16)).cast("int").alias("part")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.select("doc_id", part, "text")
    held = anchors(base.filter("doc_id is not null and text is not null"), length)
    # a document counts once an anchor; repeated rows may count again, which only makes more candidates
    common = materialise(held.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                         .select("anchor", "n", (F.col("n") > HOT).alias("hot")), "anchors")
    total = common.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_RUNS))
    wanted = (held.join(common.select("anchor", "hot"), "anchor").groupBy("doc_id", "part")
              .agg(F.collect_set("anchor").alias("wanted"),
                   F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot")))
    found = (asks(base.join(wanted, ["doc_id", "part"], "left"), length)
             .withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)))
             .groupBy("shard").applyInArrow(lambda t: repeats(t, length),
                                            "doc_id long, part int, digest long, spans array<long>")
             .groupBy("doc_id", "part").agg(F.collect_list(F.struct("digest", "spans")).alias("found")))

    def run(batches):
        for b in batches:
            out = []
            for d, text, found in zip(b.column(0).to_pylist(), b.column(2).cast(pa.binary()), b.column(3)):
                text = text.as_py() or b""
                spans: list[int] = []
                if found.is_valid:
                    own = _digest(text)
                    spans = _merged([x for f in found.as_py() if f["digest"] == own for x in f["spans"]])
                out.append((d, *_kept(text, spans, with_text)))
            cols = list(zip(*out)) or [[]] * (5 if with_text else 4)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names[:len(cols)])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else "")
    return base.join(found, ["doc_id", "part"], "left").select("doc_id", "part", "text", "found").mapInArrow(run, schema)

