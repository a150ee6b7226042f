"""Best-fit decreasing packing of token sequences.

The outcome of best-fit decreasing depends on the lengths alone, and a length is
at most the capacity. The lengths' histogram (at most ``capacity`` rows, whatever
the corpus) therefore decides everything: ``plan`` runs best-fit decreasing over
it, holding equal bins as one run of consecutive sequence ids, and finds the
tightest open bin with a segment tree over remaining capacities. Its rows say
which ranks of a length go to which sequences; Spark numbers the pieces within
their lengths and joins them to those rows. The bins are those that a packer
going through all documents one by one would open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import buckets_for, materialise, prefix_sums

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BUCKET_ROWS = 2048


class CapacityTree:
    """Segment tree over 0..capacity: which remaining capacities have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, capacity.bit_length())
        self.any = bytearray(2 * self.size)

    def set(self, at: int, present: bool) -> None:
        i = at + self.size
        self.any[i] = present
        i >>= 1
        while i:
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]
            i >>= 1

    def first_from(self, at: int) -> int:
        """The smallest present index of at least ``at``, or -1."""
        i = at + self.size
        if self.any[i]:
            return at
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def plan(histogram: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``(length, count)`` rows.

    Returns ``(length, first_rank, bins, per_bin, first_sequence, offset)`` rows:
    the items of that length with ranks from ``first_rank`` on fill ``bins``
    consecutive sequences with ``per_bin`` items each, the first at ``offset``.
    """
    tree, open_bins = CapacityTree(capacity), {}  # remaining -> [(first sequence, bins)]
    rows, next_id = [], 0

    def put(left: int, first: int, bins: int) -> None:
        if bins and left:
            open_bins.setdefault(left, []).append((first, bins))
            tree.set(left, True)

    for length, count in sorted(histogram, reverse=True):
        rank = 0
        while count:
            left = tree.first_from(length)
            if left < 0:
                left, first = capacity, next_id
                bins = -(-count // (capacity // length))
                next_id += bins
            else:
                first, bins = open_bins[left].pop()
                if not open_bins[left]:
                    tree.set(left, False)
            # the bin just used is the tightest one until the length no longer fits
            per = left // length
            full = min(bins, count // per)
            if full:
                use, each = full, per
            else:
                use, each = 1, count
            rows.append((length, rank, use, each, first, capacity - left))
            rank += use * each
            count -= use * each
            put(left - each * length, first, use)
            if bins > use:
                if left == capacity:  # opened just now for the rest of this length
                    next_id = first + use
                else:
                    put(left, first + use, bins - use)
    return rows


def pieces(docs: DataFrame, tokenizer_path: str, kind: str, end_id: int, capacity: int,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every whole text: ids, then ``end_id``; documents of more
    than ``capacity`` ids are cut, only the last piece is shorter."""

    def run(batches):
        from churnlake.llm.encode import encoder
        enc, end = encoder(tokenizer_path, kind), end_id.to_bytes(4, "little")
        step = 4 * capacity
        for b in batches:
            out = ([], [], [], [], [])
            for d, ids in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                ids += end
                for n, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at:at + step]
                    for col, v in zip(out, (d, n, at // 4, len(cut) // 4, zlib.crc32(cut))):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
        enc.rest()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def pack_pieces(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (a fixed table with ``doc_id``, ``piece``, ``length`` in
    1..capacity) with ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    hist = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # at most one row per length, and a bounded number of plan rows for each
    by_length = spark.createDataFrame([(k, n) for k, n in hist.items()], "length long, n long")
    rows = spark.createDataFrame(plan(hist.items(), capacity),
                                 "length long, first_rank long, bins long, per_bin long, first_seq long, at long")
    order = ["doc_id", "piece", "ids_crc32"]
    one = F.lit(1).cast("long")
    spread = (items.join(F.broadcast(by_length), "length")
              .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), buckets_for(F.col("n"), _BUCKET_ROWS)))
              .drop("n").withColumn("one", one))
    ranked = prefix_sums(spread, ["length"], "bucket", order, "one", "rank").drop("bucket", "one")
    hit = ranked.join(F.broadcast(rows), "length").filter(
        "rank >= first_rank and rank < first_rank + bins * per_bin")
    r = F.col("rank") - F.col("first_rank")
    return hit.select(*items.columns,
                      (F.col("first_seq") + F.floor(r / F.col("per_bin"))).cast("long").alias("sequence_id"),
                      (F.col("at") + F.pmod(r, F.col("per_bin")) * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, kind: str = "word", end_id: int = 1, capacity: int = 4096,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Every document has at least its end id, so null and empty texts
    give one piece of length 1. Null and repeated ids are kept, each row as a
    document of its own. An empty table gives no rows; other columns are not
    read."""
    items = materialise(pieces(docs, tokenizer_path, kind, end_id, capacity, doc_id, text), "pieces")
    return pack_pieces(items, capacity)
