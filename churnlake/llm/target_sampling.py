"""Importance resampling towards a target distribution of hashed n-grams.

Every n-gram falls into one of ``buckets`` buckets. Bucket counts over all
documents and over the target texts give a gain per bucket, a document's weight
is the sum of its n-grams' gains, and a Gumbel-noised top share is drawn.

Inside a task the n-grams of an Arrow batch are interned in an open-addressed
NumPy table (``words.InternTable``: xxhash64 keys, verified by bytes). CRC-32 and
bucket are computed once per distinct n-gram; a slot stores the bucket and the
number of occurrences, and the slot ids of the occurrences gather the gains. What
leaves a task is at most one row per bucket, or one row per document.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import running_totals
from churnlake.llm.common import materialise
from churnlake.llm.words import NOT_ALNUM, InternTable, Piece, joined, pieces, xxh64


def grams(p: Piece, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and rows of all runs of 1 to ``longest`` words; the last
    words of a cut text are left to its next piece, which begins with them."""
    data, start, end = (p.data, p.start, p.end) if longest == 1 else joined(p)
    stop = np.searchsorted(p.row, p.row, side="right")  # end of the word's text in this piece
    go_on = np.array([r for r, last in zip(p.texts, p.last) if not last], dtype=np.int64)
    first = np.flatnonzero(np.arange(len(start)) < stop - np.where(np.isin(p.row, go_on), longest - 1, 0))
    parts = []
    for k in range(1, longest + 1):
        i = first[first + k <= stop[first]]
        parts.append((start[i], end[i + k - 1], p.row[i]))
    a, b, r = (np.concatenate(x) for x in zip(*parts))
    return data, a, b, r


def _intern(col: pa.Array, longest: int):
    """The batch's table and, piece by piece, each occurrence's slot and row."""
    table, met = InternTable(), []
    for p in pieces(col, NOT_ALNUM, lower=True, overlap=longest - 1):
        data, a, b, row = grams(p, longest)
        met.append((table.add(data, a, b, xxh64(data, a, b)).astype(np.int32), row.astype(np.int32)))
    return table, met


def _bucket(table: InternTable, buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(s) % buckets for s in table.strings()], dtype=np.int64)


def bucket_counts(texts: DataFrame, longest: int, buckets: int, text: str = "text") -> DataFrame:
    """``bucket, n``: occurrences of all n-grams of 1 to ``longest`` words."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            table, _ = _intern(b.column(0), longest)
            np.add.at(total, _bucket(table, buckets), table.count[:table.n])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return (texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Each bucket's gain, in thousandths of the log ratio of the target's and the
    documents' smoothed shares. ``buckets`` bounds what reaches the driver."""
    s, t = (np.zeros(buckets, dtype=np.int64) for _ in range(2))
    for total, frame in ((s, docs), (t, target)):
        for r in bucket_counts(frame, longest, buckets).collect():
            total[r["bucket"]] = r["n"]
    S, T = float(s.sum()) + buckets, float(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((float(b) + 1) * S / ((float(a) + 1) * T)))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """``doc_id, n_features, n_words, weight`` of every row of ``docs``."""

    def run(batches):
        for b in batches:
            table, met = _intern(b.column(1), longest)
            of = gain[_bucket(table, len(gain))]
            n, w, words = (np.zeros(b.num_rows, dtype=np.int64) for _ in range(3))
            for slot, row in met:
                if len(row):
                    lo, k = int(row.min()), int(row.max()) + 1
                    n[lo:k] += np.bincount(row - lo, minlength=k - lo)
                    # whole numbers far below 2**53: exact in doubles
                    w[lo:k] += np.bincount(row - lo, weights=of[slot], minlength=k - lo).astype(np.int64)
            # n words have n + (n - 1) + ... runs of up to `longest` words
            words[:] = n if longest == 1 else _words_of(n, longest)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, words, w))],
                                             ["doc_id", "n_features", "n_words", "weight"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_features long, n_words long, weight long"))


def _words_of(features: np.ndarray, longest: int) -> np.ndarray:
    """Words of a text from its number of n-grams: each word ends as many as there
    are words up to it, ``longest`` at most."""
    first = np.cumsum(np.arange(1, longest + 1))
    few = np.searchsorted(first, features, side="right")
    return np.where(features < first[-1], few, longest + (features - first[-1]) // longest)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from SHA-256 of ``<seed>:<doc_id>``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10000, seed: int = 2024,
             least_words: int = 20, percent: int = 10) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.

    Of the N documents with at least ``least_words`` words the floor(percent * N /
    100) of the highest scores are drawn and ranked from 1, ties by the smaller
    doc_id; the rank of others is null. A null or empty text has no features and
    weight 0; a null doc_id takes part, hashed as the empty string and first in
    ties. Rows of the same doc_id are documents of their own. Very long texts are
    walked in pieces of 2 MB. An empty ``docs`` gives no rows; an empty
    ``target`` leaves the gains to the documents' counts alone. Other columns are
    not read.

    Ranking moves ids and scores only: ranges of the order are numbered apart and
    offset by the counts of the ranges before.
    """
    gain = gains(docs, target, longest, buckets)
    scored = materialise(weights(docs, gain, longest)
                         .withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    fit = scored.filter(F.col("n_words") >= least_words)
    draw = percent * fit.count() // 100
    order = running_totals(fit.select("doc_id", (-F.col("score")).alias("down"), "n_features", "weight", "score",
                                      F.lit(1).cast("long").alias("one")), [], ["down", "doc_id"], ["one"])
    place = F.col("cum_one")
    cols = ["doc_id", "n_features", "weight", "score"]
    return (order.select(*cols, F.when(place <= draw, place).cast("long").alias("rank"))
            .unionByName(scored.filter(F.col("n_words") < least_words)
                         .select(*cols, F.lit(None).cast("long").alias("rank"))))
