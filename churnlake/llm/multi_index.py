"""Approximate nearest neighbours with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own k-means
codebook; the pair of codes is an entry's cell. A query ranks the centroids of
either half by distance and walks the pairs in the order of summed distance with
a heap, until the cells passed hold enough entries; the entries of those cells
are reranked by exact cosine. Entries are dealt out by their first code and, if
that list is long, by blocks of bounded size; queries go to the blocks that hold
their cells.

How many entries are enough is measured when the index is fitted: on a bounded
sample, against brute force, as the share of entries that must be passed to
reach ``target_recall``. Where vectors form clusters the share is small; where
they are spread evenly in many dimensions, no list of cells holds the nearest.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm import vectors as V
from churnlake.llm.common import materialise, parallelism

SAMPLE_ROWS = 16_384
CODES = 128
LEAST_ENTRIES = 1000
BLOCK_ROWS = 4096
_TRIALS = 256


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray
    share: float  # of all entries that a query passes

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.first.shape[1]
        return V.nearest(x[:, :m], self.first), V.nearest(x[:, m:], self.second)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = self.first.shape[1]
        return _square(x[:, :m], self.first), _square(x[:, m:], self.second)


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)).clip(0)


def fit(x: np.ndarray, codes: int, k: int, target_recall: float, seed: int) -> Codebooks:
    """Codebooks of the unit vectors ``x`` and the share of entries to pass."""
    m = max(1, x.shape[1] // 2)
    codes = max(1, min(codes, len(x) // 8))
    books = Codebooks(V.kmeans(x[:, :m], codes, 15, seed, spherical=False),
                      V.kmeans(x[:, m:], codes, 15, seed + 1, spherical=False), 1.0)
    a, b = books.codes(x)
    trials = x[:_TRIALS]
    d1, d2 = books.distances(trials)
    needed = []
    for i in range(len(trials)):
        cos = x @ trials[i]
        cos[i] = -2
        best = np.argsort(-cos, kind="stable")[:k]
        passed = d1[i][a] + d2[i][b]
        needed += [(passed <= passed[j]).mean() for j in best if j != i]
    if needed:
        books.share = min(1.0, float(np.quantile(needed, target_recall)))
    return books


def traverse(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Non-empty cells in ascending summed distance until they hold ``enough``
    entries. ``counts[i, j]`` are the cells' entries."""
    r1, r2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, out, held = [(d1[r1[0]] + d2[r2[0]], 0, 0)], [], 0
    seen_up_to = np.zeros(len(r1), np.int64)  # pairs of a row are entered in order
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        n = counts[r1[i], r2[j]]
        if n:
            out.append((int(r1[i]), int(r2[j])))
            held += int(n)
        if j == 0 and i + 1 < len(r1):
            heapq.heappush(heap, (d1[r1[i + 1]] + d2[r2[0]], i + 1, 0))
        if j + 1 < len(r2) and seen_up_to[i] == j:
            seen_up_to[i] = j + 1
            heapq.heappush(heap, (d1[r1[i]] + d2[r2[j + 1]], i, j + 1))
    return out


def _probe(books: Codebooks, counts: np.ndarray, enough: int):
    def run(frames):
        for f in frames:
            if not len(f):
                continue
            d1, d2 = books.distances(V.unit(V.matrix(f["v"])))
            rows = []
            for i, (row, v) in enumerate(zip(f["row"], f["v"])):
                cells: dict[int, list[int]] = {}
                for a, b in traverse(d1[i], d2[i], counts, enough):
                    cells.setdefault(a, []).append(b)
                v = np.asarray(v, np.float64)
                rows += [(row, v, a, bs) for a, bs in cells.items()]
            yield pd.DataFrame(rows, columns=["row", "v", "code1", "wanted"])
    return run


def _blocks(frames):
    """(entries, queries) of each (code, block): its entries, which are at most a
    block and come first, with the queries that follow them, a batch at a time."""
    key, held, entries = None, [], None
    for f in frames:
        if not len(f):
            continue
        code, block, asks = f["code1"].to_numpy(), f["block"].to_numpy(), f["asks"].to_numpy()
        cut = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
        for lo, hi in zip([0, *cut], [*cut, len(f)]):
            part = f.iloc[lo:hi]
            if (code[lo], block[lo]) != key:
                key, held, entries = (code[lo], block[lo]), [], None
            if not asks[lo]:
                held.append(part)
            elif held:
                entries = pd.concat(held) if entries is None else entries
                yield entries, part


def _rerank(k: int):
    """The ``k`` nearest ids of a block for each query vector sent to it."""

    def run(frames):
        of, y, code2, ids = None, None, None, None
        for e, q in _blocks(frames):
            if e is not of:
                of, y, code2, ids = e, V.unit(V.matrix(e["v"])), e["code2"].to_numpy(), e["ids"].to_numpy()
            rows, found, scores = [], [], []
            for at in range(0, len(q), 256):
                p = q.iloc[at:at + 256]
                cos = V.unit(V.matrix(p["v"])) @ y.T
                for i, (row, wanted) in enumerate(zip(p["row"], p["wanted"])):
                    ok = np.flatnonzero(np.isin(code2, wanted))
                    s = cos[i][ok]
                    if len(ok) > k:
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        ok, s = ok[s >= least], s[s >= least]
                    best = sorted((-x, int(v)) for j, x in zip(ok, s.tolist()) for v in ids[j])[:k]
                    rows += [row] * len(best)
                    found += [v for _, v in best]
                    scores += [-x for x, _ in best]
            yield pd.DataFrame({"row": np.array(rows, np.int64), "vec_id": np.array(found, np.int64),
                                "score": np.array(scores, np.float64)})
    return run


def search(embeddings: DataFrame, queries: str, k: int = 5, codes: int = CODES, target_recall: float = 0.97,
           least_entries: int = LEAST_ENTRIES, block_rows: int = BLOCK_ROWS, vec_id: str = "vec_id",
           vector: str = "embedding", seed: int = 7) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest entries found for the
    rows that the condition ``queries`` (on ``vec_id``) selects.

    Nearest is the largest cosine, ties go to the smaller vec_id. Candidates are
    all ids but the query's own. Vectors that are null, empty, zero or hold null
    or non-finite components and rows with a null id take no part; vectors of
    other than the commonest length are not comparable and take no part either.
    Equal vectors are one entry that keeps its ``k + 1`` smallest ids, which is
    all an answer can use; rows that repeat id and vector count once. An empty
    table gives no rows; other columns are not read."""
    spark = embeddings.sparkSession
    e = embeddings.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"))
    e = e.filter(F.col("id").isNotNull() & V.usable(F.col("v")))
    dim = e.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dim is None:
        return empty
    e = e.filter(F.size("v") == dim["d"])
    e = materialise(e.distinct(), "vectors")
    w = Window.partitionBy("v").orderBy("id")
    few = e.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1)
    entries = materialise(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                          .withColumn("row", F.monotonically_increasing_id()), "entries")
    books = fit(V.sample(entries, entries.count(), SAMPLE_ROWS, "row", "v"), codes, k, target_recall, seed)

    @F.pandas_udf("code1 int, code2 int")
    def coded(s: pd.Series) -> pd.DataFrame:
        a, b = books.codes(V.unit(V.matrix(s))) if len(s) else ([], [])
        return pd.DataFrame({"code1": np.asarray(a, np.int32), "code2": np.asarray(b, np.int32)})

    cells = materialise(entries.withColumn("c", coded("v")).select("row", "v", "ids", "c.code1", "c.code2"), "cells")
    counts = np.zeros((len(books.first), len(books.second)), np.int64)
    for r in cells.groupBy("code1", "code2").count().collect():  # at most codes * codes rows
        counts[r["code1"], r["code2"]] = r["count"]
    enough = max(least_entries, int(np.ceil(books.share * counts.sum())))
    by_code = spark.createDataFrame([(a, int(-(-n // block_rows))) for a, n in enumerate(counts.sum(axis=1).tolist())
                                     if n], "code1 int, blocks int")  # at most one row a code

    asked = materialise(e.withColumnRenamed("id", "vec_id").filter(queries)
                        .join(entries.select("v", "row"), "v").select("vec_id", "row"), "asked")
    vectors = asked.select("row").distinct().join(entries.select("row", "v"), "row")
    walked = vectors.mapInPandas(_probe(books, counts, enough),
                                 "row long, v array<double>, code1 int, wanted array<int>")
    # an entry is sent once, to its block; a block's queries stream past it
    keys = ["code1", "block"]
    sent = (walked.join(F.broadcast(by_code), "code1")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*keys, F.lit(True).alias("asks"), "row", F.col("v").cast("array<double>").alias("v"), "wanted",
                    F.lit(None).cast("int").alias("code2"), F.lit(None).cast("array<long>").alias("ids")))
    held = (cells.join(F.broadcast(by_code), "code1")
            .select("code1", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"),
                    F.lit(False).alias("asks"), "row", F.col("v").cast("array<double>").alias("v"),
                    F.lit(None).cast("array<int>").alias("wanted"), "code2", "ids"))
    near = (sent.unionByName(held).repartition(parallelism(e), *keys).sortWithinPartitions(*keys, "asks")
            .mapInPandas(_rerank(k + 1), "row long, vec_id long, score double"))
    order = [F.desc("score"), F.asc("vec_id")]
    best = (near.withColumn("r", F.row_number().over(Window.partitionBy("row").orderBy(*order)))
            .filter(F.col("r") <= k + 1).drop("r"))
    own = (asked.withColumnRenamed("vec_id", "query_id").join(best, "row").filter("vec_id <> query_id")
           .withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "row").orderBy(*order))))
    return own.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                                                 "score")
