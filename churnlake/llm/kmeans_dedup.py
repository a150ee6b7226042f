"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Equal vectors of a label are one class. Classes go to the cell of their nearest
centroid, and as guests to every cell whose border is within reach: two unit
vectors of cosine ``c`` are at most ``sqrt(2 - 2c)`` apart, so a partner in
another cell is no farther away than the plane between the two centroids. A
cell's members thus meet all partners in their own cell, whatever the
centroids; these only decide how much is compared. Cells are cut into blocks of
bounded rows, and block pairs into tasks; a task returns counts for its home
vectors and a spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm import vectors as V
from churnlake.llm.common import materialise, parallelism
from churnlake.llm.components import connected_components

SAMPLE_ROWS = 8192
BLOCK_ROWS = 2048
CELL_ROWS = 8192     # aimed at
MAX_CELLS = 1024     # centroids are sent to every task
_SLACK = 1e-6        # rounding of the plane test


def _cells_of(centroids: np.ndarray, reach: float):
    """Home and guest cells of each vector."""
    gap = np.sqrt(np.maximum(((centroids[:, None] - centroids[None]) ** 2).sum(axis=2), 1e-18))

    @F.pandas_udf("array<struct<cell:int,home:boolean>>")
    def cells(s: pd.Series) -> pd.Series:
        out = []
        x = V.unit(V.matrix(s)) if len(s) else np.zeros((0, centroids.shape[1]))
        score = 2 * x @ centroids.T - (centroids * centroids).sum(axis=1)
        home = score.argmax(axis=1)
        # distance to the plane between the home centroid and another
        plane = (score[np.arange(len(x)), home][:, None] - score) / (2 * gap[home])
        near = plane <= reach + _SLACK
        near[np.arange(len(x)), home] = True
        for h, row in zip(home.tolist(), near):
            out.append([{"cell": c, "home": c == h} for c in np.flatnonzero(row).tolist()])
        return pd.Series(out)

    return cells


def _groups(frames, keys: list[str]):
    """Whole key groups of a sorted stream of frames."""
    carry = None
    for f in frames:
        carry = f if carry is None or not len(carry) else pd.concat([carry, f], ignore_index=True)
        k = carry[keys].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1 if len(k) > 1 else []
        at = 0
        for c in cut:
            yield carry.iloc[at:c]
            at = c
        carry = carry.iloc[at:].reset_index(drop=True)
    if carry is not None and len(carry):
        yield carry


def _compare(least_cosine: float):
    """Home block against another block of the same cell."""

    def run(frames):
        for g in _groups(frames, ["label", "cell", "homes", "others"]):
            q, o = g[g["query"]], g[g["other"]]
            if not len(q) or not len(o):
                continue
            x, y = V.unit(V.matrix(q["v"])), V.unit(V.matrix(o["v"]))
            a, b, copies = q["rep"].to_numpy(), o["rep"].to_numpy(), o["copies"].to_numpy()
            found = np.zeros(len(a), np.int64)
            root = {}

            def find(i):
                while root.setdefault(i, i) != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            links = []
            for at in range(0, len(a), 256):
                hit = (x[at:at + 256] @ y.T) >= least_cosine
                hit &= a[at:at + 256, None] != b[None]
                found[at:at + 256] = hit @ copies
                for i, j in zip(*np.nonzero(hit)):
                    p, r = find(a[at + i]), find(b[j])
                    if p != r:
                        root[p] = r
                        links.append((a[at + i], b[j]))
            some = found > 0
            yield pd.DataFrame({"a": np.r_[a[some], [s for s, _ in links]].astype(np.int64),
                                "b": np.r_[a[some], [t for _, t in links]].astype(np.int64),
                                "n": np.r_[found[some], np.zeros(len(links), np.int64)].astype(np.int64)})
    return run


def near_duplicates(embeddings: DataFrame, least_cosine: float = 0.98, vec_id: str = "vec_id",
                    vector: str = "embedding", label: str = "label", block_rows: int = BLOCK_ROWS,
                    cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS, seed: int = 7) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Only vectors of the same, non-null label and the same length are compared,
    by cosine in double precision. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing and are components of their
    own. Rows that repeat an id are vectors of their own that share it; a null id
    takes part and a component without ids has a null id (and is not kept). An
    empty table gives no rows; other columns are not read."""
    spark = embeddings.sparkSession
    e = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"),
                          F.col(label).alias("label"))
    ok = V.usable(F.col("v")) & F.col("label").isNotNull()
    # a class is named by its smallest row number in a fixed table
    rows = materialise(e.withColumn("ok", ok).withColumn("v", F.when(F.col("ok"), F.col("v")))
                       .withColumn("row", F.monotonically_increasing_id()), "vectors")
    classes = materialise(rows.filter("ok").groupBy("label", "v")
                          .agg(F.min("row").alias("rep"), F.min("vec_id").alias("least_id"),
                               F.count(F.lit(1)).alias("copies")), "classes")
    dims = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect()]  # lengths in use
    parts = [_linked(classes.filter(F.size("v") == d), least_cosine, block_rows, cell_rows, max_cells, seed)
             for d in sorted(dims)]
    got = spark.createDataFrame([], "a long, b long, n long")
    for p in parts:
        got = got.unionByName(p)
    got = materialise(got, "cosines")
    counts = got.filter("a = b").groupBy("a").agg(F.sum("n").alias("n"))
    comps = connected_components(got.select("a", "b"))
    c = (classes.drop("v").join(counts, F.col("rep") == F.col("a"), "left").drop("a")
         .join(comps, F.col("rep") == F.col("node"), "left")
         .select("rep", "least_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - F.lit(1)).alias("n_links"),
                 F.coalesce("component", "rep").alias("component")))
    least = c.groupBy("component").agg(F.min("least_id").alias("component_id"))
    c = materialise(c.join(least.select(F.col("component").bitwiseXOR(F.lit(0)).alias("component"), "component_id"),
                           "component").select("rep", "n_links", "component_id"), "linked")
    member = (rows.filter("ok").select("vec_id", "label", "v")
              .join(classes.select("label", "v", "rep"), ["label", "v"]).select("vec_id", "rep")
              .join(c, "rep").select("vec_id", "n_links", "component_id"))
    alone = rows.filter(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return (member.unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _linked(classes: DataFrame, least_cosine: float, block_rows: int, cell_rows: int, max_cells: int,
            seed: int) -> DataFrame:
    """``(a, b, n)``: counts of a home class (a = b) and spanning links (n = 0)."""
    n = classes.count()
    k = int(min(max_cells, max(1, -(-n // cell_rows))))
    centroids = V.kmeans(V.sample(classes, n, SAMPLE_ROWS, "rep", "v"), k, 20, seed, spherical=True)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least_cosine)))
    cells = _cells_of(centroids, reach)
    at = materialise(classes.withColumn("c", F.explode(cells("v")))
                     .select("label", "rep", "copies", "v", F.col("c.cell").alias("cell"),
                             F.col("c.home").alias("home")), "cells")
    sizes = (at.groupBy("label", "cell").agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("m"))
             .filter("h > 0 and m > 1")
             .select("label", "cell", F.ceil(F.col("h") / F.lit(block_rows)).cast("int").alias("hb"),
                     F.ceil(F.col("m") / F.lit(block_rows)).cast("int").alias("mb")))
    some = at.join(sizes, ["label", "cell"])
    mix = F.xxhash64("rep")
    queries = (some.filter("home").withColumn("homes", F.pmod(mix, F.col("hb")).cast("int"))
               .withColumn("others", F.explode(F.sequence(F.lit(0), F.col("mb") - 1))))
    others = (some.withColumn("others", F.pmod(mix, F.col("mb")).cast("int"))
              .withColumn("homes", F.explode(F.sequence(F.lit(0), F.col("hb") - 1))))
    cols = ["label", "cell", "homes", "others", "rep", "copies", "v"]
    both = (queries.select(*cols, F.lit(True).alias("query"), F.lit(False).alias("other"))
            .unionByName(others.select(*cols, F.lit(False).alias("query"), F.lit(True).alias("other"))))
    keys = ["label", "cell", "homes", "others"]
    return (both.repartition(parallelism(classes), *keys).sortWithinPartitions(*keys)
            .mapInPandas(_compare(least_cosine), "a long, b long, n long"))
