"""SimHash near-duplicates with BK-trees.

Fingerprints are computed in Arrow batches; everything after works on distinct
fingerprints. Two fingerprints within ``radius`` bits agree on all but ``radius``
of their ``radius + 2`` blocks, so at least two blocks are equal: every choice of
two equal blocks names a shard, and all links lie inside shards. Each shard holds
a BK-tree (children keyed by the Hamming distance to their parent). A shard of
more than ``tree_rows`` fingerprints is cut into pieces; the tree of each piece
(bounded, so it may be sent around) goes to the tasks of the other pieces. A
search follows only edges within ``radius`` of its distance. Each task returns a
spanning forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import fresh, give_back, materialise, parallelism
from churnlake.llm.components import connected_components

TREE_ROWS = 2048
_BITS = 64


def fingerprint(data: bytes | None, k: int) -> int:
    """Signed 64-bit SimHash of the ``k``-word shingles of a UTF-8 text."""
    import xxhash
    words = (data or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < k:
        shingles, n = [b" ".join(words)], 1
    else:
        shingles, n = map(b" ".join, zip(*(words[i:] for i in range(k)))), len(words) - k + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8", count=n)
    ones = np.zeros(_BITS, dtype=np.int64)
    for i in range(0, n, 65536):
        b = h[i:i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(b, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, out: str, k: int = 3, text: str = "text") -> DataFrame:
    """``docs`` and its fingerprint as a long. Null and word-less texts: zero."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([fingerprint(x, k) for x in s], dtype="int64")
            del s
        give_back()

    return docs.withColumn(out, fp(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")))


class BKTree:
    """Burkhard-Keller tree over integers under Hamming distance."""

    def __init__(self):
        self.value: list[int] = []
        self.child: list[dict[int, int]] = []

    def add(self, x: int) -> int:
        me = len(self.value)
        self.value.append(x)
        self.child.append({})
        if me:
            at = 0
            while True:
                d = (x ^ self.value[at]).bit_count()
                nxt = self.child[at].setdefault(d, me)
                if nxt == me:
                    break
                at = nxt
        return me

    def search(self, x: int, radius: int) -> list[int]:
        """Indices of the stored values within ``radius`` of ``x``."""
        if not self.value:
            return []
        found, todo = [], [0]
        value, child = self.value, self.child
        while todo:
            at = todo.pop()
            d = (x ^ value[at]).bit_count()
            if d <= radius:
                found.append(at)
            edges = child[at]
            if edges:
                for e in range(d - radius, d + radius + 1):
                    if e in edges:
                        todo.append(edges[e])
        return found


def _forest(values: list[int], from_tree: list[bool], same: bool, radius: int) -> list[tuple[int, int]]:
    """Spanning links among the values of one shard piece pair."""
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    tree, member, links = BKTree(), [], []
    order = range(len(values)) if same else sorted(range(len(values)), key=lambda i: not from_tree[i])
    for i in order:
        x = values[i] & 0xFFFFFFFFFFFFFFFF
        if same or not from_tree[i]:
            for t in tree.search(x, radius):
                j = member[t]
                a, b = find(i), find(j)
                if a != b:
                    root[a] = b
                    links.append((values[i], values[j]))
        if same or from_tree[i]:
            tree.add(x)
            member.append(i)
    return links


def _shard_links(radius: int):
    def run(frames):
        carry = None
        for f in frames:
            carry = f if carry is None else pd.concat([carry, f], ignore_index=True)
            key = carry[["shard", "piece", "other"]].to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1 if len(key) > 1 else np.array([], int)
            if len(cut):
                yield _links_of(carry.iloc[:cut[-1]], np.append(0, cut), radius)
                carry = carry.iloc[cut[-1]:].reset_index(drop=True)
        if carry is not None and len(carry):
            yield _links_of(carry, np.array([0, len(carry)]), radius)
    return run


def _links_of(f: pd.DataFrame, cuts: np.ndarray, radius: int) -> pd.DataFrame:
    fp, tree = f["fp"].tolist(), f["in_tree"].tolist()
    same = (f["piece"] == f["other"]).tolist()
    links: list[tuple[int, int]] = []
    for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if e - s > 1:
            links += _forest(fp[s:e], tree[s:e], same[s], radius)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def fingerprint_links(fps: DataFrame, radius: int = 2, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``fps(fp long)``, distinct -> links ``(a, b)`` that connect exactly the
    fingerprints connected by distances of at most ``radius``."""
    blocks = radius + 2
    edge = [_BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, pair in enumerate(combinations(range(blocks), 2)):
        mask = sum(((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in pair)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(signed))))
    named = fps.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = named.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = sizes.select(F.col("shard").bitwiseXOR(F.lit(0)).alias("shard"),
                         F.ceil(F.col("n") / F.lit(tree_rows)).cast("int").alias("pieces"))
    mine = (named.join(sizes, "shard")
            .withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("pieces").cast("long")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))))
    pairs = mine.select("shard", F.least("mine", "with").alias("piece"), F.greatest("mine", "with").alias("other"),
                        "fp", (F.col("mine") <= F.col("with")).alias("in_tree"))
    return (pairs.repartition(parallelism(fps), "shard", "piece", "other")
            .sortWithinPartitions("shard", "piece", "other", "in_tree", "fp")
            .mapInPandas(_shard_links(radius), "a long, b long"))


def _components(fps: DataFrame, radius: int, tree_rows: int) -> DataFrame:
    """``fps(doc_id, fp)`` -> one row per distinct ``fp`` with its component_id."""
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comps = connected_components(fingerprint_links(classes.select("fp"), radius, tree_rows))
    named = (classes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "rep", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return materialise(named.join(least.select(F.col("component").bitwiseXOR(F.lit(0)).alias("component"),
                                               "component_id"), "component")
                       .select("fp", "component", "component_id"), "ids")


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 2, doc_id: str = "doc_id",
                    text: str = "text", tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (long), ``component_id`` (the
    smallest doc_id reachable over links of at most ``radius`` bits, its own
    included). Null ids are kept: they take part by their text, and a component
    without any id has a null id. Repeated rows link like equal texts. An empty
    table gives no rows; other columns are not read."""
    fps = materialise(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")),
                                       "fp", k).select("doc_id", "fp"), "fingerprints")
    return fps.join(_components(fps, radius, tree_rows).drop("component"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, k: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text",
             tree_rows: int = TREE_ROWS) -> DataFrame:
    """``docs``, all columns, with exactly one row of each component: the one of
    the smallest doc_id (nulls last; of rows that repeat an id, the one whose
    text hashes lowest, and one of rows that repeat both). An empty table stays
    empty."""
    key = [F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash")]
    fps = materialise(with_fingerprint(docs.select(*key, F.col(text).alias("text")), "fp", k)
                      .select("doc_id", "text_hash", "fp"), "fingerprints")
    ids = _components(fps, radius, tree_rows)
    best = (fps.join(ids, "fp").groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best"))
            .select(F.col("best.doc_id").alias("doc_id"), F.col("best.text_hash").alias("text_hash")).distinct())
    best = materialise(best, "kept")
    a, b, c = fresh(docs, "kept_id"), fresh(docs, "text_key"), fresh(docs, "kept_key")
    marked = docs.withColumn(b, key[1])
    best = best.withColumnsRenamed({"doc_id": a, "text_hash": c})
    hit = marked.join(best, F.col(doc_id).eqNullSafe(F.col(a)) & (F.col(b) == F.col(c)))
    return hit.dropDuplicates([doc_id, b]).select(*[F.col(f"`{c}`") for c in docs.columns])
