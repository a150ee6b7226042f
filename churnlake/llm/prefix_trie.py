"""The trie of conversations' prefixes by van Emde Boas recursion.

Sequences are padded to a power of two and cut at half depth, the halves at half
again, and so on, for all sequences and all parts at once. A part [s, s + h) of a
sequence is a block; the recursion runs as three sweeps over tables of blocks,
each level one Spark job on half (or twice) the rows of the level before:

* names of blocks, from single turns up: a block's name comes from its halves';
* cut prefixes, from the whole down: the prefix up to a cut is named from the
  prefix before the block and the name of the block's upper half. That name is
  the root under which the lower forest hangs, so both halves go on alone;
* totals, grafted upward: a lower half's total is added to all of its upper half.

Names are 128 bits of xxhash64 (two chains). A sequence's rows are keyed by
(sequence, block), so a very long sequence is spread over many tasks; a prefix
that many sequences share is combined before its rows meet.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.functions.stats import running_totals
from churnlake.llm.common import materialise, parallelism

_IDS_PER_CHUNK = 4096
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _named(*cols) -> tuple[Column, Column]:
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *reversed(cols))


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, words``: each conversation's turns numbered from 0 in
    order of turn (null first, ties by role, then text); a, b name role and text."""
    text = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one")).filter("conv_id is not null")
    a, b = _named("role", "text")
    return (running_totals(text, ["conv_id"], ["turn", "role", "text"], ["one"])
            .select("conv_id", (F.col("cum_one") - 1).alias("pos"), a.alias("a"), b.alias("b"),
                    F.regexp_count("text", F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long").alias("words")))


def branched(own: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns and all conversations (``conv_id, n``, turnless ones too): the
    first h turns of conversation c - c % ``every``, then c's own after its first
    h, for h = crc32(decimal c) % ``heads``."""
    c = F.col("conv_id")
    lengths = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("len"))
    convs = lengths.select("conv_id", "len", (c - F.pmod(c, F.lit(every))).alias("base"),
                           (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"))
    base = lengths.filter(F.pmod(c, F.lit(every)) == 0).select(c.alias("base"), F.col("len").alias("base_len"))
    convs = (convs.join(base, "base", "left")
             .withColumn("head", F.least("h", F.coalesce("base_len", F.lit(0))))
             .select("conv_id", "base", "h", "head",
                     (F.col("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("n")))
    convs = materialise(convs, "convs")
    first = (own.filter((F.pmod(c, F.lit(every)) == 0) & (F.col("pos") < heads - 1))
             .withColumnRenamed("conv_id", "base"))
    head = (convs.select("conv_id", "base", "h").join(first, "base").filter("pos < h")
            .select("conv_id", "pos", "a", "b", "words"))
    rest = (own.join(convs.select("conv_id", "h", "head"), "conv_id").filter("pos >= h")
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "a", "b", "words"))
    return head.unionByName(rest), convs.select("conv_id", "n")


def _block_names(seqs: DataFrame, levels: int) -> list[DataFrame]:
    """Level j: ``conv_id, block, a, b`` of every whole block of 2**j turns."""
    out = [seqs.select("conv_id", F.col("pos").alias("block"), "a", "b")]
    for _ in range(1, levels):
        left, right = F.col("block") % 2 == 0, F.col("block") % 2 == 1
        pairs = (out[-1].groupBy("conv_id", F.floor(F.col("block") / 2).alias("block"))
                 .agg(*[F.max(F.when(side, F.col(x))).alias(f"{x}{i}") for i, side in enumerate((left, right))
                        for x in "ab"], F.count(F.lit(1)).alias("halves")).filter("halves = 2"))
        a, b = _named("a0", "b0", "a1", "b1")
        out.append(materialise(pairs.select("conv_id", "block", a.alias("a"), b.alias("b")), "blocks"))
    return out


def prefixes(seqs: DataFrame, convs: DataFrame, levels: int) -> DataFrame:
    """``conv_id, depth, a, b``: the name of every conversation's prefix of every depth."""
    known = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"),
                         F.lit(0).cast("long").alias("b"))
    names = _block_names(seqs, levels)
    for j in range(levels - 1, -1, -1):
        half = names[j].select("conv_id", (F.col("block") * (1 << j)).alias("depth"), F.col("a").alias("c"),
                               F.col("b").alias("d"))
        a, b = _named("a", "b", "c", "d")
        cut = known.join(half, ["conv_id", "depth"]).select(
            "conv_id", (F.col("depth") + (1 << j)).alias("depth"), a.alias("a"), b.alias("b"))
        known = materialise(known.unionByName(cut), "prefixes")
    return known


def grafted(own: DataFrame, levels: int, sums: list[str]) -> DataFrame:
    """``own(conv_id, pos, *sums)`` with each sum taken over the row and all later
    rows of its conversation: block totals upward, then what lies below each block
    handed down to its halves."""
    total = [materialise(own.select("conv_id", F.col("pos").alias("block"), *sums), "totals")]
    for _ in range(levels):
        total.append(materialise(
            total[-1].groupBy("conv_id", F.floor(F.col("block") / 2).alias("block")).agg(
                *[F.sum(s).alias(s) for s in sums],
                *[F.sum(F.when(F.col("block") % 2 == 1, F.col(s)).otherwise(0)).alias(f"low_{s}") for s in sums]),
            "totals"))
    below = total[-1].select("conv_id", "block", *[F.lit(0).cast("long").alias(f"below_{s}") for s in sums])
    for j in range(levels, 0, -1):
        whole = below.join(total[j].select("conv_id", "block", *[f"low_{s}" for s in sums]), ["conv_id", "block"])
        half = total[j - 1].select("conv_id", "block", F.floor(F.col("block") / 2).alias("whole"))
        below = materialise(
            half.join(whole.withColumnRenamed("block", "whole"), ["conv_id", "whole"]).select(
                "conv_id", "block",
                *[(F.col(f"below_{s}") + F.when(F.col("block") % 2 == 0, F.col(f"low_{s}")).otherwise(0))
                  .alias(f"below_{s}") for s in sums]), "below")
    return below.join(total[0], ["conv_id", "block"]).select(
        "conv_id", F.col("block").alias("pos"), *[(F.col(s) + F.col(f"below_{s}")).alias(s) for s in sums])


def _ends(members: DataFrame) -> DataFrame:
    """``conv_id, depth, ends_sha256`` from ``conv_id, depth, member``: ascending
    ids are put into chunks of a range of ids first; a task then reads a node's
    chunks in order and hashes on, holding one batch at a time."""
    chunks = (members.withColumn("chunk", F.floor(F.col("member") / _IDS_PER_CHUNK))
              .groupBy("conv_id", "depth", "chunk")
              .agg(F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("ids")))
    names = ["conv_id", "depth", "ends_sha256"]

    def run(batches):
        now, digest = None, None
        for b in batches:
            out = []
            for c, d, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 3))):
                if (c, d) == now:
                    digest.update(b"," + ids.encode())
                else:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (c, d), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out])
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*now, digest.hexdigest())))])

    return (chunks.repartition(parallelism(chunks), "conv_id", "depth")
            .sortWithinPartitions("conv_id", "depth", "chunk").mapInArrow(run, "conv_id long, depth long, ends_sha256 string"))


def trie(seqs: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of ``seqs(conv_id, pos, a, b, words)``, whose
    conversations are those of ``convs(conv_id, n)``, n turns each (0: members of
    the root alone). One row per node with the columns ``NODES``; no conversations
    give no rows."""
    longest = convs.agg(F.max("n")).first()[0]
    if longest is None:
        return convs.sparkSession.createDataFrame(
            [], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in NODES))
    levels = max(0, int(longest - 1).bit_length()) if longest else 0
    seqs = materialise(seqs, "turns")
    at = prefixes(seqs, convs, levels + 1 if longest else 0)
    key = ["depth", "a", "b"]
    nodes = materialise(at.groupBy(*key).agg(F.min("conv_id").alias("id"), F.count(F.lit(1)).alias("n_convs")), "nodes")
    # the parent is the prefix one turn shorter of the node's smallest member
    up = at.select(F.col("conv_id").alias("id"), (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"),
                   F.col("b").alias("pb"))
    child = nodes.join(up, ["id", "depth"])
    parent = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                          F.col("id").alias("parent_id"))
    child = materialise(child.join(parent, ["depth", "pa", "pb"]).select("id", "depth", "parent_id"), "children")
    born = (child.groupBy(F.col("parent_id").alias("id"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count(F.lit(1)).alias("n_children")))
    last = seqs.select(F.col("conv_id").alias("id"), (F.col("pos") + 1).alias("depth"), "words")
    facts = materialise(
        nodes.join(born, ["id", "depth"], "left").join(last, ["id", "depth"], "left")
        .join(child, ["id", "depth"], "left")
        .select("id", "depth", "parent_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
                ((F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))).alias("saved")), "facts")
    # a node is counted in its smallest member's row; what lies below a row of a
    # conversation is grafted onto it, and a node sums the rows of its members
    sums = ["leaves", "saved"]
    counted = facts.select(F.col("id").alias("conv_id"), F.col("depth").alias("pos"), *sums)
    depths = int(longest).bit_length()
    own = materialise(grafted(counted, depths, sums), "grafted")
    whole = counted.groupBy("conv_id").agg(*[F.sum(s).alias(f"all_{s}") for s in sums])
    rows = (at.join(own.withColumnRenamed("pos", "depth"), ["conv_id", "depth"], "left")
            .join(whole, "conv_id", "left"))
    total = rows.groupBy(*key).agg(F.min("conv_id").alias("id"), *[
        F.sum(F.coalesce(F.col(s), F.col(f"all_{s}"), F.lit(0))).alias(f"sum_{s}") for s in sums])
    ended = (convs.select("conv_id", F.col("n").alias("depth")).join(at, ["conv_id", "depth"])
             .join(nodes.select(*key, "id"), key)
             .select(F.col("id").alias("conv_id"), "depth", F.col("conv_id").alias("member")))
    ends = _ends(ended)
    out = (facts.join(total.select("id", "depth", "sum_leaves", "sum_saved"), ["id", "depth"])
           .withColumnRenamed("id", "conv_id").join(ends, ["conv_id", "depth"], "left"))
    return out.select("conv_id", "depth", F.col("parent_id").alias("parent_conv_id"), "n_convs", "n_children",
                      F.col("sum_leaves").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def branched_trie(conversations: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations (``branched``).

    Turns are ordered by turn, null first, ties by role and text; null roles and
    texts are empty ones. Rows without a conv_id take no part. Repeated rows are
    turns of their own. Very long texts count as one name each and very long
    conversations are spread by block. Other columns are not read; an empty table
    gives no rows.
    """
    own = materialise(turns(conversations), "own")
    return trie(*branched(own, every, heads))
