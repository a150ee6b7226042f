"""Mixing sources to target weights by temperature, with DataFrame operations only.

Source weights are token shares raised to an exponent and normalised. The
exponent is found by bisection on one row per source: each round evaluates a few
evenly spaced exponents in one aggregate and keeps the interval in which the
target (an entropy, or a limit on how often a source repeats) is met. Weights
times the budget are each source's tokens. A source is read in passes; each pass
has its own permutation (a hash of seed, pass and document), whole passes first,
then the head of one more up to the budget. Tokens of a source are dealt evenly
over blocks, so every block of the mixture has the target weights, and blocks
are permuted by hash again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm.common import buckets_for, fresh, materialise, prefix_sums

_GRID = 16      # intervals of a round
_ROUNDS = 10    # the exponent is found to one part in 16**10
_HASH_MAX = 1 << 60
_BUCKET_ROWS = 2048
BLOCK_TOKENS = 1_000_000


def tokens(text: Column) -> Column:
    """Words of the text and one end token; null is the empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0b\f\r]+")), F.lit(0)).cast("long") + F.lit(1)


def permutation(doc_id: Column, pass_no: Column, seed: int) -> Column:
    """A document's place in its source's permutation of a pass: 60 hash bits."""
    name = F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("")), pass_no.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def source_totals(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """``(src, docs, tokens)``, one row per source; null is a source of its own."""
    n = docs.select(F.struct(F.col(source).alias("name")).alias("src"), tokens(F.col(text)).alias("t"))
    return n.groupBy("src").agg(F.count(F.lit(1)).alias("docs"), F.sum("t").alias("tokens"))


def _measures(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent the entropy of the weights (nats) and the most repeated
    source's passes when every source is read once at least."""
    top = totals.agg(F.max("tokens").alias("m")).first()["m"]
    x = F.ln(F.col("tokens") / F.lit(float(top)))
    rows = (totals.select(x.alias("x"), F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a"))
            .groupBy("a").agg(F.sum(F.exp(F.col("a") * F.col("x"))).alias("z"),
                              F.sum(F.col("a") * F.col("x") * F.exp(F.col("a") * F.col("x"))).alias("s"),
                              F.max(F.exp((F.col("a") - F.lit(1.0)) * F.col("x"))).alias("passes")))
    return {r["a"]: (math.log(r["z"]) - r["s"] / r["z"], r["passes"]) for r in rows.collect()}


def exponent(totals: DataFrame, target_entropy: float | None = None, repeat_limit: float | None = None) -> float:
    """The exponent in 0..1 whose weights meet the target.

    Entropy and repetition both fall as the exponent rises. ``target_entropy``
    (nats): the largest exponent with at least that entropy, 0 if none reaches
    it. ``repeat_limit``: the smallest exponent at which no source is read more
    often. Both: the larger of the two, the limit being a hard one."""
    found = []
    for target, which in ((target_entropy, 0), (repeat_limit, 1)):
        if target is None:
            continue
        lo, hi = 0.0, 1.0
        for _ in range(_ROUNDS):
            grid = [lo + (hi - lo) * i / _GRID for i in range(_GRID + 1)]
            m = _measures(totals, grid)
            above = [i for i, a in enumerate(grid) if m[a][which] > target]  # falls with the exponent
            at = above[-1] if above else -1
            if at < 0 or at == _GRID:
                lo = hi = grid[0] if at < 0 else grid[-1]
                break
            lo, hi = grid[at], grid[at + 1]
        found.append(lo if which == 0 else hi)
    return max(found) if found else 1.0


def weights(totals: DataFrame, alpha: float, budget: float | None = None) -> DataFrame:
    """``totals`` with ``share``, ``weight``, ``budget`` (tokens) and ``passes``
    (whole ones). Without a budget in tokens it is the least at which every
    source is read once at least, so that no document is left out."""
    s = totals.agg(F.max("tokens").alias("top"), F.sum("tokens").alias("all")).first()
    if s["top"] is None:
        s = {"top": 1, "all": 1}
    part = F.exp(F.lit(alpha) * F.ln(F.col("tokens") / F.lit(float(s["top"]))))
    z = totals.agg(F.sum(part).alias("z")).first()["z"] or 1.0
    total = budget if budget is not None else s["top"] * z
    out = totals.select("src", "docs", "tokens", (F.col("tokens") / F.lit(float(s["all"]))).alias("share"),
                        (part / F.lit(z)).alias("weight"))
    # a whole pass less a rounding error, which grows with the tokens, is a whole pass
    share = F.col("weight") * F.lit(float(total))
    tokens_ = F.floor(share + F.greatest(F.lit(1e-6), share * F.lit(1e-14))).cast("long")
    return (out.withColumn("budget", tokens_ if budget is not None else F.greatest(tokens_, F.col("tokens")))
            .withColumn("passes", F.floor(F.col("budget") / F.col("tokens")).cast("int")))


def _placed(units: DataFrame, mix: DataFrame, seed: int) -> DataFrame:
    """``units(src, pass, doc_id, t)`` with ``before``: the source's tokens of the
    same pass that come earlier in its permutation. Equal hashes (repeated ids)
    are ordered by size; what is equal in both may change places."""
    h = (units.withColumn("h", permutation(F.col("doc_id"), F.col("pass"), seed))
         .join(mix.select("src", "docs", "budget", "weight", F.col("tokens").alias("all_tokens")), "src"))
    nb = buckets_for(F.col("docs"), _BUCKET_ROWS)
    h = h.withColumn("bucket", F.floor(F.col("h") / F.lit(float(_HASH_MAX)) * nb).cast("long"))
    return prefix_sums(h, ["src", "pass"], "bucket", ["h", "t"], "t", "before")


def cuts(docs: DataFrame, mix: DataFrame, seed: int, doc_id: str, source: str, text: str) -> DataFrame:
    """``(src, passes, cut)``: a document is read ``passes`` times, and once more
    if its place in that pass's permutation is at most ``cut``."""
    units = (docs.select(F.struct(F.col(source).alias("name")).alias("src"), F.col(doc_id).alias("doc_id"),
                         tokens(F.col(text)).alias("t"))
             .join(mix.select("src", F.col("passes").alias("pass")), "src"))
    placed = _placed(units, mix, seed)
    left = F.col("budget") - F.col("pass").cast("long") * F.col("all_tokens")
    cut = placed.filter(F.col("before") < left).groupBy("src").agg(F.max("h").alias("cut"))
    return mix.select("src", "passes").join(cut, "src", "left").withColumn("cut", F.coalesce("cut", F.lit(-1)))


def _mix(docs: DataFrame, target_entropy, repeat_limit, budget, source: str, text: str) -> DataFrame:
    totals = materialise(source_totals(docs, source, text), "sources")
    alpha = exponent(totals, target_entropy, repeat_limit) if not totals.isEmpty() else 1.0
    return materialise(weights(totals, alpha, budget), "mix")


def schedule(docs: DataFrame, target_entropy: float | None = None, repeat_limit: float | None = 2.0,
             budget: float | None = None, seed: int = 7, block_tokens: int = BLOCK_TOKENS,
             doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixture: one row per document and pass that it is read in:
    ``doc_id, source, pass, n_tokens, weight, block, position``.

    ``block`` is the mixture's block the document starts in, ``position`` its
    place there (from 0). A document is read when it starts before its source's
    budget ends. Null and empty texts have one token. Null sources are one
    source, null ids share a hash and are ordered by size; repeated rows are read
    each. An empty table gives no rows; other columns are not read."""
    mix = _mix(docs, target_entropy, repeat_limit, budget, source, text)
    units = (docs.select(F.struct(F.col(source).alias("name")).alias("src"), F.col(doc_id).alias("doc_id"),
                         tokens(F.col(text)).alias("t"))
             .join(mix.select("src", "passes"), "src")
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes")))).drop("passes"))
    placed = _placed(units, mix, seed)
    start = F.col("pass").cast("long") * F.col("all_tokens") + F.col("before")
    every = F.lit(float(block_tokens)) * F.col("weight")
    kept = (placed.withColumn("start", start).filter(F.col("start") < F.col("budget"))
            .withColumn("block", F.floor(F.col("start") / every).cast("long")))
    w = Window.partitionBy("block").orderBy("h", "src", "pass", "t")
    return kept.select("doc_id", F.col("src.name").alias("source"), F.col("pass").cast("int").alias("pass"),
                       F.col("t").alias("n_tokens"), "weight", "block",
                       (F.row_number().over(w) - F.lit(1)).alias("position"))


def mixed(docs: DataFrame, target_entropy: float | None = None, repeat_limit: float | None = 2.0,
          budget: float | None = None, seed: int = 7, doc_id: str = "doc_id", source: str = "source",
          text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, as often as ``schedule`` reads them (a
    whole text is decided in place by its source's cut; no text is shuffled).
    Documents whose places are equal are read together."""
    mix = _mix(docs, target_entropy, repeat_limit, budget, source, text)
    src, passes, cut, n = (fresh(docs, c) for c in ("mix_source", "mix_passes", "mix_cut", "mix_times"))
    table = materialise(cuts(docs, mix, seed, doc_id, source, text), "cuts").toDF(src, passes, cut)
    d = docs.join(table, F.struct(F.col(source).alias("name")) == F.col(src))
    more = (permutation(F.col(doc_id), F.col(passes), seed) <= F.col(cut)).cast("int")
    d = d.withColumn(n, F.col(passes) + more).filter(F.col(n) > 0)
    d = d.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n))))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])
