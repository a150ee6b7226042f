"""Quality classifier: interpolated modified Kneser-Ney models of characters.

Each language has its own model, trained on all of its trusted text.
``classify`` and ``keep_clean`` use the model of all characters in kn_sharded.py,
whose tables grow with the text and are joined with the documents' n-grams.

Thresholds come from perplexities of trusted documents that the scoring model
has not seen: the trusted text is counted in two halves, and the model of either
half scores the other one. The sum of both counts gives the final model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.llm import kn_sharded
from churnlake.llm.common import fresh, materialise

QUANTILE = 0.99           # of the trusted documents of a language
POOLED_DOCS = 100         # weight, in documents, of all languages' quantile in one language's limit
PRIOR_CHARS = 64          # a document counts as having so many more average characters
BROADCAST_IDS = 1_000_000
KEEP_LOT_CHARS = 6_000_000  # ``keep_clean``: its workers carry whole rows, and later stages meet what they hold
_HALF = "\x01"  # between a language and the number of its half


def _language(lang: str) -> F.Column:
    return F.coalesce(F.col(lang), F.lit(""))


def trusted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents labelled of good quality and not toxic."""
    ids = labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("_trusted")).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(ids, F.col(doc_id) == F.col("_trusted"), "left_semi")


# ---- thresholds and decisions ---------------------------------------------------------------

def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``scored(lang, nll, n)`` of trusted documents -> ``(lang, mean, limit)``:
    the language's mean, and that plus the quantile of its documents' differences
    from it (adjusted mean negative log-likelihoods, in steps of a thousandth).
    The quantile of all languages counts as ``POOLED_DOCS`` further documents, so
    a few odd documents do not set the limit of a small language."""
    some = scored.filter("n > 0")
    mean = some.groupBy("lang").agg((F.sum("nll") / F.sum("n")).alias("mean"))
    steps = (some.join(mean, "lang")
             .select("lang", F.ceil((_adjusted("nll", "n", "mean") - F.col("mean")) * F.lit(1000)).alias("step"))
             .groupBy("lang", "step").agg(F.count(F.lit(1)).alias("k")))
    own = _cut(steps, ["lang"], quantile).withColumnsRenamed({"cut": "own", "all": "docs"})
    every = _cut(steps.groupBy("step").agg(F.sum("k").alias("k")), [], quantile).select(F.col("cut").alias("every"))
    weight = F.lit(POOLED_DOCS)
    return (mean.join(own, "lang").crossJoin(F.broadcast(every))  # one row
            .select("lang", "mean", (F.col("mean") + (F.col("docs") * F.col("own") + weight * F.col("every"))
                                     / (F.col("docs") + weight) / F.lit(1000.0)).alias("limit")))


def _cut(steps: DataFrame, by: list[str], quantile: float) -> DataFrame:
    """``steps(*by, step, k)`` -> ``(*by, cut, all)``: the step at the quantile. It is
    below the last document's whenever there are two or more."""
    w = Window.partitionBy(*by).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy(*by)
    return (steps.withColumn("upto", F.sum("k").over(w)).withColumn("all", F.sum("k").over(total))
            .filter(F.col("upto") > F.floor((F.col("all") - 1) * F.lit(quantile)))
            .groupBy(*by, "all").agg(F.min("step").alias("cut")))


def _adjusted(nll: str, n: str, mean: str) -> F.Column:
    """Mean over the document and ``PRIOR_CHARS`` average characters of its
    language: a few odd characters of a short text are little evidence."""
    return (F.col(nll) + F.lit(PRIOR_CHARS) * F.col(mean)) / (F.col(n) + F.lit(PRIOR_CHARS))


def fit(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, doc_id: str = "doc_id",
                lang: str = "lang", text: str = "text", lot_chars: int | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Model of all characters (kn_sharded.py) and thresholds of the trusted documents."""
    good = trusted(docs.select(F.col(doc_id).alias("doc_id"), _language(lang).alias("lang"),
                               F.coalesce(F.col(text), F.lit("")).alias("text")), labels)
    good = good.withColumn("half", F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)))
    named = lambda h: F.concat("lang", F.lit(_HALF), h.cast("string"))
    grams = materialise(kn_sharded.ngram_counts(good.select(named(F.col("half")).alias("lang"), "text")), "ngrams")
    every = (grams.select(F.expr("left(lang, length(lang) - 2)").alias("lang"), "ctx", "sym", "n")
             .groupBy("lang", "ctx", "sym").agg(F.sum("n").alias("n")))
    model = kn_sharded.train(materialise(every, "ngrams"))
    other = good.select("doc_id", F.col("lang").alias("of"), named(F.lit(1) - F.col("half")).alias("lang"), "text")
    s = kn_sharded.score(other, kn_sharded.train(grams), "s", lot_chars=lot_chars)
    s = materialise(s.select(F.col("of").alias("lang"), F.col("s_nll").alias("nll"), F.col("s_n").alias("n")), "scores")
    return model, thresholds(s, quantile)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, doc_id: str = "doc_id",
             lang: str = "lang", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang, perplexity, threshold, kept``.

    Perplexity is per character; ``kept`` compares the adjusted perplexity with
    the threshold of the language. Documents without characters, of a language
    without trusted text or with too little to hold some out have nothing against
    them and are kept. A null language counts as the empty one; repeated rows
    stay. An empty table gives no rows; other columns are not read."""
    model, limits = fit(docs, labels, quantile, doc_id, lang, text)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    s = (kn_sharded.score(d, model, "s")
         .select("doc_id", "lang", F.col("s_nll").alias("nll"), F.col("s_n").alias("n")))
    limits = limits.select(F.col("lang").alias("of"), "mean", "limit")
    got = s.join(limits, _language("lang") == F.col("of"), "left")
    known = F.col("n") > 0
    return got.select("doc_id", "lang", F.when(known, F.exp(F.col("nll") / F.col("n"))).alias("perplexity"),
                      F.exp("limit").alias("threshold"),
                      F.coalesce(~known | (_adjusted("nll", "n", "mean") <= F.col("limit")), F.lit(True))
                      .alias("kept"))


def keep_clean(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, doc_id: str = "doc_id",
               lang: str = "lang", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` keeps."""
    model, limits = fit(docs, labels, quantile, doc_id, lang, text, KEEP_LOT_CHARS)
    out = fresh(docs, "quality", "_nll", "_n")
    of, mean, limit = (fresh(docs, c) for c in ("limit_of", "limit_mean", "limit_at"))
    got = kn_sharded.score(docs, model, out, doc_id, lang, text, lot_chars=KEEP_LOT_CHARS)
    got = got.join(limits.select("lang", "mean", "limit").toDF(of, mean, limit),
                   _language(lang) == F.col(of), "left")
    ok = (F.col(out + "_n") == 0) | (_adjusted(out + "_nll", out + "_n", mean) <= F.col(limit))
    return got.filter(F.coalesce(ok, F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns])
