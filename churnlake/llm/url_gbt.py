"""URL filter: host and path rules, and gradient-boosted trees for all other URLs.

Rules name a host with all its subdomains and a path prefix; the longest fitting
rule decides. URLs that a rule decides are the labelled examples: lexical
features of a bounded sample of them train the trees, which judge every URL
without a rule. Suffix statistics (how often, and how often blocked, a host's
last label and its last two labels are among all labelled URLs) are counted over
all rows. A rule labels all URLs of its suffix, so a suffix would tell the trees the
label itself: while fitting, a URL's statistics leave out all URLs of its own rule,
and half of what is left is hidden at random, as a URL without a rule often has a
suffix that no rule has met. Everything is column expressions, aggregates and joins.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import materialise

TRAIN_ROWS = 20_000    # labelled URLs of each verdict, about, that the trees are fitted on
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._/%?=&:"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["len", "host_len", "path_len", "depth", "digits", "entropy", "params", "query_len", "labels", "hyphens",
           "longest_label"]
SUFFIX = ["tld_share", "tld_blocked", "site_share", "site_blocked"]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    h = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(h, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_col: Column, path_col: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits. A rule is
    ``host/path``; the list is a parameter, so it is one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r, v in sorted(rules, key=lambda x: (len(x[0]), x[0])):
        h, p = r.split("/", 1)
        fits = ((host_col == h) | host_col.endswith("." + h)) & path_col.startswith("/" + p)
        name, verdict = F.when(fits, F.lit(r)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _count(s: Column, what: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(what), F.lit("")))


def features(df: DataFrame, url: str, host_col: str, path_col: str, prefix: str) -> DataFrame:
    """``df`` with the lexical features, each named ``prefix`` and its name."""
    u = F.translate(F.coalesce(F.col(url), F.lit("")), _UPPER, _LOWER)
    h, p = F.col(host_col), F.col(path_col)
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    counts = [_count(u, c).cast("double") for c in _ALPHABET]
    rest = F.length(F.translate(u, _ALPHABET, "")).cast("double")
    entropy = F.lit(0.0)
    for c in [*counts, rest]:
        entropy = entropy - F.when(c > 0, c / n * F.log2(c / n)).otherwise(F.lit(0.0))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    values = {
        "len": n, "host_len": F.length(h), "path_len": F.length(p), "depth": _count(p, "/"),
        "digits": F.length(F.regexp_replace(u, "[^0-9]", "")) / n, "entropy": entropy,
        "params": F.when(query == "", F.lit(0)).otherwise(_count(query, "&") + F.lit(1)),
        "query_len": F.length(query), "labels": F.when(h == "", F.lit(0)).otherwise(_count(h, ".") + F.lit(1)),
        "hyphens": _count(u, "-"),
        "longest_label": F.array_max(F.transform(F.split(h, r"\."), lambda x: F.length(x))),
    }
    return df.withColumns({prefix + k: v.cast("double") for k, v in values.items()})


def _suffixes(df: DataFrame, host_col: str, prefix: str) -> DataFrame:
    h = F.col(host_col)
    return df.withColumns({prefix + "tld": F.substring_index(h, ".", -1), prefix + "site": F.substring_index(h, ".", -2)})


def suffix_counts(labelled: DataFrame, key: str, verdict: str, by: str) -> DataFrame:
    """``(key, by, n, blocked)``: labelled URLs of a suffix and rule, and blocked ones."""
    return labelled.groupBy(key, by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(verdict) == "block").alias("blocked"))


def _statistics(n: Column, blocked: Column) -> tuple[Column, Column]:
    """Logarithm of one plus the URLs' number, and the smoothed share of blocked ones."""
    return F.log1p(n.cast("double")), (blocked + F.lit(1.0)) / (n + F.lit(2.0))


def _out_of_rule(df: DataFrame, counts: dict[str, DataFrame], by: str, prefix: str, hidden: Column) -> DataFrame:
    """``df``, rows with a rule, with each suffix's statistics over other rules' URLs;
    none of them where ``hidden``."""
    for name, c in counts.items():
        k = prefix + name
        own = c.toDF(k + "_of", k + "_by", k + "_n", k + "_b")
        every = c.groupBy(k).agg(F.sum("n"), F.sum("blocked")).toDF(k + "_all", k + "_sn", k + "_sb")
        df = (df.join(own, (F.col(k) == F.col(k + "_of")) & (F.col(by) == F.col(k + "_by")))
              .join(every, F.col(k) == F.col(k + "_all")))
        share, blocked = _statistics(*[F.when(hidden, F.lit(0)).otherwise(F.col(f"{k}_s{x}") - F.col(f"{k}_{x}"))
                                       for x in "nb"])
        df = df.withColumns({k + "_share": share, k + "_blocked": blocked}).drop(
            *[f"{k}_{x}" for x in ("of", "by", "n", "b", "all", "sn", "sb")])
    return df


def _with_suffixes(df: DataFrame, counts: dict[str, DataFrame], prefix: str) -> DataFrame:
    """``df`` with each suffix's statistics over all labelled URLs."""
    for name, c in counts.items():
        k = prefix + name
        share, blocked = _statistics(F.sum("n"), F.sum("blocked"))
        s = c.groupBy(k).agg(share, blocked).toDF(k + "_of", k + "_share", k + "_blocked")
        df = (df.join(s, F.col(k) == F.col(k + "_of"), "left").drop(k + "_of")
              .withColumns({k + "_share": F.coalesce(k + "_share", F.lit(0.0)),
                            k + "_blocked": F.coalesce(k + "_blocked", F.lit(0.5))}))
    return df


def judge(pages: DataFrame, rules: list[tuple[str, str]], page_id: str = "page_id", url: str = "url",
          train_rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 4, seed: int = 7) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, score``.

    ``score`` is the trees' probability of blocking, null where a rule decides.
    A null or malformed URL has an empty host and path and is judged by its
    features like any other. If all labelled URLs have one verdict, that is the
    verdict of the rest; without any, ``allow``. Null and repeated ids are kept.
    An empty table gives no rows; other columns are not read."""
    d = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    d = d.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    d = _suffixes(d.withColumn("rule", name).withColumn("ruled", verdict), "host", "f_")
    labelled = d.filter("ruled is not null").select("page_id", "url", "host", "path", "f_tld", "f_site", "rule", "ruled")
    sizes = {r["ruled"]: r["count"] for r in labelled.groupBy("ruled").count().collect()}  # allow, block
    kinds = sorted(sizes)
    columns = ["page_id", "host", "path", "rule"]
    if len(kinds) < 2:
        only = kinds[0] if kinds else "allow"
        return d.select(*columns, F.coalesce("ruled", F.lit(only)).alias("verdict"),
                        F.lit(None).cast("double").alias("score"))
    counts = {k: materialise(suffix_counts(labelled, "f_" + k, "ruled", "rule"), k) for k in ("tld", "site")}
    # the bound is on the fit only; the statistics above are of all rows
    place = F.pmod(F.xxhash64("page_id", "url", F.lit(seed)), F.lit(1 << 30))
    share = F.lit(0)
    for k in kinds:
        share = F.when(F.col("ruled") == k, F.lit(int(min(1.0, train_rows / sizes[k]) * (1 << 30)))).otherwise(share)
    some = labelled.filter(place < share)
    names = ["f_" + x for x in LEXICAL + SUFFIX]
    vec = VectorAssembler(inputCols=names, outputCol="f_vec")
    hidden = F.pmod(F.xxhash64("url", "page_id", F.lit(seed + 1)), F.lit(2)) == 0
    sample = features(_out_of_rule(some, counts, "rule", "f_", hidden), "url", "host", "path", "f_")
    sample = sample.withColumn("f_y", (F.col("ruled") == "block").cast("double")).select(*names, "f_y")
    sample = materialise(sample, "url_sample")
    model = GBTClassifier(featuresCol="f_vec", labelCol="f_y", maxIter=trees, maxDepth=depth, seed=seed)
    model = model.fit(vec.transform(sample).select("f_vec", "f_y").coalesce(8))
    every = features(_with_suffixes(d, counts, "f_"), "url", "host", "path", "f_")
    got = model.transform(vec.transform(every))
    block = vector_to_array("probability")[1]
    return got.select(*columns,
                      F.coalesce("ruled", F.when(block >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
                      .alias("verdict"),
                      F.when(F.col("ruled").isNull(), block).alias("score"))
