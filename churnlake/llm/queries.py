"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlake.llm import bestfit, bitpack, kmeans_dedup, kn_quality, mixing, multi_index, prefix_trie, simhash, substring, target_sampling, token_trie, url_gbt, warc, warc_sql
from churnlake.llm.common import table

QUERIES = {}
ORACLE = {}


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op4_simhash_bktree")
def op4(spark, sf_dir):
    """Every document's fingerprint and near-duplicate component."""
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, radius=2)
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op3_bit_packing")
def op3(spark, sf_dir):
    """Every document's ids, written as bit-packed shards and read back."""
    return bitpack.roundtrip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), "byte", end_id=2)


@register("op10_best_fit_packing")
def op10(spark, sf_dir):
    """Every document's pieces and their places in sequences of 4096 tokens."""
    return bestfit.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), "word", end_id=1,
                        capacity=4096)


@register("op6_kneser_ney_quality")
def op6(spark, sf_dir):
    """Every document's perplexity, its language's threshold and the decision."""
    return kn_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_temperature_mixing", r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t\n\x0b\f\r]+')), 0) + 1 AS t FROM documents),
s AS (SELECT source, sum(t)::BIGINT AS tokens FROM d GROUP BY source),
-- passes of the smallest source are (top / tokens) ** (1 - alpha) when the largest is read once
a AS (
  SELECT max(tokens) AS top,
    CASE WHEN max(tokens) = min(tokens) THEN 0.0
         ELSE greatest(0.0, 1.0 - ln(2.0) / ln(max(tokens)::DOUBLE / min(tokens))) END::DOUBLE AS alpha FROM s),
w AS (SELECT source, tokens, top, exp(alpha * ln(tokens / top::DOUBLE)) AS part FROM s, a),
m AS (
  SELECT source, tokens, part / sum(part) OVER () AS weight, floor(part * top + 1e-6)::BIGINT AS budget FROM w),
u AS (
  SELECT d.doc_id, d.source, d.t, m.tokens, m.weight, m.budget, unnest(range(0, m.budget // m.tokens + 1)) AS pass
  FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source),
h AS (
  SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || pass || '/7'), 1, 15))::BIGINT AS h FROM u),
p AS (
  SELECT *, pass * tokens + sum(t) OVER (PARTITION BY source, pass ORDER BY h, t ROWS UNBOUNDED PRECEDING) - t
    AS start FROM h),
k AS (SELECT *, floor(start / (1e6 * weight))::BIGINT AS block FROM p WHERE start < budget)
SELECT doc_id, source, pass::INTEGER AS pass, t AS n_tokens, round(weight, 9) AS weight, block,
  (row_number() OVER (PARTITION BY block ORDER BY h, source NULLS FIRST, pass, t) - 1)::INTEGER AS position
FROM k""")
def op7(spark, sf_dir):
    """The mixture of all sources: every document once at least, none of a small
    source more than twice, in blocks of a million tokens."""
    return (mixing.schedule(table(spark, sf_dir, "documents"), repeat_limit=2.0)
            .withColumn("weight", F.round("weight", 9)))


@register("op2_inverted_multi_index", """
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM e AS q JOIN e AS c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""")
def op2(spark, sf_dir):
    """The five nearest entries of every vector whose id is divisible by 50."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@register("op5_spherical_kmeans_dedup", """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e AS a JOIN e AS b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
r AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""")
def op5(spark, sf_dir):
    """Every vector's links of cosine 0.98 within its label and its component."""
    return kmeans_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.98)


@register("op9_trie_token_counts")
def op9(spark, sf_dir):
    """Every document's pre-tokens and tokens."""
    return token_trie.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@register("op8_url_boosted_trees")
def op8(spark, sf_dir):
    """Every page's verdict, by rule or by the trees."""
    return url_gbt.judge(table(spark, sf_dir, "pages"), URL_RULES)


WARC_DATE = "2024-01-01T00:00:00Z"


@register("op1_warc_derivatives", warc_sql.sql(WARC_DATE))
def op1(spark, sf_dir):
    """The metadata and conversion record of every page's response."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"), WARC_DATE))


CRC_TABLE = """list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def crc32_sql(value: str, table: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, with CRC_TABLE's column."""
    code = f"hex(encode({value}))"
    byte = f"list_transform(range(0, len({code}) // 2), lambda i: ('0x' || substr({code}, (2 * i + 1)::INT, 2))::BIGINT)"
    return (f"xor(list_reduce([4294967295::BIGINT] || {byte}, "
            f"lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)")


@register("op11_target_resampling", rf"""
WITH k AS (SELECT {CRC_TABLE} AS crc),
x AS (
  SELECT 's' AS side, doc_id AS id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT 't', item_id, row_number() OVER (), text FROM benchmark),
u AS (
  SELECT side, id, row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM x),
v AS (SELECT w, {crc32_sql("w", "crc")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM u), k),
f AS (SELECT u.side, u.id, u.row, v.bucket FROM u JOIN v USING (w)),
n AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM f GROUP BY bucket),
a AS (SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM n),
g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
  FROM n, a),
d AS (SELECT id, row, count(*) AS n, sum(gain)::BIGINT AS weight FROM f JOIN g USING (bucket) WHERE side = 's' GROUP BY ALL),
h AS (
  SELECT x.id AS doc_id, coalesce(d.n, 0) AS n_features, coalesce(d.weight, 0) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(x.id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM x LEFT JOIN d USING (row, id) WHERE x.side = 's'),
c AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS fit FROM c)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= 10 * fit // 100 THEN place END AS rank
FROM r""")
def op11(spark, sf_dir):
    """Every document's weight towards the benchmark's words, and the drawn tenth."""
    return target_sampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_fm_substring_dedup", r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w FROM documents),
x AS (SELECT row, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (
  SELECT row, doc_id, i, word, count(*) OVER o AS n, array_to_string(list(word) OVER o, ' ') AS seq
  FROM x WINDOW o AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
m AS (SELECT seq, min(doc_id) AS first FROM s WHERE n = 13 GROUP BY seq),
j AS (
  SELECT s.row, s.i, s.word, s.n = 13 AND coalesce(m.first < s.doc_id, false) AS again
  FROM s LEFT JOIN m ON m.seq = s.seq AND s.n = 13),
r AS (
  SELECT row, i, word, bool_or(again) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM j),
a AS (
  SELECT row, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM r GROUP BY row)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (row)""")
def op12(spark, sf_dir):
    """Every document without the passages of 13 words and more that a smaller doc_id holds."""
    return substring.dedupe(table(spark, sf_dir, "documents"), length=13)


@register("op13_conversation_trie", rf"""
WITH k AS (SELECT {CRC_TABLE} AS crc),
o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (
  SELECT c, c - ((c % 20) + 20) % 20 AS base, {crc32_sql("c::VARCHAR", "crc")} % 4 AS h
  FROM (SELECT DISTINCT c FROM o), k),
q AS (
  SELECT v.c, 0 AS part, o.pos, o.role, o.text FROM v JOIN o ON o.c = v.base AND o.pos < v.h
  UNION ALL SELECT v.c, 1, o.pos, o.role, o.text FROM v JOIN o ON o.c = v.c AND o.pos >= v.h),
t AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS p FROM q),
x AS (
  SELECT c, p, text, array_to_string(list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY p
    ROWS UNBOUNDED PRECEDING), '') AS name FROM t
  UNION ALL SELECT c, 0, '', '' FROM v),
n AS (
  SELECT p, name, min(c) AS id, count(*) AS n_convs,
    (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^ \t\n\x0b\f\r]+')) AS saved FROM x GROUP BY p, name),
m AS (SELECT n.id AS node, n.p AS depth, x.c, x.p FROM n JOIN x ON x.p = n.p AND x.name = n.name),
-- the nodes' smallest members' nodes one turn up, and all their nodes up to their own depth
par AS (SELECT n.id, n.p, m.node AS parent FROM n JOIN m ON m.c = n.id AND m.p = n.p - 1),
ch AS (SELECT parent AS id, p - 1 AS p, count(*) AS n_children FROM par GROUP BY ALL),
f AS (SELECT n.*, coalesce(ch.n_children, 0) AS n_children FROM n LEFT JOIN ch ON ch.id = n.id AND ch.p = n.p),
s AS (
  SELECT m.node AS id, m.depth AS p, sum(f.saved) AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM f JOIN m ON m.c = f.id AND m.p <= f.p GROUP BY ALL),
l AS (SELECT c, max(p) AS p FROM x GROUP BY c),
e AS (
  SELECT m.node AS id, m.depth AS p, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ends
  FROM l JOIN m ON m.c = l.c AND m.p = l.p GROUP BY ALL)
SELECT f.id AS conv_id, f.p::BIGINT AS depth, par.parent AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM f JOIN s ON s.id = f.id AND s.p = f.p LEFT JOIN par ON par.id = f.id AND par.p = f.p
LEFT JOIN e ON e.id = f.id AND e.p = f.p""")
def op13(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"))
