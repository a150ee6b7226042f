"""Each pipeline stage against a plain version, on the smallest test tables."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from test_text_operators import components_of, naive_best_fit, slow_fingerprint
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from churnlake.llm import kn_quality
from churnlake.llm.common import materialise, table

SF = "/root/testdata/sf0.001"


def words_of(text):
    return len(re.findall(r"[^ \t\n\x0b\f\r]+", text or "")) + 1


def mixed_plainly(rows, limit):
    """How often each (doc_id, source) is read."""
    n = defaultdict(int)
    for i, s, t in rows:
        n[s] += words_of(t)
    top, least = max(n.values()), min(n.values())
    alpha = 0.0 if top == least else max(0.0, 1 - math.log(limit) / math.log(top / least))
    out = Counter()
    for s, total in n.items():
        budget = math.floor(top * (total / top) ** alpha + 1e-6)
        for k in range(budget // total + 1):
            h = lambda i: int(hashlib.md5(f"{i}/{k}/7".encode()).hexdigest()[:15], 16)
            at = k * total
            for i, _, t in sorted((r for r in rows if r[1] == s), key=lambda r: (h(r[0]), words_of(r[2]))):
                if at < budget:
                    out[(i, s)] += 1
                at += words_of(t)
    return out


def test_stages_in_turn(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "mix", "pack"]
    docs = table(spark, SF, "documents")
    columns = docs.columns
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in table(spark, SF, "labels").collect()}

    kept = materialise(P.quality(spark, docs, SF), "quality")
    assert kept.columns == columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in kn_quality.classify(docs, table(spark, SF, "labels")).filter("kept").collect()}
    clean = [i for i, l in labels.items() if l == (1, 0)]
    junk = [i for i, l in labels.items() if l[0] == 0]
    assert sum(i in ids for i in clean) >= 0.98 * len(clean) and sum(i in ids for i in junk) <= 0.4 * len(junk)

    single = materialise(P.near_duplicates(spark, kept, SF), "single")
    assert single.columns == columns
    rows = kept.select("doc_id", "text").orderBy("doc_id").collect()
    least = {}
    for c, r in zip(components_of([slow_fingerprint(r["text"]) for r in rows], 2), rows):
        least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(least.values())

    mix = materialise(P.mix(spark, single, SF), "mix")
    assert mix.columns == columns
    rows = [(r["doc_id"], r["source"], r["text"]) for r in single.collect()]
    assert Counter((r["doc_id"], r["source"]) for r in mix.collect()) == mixed_plainly(rows, 2.0)

    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in mix.collect():
        x = [*tk.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(x), 4096)):
            want[(r["doc_id"], k, at, len(x[at:at + 4096]), zlib.crc32(np.array(x[at:at + 4096], "<u4").tobytes()))] += 1
    got = P.pack(spark, mix, SF).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert sorted(4096 - u for u in used.values()) == naive_best_fit([k[3] for k in want.elements()], 4096)


CLASHES = ("quality string, quality_nll double, quality_n long, lot string, limit_of string, limit_mean double, "
           "kept_id string, kept_hash string, kept_hash_r string, text_key long, kept_key int, fp string, pass long, "
           "bucket string, start double, component string, rank string, weight string")


def test_stages_with_clashing_columns_nulls_and_nothing(spark, tmp_path, monkeypatch):
    """Every stage on documents whose extra columns have the stages' own names, with
    null ids, texts, languages and sources, empty and repeated rows, and on none."""
    text = "the quick brown fox jumps over the lazy dog and runs away from all the others"
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text + " x", "en", "b"), (None, text, None, None),
            (3, None, "en", "a"), (4, "", None, "b"), (5, "other words " * 3000, "de", None), (None, None, None, None)]
    rows += [(10 + i, f"{text} number {i} " * (1 + i % 3), "en", "ab"[i % 2]) for i in range(20)]
    names = [c.split()[0] for c in CLASHES.split(", ")]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.length("text").cast("long"))
    extra = spark.createDataFrame([(None,) * len(names)], CLASHES)
    docs = base.crossJoin(extra)
    labels = spark.createDataFrame([(10 + i, 1, 0) for i in range(20)] + [(None, None, None), (2, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (docs, docs.limit(0)):
        now = materialise(frame, "edge")
        for name, stage in P.STAGES:
            out = materialise(stage(spark, now, str(tmp_path)), f"edge-{name}")
            if name != "pack":
                assert out.columns == docs.columns
                assert out.count() >= 1 if frame is docs else out.count() == 0
                now = out
        assert (out.count() >= now.count()) if frame is docs else out.count() == 0
