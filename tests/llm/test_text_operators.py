"""SimHash, packing, bit packing, token counts and mixing against brute force."""
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from edge import DOCS, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from churnlake.llm import bestfit, bitpack, mixing, simhash, token_trie
from churnlake.llm.components import connected_components
from churnlake.llm.encode import Encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


# ---- SimHash --------------------------------------------------------------------------------

def slow_fingerprint(text, k=3):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall("[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(values, radius):
    """Component of each index by all pairs."""
    own = list(range(len(values)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                own[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_near_duplicates_on_edge_cases(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    comp = components_of(fps, 2)
    least = defaultdict(list)
    for c, r in zip(comp, rows):
        least[c].append(r["doc_id"])
    want = sorted(((r["doc_id"], f, min((x for x in least[c] if x is not None), default=None))
                   for r, f, c in zip(rows, fps, comp)), key=key)
    got = simhash.near_duplicates(docs, tree_rows=2).collect()
    assert sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got), key=key) == want


def test_keep_one_keeps_one_row_of_each_component(spark, docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    comp = components_of([slow_fingerprint(r["text"]) for r in docs.select("text").collect()], 2)
    kept = got.collect()
    assert len(kept) == len(set(comp))
    assert {1, 5, 6, 9}.issubset({r["doc_id"] for r in kept}) and not {2, 7, 15} & {r["doc_id"] for r in kept}


def test_simhash_empty_table(spark):
    none = nothing(spark, DOCS)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("radius,tree_rows", [(2, 3), (2, 500), (3, 16), (0, 4), (1, 2)])
def test_links_connect_what_all_pairs_connect(spark, radius, tree_rows):
    r = random.Random(radius)
    base = [r.getrandbits(64) for _ in range(12)]
    values = {b for b in base}
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(r.randint(0, 4)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values = sorted(values)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, tree_rows)
    seen = links.collect()
    assert all(((x["a"] ^ x["b"]) & (2**64 - 1)).bit_count() <= radius for x in seen)
    got = {x["node"]: x["component"] for x in connected_components(links).collect()}
    want = components_of(values, radius)
    same = lambda f: {frozenset(v for v, c in zip(signed, f) if c == x) for x in f}
    assert same([got.get(v, v) for v in signed]) == same(want)


def test_bk_tree_search_equals_scan():
    r = random.Random(5)
    values = [r.getrandbits(16) for _ in range(400)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[::9]:
        assert sorted(tree.search(q, 3)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 3]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 3), (3, 2)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(201)) and all(got[2000 + i] == 1000 for i in range(300))
    assert len(got) == 201 + 301


# ---- encoding, packing ----------------------------------------------------------------------

@pytest.mark.parametrize("path,kind", [(BYTE, "byte"), (WORD, "word")])
@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r'sStT.,  \x1c\x85ÉéßΣİ"), st.characters(codec="utf-8")),
               max_size=80))
def test_encoder_equals_the_library(path, kind, text):
    e = ENCODERS.setdefault(path, Encoder(path, kind))
    want = e.tk.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(e.encode(text), "<u4").tolist() == want
    # in a batch, before and after texts of all kinds, cached and not
    batch = [text, None, "a  b\n", text, "", "\n\n x\t", "Stra\u00dfe \u00a0z", text + " ", " ", "<|endoftext|>" + text]
    got = e.encode_all(pa.array(batch, pa.string()))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        e.tk.encode(t or "", add_special_tokens=False).ids for t in batch]


ENCODERS: dict[str, Encoder] = {}


def ids_of(path, text, end):
    tk = ENCODERS.setdefault(path, Encoder(path, "byte" if path == BYTE else "word")).tk
    return [*tk.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def naive_best_fit(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [x for x in left if x >= n]
        if fits:
            left[left.index(min(fits))] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 50).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_opens_the_bins_of_best_fit_decreasing(case):
    capacity, lengths = case
    used, ranks = Counter(), defaultdict(list)
    for n, first, bins, per, seq, at in bestfit.plan(Counter(lengths).items(), capacity):
        for s in range(seq, seq + bins):
            assert used[s] == at
            used[s] += n * per
        ranks[n].append((first, first + bins * per))
    assert sorted(capacity - u for u in used.values()) == naive_best_fit(lengths, capacity)
    for n, k in Counter(lengths).items():  # every rank once
        assert sorted(x for a, b in ranks[n] for x in range(a, b)) == list(range(k))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 100)), st.integers(0, 100))
def test_capacity_tree(present, at):
    t = bestfit.CapacityTree(100)
    for x in present:
        t.set(x, True)
    assert t.first_from(at) == min((x for x in present if x >= at), default=-1)


def test_pack_on_edge_cases(spark, docs):
    capacity = 512
    got = bestfit.pack(docs, WORD, "word", end_id=1, capacity=capacity).collect()
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = ids_of(WORD, r["text"], 1)
        want += [(r["doc_id"], n, at, len(ids[at:at + capacity]), crc(ids[at:at + capacity]))
                 for n, at in enumerate(range(0, len(ids), capacity))]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    rows = defaultdict(list)
    for r in got:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in rows.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in v) for v in rows.values()) == naive_best_fit([w[3] for w in want], capacity)


def test_pack_empty_table(spark):
    assert bestfit.pack(nothing(spark, DOCS), WORD).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 24, 31, 32])
def test_bit_packing_round_trip_and_random_access(bits):
    r = np.random.default_rng(bits)
    ids = r.integers(0, 2**bits, 10_001, dtype=np.uint64).astype("<u4")
    lengths = [0, 1, 4000, 0, 6000]
    s = bitpack.Shard(bitpack.shard_bytes([5, None, 7, 7, 9], lengths, ids, bits, block=1024))
    assert (s.ids(0, s.n_ids) == ids).all() and s.known.tolist() == [1, 0, 1, 1, 1]
    for a, b in [(0, 0), (1023, 1025), (5000, 5001), (9999, 20000)]:
        assert (s.ids(a, b) == ids[a:b]).all()
    assert (s.document(2) == ids[1:4001]).all()
    assert len(s.payload) <= 10_001 * bits / 8 + 16


def test_bits_for_a_vocabulary():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 4, 5, 50257, 65536, 65537)] == [1, 1, 2, 2, 3, 16, 16, 17]


def test_token_files_on_edge_cases(spark, docs):
    got = bitpack.roundtrip(docs, BYTE, "byte", end_id=2).collect()
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r["doc_id"], len(i), crc(i)) for r in rows for i in [ids_of(BYTE, r["text"], 2)]), key=key)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == want
    at = 0
    order = sorted(got, key=lambda r: r["start"])
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_token_files_of_an_empty_table(spark):
    assert bitpack.roundtrip(nothing(spark, DOCS), BYTE).count() == 0


# ---- token counts ---------------------------------------------------------------------------

def slow_count(scores, byte, word):
    best, n = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for e in range(1, len(word) + 1):
        for s in range(e - 1, -1, -1):
            p = word[s:e]
            if p in scores:
                v, k = scores[p], 1
            elif e - s == 1:
                k = len(p.encode())
                v = k * byte
            else:
                continue
            if best[s] + v > best[e]:
                best[e], n[e] = best[s] + v, n[s] + k
    return n[-1]


def test_token_counts_on_edge_cases(spark, docs, monkeypatch):
    monkeypatch.setattr(token_trie, "TRIE_NODES", 50)  # the driver's trie below starts anew often
    scores = token_trie.piece_scores(PIECES)
    trie = token_trie.Trie(scores)
    want = []
    for r in docs.filter(F.length("text") < 3000).collect():
        pre = token_trie.pretokens(r["text"])
        n = sum(slow_count(scores, trie.byte, w) for w in pre)
        assert trie.count(pre) == n
        want.append((r["doc_id"], len(pre), n))
    want += [(r["doc_id"], 0, 0) for r in docs.filter("text is null").collect()]
    got = token_trie.token_counts(docs, PIECES)
    short = {(r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in got.collect()}
    assert set(want) <= short and got.count() == docs.count()
    assert token_trie.token_counts(nothing(spark, DOCS), PIECES).count() == 0


def test_token_counts_equal_the_library_unigram():
    scores = token_trie.piece_scores(PIECES)
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *scores.items()], 0, False))
    trie = token_trie.Trie(scores)
    text = "the quick brown foxes are jumping over unbelievably lazy dogs while reading newspapers 12345"
    for w in token_trie.pretokens(text):
        assert trie.count([w]) == len(lib.encode(w).ids)


def test_shared_prefixes_are_computed_once():
    trie = token_trie.Trie(token_trie.piece_scores(PIECES))
    trie.count(["abcd", "abce", "abc"])
    assert len(trie.best) == 1 + 5 and trie.terminal.keys() == {"abcd", "abce", "abc"}


# ---- mixing ---------------------------------------------------------------------------------

def totals(spark, sizes):
    return spark.createDataFrame([((f"s{i}",), 1, n) for i, n in enumerate(sizes)],
                                 "src struct<name:string>, docs long, tokens long")


def entropy(w):
    return -sum(x * math.log(x) for x in w if x)


def test_exponent_meets_entropy_and_repetition(spark):
    sizes = [10_000, 1_000, 300, 20]
    t = totals(spark, sizes)
    w = lambda a: [n**a / sum(m**a for m in sizes) for n in sizes]
    a = mixing.exponent(t, target_entropy=1.0)
    assert entropy(w(a)) == pytest.approx(1.0, abs=1e-6)
    a = mixing.exponent(t, repeat_limit=3.0)
    assert (10_000 / 20) ** (1 - a) == pytest.approx(3.0, rel=1e-6)
    assert mixing.exponent(t, target_entropy=5.0) == 0.0 and mixing.exponent(t, repeat_limit=1.0) == 1.0
    assert mixing.exponent(t, repeat_limit=1e9) == 0.0


def test_schedule_realises_the_weights(spark, docs):
    got = mixing.schedule(docs, repeat_limit=2.0, block_tokens=5000).collect()
    n = defaultdict(int)
    for r in docs.collect():
        n[r["source"]] += len(re.findall(r"[^ \t\n\x0b\f\r]+", r["text"] or "")) + 1
    spent, per = defaultdict(int), defaultdict(set)
    for r in got:
        spent[r["source"]] += r["n_tokens"]
        per[r["pass"]].add(r["doc_id"])
    ids = {r["doc_id"] for r in docs.collect()}
    assert per[0] == ids                               # everything once at least
    top = max(n.values())
    weight = {r["source"]: r["weight"] for r in got}
    budget = {s: w * top / max(weight.values()) for s, w in weight.items()}
    assert sum(weight.values()) == pytest.approx(1.0)
    for s in n:
        longest = max(r["n_tokens"] for r in got if r["source"] == s)
        assert budget[s] - 1 <= spent[s] < budget[s] + longest and budget[s] <= 2 * n[s] * (1 + 1e-6)
    places = defaultdict(list)
    for r in got:
        places[r["block"]].append(r["position"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())


def test_budget_below_the_corpus_takes_heads_of_permutations(spark, docs):
    got = mixing.schedule(docs, repeat_limit=1.0, budget=3000.0).collect()
    assert 0 < sum(r["n_tokens"] for r in got) and {r["pass"] for r in got} == {0}
    assert len(got) < docs.count()


def test_budgets_of_large_sources_reach_a_whole_pass(spark):
    r = random.Random(4)
    for _ in range(3):
        rows = [((f"s{i}",), 10, r.randint(10**12, 9 * 10**13)) for i in range(40)]
        totals = spark.createDataFrame(rows, "src struct<name: string>, docs long, tokens long")
        for alpha in (0.3, 1.0):
            assert mixing.weights(totals, alpha).filter("budget < tokens or passes < 1").count() == 0


def test_mixed_rows_are_the_scheduled_ones(spark, docs):
    got = mixing.mixed(docs, repeat_limit=2.0)
    assert got.columns == docs.columns
    a = Counter((r["doc_id"], r["source"]) for r in got.collect())
    b = Counter((r["doc_id"], r["source"]) for r in mixing.schedule(docs, repeat_limit=2.0).collect())
    differ = {k for k in a | b if a[k] != b[k]}
    assert differ <= {(12, None), (None, "a"), (None, None), (13, "a"), (13, "b")}  # equal places are read together
    assert mixing.mixed(nothing(spark, DOCS)).count() == 0 and mixing.schedule(nothing(spark, DOCS)).count() == 0


def test_prefix_sums_over_many_buckets(spark):
    from churnlake.llm.common import prefix_sums
    r = random.Random(3)
    rows = [(r.choice("xy"), i, r.randint(1, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, w long").withColumn("b", F.floor(F.col("k") / 7))
    got = {x["k"]: x["s"] for x in prefix_sums(df, ["g"], "b", ["k"], "w", "s").collect()}
    for g, k, _ in rows:
        assert got[k] == sum(w for h, j, w in rows if h == g and j < k)


@pytest.mark.parametrize("kind, file", [("byte", "byte_bpe_50k.json"), ("word", "word_bpe_49k.json")])
def test_a_workers_next_task_meets_segments_it_knows(kind, file):
    e = Encoder(public_tokenizers.path(file), kind)
    texts = pa.array([" ".join(f"a{i}z" for i in range(100_000)), None, "", " b\n\n a1z a2z \n", "\na1z", "a1z\n"])
    first = e.encode_all(texts)
    assert first == [e.encode(t) for t in texts.to_pylist()]
    e.rest()
    learned, learn = [], e._learn
    e._learn = lambda new: (learned.extend(new), learn(new))
    assert e.encode_all(texts) == first and not learned
