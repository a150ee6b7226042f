"""Target resampling, substring removal and the conversation trie against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from edge import CLASH, DOCS, EXTRA, documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from churnlake.llm import prefix_trie, substring, target_sampling
from churnlake.llm import words as W
from churnlake.llm.fm_index import FMIndex, WaveletMatrix

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = "[^\x20\x09-\x0D]+"
ALNUM = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


# ---- words ------------------------------------------------------------------------------

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é\n日.x\t\0", max_size=120), st.just("longword" * 40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([16, 100, 1 << 20]), st.integers(0, 4))
def test_pieces_hold_every_word_and_every_run_once(texts, size, overlap):
    met, runs = defaultdict(dict), Counter()
    for p in W.pieces(pa.array(texts, pa.string()), W.WHITE, size=size, overlap=overlap):
        body = p.data.tobytes()
        for a, b, r, n in zip(p.start, p.end, p.row, p.number):
            assert met[int(r)].setdefault(int(n), body[a:b]) == body[a:b]
        stop = np.searchsorted(p.row, p.row, side="right")
        runs.update((int(p.row[i]), int(p.number[i])) for i in range(len(p.row)) if i + overlap + 1 <= stop[i])
    for r, t in enumerate(texts):
        want = [w.encode() for w in re.findall(WHITE, t or "")]
        assert [met[r][k] for k in range(len(met[r]))] == want
        assert all(runs[(r, k)] == 1 for k in range(len(want) - overlap))
    assert all(c == 1 for c in runs.values())


def test_xxh64_equals_the_library_and_slots_are_told_apart_by_bytes():
    r = random.Random(1)
    strings = [bytes(r.choice(b"ab\0") for _ in range(r.choice([1, 2, 3, 4, 7, 8, 9, 16, 31, 32, 33, 80]))) for _ in range(3000)]
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    end = np.cumsum([len(s) for s in strings])
    start = end - [len(s) for s in strings]
    h = W.xxh64(data, start, end, 42)
    assert [int(x) for x in h] == [xxhash.xxh64_intdigest(s, seed=42) for s in strings]
    table = W.InternTable(16)
    for lo in range(0, 3000, 500):  # few different keys: most probes meet other strings
        i = slice(lo, lo + 500)
        slot = table.add(data, start[i], end[i], h[i] & np.uint64(7))
        assert [table.strings()[k] for k in slot] == strings[i]
    assert dict(zip(table.strings(), table.count[:table.n].tolist())) == Counter(strings)


# ---- target resampling ------------------------------------------------------------------

def slow_resample(rows, target, longest, buckets, seed, least, percent):
    def features(t):
        w = re.findall(ALNUM, (t or "").translate(UPPER))
        return [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)], len(w)

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t)[0])
    t = Counter(bucket(f) for x in target for f in features(x)[0])
    S, T = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for d, text in rows:
        f, n = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * S / ((s[b] + 1) * T))) for b in map(bucket, f))
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(fit[:percent * len(fit) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


@pytest.mark.parametrize("longest,buckets", [(1, 10000), (3, 50)])
def test_resample_on_edge_cases(spark, docs, longest, buckets):
    target = ["one ünïcödé x1 y2", None, "", "aeiou one one"]
    got = target_sampling.resample(docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "n long, text string"),
                                   longest, buckets, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        slow_resample(rows, target, longest, buckets, 2024, 20, 40), key=key)


def test_resample_of_cut_texts(spark, docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").filter("doc_id < 6").collect()]
    for longest in (1, 2, 4):
        want = {(d, n, w) for d, n, w, _, _ in slow_resample(rows, ["a"], longest, 100, 1, 20, 10)}
        gain = target_sampling.gains(docs.filter("doc_id < 6"), spark.createDataFrame([("a",)], "text string"), longest, 100)
        batch = pa.array([t for _, t in rows])
        table, met = W.InternTable(), Counter()
        for p in W.pieces(batch, W.NOT_ALNUM, lower=True, overlap=longest - 1, size=300):
            data, a, b, row = target_sampling.grams(p, longest)
            slots = table.add(data, a, b, W.xxh64(data, a, b))
            text = table.strings()
            for r, x in zip(row, slots):
                met[(int(r), "n")] += 1
                met[(int(r), "w")] += int(gain[zlib.crc32(text[x]) % 100])
        assert {(d, met[(i, "n")], met[(i, "w")]) for i, (d, _) in enumerate(rows)} == want


def test_resample_of_nothing(spark, docs):
    none = nothing(spark, DOCS)
    assert target_sampling.resample(none, docs).collect() == []
    assert len(target_sampling.resample(docs, none).collect()) == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 60), st.integers(1, 6))
def test_words_from_features(n, longest):
    f = sum(max(0, n - k) for k in range(longest))
    assert target_sampling._words_of(np.array([f]), longest)[0] == n


# ---- FM-index and substring removal -----------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), min_size=1, max_size=25), min_size=1, max_size=8),
       st.lists(st.lists(st.integers(1, 7), min_size=1, max_size=25), min_size=1, max_size=4), st.integers(1, 14))
def test_matching_statistics(texts, queries, depth):
    holder = [(7 * i) % 5 for i in range(len(texts))]
    index = FMIndex(np.array([x for t in texts for x in [*t, 0]]), depth,
                    np.array([h for t, h in zip(texts, holder) for _ in range(len(t) + 1)]))
    length = np.array([len(q) for q in queries])
    start = np.cumsum(length) - length
    got, row = index.matching_statistics(np.array([x for q in queries for x in q]), start, length)
    for q, s in zip(queries, start):
        for i in range(len(q)):
            fits = [k for k in range(depth + 1) if i + k <= len(q) and any(
                t[j:j + k] == q[i:i + k] for t in texts for j in range(len(t) - k + 1))]
            assert got[s + i] == max(fits, default=0)
            if got[s + i] == depth:
                assert index.least(row[s + i:s + i + 1])[0] == min(
                    h for t, h in zip(texts, holder) for j in range(len(t)) if t[j:j + depth] == q[i:i + depth])


def test_wavelet_rank():
    r = np.random.default_rng(3)
    for symbols in (1, 2, 3, 64, 65, 1000):
        seq = r.integers(0, symbols, 700)
        w = WaveletMatrix(seq, symbols)
        c, at = r.integers(0, symbols, 300), r.integers(0, 701, 300)
        assert w.rank(c, at).tolist() == [int((seq[:i] == x).sum()) for x, i in zip(c, at)]


def slow_dedupe(rows, length):
    words = [re.findall(WHITE, t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - length + 1):
            if d is not None:
                s = tuple(w[i:i + length])
                first[s] = min(first.get(s, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - length + 1) if d is not None and first[tuple(w[i:i + length])] < d
                for j in range(i, i + length)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passages(n=60):
    """Documents that share passages at many offsets, one of them in most documents."""
    r = random.Random(9)
    w = lambda k: [f"w{r.randrange(400)}" for _ in range(k)]
    common, others = w(30), [w(r.randint(8, 25)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = w(r.randint(0, 20))
        for _ in range(r.randint(0, 4)):
            text += r.choice([common, common, *others]) + w(r.randint(0, 3))
        rows.append((r.choice([i, i, None, 5]), " ".join(text)))
    return rows + [(200, "a " * 500), (201, "a " * 700 + "b"), (100, " ".join(common)), (100, " ".join(common))]


@pytest.mark.parametrize("length", [1, 3, 13])
def test_dedupe_of_shared_passages(spark, monkeypatch, length):
    monkeypatch.setattr(substring, "SHARD_RUNS", 40)
    monkeypatch.setattr(substring, "HOT", 3)      # most anchors are dealt window by window
    rows = passages()
    frame = spark.createDataFrame([(d, t, *EXTRA) for d, t in rows], "doc_id long, text string, " + CLASH)
    got = substring.dedupe(frame.repartition(4), length)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(slow_dedupe(rows, length), key=key)


@pytest.mark.parametrize("length", [2, 13])
def test_dedupe_on_edge_cases(spark, docs, length):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = substring.dedupe(docs, length, with_text=True).collect()
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(slow_dedupe(rows, length), key=key)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got)


def test_dedupe_of_nothing(spark):
    assert substring.dedupe(nothing(spark, DOCS)).collect() == []
    with pytest.raises(ValueError):
        substring.dedupe(nothing(spark, DOCS), 0)


def test_runs_of_cut_texts_are_the_same():
    text = pa.array([" ".join(f"w{i % 97 * (i % 13)}" for i in range(3000))])
    whole, cut = set(), set()
    for size, out in ((1 << 20, whole), (500, cut)):
        for p in W.pieces(text, W.WHITE, size=size, overlap=12):
            first, anchor, _ = substring.windows(p, 13)
            out.update(zip(p.number[first].tolist(), anchor.tolist()))
    assert whole == cut and len(whole) == 3000 - 12


# ---- conversation trie ------------------------------------------------------------------

def slow_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append(((t is not None, t or 0), r or "", x or ""))
    seq = {c: [(r, x) for _, r, x in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in seq:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = seq.get(c - c % 20, [])[:h] + seq[c][h:]
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in m if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                    sum(not children[q] for q in below),
                    sum((len(members[q]) - 1) * len(re.findall(WHITE, q[-1][1])) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def talks(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(0, 90), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 9, 17])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "assistant", None]),
                         r.choice(["hi", "hi there", "a b\tc", "", None])))
    return rows + [(None, 1, "user", "lost"), (-3, 0, "user", "hi"), (40, 0, "user", "x" * 30000)] + rows[:2]


TALK = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 3)])
def test_trie_of_rebuilt_conversations(spark, seed, n):
    rows = talks(seed, n)
    frame = spark.createDataFrame([(*r, *EXTRA) for r in rows], f"{TALK}, {CLASH}")
    got = prefix_trie.branched_trie(frame).select(*prefix_trie.NODES).collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow_trie(rows), key=key)


def test_trie_of_one_shared_conversation(spark):
    """Very many conversations with the same turns: chunks of ids are hashed on."""
    rows = [(c, t, "user", f"t{t}") for c in range(0, 9000, 20) for t in range(3)]
    got = prefix_trie.branched_trie(spark.createDataFrame(rows, TALK)).select(*prefix_trie.NODES).collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow_trie(rows), key=key)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.branched_trie(nothing(spark, TALK)).collect() == []
    assert prefix_trie.branched_trie(spark.createDataFrame([(None, 1, "u", "x")], TALK)).collect() == []
    rows = [(c, 0, "u", "x") for c in range(1, 12) if zlib.crc32(str(c).encode()) % 4]  # all turns go, no base
    got = prefix_trie.branched_trie(spark.createDataFrame(rows, TALK)).select(*prefix_trie.NODES).collect()
    assert sorted(map(tuple, got), key=key) == sorted(slow_trie(rows), key=key)
