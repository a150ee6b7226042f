"""Interpolated modified Kneser-Ney model of all characters, scored by a join.

Every character of the trusted text is a symbol (its code point; 0 is the text's
start), and every n-gram of it is a row: the table grows with the corpus. A
context of up to three symbols is one long of 21 bits a symbol. A table row holds
the probability of an n-gram, or, with ``sym`` -1, what a context leaves to the
next lower order.

Scoring deals documents into lots of about ``LOT_CHARS`` characters, as many as the
text needs and no more. A lot asks for each distinct n-gram of its texts, numbered
in order. The distinct n-grams of all lots are answered level by level: each order
takes its own probability where the table has one, else what its context leaves
times the lower order's, and lower orders have ever fewer distinct n-grams. One
probability per n-gram goes back to the lot, where a co-group adds up its texts.
An n-gram meets a lot once, so a frequent one is no hot key; nothing of the table
passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.common import fresh, give_back, materialise, release

ORDER = 4                  # pairs of pairs, in _distinct
BITS = 21                  # a code point
CONTEXT = -1               # ``sym`` of a context's row
LOT_CHARS = 14_000_000
_CHUNK = 1_000_000
_HELD = 2_000_000          # n-grams that a counting task holds before it sends them on
_PAD = ORDER - 1
_TABLE = 1 << 24           # values up to which a table numbers them


# ---- n-grams --------------------------------------------------------------------------------

def _lots(texts):
    """(context, body, document number) items in lots of about ``_CHUNK`` characters."""
    lot, size = [], 0
    for i, t in enumerate(texts):
        t = t.replace("\0", "\1") if t and "\0" in t else t or ""
        for at in range(0, len(t), _CHUNK):
            lot.append((t[at - _PAD:at] if at else "\0" * _PAD, t[at:at + _CHUNK], i))
            size += len(lot[-1][1])
            if size >= _CHUNK:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _renumbered(values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The different values below ``top``, ascending, and each value's place among them."""
    if top > _TABLE:
        return np.unique(values, return_inverse=True)
    met = np.zeros(top, bool)
    met[values] = True
    kinds = np.flatnonzero(met)
    place = np.zeros(top, np.int32)
    place[kinds] = np.arange(len(kinds), dtype=np.int32)
    return kinds, place[values]


def _distinct(lot):
    """Contexts and symbols of a lot's distinct n-grams, which of them each body
    position ends, and the item it belongs to. Pairs of symbols are numbered
    first, then pairs of pairs, by tables where those are small."""
    s = np.frombuffer("".join(c + b for c, b, _ in lot).encode("utf-32-le", "replace"), "<u4").astype(np.int32)
    size = np.array([len(b) for _, b, _ in lot])
    item = np.repeat(np.arange(len(lot), dtype=np.int32), size)
    at = np.arange(size.sum()) + (item + 1) * _PAD
    chars, code = _renumbered(s, 1 << BITS)
    n = len(chars)
    pairs, pair = _renumbered(code[:-1].astype(np.int64) * n + code[1:], n * n)  # of every two neighbours
    m = len(pairs)
    grams, which = _renumbered(pair[at - 3].astype(np.int64) * m + pair[at - 1], m * m)
    first, last = pairs[grams // m], pairs[grams % m]
    ctx = chars[first // n].astype(np.int64)
    for x in (first % n, last // n):
        ctx = (ctx << BITS) | chars[x]
    return ctx, chars[last % n], which, item


def _by_language(langs, texts):
    langs = langs.to_pylist()
    where: dict = {}
    for i, x in enumerate(langs):
        where.setdefault(x or "", []).append(i)
    for lang, rows in where.items():
        yield lang, rows, (texts[i].as_py() for i in rows)


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``docs(lang, text)`` -> ``(lang, ctx, sym, n)``: n-grams of the highest order over all text."""

    def sent(acc):
        for lang, lots in acc.items():
            got = pd.concat(lots).groupby(["ctx", "sym"], sort=False, as_index=False)["n"].sum()
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(got)), pa.array(got["ctx"], pa.int64()),
                 pa.array(got["sym"], pa.int32()), pa.array(got["n"], pa.int64())], ["lang", "ctx", "sym", "n"])

    def run(batches):
        acc, held = {}, 0
        for b in batches:
            for lang, _, texts in _by_language(b.column(0), b.column(1)):
                for lot in _lots(texts):
                    ctx, sym, which, _ = _distinct(lot)
                    acc.setdefault(lang, []).append(pd.DataFrame({"ctx": ctx, "sym": sym, "n": np.bincount(which)}))
                    held += len(ctx)
                    if held >= _HELD:
                        yield from sent(acc)
                        acc, held = {}, 0
                        give_back()
        yield from sent(acc)
        acc.clear()
        give_back()

    return (docs.mapInArrow(run, "lang string, ctx long, sym int, n long")
            .groupBy("lang", "ctx", "sym").agg(F.sum("n").alias("n")))


# ---- training -------------------------------------------------------------------------------

def _column_short(order: int):
    return F.col("ctx").bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1).cast("long"))


def _lower(c: DataFrame, order: int) -> DataFrame:
    """Continuation counts of one order lower: how many symbols precede an n-gram.
    Nothing can precede the start, so n-grams that begin there keep their counts."""
    starts = F.col("ctx") < F.lit(1 << (BITS * (order - 3))) if order > 2 else F.lit(False)
    return (c.select("lang", _column_short(order - 1).alias("ctx"), "sym", "n").groupBy("lang", "ctx", "sym")
            .agg(F.sum("n").alias("raw"), F.count(F.lit(1)).alias("kinds"))
            .select("lang", "ctx", "sym", F.when(starts, F.col("raw")).otherwise(F.col("kinds")).alias("n")))


def discounts(c: DataFrame) -> DataFrame:
    """The three discounts of a language and order, from its counts of counts."""
    n = [F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]
    q = c.groupBy("lang").agg(*[x.alias(f"n{i + 1}") for i, x in enumerate(n)])
    y = F.expr("try_divide(n1, n1 + 2 * n2)")
    out = ["lang"]
    for k in (1, 2, 3):
        d = F.lit(float(k)) - F.lit(k + 1.0) * y * F.expr(f"try_divide(n{k + 1}, n{k})")
        # too little text for an estimate: half of what is counted
        out.append(F.least(F.greatest(F.coalesce(d, F.lit(k / 2.0)), F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}"))
    return q.select(*out)


def train(grams: DataFrame) -> list[DataFrame]:
    """``grams(lang, ctx, sym, n)`` -> a table ``(lang, ctx, sym, v)`` per order. Order
    0 has one row a language, the even share of its characters and one more for all
    others."""
    counts = {ORDER: grams}
    for order in range(ORDER, 1, -1):
        counts[order - 1] = materialise(_lower(counts[order], order), f"counts{order - 1}")
    out = counts[1].groupBy("lang").agg((F.lit(1.0) / (F.count(F.lit(1)) + F.lit(1))).alias("v"))
    levels = [materialise(out.select("lang", F.lit(0).cast("long").alias("ctx"), F.lit(CONTEXT).alias("sym"), "v"),
                          "order0")]
    below = levels[0].select("lang", F.col("v").alias("low"))
    d = F.expr("case when n = 1 then d1 when n = 2 then d2 else d3 end")
    for order in range(1, ORDER + 1):
        c = counts[order]
        c = c.join(discounts(c), "lang").select("lang", "ctx", "sym", "n", d.alias("d"))
        sums = c.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
        c = c.join(sums, ["lang", "ctx"])
        if order == 1:
            c = c.join(below, "lang")
        else:
            c = c.withColumn("short", _column_short(order - 1)).join(below, ["lang", "short", "sym"])
        own = c.select("lang", "ctx", "sym",
                       ((F.col("n") - F.col("d") + F.col("held") * F.col("low")) / F.col("total")).alias("v"))
        left = sums.select("lang", "ctx", F.lit(CONTEXT).alias("sym"),
                           (F.col("held") / F.col("total")).alias("v"))
        level = materialise(own.unionByName(left), f"order{order}")
        below = level.filter(F.col("sym") != CONTEXT).select("lang", F.col("ctx").alias("short"), "sym",
                                                             F.col("v").alias("low"))
        levels.append(level)
    return levels


# ---- scoring --------------------------------------------------------------------------------

def _lot_grams(langs, texts, positions: bool = True):
    """Of each language of a lot, in order of name: the distinct n-grams in order,
    and with ``positions`` for each part of its texts the places of the part's own
    distinct n-grams among them, which of those each position ends, and the items'
    (row, characters)."""
    for lang, rows, own in sorted(_by_language(langs, texts), key=lambda x: x[0]):
        grams, parts = [], []
        for part in _lots(own):
            ctx, sym, which, _ = _distinct(part)
            grams.append((ctx, sym))
            if positions:
                parts.append((which.astype(np.int32, copy=False), [(rows[i], len(b)) for _, b, i in part]))
        if grams:
            ctx, sym = (np.concatenate(x) for x in zip(*grams))
            order = np.lexsort((sym, ctx))
            c, g = ctx[order], sym[order]
            new = np.append(True, (c[1:] != c[:-1]) | (g[1:] != g[:-1]))
            place = np.empty(len(order), np.int32)
            place[order] = np.cumsum(new) - 1
            cuts = np.cumsum([len(x) for x, _ in grams])[:-1]
            yield lang, c[new], g[new], [(own_, *p) for own_, p in zip(np.split(place, cuts), parts)]


def _answered(asked: DataFrame, model: list[DataFrame]) -> DataFrame:
    """``asked(lang, ctx, sym)``, distinct, with ``v``: the probability of each n-gram."""
    grams = {ORDER: asked}
    for order in range(ORDER - 1, 0, -1):
        grams[order] = materialise(
            grams[order + 1].select("lang", _column_short(order).alias("ctx"), "sym").distinct(), f"asked{order}")
    low = model[0].select("lang", F.col("v").alias("low"))
    for order in range(1, ORDER + 1):
        own = model[order].filter(F.col("sym") != CONTEXT).select("lang", "ctx", "sym", F.col("v").alias("own"))
        left = model[order].filter(F.col("sym") == CONTEXT).select("lang", "ctx", F.col("v").alias("left"))
        g = grams[order].join(own, ["lang", "ctx", "sym"], "left").join(left, ["lang", "ctx"], "left")
        if order == 1:
            g = g.join(low, "lang")  # languages without a model end here
        else:
            g = g.withColumn("short", _column_short(order - 1)).join(low, ["lang", "short", "sym"])
        v = F.coalesce("own", F.coalesce("left", F.lit(1.0)) * F.col("low"))
        g = materialise(g.select("lang", "ctx", "sym", v.alias("v")), f"answered{order}")
        low = g.select("lang", F.col("ctx").alias("short"), "sym", F.col("v").alias("low"))
    return g


def _packed(dealt: DataFrame, lot: str) -> DataFrame:
    """``lot, rows``: the rows of each lot in a batch, compressed together, which
    moves about half of what single rows would."""

    def run(batches):
        for b in batches:
            lots = b.column(b.num_columns - 1).to_numpy()
            rows = b.drop_columns(lot)
            order = np.argsort(lots, kind="stable")
            cut = np.flatnonzero(np.append(True, np.diff(lots[order]) != 0))
            for own in np.split(order, cut[1:]):
                if len(own):
                    sink = pa.BufferOutputStream()
                    some = rows.take(pa.array(own))
                    with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                        w.write_batch(some)
                    yield pa.RecordBatch.from_arrays([pa.array([int(lots[own[0]])], pa.int32()),
                                                      pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                     ["lot", "rows"])
                    del some, sink
            del b, rows, lots
        give_back()

    return dealt.mapInArrow(run, "lot int, rows binary")


def _unpacked(packed: pa.Table) -> pa.Table:
    give_back()  # of the lot before, whose tables have gone too
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in packed.column("rows")])


def score(docs: DataFrame, model: list[DataFrame], out: str, doc_id: str = "doc_id", lang: str = "lang",
          text: str = "text", lot_chars: int | None = None) -> DataFrame:
    """``docs`` with ``out``_nll (negative log-likelihood) and ``out``_n (characters).
    Empty and null texts and languages without a model have n = 0; a null language
    counts as the empty one. Very long texts are cut into overlapping parts. A task
    holds a lot of about ``lot_chars`` characters (``LOT_CHARS``); smaller ones ask
    for more n-grams in all, with the same scores."""
    lot = fresh(docs, "lot")
    chars = docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0
    lots = max(1, -(-chars // (lot_chars or LOT_CHARS)))
    # equal rows of different input partitions go to different lots
    place = F.pmod(F.xxhash64(doc_id, text, F.spark_partition_id()), F.lit(lots)).cast("int")
    dealt = _packed(docs.withColumn(lot, place), lot)
    fields = [*docs.columns, f"{out}_nll", f"{out}_n"]
    kinds = [("lang", pa.string()), ("ctx", pa.int64()), ("sym", pa.int32()), ("nr", pa.int32()), ("lot", pa.int32())]

    def asked(packed: pa.Table) -> pa.Table:
        t, tables, n = _unpacked(packed), [], 0
        for x, ctx, sym, _ in _lot_grams(t.column(lang), t.column(text), positions=False):
            nr = np.arange(n, n + len(ctx), dtype=np.int32)
            n += len(ctx)
            tables.append(pa.table([pa.repeat(x, len(ctx)), pa.array(ctx), pa.array(sym, pa.int32()), pa.array(nr),
                                    pa.repeat(packed.column("lot")[0], len(ctx))], schema=pa.schema(kinds)))
        return pa.concat_tables(tables or [pa.schema(kinds).empty_table()])

    def answered(packed: pa.Table, told: pa.Table) -> pa.Table:
        t = _unpacked(packed)
        nll, n = np.zeros(len(t)), np.zeros(len(t), np.int64)
        every = list(_lot_grams(t.column(lang), t.column(text)))
        cost = np.full(sum(len(c) for _, c, _, _ in every), np.nan)
        cost[told.column("nr").to_numpy()] = -np.log(told.column("v").to_numpy())
        at = 0
        for _, ctx, _, parts in every:
            own, at = cost[at:at + len(ctx)], at + len(ctx)
            if len(own) and np.isnan(own[0]):
                continue  # no model of this language
            for places, which, items in parts:
                doc, size = (np.array(x) for x in zip(*items))
                # every item has characters
                np.add.at(nll, doc, np.add.reduceat(own[places][which], np.cumsum(size) - size))
                np.add.at(n, doc, size)
        return pa.Table.from_arrays([*t.columns, pa.array(nll), pa.array(n)], names=fields)

    # a task's last lot, too, gives back what it took, before its worker goes idle
    def ask(packed: pa.Table) -> pa.Table:
        got = asked(packed)
        give_back()
        return got

    def answer(packed: pa.Table, told: pa.Table) -> pa.Table:
        got = answered(packed, told)
        give_back()
        return got

    asks = materialise(dealt.groupBy("lot").applyInArrow(ask, "lang string, ctx long, sym int, nr int, lot int"), "asked")
    release(docs.sparkSession)  # the texts that were dealt for asking
    probability = _answered(materialise(asks.select("lang", "ctx", "sym").distinct(), f"asked{ORDER}"), model)
    told = asks.join(probability, ["lang", "ctx", "sym"]).select("lot", "nr", "v")
    schema = docs.withColumns({f"{out}_nll": F.lit(0.0), f"{out}_n": F.lit(0).cast("long")}).schema
    release(docs.sparkSession)
    return dealt.groupBy("lot").cogroup(told.groupBy("lot")).applyInArrow(answer, schema)
