"""LM scoring with a probabilistic suffix tree over words whose states are tables.

Tokens are lowered words, then one end token per text. The counts of all training tokens give a unigram distribution,
add-one smoothed; it is the root of the tree. A context is the last 1 to ``depth`` tokens (the start of a text is one,
too). It is a candidate state if training texts hold it ``least`` times or more, and it keeps the next symbols that follow
it ``entry_least`` times or more. Both counts hold for a corpus of any size, so other texts beside them take no state away
for being many.

A state smooths with what the state of its suffix gives (``strength`` pseudo counts), and so does the mass of the symbols
that it does not keep: P(w | s) = (count(s, w) + (rest(s) + strength) * P(w | suffix)) / (count(s) + strength), where
count(s, w) is 0 for symbols not kept and rest(s) is their total. So the probabilities of a state sum to 1. A state is
retained if its next symbols diverge from its suffix's: the log-likelihood gain, count * KL in nats over the kept symbols
and the rest, must exceed ``gain`` per kept symbol. The suffixes of a retained state stay, too. A token is scored by its
longest retained state.

That score is a sum: the root's log, plus for each retained suffix of the context the log of its back-off factor, plus for
each kept (state, symbol) what the symbol gains over that factor. Each term is a row of one table (hash, value). Terms in
a share of ``local_share`` or more of the training tokens (the ``NEAR`` most frequent ones at most) are added where the text is;
all others go through one join by hash, behind a bitmap of fixed size that only saves work. Nothing else is sent out.

Counting goes by levels: an n-gram can be frequent only if both its (n-1)-grams are, so bitmaps of those (fixed size,
false positives cost work, not truth) thin out what is shuffled; exact counts decide. All n-grams are told apart by 64-bit
hashes. What is shuffled are not rows but sorted blocks of counts, dealt by hash: an n-gram made of frequent parts is one
number of their places in a table, the difference to the number before it, in as few bytes as that takes; others are their
hashes. Texts of any length are read whole; one text is one slice of a task's memory.

Null and empty texts have the end token only. Repeated rows count and are scored one by one. A null id counts as an
empty one. With no training rows N and V are 0 and every token has probability 1; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import NOT_SPACE, Lookup, Tokens, blocks, cut, mixed, spread_join

END, START = np.uint64(0x51ED270B9F652C41), np.uint64(0x2545F4914F6CDD1D)
FOLDS, HELD_OUT = 7, 2
DEPTH, LEAST, ENTRY_LEAST, GAIN, STRENGTH = 3, 100, 20, 1.0, 20.0
LOCAL_SHARE = 2.5e-7
#: A context or suffix in 1 / SPREAD of the training tokens (there are at most SPREAD a level) is joined by broadcast.
SPREAD = 1024
#: Places in a bitmap, as a power of two.
BITS = 24
#: Training tokens a deal of n-grams, which one group adds up; there are 16 to 2**16 deals.
DEAL = 1 << 21
#: Terms of all kinds that every task holds at most; all others go through the join.
NEAR = 1 << 20
#: Kinds of terms: a word's root log, a state's back-off, a kept symbol's gain.
WORD, BACK, EXTRA = 1, 2, 3
_SLICE = 1 << 20


def held_out(id_col: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the n-gram whose first and last n-1 tokens have these hashes."""
    with np.errstate(over="ignore"):
        return mixed(left * np.uint64(0x9FB21C651E98DF25) + mixed(right + np.uint64(0xD1B54A32D192ED03)))


def term(kind: int, h: np.ndarray) -> np.ndarray:
    """Hash of a term's row; words are their own."""
    with np.errstate(over="ignore"):
        return h if kind == WORD else mixed(h + np.uint64(kind) * np.uint64(0x9E3779B97F4A7C15))


class Grams:
    """Hashes of the n-grams that end at each token of a slice; each text has a start before and an end behind it."""

    def __init__(self, t: Tokens):
        n = t.counts()
        self.rows = len(n)
        base = np.concatenate([[0], np.cumsum(n + 2)])
        self.row = np.repeat(np.arange(self.rows), n + 2)
        self.place = np.arange(base[-1]) - base[self.row]
        seq = np.empty(base[-1], np.uint64)
        seq[base[:-1]] = START
        seq[base[1:] - 1] = END
        seq[np.arange(len(t)) + 2 * np.repeat(np.arange(self.rows), n) + 1] = t.hash
        self.of = [seq, seq]  # of[n][i]: the n-gram that ends at i; valid where place >= n - 1

    def up_to(self, n: int) -> Grams:
        while len(self.of) <= n:
            last = self.of[-1]
            longer = np.zeros_like(last)
            longer[1:] = joined(last[:-1], last[1:])
            self.of.append(longer)
        return self

    def next(self, n: int) -> np.ndarray:
        """Places of tokens to predict with a context of n tokens."""
        return np.flatnonzero(self.place >= max(n, 1))


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, cuts): places by key, and where in that order a new key begins. Equal keys come in any order, which a
    stable sort, as in ``np.unique`` with indices, pays for several times."""
    order = np.argsort(key)
    key = key[order]
    return order, np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _by_row(rows: np.ndarray, h: np.ndarray, most: int) -> np.ndarray:
    """Places by row, below ``most``, and then by hash."""
    if most > 1 << 16:
        return np.lexsort((h, rows))
    order = np.argsort(h)
    return order[np.argsort(rows[order].astype(np.uint16), kind="stable")]


class _Counter:
    """Counts of rows of 64-bit columns; what is held is compacted as it doubles and handed on above a bound."""

    def __init__(self, columns: int, most: int = 1_500_000):
        self.columns, self.most, self.parts, self.size = columns, most, [], 0

    def add(self, key: np.ndarray, *columns: np.ndarray) -> None:
        order, cuts = _grouped(key)
        first = order[cuts]
        self.parts.append((key[first], np.diff(np.r_[cuts, len(key)]), *(c[first] for c in columns)))
        self.size += len(first)

    def compact(self) -> None:
        if len(self.parts) > 1:
            key, times, *columns = (np.concatenate(x) for x in zip(*self.parts))
            order, cuts = _grouped(key)
            first = order[cuts]
            self.parts = [(key[first], np.add.reduceat(times[order], cuts) if len(cuts) else times, *(c[first] for c in columns))]
        self.size = sum(len(p[0]) for p in self.parts)

    def full(self) -> bool:
        if self.size > self.most:
            self.compact()
        return self.size > self.most * 3 // 4

    def take(self) -> tuple[np.ndarray, ...] | None:
        self.compact()
        out, self.parts, self.size = (self.parts[0] if self.parts else None), [], 0
        return out


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _count_words(batches):
    """Per task: (hash, count) of training words, and under the end's hash the texts."""
    counter, ends = _Counter(0), 0

    def out():
        got = counter.take()
        if got is not None:
            yield pa.RecordBatch.from_arrays([_long(got[0]), pa.array(got[1])], names=["h", "c"])

    for batch in batches:
        for at, end, data, offsets in blocks(batch.column(0), _SLICE):
            ends += end - at
            counter.add(Tokens(data, offsets, NOT_SPACE).hash)
            if counter.full():
                yield from out()
    yield from out()
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([END]).view(np.int64)), pa.array([ends], pa.int64())], names=["h", "c"])


def passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h >> np.uint64(65 - (8 * len(bitmap)).bit_length())
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Leading bits of column h; at most 2**BITS / 64 rows come to the driver, whatever the table's size."""
    slot = F.shiftrightunsigned("h", 64 - BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITS}) & 63 as int))")
    words = hashes.select(F.shiftrightunsigned(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(np.uint8)


def _hashes(rows: DataFrame) -> np.ndarray:
    """Column h of a bounded number of rows."""
    return rows.select("h").toArrow()["h"].to_numpy().view(np.uint64)


class Coding:
    """n-grams made of frequent parts as one number: the parts' places in a table, side by side."""

    def __init__(self, keys: np.ndarray):
        self.lookup = Lookup(keys)
        self.bits = max(1, (len(keys) - 1).bit_length())

    def fits(self, parts: int) -> bool:
        return self.bits * parts <= 64

    def encode(self, places: list[np.ndarray]) -> np.ndarray:
        out = places[0].astype(np.uint64)
        for x in places[1:]:
            out = out << np.uint64(self.bits) | x.astype(np.uint64)
        return out

    def decode(self, code: np.ndarray, parts: int) -> list[np.ndarray]:
        """Hashes of the parts."""
        last = np.uint64((1 << self.bits) - 1)
        return [self.lookup.keys[(code >> np.uint64(self.bits * j) & last).astype(np.int64)] for j in reversed(range(parts))]


def pack(columns: list[np.ndarray]) -> tuple[int, bytes]:
    """(size, bytes) of 64-bit columns of one length, the first one ascending: its differences, then the others, each by
    places of bytes without the highest ones that are zero throughout."""
    columns = [np.diff(columns[0], prepend=np.uint64(0)), *columns[1:]]
    wide = [(int(x.max()).bit_length() + 7) // 8 if len(x) else 0 for x in columns]
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for x, w in zip(columns, wide)]
    raw = np.array([len(columns[0]), *wide], "<u8").tobytes() + b"".join(planes)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpack(size: int, packed: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, size, codec="zstd", asbytes=True), np.uint8)
    at = 8 * (columns + 1)
    n, *wide = (int(x) for x in raw[:at].view("<u8"))
    out = []
    for w in wide:
        x = np.zeros((n, 8), np.uint8)
        x[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(x.reshape(-1).view("<u8"))
        at += n * w
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def _count_grams(levels: list[int], n: int, as_context, as_entry, coding, deals: int):
    """Blocks of counts of (level + 1)-grams, dealt to 2**deals by hash: rows (level, whether coded, deal, size, block).

    The bitmaps hold n-grams that may be contexts and that may be entries. A context of a higher level is made of such
    n-grams, too: each n-gram in it must be frequent. A coded block holds (code, count), others (hash of the context, hash
    of the suffix, count).
    """

    def run(batches):
        contexts, entries, code = as_context.value, as_entry.value, Coding(coding.value)
        counters = {(d, coded): _Counter(0 if coded else 2) for d in levels for coded in (True, False)}

        def out(d, coded):
            got = counters[d, coded].take()
            if got is None or not len(got[0]):
                return
            key, times, *columns = got
            deal = (mixed(key) >> np.uint64(64 - deals)).astype(np.uint16)
            columns = [*(columns or [key]), times.view(np.uint64)]
            order = np.argsort(columns[0])
            order = order[np.argsort(deal[order], kind="stable")]
            deal, columns = deal[order], [c[order] for c in columns]
            first = np.flatnonzero(np.r_[True, deal[1:] != deal[:-1]])
            blocks_ = [pack([c[i:j] for c in columns]) for i, j in zip(first, [*first[1:], len(deal)])]
            m = len(first)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, d, np.int32)), pa.array(np.full(m, coded)), pa.array(deal[first].astype(np.int32)), pa.array([x for x, _ in blocks_], pa.int64()), pa.array([x for _, x in blocks_], pa.binary())], names=["d", "coded", "deal", "size", "block"])

        def add(d, coded, key, *columns):
            counters[d, coded].add(key, *columns)
            if counters[d, coded].full():
                yield from out(d, coded)

        for batch in batches:
            for _, _, data, offsets in blocks(batch.column(0), _SLICE):
                g = Grams(Tokens(data, offsets, NOT_SPACE)).up_to(max(levels) + 1)
                can = passes(contexts, g.of[n])
                if n == 1:
                    can |= g.place == 0
                fits = passes(entries, g.of[n])
                place = code.lookup.find(g.of[n])
                for d in levels:
                    i = g.next(d)
                    i = i[fits[i]]
                    for back in range(1, d - n + 2):
                        i = i[can[i - back]]
                    parts = [place[i - back] for back in reversed(range(d - n + 2))]
                    known = np.logical_and.reduce([x >= 0 for x in parts]) & code.fits(len(parts))
                    yield from add(d, True, code.encode([x[known] for x in parts]))
                    i = i[~known]
                    yield from add(d, False, g.of[d + 1][i], g.of[d][i - 1], g.of[d][i])
        for d, coded in counters:
            yield from out(d, coded)

    return run


def _add_up(n: int, coding, least: int):
    """(d, h, ctx, suf, c) of one deal's blocks: the hashes of the n-gram, its context and suffix, if counted ``least`` times."""

    def run(table: pa.Table) -> pa.Table:
        d, coded = table["d"][0].as_py(), table["coded"][0].as_py()
        read = [unpack(size.as_py(), block.as_py(), 2 if coded else 3) for size, block in zip(table["size"], table["block"])]
        *columns, times = (np.concatenate(x) for x in zip(*read))
        key = columns[0] if coded else joined(*columns)
        order, cuts = _grouped(key)
        c = np.add.reduceat(times.view(np.int64)[order], cuts)
        first, c = order[cuts][c >= least], c[c >= least]
        if coded:
            grams = Coding(coding.value).decode(key[first], d - n + 2) if len(first) else [key[first]] * 2
            while len(grams) > 2:
                grams = [joined(a, b) for a, b in zip(grams, grams[1:])]
        else:
            grams = [x[first] for x in columns]
        return pa.table({"d": pa.array(np.full(len(c), d, np.int32)), "h": _long(joined(*grams)), "ctx": _long(grams[0]), "suf": _long(grams[1]), "c": pa.array(c)})

    return run


def _level(counted: DataFrame, contexts: DataFrame, above: DataFrame, tokens: int, strength: float, gain: float) -> DataFrame:
    """(h, ctx, suf, c, p, up, total, back, passed): entries of one level, p being what the state ctx gives the symbol.

    contexts: (ctx, total) of candidate states; above: (suf, up, n), what the suffixes' states give. back is the state's
    back-off factor; passed says whether it diverges from its suffix.
    """
    often = tokens / SPREAD
    hot = contexts.where(F.col("total") > often)
    # Each join is cut: a spread join names its rows and its table twice, so joins of joins would multiply in the plan.
    e = cut(spread_join(counted, contexts, "ctx", hot))
    e = cut(spread_join(e, above.drop("n"), "suf", above.where(F.col("n") > often)))
    s = e.groupBy("ctx").agg(F.first("total").alias("total"), F.sum("c").alias("held"), F.sum("up").alias("mass"), F.count("*").alias("symbols"), F.sum(F.col("c") * F.log(F.col("c") / F.col("total") / F.col("up"))).alias("own"))
    rest = F.greatest(F.col("total") - F.col("held"), F.lit(0))
    others = F.when(rest > 0, rest * F.log(rest / F.col("total") / F.greatest(F.lit(1e-12), 1 - F.col("mass")))).otherwise(0.0)
    states = cut(s.select("ctx", ((rest + strength) / (F.col("total") + strength)).alias("back"), (F.col("own") + others > gain * F.col("symbols")).alias("passed")))
    p = F.col("c") / (F.col("total") + strength) + F.col("back") * F.col("up")
    return cut(spread_join(e, states, "ctx", hot).select("h", "ctx", "suf", "c", p.alias("p"), "up", "total", "back", "passed"))


class Model:
    """``terms`` (h, kind, v, c), the training tokens and texts, the vocabulary, and the number of states."""

    def __init__(self, terms: DataFrame, tokens: int, size: int, ends: int, states: list[DataFrame]):
        self.terms, self.tokens, self.size, self.ends, self.levels = terms, tokens, size, ends, states

    def states(self) -> list[int]:
        return [s.count() for s in self.levels]


def _terms(columns: DataFrame, kind: int) -> DataFrame:
    """(h, v, c) as terms of a kind."""

    def run(batches):
        for b in batches:
            h = term(kind, b.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([_long(h), pa.array(np.full(len(h), kind, np.int32)), b.column(1), b.column(2)], names=["h", "kind", "v", "c"])

    return columns.mapInArrow(run, "h long, kind int, v double, c long")


def fit(texts: DataFrame, depth: int = DEPTH, least: int = LEAST, entry_least: int = ENTRY_LEAST, gain: float = GAIN, strength: float = STRENGTH, local_share: float = LOCAL_SHARE) -> Model:
    """The tree of all texts (one binary column)."""
    spark = texts.sparkSession
    words = cut(texts.mapInArrow(_count_words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    N, V = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    entry_least = min(least, entry_least)
    ends = int(words.where(F.col("h") == int(END.view(np.int64))).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    starts = spark.range(1).select(F.lit(int(START.view(np.int64))).alias("ctx"), F.lit(ends).cast("long").alias("total"))
    contexts = words.where((F.col("c") >= least) & (F.col("h") != int(END.view(np.int64)))).select(F.col("h").alias("ctx"), F.col("c").alias("total")).union(starts.where(F.col("total") >= least))
    above = words.select(F.col("h").alias("suf"), ((F.col("c") + 1) / F.lit(float(N + V + 1))).alias("up"), F.col("c").alias("n"))
    as_context, as_entry = (spark.sparkContext.broadcast(bitmap(words.where(F.col("c") >= n).select("h"))) for n in (least, entry_least))
    often = max(entry_least, local_share * N)
    starting = START if ends else np.zeros(0, np.uint64)
    coding = spark.sparkContext.broadcast(np.append(_hashes(words.where(F.col("c") >= often)), starting))
    deals = min(16, max(4, math.ceil(math.log2(max(1, N / DEAL)))))
    levels, counted = [], None
    for d in range(1, depth + 1):
        if d != 3:  # the third level needs no pass of its own: it is thinned out by pairs as the second is
            now, n = [d, 3] if d == 2 and depth > 2 else [d], min(d, 2)
            found = texts.mapInArrow(_count_grams(now, n, as_context, as_entry, coding, deals), "d int, coded boolean, deal int, size long, block binary")
            counted = cut(found.groupBy("d", "coded", "deal").applyInArrow(_add_up(n, coding, entry_least), "d int, h long, ctx long, suf long, c long"))
        entries = _level(counted.where(F.col("d") == d).select("h", "ctx", "suf", "c"), contexts, above, N, strength, gain)
        levels.append(entries)
        contexts = entries.where((F.col("c") >= least)).select(F.col("h").alias("ctx"), F.col("c").alias("total"))
        above = entries.select(F.col("h").alias("suf"), F.col("p").alias("up"), F.col("c").alias("n"))
        if d == 1 and depth > 1:
            as_context, as_entry = (spark.sparkContext.broadcast(bitmap(entries.where(F.col("c") >= n).select("h"))) for n in (least, entry_least))
            coding = spark.sparkContext.broadcast(_hashes(entries.where(F.col("c") >= often)))
    # From the longest contexts down: a retained state's suffix is retained. A state is an entry of the level above it.
    kept, wanted = [], None
    for d in range(depth, 0, -1):
        keep = levels[d - 1].where("passed").select("ctx")
        kept.insert(0, cut((keep if wanted is None else keep.union(wanted)).distinct()))
        if d > 1:
            wanted = levels[d - 2].join(kept[0].withColumnRenamed("ctx", "h"), "h", "left_semi").select(F.col("suf").alias("ctx"))
    terms = _terms(words.select("h", F.log10(F.col("c") + F.lit(1.0)).alias("v"), "c"), WORD)
    for entries, keep in zip(levels, kept):
        own = entries.join(keep, "ctx", "left_semi")
        terms = terms.union(_terms(own.groupBy("ctx").agg(F.log10(F.first("back")).alias("v"), F.first("total").alias("c")).withColumnRenamed("ctx", "h"), BACK))
        terms = terms.union(_terms(own.select("h", F.log10(F.col("p") / F.col("up") / F.col("back")).alias("v"), "c"), EXTRA))
    return Model(cut(terms), int(N), int(V), ends, kept)


def _score(depth: int, tables: dict[int, tuple[np.ndarray, np.ndarray]], far_map: np.ndarray, names: list[str]):
    """A row of each text with the sums of the terms known here and no term (its ``h`` is met nowhere), and rows of the
    other terms: hash and times, without the text's columns."""
    local = {}
    for kind, (h, v) in tables.items():
        order = np.argsort(h)
        local[kind] = (Lookup(h), v[order])

    def run(batches):
        for batch in batches:
            for at, end, data, offsets in blocks(batch.column(0), _SLICE):
                t = Tokens(data, offsets, NOT_SPACE)
                n = t.counts()
                m = len(n)
                g = Grams(t).up_to(depth + 1)
                base, shift, seen = np.zeros(m), np.zeros(m), np.zeros(m, np.int64)
                far_rows, far_hashes = [], []

                def look(kind, h, rows, total):
                    """Adds what is known here; says where a term is known or may be known elsewhere."""
                    table, values = local[kind]
                    found = table.find(h)
                    here = found >= 0
                    total += np.bincount(rows[here], weights=values[found[here]], minlength=m)
                    if kind == WORD:
                        np.add(seen, np.bincount(rows[here], minlength=m), out=seen)
                        away = ~here
                    else:
                        away = ~here & passes(far_map, h)
                    far_rows.append(rows[away])
                    far_hashes.append(h[away])
                    return here | away

                look(WORD, t.hash, t.rows(), base)
                back = extra = np.flatnonzero(g.place >= 1)
                for d in range(1, depth + 1):  # a state's suffix is a state, and what a state keeps its suffix keeps
                    back = back[g.place[back] >= d]
                    back = back[look(BACK, term(BACK, g.of[d][back - 1]), g.row[back], shift)]
                    extra = np.intersect1d(extra, back, assume_unique=True)
                    extra = extra[look(EXTRA, term(EXTRA, g.of[d + 1][extra]), g.row[extra], shift)]
                fr, fh = np.concatenate(far_rows).astype(np.int64), np.concatenate(far_hashes)
                sort = _by_row(fr, fh, m)
                fr, fh = fr[sort], fh[sort]
                cuts = np.flatnonzero(np.r_[True, (fr[1:] != fr[:-1]) | (fh[1:] != fh[:-1])]) if len(fr) else np.zeros(0, np.int64)
                times = np.diff(np.r_[cuts, len(fr)])
                own = batch.slice(at, end - at)
                row = own.column(1)
                alone = mixed(row.to_numpy().view(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                yield pa.RecordBatch.from_arrays([row, _long(alone), pa.array(np.zeros(m, np.int64)), *(own.column(i) for i in range(2, own.num_columns)), pa.array(n + 1), pa.array(seen), pa.array(base), pa.array(shift)], names=names)
                if len(cuts):
                    none = [pa.nulls(len(cuts), f.type) for f in own.schema][2:]
                    yield pa.RecordBatch.from_arrays([row.take(pa.array(fr[cuts])), _long(fh[cuts]), pa.array(times.astype(np.int64)), *none, *(pa.nulls(len(cuts), k) for k in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=names)

    return run


def _least_near(terms: DataFrame, least: float, most: int = NEAR) -> float:
    """The least count of terms that every task holds: ``least``, or more where over ``most`` terms of all kinds have that."""
    sizes = terms.where(F.col("c") >= least).groupBy(F.floor(F.log2("c") * 16).alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c"))
    held, found = 0, math.inf
    for row in sorted(sizes.collect(), key=lambda r: -r.b):
        held += row.n
        if held > most:
            return found
        found = row.c
    return least


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, least: int = LEAST, entry_least: int = ENTRY_LEAST, local_share: float = LOCAL_SHARE, gain: float = GAIN, strength: float = STRENGTH) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("binary").alias("t")
    out = held_out(F.col(id_col))
    model = fit(docs.where(~out).select(text), depth, least, entry_least, gain, strength, local_share)
    N, V, ends, terms = model.tokens, model.size, model.ends, model.terms
    near = F.col("c") >= _least_near(terms, max(2.0, local_share * N))
    here = terms.where(near).select("h", "kind", "v").toArrow()
    h, which, v = (here[c].to_numpy() for c in ("h", "kind", "v"))
    tables = {k: (h[which == k].view(np.uint64), v[which == k]) for k in (WORD, BACK, EXTRA)}
    fitted = spark.sparkContext.broadcast((tables, bitmap(terms.where(~near & (F.col("kind") != WORD)).select("h"))))
    names = ["row", "h", "times", "id", "out", "n_tokens", "seen", "base", "shift"]

    def run(batches):
        yield from _score(depth, *fitted.value, names)(batches)

    read = docs.select(text, F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), out.alias("out"))
    scored = read.mapInArrow(run, f"row long, h long, times long, id {docs.schema[id_col].dataType.simpleString()}, out boolean, n_tokens long, seen long, base double, shift double")
    joined_ = scored.join(terms.where(~near).select("h", "kind", "v"), "h", "left")
    word = F.col("kind") == WORD
    value = F.col("times") * F.col("v")
    # A text's own row has n_tokens and its sums so far; the terms' rows bring the rest.
    all_ = joined_.groupBy("row").agg(
        F.max("id").alias("id"), F.max("out").alias("out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("seen", F.when(word, F.col("times")), F.lit(0))).alias("known"),
        F.sum(F.coalesce("base", F.when(word, value), F.lit(0.0))).alias("base"),
        F.sum(F.coalesce("shift", F.when(~word, value), F.lit(0.0))).alias("shift"),
    )
    base_score = F.col("base") + F.lit(math.log10(ends + 1)) - F.col("n_tokens") * F.lit(math.log10(N + V + 1))
    return all_.select(
        F.col("id").alias(id_col), F.col("out").alias("held_out"), "n_tokens", (F.col("known") + F.lit(1 if ends else 0)).cast("long").alias("n_known"), F.lit(N).cast("long").alias("train_tokens"),
        base_score.alias("base_score"), (base_score + F.col("shift")).alias("score"),
    )
