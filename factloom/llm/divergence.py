"""Source divergence audit: how far the sources of a language differ in their terms, and by which terms.

Terms are runs of bytes of letters A-Z, a-z or of non-ASCII characters, A-Z lowered. A language keeps the terms that are in
``min_docs`` or more of its rows (V of them). In a group (language, source) and in a whole language each kept term has
p = 1 + floor(10^9 (count + 1) / (N + V)), N being the counts' sum over kept terms; f(p, q) = floor((p - q)^2 / q). All
of it is integers: decimals of 38 digits where 10^9 (count + 1) is formed, longs elsewhere (p is 10^9 + 1 at most, so a
square fits; sums over terms stay below 2^63 for up to 10^9 kept terms).

``pairs`` adds f over all V terms for each two sources of a language without looking at terms that neither holds: such a
term has the groups' baselines, p at count 0. With z for a baseline, the sum is

    (V - |A| - |B|) f(zA, zB) + sum over A of f(pA, zB) + sum over B of f(zA, pB)
        + sum over A and B of (f(pA, pB) - f(pA, zB) - f(zA, pB) + f(zA, zB)).

The single sums need only how often each p occurs in a group; only terms held by both sources are joined.

``top`` finds the k greatest of each group by radix selection: histograms over 16 bits of the values, from the highest,
give the digit at which the k-th value lies; the rows of that digit go on to the next 16 bits. Where the k-th value is
shared by more rows than are wanted, the same passes go on over the UTF-8 bytes of the items, two at a time, in ascending
order. A pass ends for a group when ``FEW`` rows or fewer are open; those and the rows above them are ranked. No group is
sorted; what a window holds is a histogram of 66,049 digits or k + ``FEW`` rows. ``ranked`` numbers whole groups from a
range sort, with the counts of earlier ranges added, so no group needs to fit a task.

Groups of a third of all rows: counts are added before they are shuffled; rows meet their group's figures by broadcast
where the group has over 1 / ``SPREAD`` of all rows, by a join elsewhere.

Null text, language and source are read as ''. A group without terms takes part in pairs; without kept terms (V = 0) its
values are 0. Repeated rows are rows of their own. Ties rank by UTF-8 bytes of the item. An empty table gives no rows.
Texts of any length are read whole: one text is one slice of a task's memory, in which terms are told apart by 64-bit
hashes; between slices they are told apart as strings. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from factloom.llm.common import Tokens, blocks, cut, quoted, spread_join

MIN_DOCS, RANKS = 3, 200
#: Rows of a group that are ranked without a further pass.
FEW = 4096
#: A group with over 1 / SPREAD of all rows (there are fewer than SPREAD such) meets its figures by broadcast.
SPREAD = 1024
#: Parts over which the sources of one language are dealt before they meet.
PARTS = 32
_SLICE = 1 << 21
_DIGIT = 16

LETTER = np.zeros(256, np.uint8)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = 1


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings data[start:end]."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.arange(at[-1]) - np.repeat(at[:-1] - start, size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())


def _count(batches):
    """Of (text, lang, source): per slice (lang, source, term, c, df), and each group once with a null term."""
    for batch in batches:
        own = [batch.column(i).fill_null("").dictionary_encode() for i in (1, 2)]
        code = own[0].indices.to_numpy().astype(np.int64) * max(1, len(own[1].dictionary)) + own[1].indices.to_numpy()
        for at, end, data, offsets in blocks(batch.column(0), _SLICE):
            of, group = np.unique(code[at:end], return_inverse=True)
            t = Tokens(data, offsets, LETTER)
            order = np.argsort(t.hash, kind="stable")  # rows ascend within a hash
            h, row = t.hash[order], t.rows()[order]
            new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
            doc = np.flatnonzero(new | np.r_[True, row[1:] != row[:-1]]) if len(h) else np.zeros(0, np.int64)
            times = np.diff(np.r_[doc, len(h)])
            key = (np.cumsum(new)[doc] - 1) * len(of) + group[row[doc]] if len(h) else doc
            by = np.argsort(key, kind="stable")
            key = key[by]
            cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else by
            first = order[doc[by[cuts]]]
            c = np.add.reduceat(times[by], cuts) if len(cuts) else times
            df = np.diff(np.r_[cuts, len(key)])
            groups = np.concatenate([of[key[cuts] % len(of)], of]) if len(of) else of
            none = len(groups) - len(first)
            terms = pa.concat_arrays([_strings(t.data, t.start[first], t.end[first]), pa.nulls(none, pa.string())])
            zeros = np.zeros(none, np.int64)
            width = max(1, len(own[1].dictionary))
            names = [own[0].dictionary.take(pa.array(groups // width)), own[1].dictionary.take(pa.array(groups % width))]
            yield pa.RecordBatch.from_arrays([*names, terms, pa.array(np.concatenate([c, zeros])), pa.array(np.concatenate([df, zeros]))], names=["lang", "source", "term", "c", "df"])


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, c, df): occurrences and rows of each term in each group; a row with a null term for each group."""
    read = docs.select(*[quoted(c).alias(n) for c, n in ((text_col, "t"), (lang_col, "lang"), (source_col, "source"))])
    found = read.mapInArrow(_count, "lang string, source string, term string, c long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("df").alias("df"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total), exact."""
    wide = (count + 1).cast("decimal(19,0)") * F.lit(10**9).cast("decimal(10,0)")
    return _div(wide, total.cast("decimal(19,0)")) + 1


def _f(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _key() -> Column:
    """One string for (lang, source)."""
    return F.concat(F.length("lang").cast("string"), F.lit(":"), "lang", "source")


def shares(counted: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, groups, hot): (key, lang, source, term, p, q, z) of kept terms with a count, (key, lang, source, V, m, z) of every
    group, m being its distinct kept terms, and the keys of groups with many rows."""
    terms = counted.where(F.col("term").isNotNull())
    kept = terms.groupBy("lang", "term").agg(F.sum("c").alias("n"), F.sum("df").alias("df")).where(F.col("df") >= min_docs)
    rows = cut(terms.join(kept.select("lang", "term", "n"), ["lang", "term"]).select("lang", "source", "term", "c", "n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("n").alias("every"))
    own = rows.groupBy("lang", "source").agg(F.sum("c").alias("own"), F.count("*").alias("m"))
    groups = counted.where(F.col("term").isNull()).select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select(_key().alias("key"), "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own", "m", "V", "every")])
    groups = cut(groups.withColumn("z", F.when(F.col("V") > 0, _share(F.lit(0), F.col("own") + F.col("V")))))
    hot = groups.where(F.col("m") > max(1, rows.count() // SPREAD)).select("key")
    met = spread_join(rows.withColumn("key", _key()).drop("lang", "source"), groups.where("m > 0"), "key", hot)
    p, q = _share(F.col("c"), F.col("own") + F.col("V")), _share(F.col("n"), F.col("every") + F.col("V"))
    return cut(met.select("key", "lang", "source", "term", p.alias("p"), q.alias("q"), "z")), groups, hot


def _dealt(left: DataFrame, groups: DataFrame, by: Column) -> DataFrame:
    """``left`` with every other group (item, zi, mi) of its language; a language is dealt over ``PARTS`` keys."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    others = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("zi"), F.col("m").alias("mi"), parts)
    own = left.withColumn("part", F.pmod(by, F.lit(PARTS)).cast("int"))
    return own.join(others, ["lang", "part"]).where(F.col("source") != F.col("item")).drop("part")


def pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language."""
    p, z, zi = F.col("p"), F.col("z"), F.col("zi")
    base = _dealt(groups, groups, F.xxhash64("source"))
    base = base.select("lang", "source", "item", F.when(F.col("V") > 0, (F.col("V") - F.col("m") - F.col("mi")) * _f(z, zi)).otherwise(0).alias("value"))
    often = rows.groupBy("lang", "source", "p", "z").agg(F.count("*").alias("times"))
    one = _dealt(often, groups, F.xxhash64("source", "p"))
    side = lambda a, b, v: F.struct(F.col(a).alias("source"), F.col(b).alias("item"), v.alias("value"))
    both_sides = F.inline(F.array(side("source", "item", F.col("times") * _f(p, zi)), side("item", "source", F.col("times") * _f(zi, p))))
    single = one.select("lang", both_sides)
    a, b = (rows.select("lang", "term", *[F.col(c).alias(c + s) for c in ("source", "p", "z")]) for s in "ab")
    met = a.join(b, ["lang", "term"]).where(F.col("sourcea") < F.col("sourceb"))

    def extra(x: str, y: str) -> Column:
        px, py, zx, zy = (F.col(c) for c in ("p" + x, "p" + y, "z" + x, "z" + y))
        return F.sum(_f(px, py) - _f(px, zy) - _f(zx, py) + _f(zx, zy))

    joint = met.groupBy("lang", "sourcea", "sourceb").agg(extra("a", "b").alias("ab"), extra("b", "a").alias("ba"))
    joint = joint.select("lang", F.inline(F.array(side("sourcea", "sourceb", F.col("ab")), side("sourceb", "sourcea", F.col("ba")))))
    return base.union(single).union(joint).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _digit(step: int, item: Column, value: Column) -> Column:
    """The step-th digit, ascending in rank: 16 bits of the value, highest first, then two bytes of the item."""
    if step < 64 // _DIGIT:
        bits = F.shiftrightunsigned(value, 64 - _DIGIT * (step + 1)).bitwiseAND(F.lit((1 << _DIGIT) - 1))
        return F.lit((1 << _DIGIT) - 1) - bits
    at = 2 * (step - 64 // _DIGIT) + 1
    byte = lambda i: F.coalesce(F.conv(F.hex(F.substring(item, i, 1)), 16, 10).cast("long") + 1, F.lit(0).cast("long"))
    return byte(at) * 257 + byte(at + 1)


def top(rows: DataFrame, hot: DataFrame, k: int = RANKS, few: int = FEW) -> DataFrame:
    """Those ``rows`` (key, item, value >= 0, ...) that can be among the first k of their key, by value descending and item
    ascending: at least min(k, all), at most k + ``few`` a key. hot: keys that may have many rows."""
    value, item = F.col("value"), F.col("item").cast("binary")
    state = rows.groupBy("key").agg(F.count("*").alias("open"))
    none = F.lit(b"")
    state = cut(state.select("key", F.lit(k).cast("long").alias("need"), "open", F.lit(64).alias("shift"), F.lit(0).cast("long").alias("high"), none.alias("bytes")))
    step = 0

    def above(by: DataFrame) -> tuple[DataFrame, Column]:
        """Rows with their key's state, and the bits above its shift."""
        bits = F.when(F.col("shift") >= 64, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(value, shift)"))
        return spread_join(rows, by, "key", hot), bits

    while not (going := state.where(F.col("open") > F.greatest(F.lit(few), F.col("need")))).isEmpty():
        met, bits = above(going.select("key", "shift", "high", "bytes"))
        met = met.where((bits == F.col("high")) & (F.substring(item, F.lit(1), F.octet_length("bytes")) == F.col("bytes")))
        to = F.min(F.substring(item, 1, 2 * (step - 64 // _DIGIT) + 2)) if step >= 64 // _DIGIT else F.first(none)  # the bytes of a digit, from any of its rows
        digits = met.groupBy("key", _digit(step, item, value).alias("digit")).agg(F.count("*").alias("n"), to.alias("to"))
        upto = F.sum("n").over(Window.partitionBy("key").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        digits = digits.withColumn("upto", upto).join(going.select("key", "need", "high"), "key").where("upto >= need and upto - n < need")
        high = F.expr(f"shiftleft(high, {_DIGIT})").bitwiseOR(F.lit((1 << _DIGIT) - 1) - F.col("digit")) if step < 64 // _DIGIT else F.col("high")
        shift = F.lit(max(0, 64 - _DIGIT * (step + 1)))
        new = digits.select("key", (F.col("need") - F.col("upto") + F.col("n")).alias("need"), F.col("n").alias("open"), shift.alias("shift"), high.alias("high"), F.col("to").alias("bytes"))
        state = cut(new.union(state.join(going.select("key"), "key", "left_anti")))
        step += 1
    met, bits = above(state.select("key", "shift", "high", "bytes"))
    first = F.substring(item, F.lit(1), F.octet_length("bytes"))
    return met.where((bits > F.col("high")) | ((bits == F.col("high")) & (first <= F.col("bytes")))).select(*rows.columns)


def ranked(rows: DataFrame, group: list[str], value: str, item: str) -> DataFrame:
    """``rows`` with rank from 1 in each group, by value descending and item ascending: a range sort, numbered per range."""
    dealt = cut(rows.repartitionByRange(*group, F.desc(value), item).withColumn("range", F.spark_partition_id()))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy(*group, "range").agg(F.count("*").alias("n")).select(*group, "range", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*group, "range").orderBy(F.desc(value), item))
    return dealt.withColumn("place", place).join(sizes, [*group, "range"]).withColumn("rank", (F.col("before") + F.col("place")).cast("int")).drop("range", "place", "before")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, ranks: int = RANKS, few: int = FEW) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources of a language, part ``term`` the terms that a
    source has more of than its language, the first ``ranks`` of them."""
    rows, groups, hot = shares(cut(counts(docs, text_col, lang_col, source_col)), min_docs)
    apart = ranked(pairs(rows, groups), ["lang", "source"], "value", "item")
    over = rows.where("p > q").select("key", "lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    first = top(over, hot, ranks, few)
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("value"), "item"))
    first = first.withColumn("rank", rank).where(F.col("rank") <= ranks)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
    return columns(apart, "pair").union(columns(first, "term"))
