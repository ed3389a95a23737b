"""Benchmark decontamination by winnowing.

Of every ``window - k + 1`` consecutive k-grams of words the least hash is kept (the last of ties), in documents and in
items alike, so two texts that share ``window`` consecutive words share a kept k-gram at the same place of that span.
Kept k-grams are joined by hash; both sides carry the words around them, up to ``window - k`` on each side, and a match
is extended word by word. It counts if it reaches ``window`` words; then all of its words are hit. An item of fewer
words is one window of its own length n: its n-gram is joined with all n-grams of the documents.

Before the shuffle, documents' k-grams pass a bitmap of fixed size (2**bits bits) made of the items' hashes: it only
saves work, since it drops no hash that an item has.

Null and empty texts have no words. An item whose id is null is named by the empty string. Items that repeat an id count
once. Repeated documents are judged one by one; extra columns are not read, and pass through ``drop_contaminated`` whatever
their names. Empty tables of documents or items give no hits. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import Tokens, blocks, cut, dealt_join, mixed, packed, row_key, unpacked

#: Bytes of words: all but [\x00-\x2F\x3A-\x60\x7B-\x7F], after lowering.
WORD_BYTES = np.ones(256, np.uint8)
WORD_BYTES[0x00:0x30] = 0
WORD_BYTES[0x3A:0x61] = 0
WORD_BYTES[0x7B:0x80] = 0
#: Places in the bitmap of items' hashes, as a power of two.
BITS = 22


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams; the length is part of the hash."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
        return mixed(total)


def winnow(hashes: np.ndarray, rows: np.ndarray, k: int, window: int) -> np.ndarray:
    """Places of kept k-grams; a window lies in one row of text."""
    h = grams(hashes, k)
    span = window - k + 1
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at, best = np.zeros(n, np.int64), h[:n].copy()
    for j in range(1, span):
        other = h[j : j + n]
        take = other <= best
        at[take] = j
        best[take] = other[take]
    inside = rows[:n] == rows[window - 1 : window - 1 + n]
    return np.unique((np.arange(n) + at)[inside])


def _words(t: Tokens, a: int, b: int) -> str:
    return b" ".join(t.data[t.start[i] : t.end[i]].tobytes() for i in range(a, b)).decode("utf-8", "replace") if b > a else ""


def _emit(t: Tokens, rows: np.ndarray, places: np.ndarray, h: np.ndarray, n: int, reach: int, whole: bool) -> list[tuple]:
    """(row, hash, length, place, words before, the gram, words after, whole item or not) of n-grams."""
    out = []
    for p, x in zip(places.tolist(), h.tolist()):
        r = int(rows[p])
        lo, hi = max(int(t.first[r]), p - reach), min(int(t.first[r + 1]), p + n + reach)
        out.append((r, x, n, p - int(t.first[r]), _words(t, lo, p), _words(t, p, p + n), _words(t, p + n, hi), whole))
    return out


_GRAM = pa.struct([("h", pa.int64()), ("n", pa.int32()), ("at", pa.int64()), ("before", pa.string()), ("gram", pa.string()), ("after", pa.string()), ("whole", pa.bool_())])
_GRAM_SQL = "struct<h: bigint, n: int, at: bigint, before: string, gram: string, after: string, whole: boolean>"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mapper(extra: list[str], k: int, window: int, short: list[int] | None, bitmap: np.ndarray | None):
    """Rows with ``extra`` columns, n_words and kept grams. short None: items, each of which has its own lengths."""

    def passes(h: np.ndarray) -> np.ndarray:
        if bitmap is None:
            return np.ones(len(h), bool)
        slot = h >> np.uint64(64 - BITS)
        return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def run(batches):
        for batch in batches:
            for at, end, data, offsets in blocks(batch.column(0)):
                t = Tokens(data, offsets, WORD_BYTES)
                rows, counts = t.rows(), t.counts()
                found: list[list[dict]] = [[] for _ in range(end - at)]
                places = winnow(t.hash, rows, k, window)
                h = grams(t.hash, k)[places]
                ok = passes(h)
                got = _emit(t, rows, places[ok], h[ok], k, window - k, False)
                for n in range(1, window) if short is None else short:
                    hn = grams(t.hash, n)
                    p = np.arange(len(hn))
                    p = p[rows[p] == rows[p + n - 1]]
                    if short is None:
                        p = p[counts[rows[p]] == n]
                    p = p[passes(hn[p])]
                    got += _emit(t, rows, p, hn[p], n, 0, True)
                for r, x, n, place, before, gram, after, whole in got:
                    found[r].append({"h": _signed(x), "n": n, "at": place, "before": before, "gram": gram, "after": after, "whole": whole})
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(1, part.num_columns)), pa.array(counts.astype(np.int64)), pa.array(found, pa.list_(_GRAM))], names=[*extra, "n_words", "grams"])

    return run


def _bitmap(grams_of_items: DataFrame) -> np.ndarray:
    """Slots of the items' hashes; what comes to the driver has at most 2**BITS / 64 rows, whatever the items."""
    slot = F.shiftrightunsigned("h", 64 - BITS)
    words = grams_of_items.select(F.shiftrightunsigned(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(shiftrightunsigned(h, {0}) & 63 as int))".format(64 - BITS)).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for w, b in words.collect():
        out[w] = b
    return out.view(np.uint8)


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """(id_col, n_words, n_hit, item_ids array<string>) for each document; spans of hit words as ``spans``."""
    spark = docs.sparkSession
    k = min(k, window)
    tests = items.select(F.col(item_text).cast("binary").alias("t"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"))
    tests = tests.mapInArrow(_mapper(["item"], k, window, None, None), f"item string, n_words long, grams array<{_GRAM_SQL}>")
    tests = cut(tests.select("item", F.explode("grams").alias("g")).select("item", "g.*").select("item", "h", "n", "before", "gram", "after", "whole").distinct())
    short = sorted(r[0] for r in tests.where("whole").select("n").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_bitmap(tests))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        yield from _mapper(["id", "key"], k, window, short, bitmap.value)(batches)

    read = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"))
    base = cut(read.mapInArrow(run, f"id {kind}, key string, n_words long, grams array<{_GRAM_SQL}>"))
    own = base.where(F.size("grams") > 0).select("id", "key", F.explode("grams").alias("g")).select("id", "key", "g.*").distinct()
    same = F.struct("h", "n", "whole", "gram").alias("same")
    x = cut(own.select(same, F.struct("id", "key", "at", "before", "after").alias("x")))
    y = tests.select(same, F.struct("item", "before", "after").alias("y"))
    met = dealt_join(x, y, "same", F.struct("x.key", "x.at"))  # a gram that very many documents share is dealt out
    words = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, " ", -1))
    run_of = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p.eqNullSafe(q) & p.isNotNull()), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, ok: F.struct((s.n + F.when(s.on & ok, 1).otherwise(0)).alias("n"), (s.on & ok).alias("on")), lambda s: s.n)
    left = run_of(F.reverse(words("x.before")), F.reverse(words("y.before")))
    right = run_of(words("x.after"), words("y.after"))
    met = met.select("x.id", "x.key", "x.at", "same.n", "y.item", "same.whole", left.alias("l"), right.alias("r"))
    met = met.where(F.col("whole") | (F.col("l") + F.col("n") + F.col("r") >= window))
    spans = met.select("id", "key", "item", F.struct((F.col("at") - F.col("l")).alias("s"), (F.col("at") + F.col("n") + F.col("r")).alias("e")).alias("span"))
    per = spans.groupBy("key").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item")).alias("item_ids"))
    merged = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")), lambda a, s: F.struct((a.n + F.greatest(s.e - F.greatest(s.s, a.to), F.lit(0).cast("long"))).alias("n"), F.greatest(a.to, s.e).alias("to")), lambda a: a.n)
    per = per.select("key", "spans", "item_ids", merged.alias("n_hit"))
    out = base.select("id", "key", "n_words").join(per, "key", "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans", "key")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: float = 0.0, **options) -> DataFrame:
    """The rows of ``docs`` of which no more than the share ``most`` of the words is hit."""
    bad = hits(docs, items, id_col, text_col, **options).where(F.col("n_hit") > F.col("n_words") * F.lit(float(most))).select("key").distinct()
    rows = packed(docs, row_key(id_col, text_col)).join(bad, "key", "left_anti")
    return rows.select(unpacked(rows, docs))
