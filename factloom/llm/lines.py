"""Line dedup by content-defined chunks of lines, DataFrame functions only.

The hashes of lines are rolled over a window that grows, from each line forward and from each line backward, until it holds
``min_words`` words and two lines: the lines' own words set its bounds, so it resists shifts. Lines without words do not
count and do not part a window. Where a rolled value is met nowhere else in the corpus, a chunk ends: a chunk is a longest
run of lines whose windows are all met at an earlier place. Every line of a repeated passage of two lines and ``min_words``
words or more lies in such a window inside the passage, so the passage goes whole, from its first line to its last; and a
line goes only with a whole window that is repeated, so lines that are met in other company stay (boundaries by a residue
of the rolled value would miss passages that hold fewer than two of them). A line of ``alone`` words or more is a window by
itself.

Equal rolled values are only candidates: the windows' lines are compared by the SHA-256 of their bytes, and the first
place, by id and then line, stays. A line that goes is equal to a line at an earlier place, so every distinct line stays at
its first place. Lines without words between two lines of a chunk go with it.

Lines are not sent, only the SHA-256 of windows whose value is met twice: a set of at most ``PREFIXES`` residues of those
values is broadcast for that; it saves work and drops nothing. A value with over 1 / ``SPREAD`` of all repeated places
(there are fewer than ``SPREAD`` such) is dealt over several tasks. Work and memory are linear in a text's lines: a window
holds ``min_words`` lines at most, and places are looked up, not searched.

Null text stays null; an empty text has one line without words. Texts without lines to remove are left as they are, byte
for byte. A null id comes last. Rows that repeat an id and a text are equal at the same place: of such rows all stay or
all lose the lines. Texts of any length are read whole: a row holds its text, and twice its text while lines are dealt
out. Extra columns pass through, whatever their names. Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import cut, packed, quoted, row_key, unpacked

ALONE, MIN_WORDS = 30, 15
SPREAD = 1024
PREFIXES = 1 << 20
_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), evaluated once: the optimizer moves a column into a lambda that uses it, where it would be made again for each element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _spoken(ls: Column, digest: bool = False) -> Column:
    """Lines with a word: array<struct<p place in the text, h hash, n words[, d SHA-256]>>."""
    d = lambda x: [F.unhex(F.sha2(x.cast("binary"), 256)).alias("d")] if digest else []
    every = F.transform(ls, lambda x, p: F.struct(p.alias("p"), F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(_WORD)).alias("n"), *d(x)))
    return F.filter(every, lambda m: m.n > 0)


def _length(around: Column, min_words: int) -> Column:
    """Lines, from the first on, that hold ``min_words`` words and are two or more; 0: there are not so many."""
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"))
    grown = F.aggregate(around, start, lambda a, m: F.when((a.n < min_words) | (a.k < 2), F.struct((a.k + 1).alias("k"), (a.n + m.n).alias("n"))).otherwise(a), lambda a: F.when((a.n >= min_words) & (a.k >= 2), a.k).otherwise(0))
    return grown.cast("int")


def _windows(w: Column, alone: int, min_words: int, digest: bool) -> Column:
    """array<struct<first, lines, hash[, digest]>> of the windows of lines with a word; first counts such lines from 0."""
    most = max(2, min_words)

    def window(first: Column, k: Column) -> Column:
        own = F.slice(w, first + 1, k)
        value = F.aggregate(own, F.lit(7).cast("long"), lambda a, m: F.xxhash64(a, m.h))
        whole = [F.unhex(F.sha2(F.aggregate(own, F.lit(b""), lambda a, m: F.concat(a, m.d)), 256)).alias("digest")] if digest else []
        return F.struct(first.cast("int").alias("first"), k.cast("int").alias("lines"), value.alias("hash"), *whole)

    def forward(i: Column) -> Column:
        return _length(F.slice(w, i + 1, F.lit(most)), min_words)

    def backward(i: Column) -> Column:
        start = F.greatest(i + 2 - most, F.lit(1))
        return _length(F.reverse(F.slice(w, start, i + 2 - start)), min_words)

    place = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i >= 0) & (i < F.size(w)))
    ahead = F.filter(F.transform(place, lambda i: F.struct(i.alias("i"), forward(i).alias("k"))), lambda u: u.k > 0)
    back = F.filter(F.transform(place, lambda i: _let(backward(i), lambda k: F.struct((i - k + 1).alias("i"), k.alias("k")))), lambda u: u.k > 0)
    back = F.filter(back, lambda u: forward(u.i) != u.k)  # the others are there already
    ones = F.transform(F.filter(place, lambda i: F.get(w, i).n >= alone), lambda i: F.struct(i.alias("i"), F.lit(1).alias("k")))
    return F.transform(F.concat(ahead, back, ones), lambda u: window(u.i, u.k))


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: int = ALONE, min_words: int = MIN_WORDS, digest: bool = False) -> DataFrame:
    """(id, key of the row, line, lines, hash[, digest]) of each window; ``line`` is its first line among those with a word."""
    rows = docs.where(quoted(text_col).isNotNull()).select(quoted(id_col).alias("id"), row_key(id_col, text_col).alias("key"), quoted(text_col).alias("t"))
    every = _let(_spoken(_lines(F.col("t")), digest), lambda w: _windows(w, alone, min_words, digest))
    rows = rows.select("id", "key", F.explode(every).alias("u"))
    return rows.select("id", "key", F.col("u.first").alias("line"), "u.lines", "u.hash", *(["u.digest"] if digest else []))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: int = ALONE, min_words: int = MIN_WORDS) -> DataFrame:
    """(key, again array<struct<line, lines>>) of rows that hold what an earlier place holds."""
    often = cut(units(docs, id_col, text_col, alone, min_words).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"))
    share = max(1, (often.agg(F.sum("n")).first()[0] or 0) // SPREAD)
    hot = F.broadcast(often.where(F.col("n") > share).select("hash", F.floor(F.col("n") / share + 1).cast("int").alias("parts")))
    residue = F.pmod("hash", F.lit(PREFIXES)).cast("int")
    own = units(docs, id_col, text_col, alone, min_words, digest=True).withColumn("residue", residue).join(F.broadcast(often.select(residue.alias("residue")).distinct()), "residue", "left_semi").drop("residue")
    own = own.join(hot, "hash", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("key", "line"), F.col("parts")), F.lit(0)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    met = cut(own.join(often.join(hot, "hash", "left").select("hash", every), ["hash", "part"], "left_semi"))
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("i"), F.col("key").alias("k"), F.col("line").alias("p"))
    first = met.groupBy("hash", "digest").agg(F.min(order).alias("first"), F.max("parts").alias("parts")).select("hash", "digest", "first", every)
    later = met.join(first, ["hash", "digest", "part"]).where(order != F.col("first"))
    return later.groupBy("key").agg(F.collect_set(F.struct("line", "lines")).alias("again"))


def _gone(again: Column, ls: Column) -> Column:
    """struct<n_chunks, words, lines places in the text> of what goes."""

    def found(w: Column) -> Column:
        flagged = F.array_sort(F.array_distinct(F.flatten(F.transform(again, lambda u: F.sequence(u.line, u.line + u.lines - 1)))))
        return _let(flagged, lambda f: placed(w, f))

    def placed(w: Column, f: Column) -> Column:
        follows = lambda i, j: F.coalesce(F.get(f, j) == i + 1, F.lit(False))
        chunks = F.size(F.filter(f, lambda i, j: ~follows(i, j + 1)))
        words = F.aggregate(f, F.lit(0).cast("long"), lambda a, i: a + F.get(w, i).n)
        upto = lambda i, j: F.when(follows(i, j + 1), F.get(w, i + 1).p - 1).otherwise(F.get(w, i).p)
        lines = F.flatten(F.transform(f, lambda i, j: F.sequence(F.get(w, i).p, upto(i, j))))
        return F.struct(chunks.alias("n_chunks"), words.alias("words"), lines.alias("lines"))

    return _let(_spoken(ls), found)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: int = ALONE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc struct of all columns, key, text, gone struct<n_chunks, words, lines>): the new text, and what went; gone null: nothing."""
    rows = packed(docs, row_key(id_col, text_col)).join(repeats(docs, id_col, text_col, alone, min_words), "key", "left")
    text = F.col("doc").getField(text_col)

    def left(ls: Column) -> Column:
        return _let(_gone(F.col("again"), ls), lambda g: F.struct(g.alias("gone"), F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), g.lines), lambda i: F.get(ls, i)), "\n").alias("text")))

    rows = rows.select("doc", "key", F.when(F.col("again").isNotNull(), _let(_lines(text), left)).alias("new"))
    return rows.select("doc", "key", F.coalesce("new.text", text).alias("text"), F.col("new.gone").alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alone: int = ALONE, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the lines of repeated chunks removed from the texts; ``n_chars``, if there is one, follows."""
    rows = measured(docs, id_col, text_col, alone, min_words)
    return rows.select(unpacked(rows, docs, F.col("gone").isNotNull(), text_col, F.col("text")))
