"""Quality rules with cross-document line frequency.

Lines are normalised (A-Z lowered, white space collapsed) and hashed; per host (a column that groups documents) the
distinct documents of each line are counted. Documents of a host that hold the same set of lines are one document, told
by a 128-bit signature of that set, so exact copies do not make each other look like boilerplate; documents that share
only a part of their lines, near copies included, are different documents. Lines in more documents than the host's limit,
the larger of ``min_docs`` and ``share`` of its documents, are removed; a document that keeps less than ``keep_share`` of
its words is depleted and rejected.

A line above the limit is a hot key by nature. Those that hold over 1 / ``SPREAD`` of all (document, line) rows are fewer
than ``SPREAD``, so they are found by broadcast; only the others are shuffled.

Null text: no words. Null hosts are one host. Repeated rows get the same verdict each. Empty table: empty result. Texts of
any length are read whole; what a text holds in memory is its words and a hash per line;
work is linear in its lines. Ties cannot arise: verdicts are
counts. Other columns pass through ``clean`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import cut, mixed, packed, row_key, texts, unpacked

SYMBOLS = b"#*$%&|<>"
REPEAT = 8
MIN_DOCS, SHARE, KEEP_SHARE = 20, 0.02, 0.3
SPREAD = 1024
_WEIGHTS = mixed(np.arange(1, REPEAT + 1, dtype=np.uint64)) | np.uint64(1)


def repeated_words(words: list[bytes], size: int = REPEAT) -> int:
    """Words in windows of ``size`` words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    coded = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) > len(words) - size:
        return 0
    with np.errstate(over="ignore"):
        spread, total = mixed(coded + np.uint64(1)), np.zeros(n, np.uint64)
        for j in range(size):
            total += spread[j : j + n] * _WEIGHTS[j % REPEAT]
    order = np.sort(total)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    places = np.flatnonzero(np.isin(total, twice))
    windows = np.lib.stride_tricks.sliding_window_view(coded, size)[places]
    _, which, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    places = places[counts[which.ravel()] > 1]
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def _measure(names: list[str]):
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches):
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in (*counts, "lines", "line_words", "sign")}
            for text in texts(batch.column(0)):
                seen: set[bytes] = set()
                words: list[bytes] = []
                sizes, dup = {}, 0
                for line in text.split(b"\n"):
                    own = line.split()
                    if not own:
                        continue
                    if line in seen:
                        dup += 1
                    seen.add(line)
                    words += own
                    plain = b" ".join(own).lower()
                    h = xxhash.xxh64_intdigest(plain, 42)
                    sizes[h] = sizes.get(h, 0) + len(own)
                rows["n_words"].append(len(words))
                rows["word_chars"].append(len(b"".join(words).decode("utf-8", "replace")))
                rows["n_symbols"].append(sum(text.count(c) for c in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))))
                rows["n_dup_lines"].append(dup)
                rows["n_repeat_words"].append(repeated_words(words))
                lines = np.fromiter(sizes, np.uint64, len(sizes))
                rows["lines"].append(lines.view(np.int64))
                rows["line_words"].append(np.fromiter(sizes.values(), np.int64, len(sizes)))
                rows["sign"].append(xxhash.xxh128_digest(np.sort(lines).tobytes()))
            kinds = {"lines": pa.list_(pa.int64()), "line_words": pa.list_(pa.int64()), "sign": pa.binary()}
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(1, batch.num_columns)), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items())], names=[*names, *rows])

    return run


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, over: pd.Series) -> pd.Series:
    """Texts without the lines of these hashes; null hashes: as they are."""

    def one(t: str, gone: set[int]) -> str:
        signed = lambda line: int(np.uint64(xxhash.xxh64_intdigest(b" ".join(line.encode().split()).lower(), 42)).view(np.int64))
        return "\n".join(line for line in t.split("\n") if signed(line) not in gone)

    return pd.Series([t if t is None or hashes is None else one(t, set(hashes.tolist())) for t, hashes in zip(text, over)], dtype=object)


def _judged(read: DataFrame, names: list[str], schema: T.StructType, min_docs: int, share: float, keep_share: float) -> DataFrame:
    """read: the text as bytes, then columns of these names, of which host is one."""
    fields = T._parse_datatype_string("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>, sign binary").fields
    base = cut(read.mapInArrow(_measure(names), T.StructType([*schema.fields, *fields])).withColumn("row", F.monotonically_increasing_id()))
    host = F.xxhash64(F.col("host").isNull(), "host").alias("host")
    pairs = F.explode(F.arrays_zip("lines", "line_words")).alias("l")  # each line once, with the words of all its places
    lines = base.select(host, "row", "sign", pairs).select("host", "row", "sign", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"))
    # Rows bound documents from above, so only lines with enough of them need their documents.
    rows = lines.groupBy("host", "line").agg(F.count("*").alias("n"))
    many = cut(rows.where(F.col("n") > min_docs))
    hot = F.broadcast(many.where(F.col("n") > max(1, (many.agg(F.sum("n")).first()[0] or 0) // SPREAD)).select("host", "line"))
    warm = many.select("host", "line").join(hot, ["host", "line"], "left_anti")

    def met(with_rows: DataFrame, hot_lines: DataFrame, other_lines: DataFrame) -> DataFrame:
        found = with_rows.join(hot_lines, ["host", "line"])
        return found.union(with_rows.join(hot, ["host", "line"], "left_anti").join(other_lines, ["host", "line"]).select(found.columns))

    counts = met(lines.select("host", "line", "sign"), hot, warm).distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    total = base.where("n_words > 0").select(host, "sign").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    over = cut(counts.where(F.col("n") > min_docs).join(total, "host").where(F.col("n") > F.col("docs") * F.lit(float(share))).select("host", "line"))
    gone = met(lines.select("host", "line", "row", "words"), F.broadcast(over.join(hot, ["host", "line"], "left_semi")), over.join(hot, ["host", "line"], "left_anti")).groupBy("row").agg(F.collect_list("line").alias("over"), F.sum("words").alias("removed_words"))
    out = base.join(gone, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
    return out.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") - F.col("removed_words")) >= F.col("n_words") * F.lit(float(keep_share))))


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Per row: id_col, the counts, ``removed_words``, ``over`` (hashes of removed lines), base_failed and kept."""
    read = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("host", T.StringType())])
    out = _judged(read, ["id", "host"], schema, min_docs, share, keep_share)
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "over", "base_failed", "kept")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Kept rows with their columns; lines above the limit are gone from their texts."""
    key = row_key(id_col, text_col, host_col)
    read = docs.select(F.col(text_col).cast("binary").alias("t"), F.col(host_col).cast("string").alias("host"), key.alias("key"))
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("key", T.StringType())])
    verdict = _judged(read, ["host", "key"], schema, min_docs, share, keep_share)
    verdict = verdict.where("kept").groupBy("key").agg(F.first("over").alias("over"))
    rows = packed(docs, key).join(verdict, "key")
    left = _without(F.col("doc").getField(text_col), F.col("over"))
    return rows.select(unpacked(rows, docs, F.col("over").isNotNull(), text_col, left))
