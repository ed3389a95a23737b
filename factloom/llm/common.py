"""Shared helpers: lineage cuts, Arrow batches as numpy, fast tokens and word hashes.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``; ``bytes.split()`` cuts at exactly those, and
``bytes.lower()`` lowers exactly A-Z, so both are used on UTF-8 as it is.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="factloom-")
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a run made inside go as soon as it ends, not when the driver's garbage is collected."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once; later reads survive lost executors and do not recompute it."""
    shared_dir(df.sparkSession)
    with _cleaned(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under the setting


def stored(df: DataFrame) -> DataFrame:
    """``cut`` by a Parquet table in the shared folder. A checkpoint keeps its plan's estimated size, the product of the joins'
    sides, so in a loop of joins the number of its digits doubles with each round; a table's size is that of its files."""
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    with _cleaned(df.sparkSession):
        df.select("*").write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(*names: str) -> Column:
    """128 bits of these columns as a string; nulls are told apart. Rows with equal values share it, others in practice never."""
    values = [x for n in names for x in (quoted(n).isNull(), quoted(n))]
    return F.concat(F.hex(F.xxhash64(*values)), F.lit("-"), F.hex(F.xxhash64(F.lit(77), *reversed(values))))


def packed(docs: DataFrame, key: Column) -> DataFrame:
    """(doc struct of all columns, key): whatever the columns' names, they clash with none that an operator adds."""
    return docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"), key.alias("key"))


def unpacked(rows: DataFrame, docs: DataFrame, changed: Column | None = None, text_col: str = "text", text: Column | None = None, length_col: str = "n_chars") -> list[Column]:
    """The columns of ``docs`` from ``doc``; where ``changed``, ``text`` is the new text and ``length_col`` its length, if there is one."""
    own = {c: F.col("doc").getField(c) for c in docs.columns}
    if changed is not None:
        own[text_col] = F.when(changed, text).otherwise(own[text_col])
        if length_col in own:
            own[length_col] = F.when(changed, F.length(text).cast(docs.schema[length_col].dataType)).otherwise(own[length_col])
    return [v.alias(c) for c, v in own.items()]


def spread_join(rows: DataFrame, table: DataFrame, on: str, hot: DataFrame) -> DataFrame:
    """Inner join; ``hot`` holds those keys, of a bounded number, that may have many rows: they are found by broadcast."""
    hot = F.broadcast(hot.select(on))
    found = rows.join(F.broadcast(table.join(hot, on, "left_semi")), on)
    return found.unionByName(rows.join(hot, on, "left_anti").join(table.join(hot, on, "left_anti"), on))


def dealt_join(rows: DataFrame, table: DataFrame, on: str, by: Column, least: int = 1024) -> DataFrame:
    """Inner join; a key with over 1 / 1024 of all ``rows`` (and ``least`` of them) is dealt over parts by the hash of ``by``, and
    its rows of ``table`` go to each part. Such keys are fewer than 1024; only they and their parts are broadcast."""
    n = rows.count()
    share = max(least, n // 1024)
    if n <= share:
        return rows.join(table, on)
    hot = F.broadcast(cut(rows.groupBy(on).agg(F.ceil(F.count("*") / share).cast("int").alias("__parts")).where("__parts > 1")))
    mine = rows.join(hot, on, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(by), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    theirs = table.join(hot, on, "left").withColumn("__part", every).drop("__parts")
    return mine.join(theirs, [on, "__part"]).drop("__part")


def lower_ascii(c: Column) -> Column:
    """Lower A-Z only, as ``bytes.lower`` does."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each row; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def blocks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of about ``most`` bytes; one longer text is one slice."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], (offsets[at : end + 1] - offsets[at])
        at = end


def shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition sorted by its columns: rows, each once, whose first column a different row shares. One row is held."""
    held, begun = None, False  # the last row so far, and whether a row before it has its key
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        columns = [c.to_numpy(zero_copy_only=False) for c in rows.columns]
        new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
        rows, key = rows.filter(pa.array(new)), columns[0][new]
        same = key[1:] == key[:-1]
        before, after = np.r_[begun, same], np.r_[same, False]
        keep = before | after
        if held is not None:
            keep[0] = after[0] and not begun  # if its key was shared before, it went out then
        last = len(key) - 1
        if held is not None or last:
            begun = bool(before[last])
        if not (held is None and last == 0):
            yield rows.filter(pa.array(keep))
        held = rows.slice(last)


def byte_set(*members: int) -> np.ndarray:
    lut = np.zeros(256, np.uint8)
    lut[list(members)] = 1
    return lut


NOT_SPACE = 1 - byte_set(*SPACE_BYTES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE_VALUE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(which: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 21)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(have, dtype=np.uint64)
        _powers[which] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Tokens:
    """Words of a slice: byte starts and ends, 64-bit hashes, and ``first[d]``..``first[d+1]`` as the words of row d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray, lower: bool = True):
        if lower:
            data = LOWER[data]
        self.data, n = data, len(data)
        inside = member[data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if n:
            before[0], after[-1] = 0, 0
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[offsets[:-1][offsets[:-1] < n]] = 0
            after[offsets[1:][offsets[1:] > 0] - 1] = 0
        self.start = np.flatnonzero(inside > before)
        self.end = np.flatnonzero(inside > after) + 1
        self.first = np.searchsorted(self.start, offsets)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[data] * _power("up", _BASE, n), out=total[1:])
            self.hash = mixed((total[self.end] - total[self.start]) * _power("down", _INVERSE, n + 1)[self.start] + (self.end - self.start).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Lookup:
    """Exact lookup of 64-bit hashes in a sorted table by the leading bits; -1: absent. The hashes must be well mixed."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(np.uint64))
        self.bits = max(1, min(24, int(len(keys)).bit_length() + 1))
        top = (self.keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.at = np.searchsorted(top, np.arange((1 << self.bits) + 1))
        self.most = int(np.diff(self.at).max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys) or not len(h):
            return out
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.at[top], self.at[top + 1]
        open_ = np.flatnonzero(at < end)
        for _ in range(self.most):
            if not len(open_):
                break
            place = at[open_]
            hit = self.keys[place] == h[open_]
            out[open_[hit]] = place[hit]
            at[open_] += 1
            open_ = open_[~hit & (at[open_] < end[open_])]
        return out
