"""Links between texts whose sets of word n-grams have a Jaccard similarity of t or more: an exact join by prefix filtering.

A set holds the distinct shingles of ``k`` lowered words (fewer words: the whole sequence; none: the set is empty and is
linked with nothing). Equal sets are one node from the start, so copies are never expanded into pairs.

*Rare first.* The shingles of a set are ordered by their counts over all sets, the rarest first. Counts come from a table
of ``2**SLOTS`` places, filled from every shingle of every document and of fixed size whatever the corpus; shingles of one
place share a count, and ties are ordered by hash, so this is one total order, on which the filters rest. A coarse count
costs candidates, not links: any order finds the same links.

*Prefix filter.* Two sets of similarity t share one of the first |s| - ceil(t |s|) + 1 shingles of each. Only these are
shuffled. *Length filter*: the smaller size is t times the larger one or more. *Positional filter*: the first
shared shingle, with i and j shingles before it, has all shared ones at it or behind it, so min(|a| - i, |b| - j) must reach
t / (1 + t) (|a| + |b|); a pair that fails there may meet again further on, and fails there, too. *Suffix filter*: the elements of a set, dealt by hash to ``BINS`` bins, leave parity
bits; a bit that differs is an element that differs, so their number bounds the Hamming distance of what is left behind the
prefix from below; a similar pair allows (1 - t) / (1 + t) (|a| + |b|). Pairs that pass are made distinct, and each is
verified once, by its whole sets, taken from the texts again.

*Rounds.* In the first ``stars`` rounds a shingle's sets are compared with two of them only (stars). One centre has the fewest
shingles before this one: a text that others were made from has none of the rare shingles of their changes, so it lies
nearest to all of them. The other is chosen by hash, by one of ``CENTRES`` orders, anew in each round, for groups without
such a text. Each component sends one set to a shingle, so a group of near copies is joined without its square of pairs. The last round compares all sets of different components that meet at a shingle, but for pairs already tested. So
no link between different components is lost; links inside a component are not needed for its name. A shingle with more
than ``block`` sets in the last round is dealt to pairs of blocks.

Null text has no words. Repeated rows stay rows and share a component; a component's id is its least id, null if all are
null. A null id's document can still link others. Empty tables give no rows. Shingles are told apart by 64-bit hashes,
equal sets by 128 bits and their size. A text of any length is one value of a task's memory. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import NOT_SPACE, Tokens, blocks, mixed, quoted, row_key, shared_rows, spread_join, stored
from factloom.llm.simhash import _compared, components
from factloom.llm.suffix_tree import joined

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
#: Places of the table of counts, as a power of two, and places in one row of it.
SLOTS, CHUNK = 22, 1 << 16
#: Rows of the table's parts that one task adds up before they meet.
FAN = 64
#: Longs of parity bits of a set.
BINS = 8
#: Longs of parity bits that go along with each shingle of a prefix: all of a set's, folded, so that they tell of all its elements.
FEW = 4
STARS = 1
#: Orders of a round by which shingles choose their second centres, so that a set is compared with several sets of its group.
CENTRES = 4
BLOCK = 2048
#: A node or component with over 1 / SPREAD of all rows (there are fewer than SPREAD such) is joined by broadcast.
SPREAD = 1024
_SLICE = 1 << 20


def prefix_length(n: np.ndarray, t: float) -> np.ndarray:
    return np.where(n > 0, n - np.ceil(t * n - 1e-9).astype(np.int64) + 1, 0)


def _slot(h: np.ndarray) -> np.ndarray:
    return (mixed(h) >> np.uint64(64 - SLOTS)).astype(np.int64)


def _sets(batches, k: int):
    """(batch, first row, end row, hashes, sizes): the sets of slices of about a megabyte, side by side, each sorted."""
    for batch in batches:
        for at, end, data, offsets in blocks(batch.column(0), _SLICE):
            t = Tokens(data, offsets, NOT_SPACE)
            words, first = t.counts(), t.first[:-1]
            many = np.maximum(words - k + 1, 0)
            row = np.repeat(np.arange(len(words)), many)
            start = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
            h = t.hash[start]
            for j in range(1, k):
                h = joined(h, t.hash[start + j])
            few = np.flatnonzero((words > 0) & (words < k))
            short = t.hash[first[few]]
            for j in range(1, k - 1):
                more = words[few] > j
                short[more] = joined(short[more], t.hash[first[few[more]] + j])
            h, row = np.concatenate([h, short]), np.concatenate([row, few])
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
            yield batch, at, end, h[new], np.bincount(row[new], minlength=end - at)


def _packed(chunk: np.ndarray) -> bytes:
    """Counts of a chunk: all of them, or the places with any and their counts."""
    at = np.flatnonzero(chunk)
    if len(at) * 3 < len(chunk):
        return b"s" + at.astype("<u2").tobytes() + chunk[at].astype("<u8").tobytes()
    return b"d" + chunk.astype("<u8").tobytes() if chunk.max() >= 1 << 32 else b"i" + chunk.astype("<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    kind, raw = raw[:1], raw[1:]
    if kind == b"s":
        n = len(raw) // 10
        out = np.zeros(CHUNK, np.int64)
        out[np.frombuffer(raw, "<u2", n)] = np.frombuffer(raw[2 * n :], "<u8", n)
        return out
    return np.frombuffer(raw, "<u8" if kind == b"d" else "<u4").astype(np.int64)


def frequencies(text: DataFrame, k: int = SHINGLE) -> np.ndarray:
    """Counts by place, over the sets of all texts (one binary column); 32 bits each, larger ones as the largest."""
    schema = "chunk int, part int, counts binary"

    def out(table: np.ndarray, part: int):
        for i, chunk in enumerate(table.reshape(-1, CHUNK)):
            if chunk.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part % FAN], pa.int32()), pa.array([_packed(chunk)], pa.binary())], names=["chunk", "part", "counts"])

    def count(batches):
        table = np.zeros(1 << SLOTS, np.int64)
        for *_, u, _ in _sets(batches, k):
            np.add.at(table, _slot(u), 1)
        yield from out(table, TaskContext.get().partitionId())

    def add(batches):
        tables = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                tables[i] = tables.get(i, 0) + _unpacked(raw)
        for i, chunk in tables.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([0], pa.int32()), pa.array([_packed(chunk)], pa.binary())], names=["chunk", "part", "counts"])

    parts = text.mapInArrow(count, schema).repartition("chunk", "part").mapInArrow(add, schema).repartition("chunk").mapInArrow(add, schema)
    whole = np.zeros(1 << SLOTS, np.uint32)
    for row in parts.select("chunk", "counts").collect():  # the table's own size, 32 MB at most
        whole[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.minimum(_unpacked(bytes(row.counts)), (1 << 32) - 1)
    return whole


def _bits() -> list[str]:
    return [f"g{i}" for i in range(BINS)]


def _few() -> list[str]:
    return [f"f{i}" for i in range(FEW)]


def _folded() -> list[Column]:
    """The parity bits dealt to FEW longs, those of one long added up: bits of fewer bins, over the whole set."""
    return [reduce(Column.bitwiseXOR, (F.col(g) for g in _bits()[i::FEW])).alias(f) for i, f in enumerate(_few())]


def described(rows: DataFrame, t: float, k: int) -> DataFrame:
    """Of (t, id, key): id, key, 128 bits that name the set, its size, parity bits, and its prefix, rarest first."""
    table = rows.sparkSession.sparkContext.broadcast(frequencies(rows.select("t"), k))
    names = ["id", "key", "s0", "s1", "n", *_bits(), "prefix"]
    schema = f"id {rows.schema['id'].dataType.simpleString()}, key string, " + ", ".join(f"{c} long" for c in names[2:-1]) + ", prefix array<long>"

    def run(batches):
        for batch, at, end, u, n in _sets(batches, k):
            row = np.repeat(np.arange(len(n)), n)
            start = np.cumsum(n) - n
            sums = []
            for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
                upto = np.concatenate([[np.uint64(0)], np.cumsum(mixed(u ^ np.uint64(salt)), dtype=np.uint64)])
                sums.append(pa.array((upto[start + n] - upto[start]).view(np.int64)))
            width = 64 * BINS
            odd = np.bincount(row * width + (u % np.uint64(width)).astype(np.int64), minlength=len(n) * width) & 1
            odd = np.packbits(odd.astype(np.uint8).reshape(-1, width), axis=1, bitorder="little").view(np.int64)
            order = np.argsort(table.value[_slot(u)], kind="stable")  # by count; hashes ascend within a set
            order = order[np.argsort(row[order], kind="stable")]
            first = prefix_length(n, t)
            prefix = u[order][np.arange(len(u)) - start[row] < first[row]]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(first)]).astype(np.int32)), pa.array(prefix.view(np.int64)))
            own = [batch.column(i).slice(at, end - at) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([*own, *sums, pa.array(n), *(pa.array(np.ascontiguousarray(odd[:, i])) for i in range(BINS)), lists], names=names)

    return rows.select("t", "id", "key").mapInArrow(run, schema)


def _near(t: float, bits: list[str]) -> Column:
    """Length and suffix filter of a pair (an, ag0, ...), (bn, bg0, ...)."""
    differ = sum((F.bit_count(F.col("a" + g).bitwiseXOR(F.col("b" + g))) for g in bits), F.lit(0))
    return (F.least("an", "bn") >= t * F.greatest("an", "bn") - 1e-9) & (differ <= (1 - t) / (1 + t) * (F.col("an") + F.col("bn")) + 1e-9)


def _possible(t: float) -> Column:
    """All filters of a pair that meets at places ai and bi, the suffix filter by its folded bits."""
    left = F.least(F.col("an") - F.col("ai"), F.col("bn") - F.col("bi"))
    return (left >= t / (1 + t) * (F.col("an") + F.col("bn")) - 1e-9) & _near(t, _few())


def _side(df: DataFrame, side: str, on: list[str]) -> DataFrame:
    return df.select(*on, *[F.col(c).alias(side + c) for c in df.columns if c not in on])


def _star(members: DataFrame, turn: int, t: float) -> DataFrame:
    """(a, b): the two centres of each shingle with the sets there of other components, one of each."""
    fields = ["node", "n", "i", *_few()]
    order = F.struct(F.col("i").alias("before"), F.xxhash64("node", F.pmod("h", F.lit(CENTRES)), F.lit(turn)).alias("o"), *fields)
    one = members.groupBy("h", "root").agg(F.min(order).alias("m"))
    both = F.array_distinct(F.array(F.min("m"), F.min_by("m", F.struct("m.o", "m.node"))))
    centres = one.groupBy("h").agg(both.alias("c"), F.count("*").alias("sets")).where("sets > 1").select("h", "c")
    met = one.join(centres, "h").select("m", F.explode("c").alias("c")).where(F.col("m.node") != F.col("c.node"))
    met = met.select(*[F.col(f"{s}.{c}").alias(x + c) for s, x in (("c", "a"), ("m", "b")) for c in fields]).where(_possible(t))
    return met.select(F.least("anode", "bnode").alias("a"), F.greatest("anode", "bnode").alias("b")).distinct()


def _meetings(members: DataFrame, t: float, block: int) -> DataFrame:
    """(a, b): all sets of different components that meet at a shingle and pass the filters."""
    at = stored(members.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("h", "c"))
    near = (F.col("anode") < F.col("bnode")) & (F.col("aroot") != F.col("broot")) & _possible(t)
    own = members.join(at.where(F.col("c") <= block).select("h"), "h")
    pairs = _side(own, "a", ["h"]).join(_side(own, "b", ["h"]), "h").where(near).select("anode", "bnode")
    if not (large := at.where(F.col("c") > block)).isEmpty():
        m = large.select("h", F.ceil(F.col("c") / block).cast("long").alias("m"))
        dealt = spread_join(members, m, "h", m).withColumn("p", F.pmod(F.xxhash64("node"), F.col("m")))
        dealt = dealt.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
        dealt = dealt.withColumn("lo", F.least("p", "q")).withColumn("hi", F.greatest("p", "q")).drop("m", "q")
        on = ["h", "lo", "hi"]
        rest = _side(dealt, "a", on).join(_side(dealt, "b", on), on).where(near & ((F.col("ap") != F.col("bp")) | (F.col("lo") == F.col("hi"))))
        pairs = pairs.union(rest.select("anode", "bnode"))
    return pairs.distinct().toDF("a", "b")


def _sifted(pairs: DataFrame, nodes: DataFrame, t: float) -> DataFrame:
    """Those (a, b) that pass the suffix filter by all parity bits."""
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(side + c) for c in ("n", *_bits())]), side)
    return pairs.where(_near(t, _bits())).select("a", "b")


def _verified(pairs: DataFrame, keys: DataFrame, rows: DataFrame, k: int, seed: int, t: float) -> DataFrame:
    """Those (a, b) whose sets have the similarity."""
    percent = round(100 * t)

    def similar(p, q):
        p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
        both = len(np.intersect1d(p, q, assume_unique=True))
        return 100 * both >= percent * (len(p) + len(q) - both)

    return _compared(pairs, keys, rows, k, seed, np.ndarray.tobytes, similar)


def _merged(rooted: DataFrame, edges: DataFrame) -> DataFrame:
    """``rooted`` (node, root) with the components at both ends of an edge as one."""
    for c in "ab":
        edges = edges.join(rooted.select(F.col("node").alias(c), F.col("root").alias("r" + c)), c)
    edges = stored(edges.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if edges.isEmpty():
        return rooted
    to = components(edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stored(spread_join(rooted, stored(rooted.select("root").distinct().join(to, "root", "left").withColumn("to", F.coalesce("to", "root"))), "root", _large(rooted)).select("node", F.col("to").alias("root")))


def _large(rooted: DataFrame) -> DataFrame:
    sizes = rooted.groupBy("root").agg(F.count("*").alias("rows"))
    return sizes.where(F.col("rows") > max(1, rooted.count() // SPREAD)).select("root")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, similarity: float = SIMILARITY, seed: int = SEED, stars: int = STARS, block: int = BLOCK) -> DataFrame:
    """(id_col, n_shingles, component_id) for each row. ``similarity`` is a whole percentage."""
    rows = docs.select(quoted(text_col).cast("binary").alias("t"), quoted(id_col).alias("id"), row_key(id_col, text_col).alias("key"))
    sets = stored(described(rows, similarity, k))
    name = ["s0", "s1", "n"]
    nodes = sets.where("n > 0").groupBy(*name).agg(F.min("id").alias("least"), F.min("key").alias("key"), *[F.first(c).alias(c) for c in (*_bits(), "prefix")])
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    keyed = rows.select(F.xxhash64("key").alias("h"), F.col("key").alias("k"), "t")
    keys = nodes.select(F.col("node").alias("id"), F.col("key").alias("k"))
    every = nodes.select("node", F.posexplode("prefix").alias("i", "h")).select("h", "node", "i")
    met = every.repartition("h").sortWithinPartitions("h", "node").mapInArrow(shared_rows, "h long, node long, i int")
    members = stored(met.join(nodes.select("node", "n", *_folded()), "node"))
    rooted, tested = nodes.select("node", F.col("node").alias("root")), None
    for turn in range(stars + 1):
        own = stored(members.join(rooted, "node"))
        pairs = stored(_sifted(_star(own, turn, similarity) if turn < stars else _meetings(own, similarity, block), nodes, similarity))
        if tested is not None:
            pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"))
        if pairs.isEmpty():
            if turn < stars:
                continue
            break
        tested = pairs if tested is None else stored(tested.union(pairs))
        rooted = _merged(rooted, _verified(pairs, keys, keyed, k, seed, similarity))
    of = nodes.select(*name, "node", "least").join(rooted, "node")
    of = spread_join(of, of.groupBy("root").agg(F.min("least").alias("component_id")), "root", _large(rooted)).select(*name, "component_id")
    set_ = F.struct(*name).alias("set")
    copies = sets.where("n > 0").groupBy(set_).agg(F.count("*").alias("rows"))
    often = copies.where(F.col("rows") > max(1, sets.count() // SPREAD)).select("set")
    linked = spread_join(sets.where("n > 0").select("id", "n", set_), of.select(set_, "component_id"), "set", often).select("id", "n", "component_id")
    alone = sets.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
