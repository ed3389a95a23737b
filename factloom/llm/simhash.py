"""SimHash near-duplicates by anchor-point covering.

A fingerprint of ``64 * lanes`` bits is looked at in parts of 32 bits. In a part, the anchors are the words of the perfect
Hamming code [31, 26] with one free bit, a covering code of radius 1. Each fingerprint goes to every anchor within 2 of a
part (the radius plus each side's share of a threshold of 2; 17 on average), and only fingerprints of one anchor are
compared, all bits of them. Two parts that differ in at most 2 bits have a midpoint within 1 of both and an anchor within
1 of that midpoint, so they meet.

One lane has two parts and a threshold of 4 at most: if two fingerprints differ in at most 4 bits, one of the parts
differs in at most 2. That is exact: no link is lost. Two lanes serve a similarity instead of a few bits: texts whose
shingle sets have Jaccard similarity J differ in a share acos(2J / (1 + J)) / pi of all bits, about 19 of 128 at J = 0.8,
with a deviation of 4; up to 23 are linked there, so that five of six such pairs are, and some between 0.7 and 0.8, too.
They have eight parts, the four words of 32 bits and the four sets of every fourth bit. Links at that distance are found
if one part differs in at most 2 bits (or in 3 or 4 with an anchor between), which is likely but not certain. So ``keep_one``
adds every pair of texts whose shingle sets reach the similarity, by prefixes of the sets. Shingles have one order; of two
sets of similarity t or more, the first |s| - ceil(t |s|) + 1 shingles of each share one. Sets that meet at such a shingle
and are not connected yet are compared whole, unless their sizes or parity bits of their shingles rule it out (a bit that
differs is a shingle that differs). The order puts shingles frequent in a sample last; any order gives the same
links, so the sample saves work only. Before all pairs that meet, two sets of each component at a shingle are compared, so
that a group of copies in several components is joined without its square of pairs.

Whole texts; A-Z lowered; words ``[^\\x20\\x09-\\x0D]+``; shingles of ``k`` words joined by a space (fewer words: the
whole sequence); XXH64 with seed 42, further lanes by mixing it; a bit is 1 if over half of the shingles have it. No words
(empty, null): zero, linked like any other. Repeated rows stay repeated; a component whose ids are all null has the id
null. Of ties the least id stays, then the least row hash. Other columns are not read, and pass through ``keep_one``
whatever their names. Empty table: empty result. A text of any length is one value of a task's memory.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import Lookup, cut, mixed, packed, row_key, shared_rows, spread_join, stored, texts, unpacked
from factloom.llm.suffix_tree import bitmap, passes

RADIUS = 4
#: For near-duplicates by similarity: words of a shingle, lanes, least similarity.
SHINGLE, LANES, SIMILARITY = 5, 2, 0.8
#: Members of an anchor that one task compares with each other; a larger anchor is cut into blocks of about so many.
BLOCK = 2048
#: A component with over 1 / SPREAD of all fingerprints (there are fewer than SPREAD such) is joined by broadcast.
SPREAD = 1024
#: Longs of parity bits of a set, those that go along with each shingle, bytes of them before sets are compared whole.
PARITY, FEW, WIDE = 16, 2, 2048
#: One in SAMPLE texts and at most FREQUENT shingles that occur OFTEN times there order the shingles.
SAMPLE, FREQUENT, OFTEN = 16, 1 << 16, 4
#: Shingles that a slice of texts holds at once; a text with more is one slice.
_SLICE = 1 << 19

_bits = np.arange(256, dtype=np.uint64)
#: Byte value to eight lanes of a byte: adds up to 255 hashes at once without a carry.
_LANES = sum((((_bits >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i)) for i in range(8))
#: Syndromes of the bytes of a word of 31 bits: the XOR of the set bits' places, from 1.
_SYNDROME = np.zeros((4, 256), np.uint8)
for _b in range(4):
    for _i in range(8):
        if _b * 8 + _i < 31:
            _SYNDROME[_b] ^= np.where((np.arange(256) >> _i) & 1, _b * 8 + _i + 1, 0).astype(np.uint8)


def radius_of(similarity: float, lanes: int = LANES) -> int:
    """Bits that fingerprints of texts with this Jaccard similarity differ in on average, and one standard deviation."""
    bits, share = 64 * lanes, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + math.sqrt(bits * share * (1 - share)))


def shingles(text: bytes, k: int = 4, seed: int = 42) -> np.ndarray:
    """Hashes of the shingles of one text, repeats included."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if n <= k:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())), np.uint64, n - k + 1)


def fingerprint(text: bytes, k: int = 4, seed: int = 42, lanes: int = 1) -> list[int]:
    """SimHash of one text, unsigned, a number of 64 bits per lane."""
    return _folded(shingles(text, k, seed), lanes)


def _folded(hashes: np.ndarray, lanes: int) -> list[int]:
    if not len(hashes):
        return [0] * lanes
    out = []
    for lane in range(lanes):
        own = hashes if lane == 0 else mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15 >> lane))
        spread = _LANES[own.view(np.uint8).reshape(-1, 8)]
        counts = np.zeros(64, np.int64)
        for i in range(0, len(spread), 255):
            counts += spread[i : i + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
        out.append(int(np.packbits(counts * 2 > len(own), bitorder="little").view(np.uint64)[0]))
    return out


def _names(lanes: int) -> list[str]:
    return [f"f{i}" for i in range(lanes)]


def fingerprints(rows: DataFrame, k: int = 4, seed: int = 42, lanes: int = 1) -> DataFrame:
    """The first column, a text as bytes, replaced by f0, f1, ... (long), behind the other columns."""
    fields = [f for f in rows.schema.fields[1:]] + [T.StructField(n, T.LongType()) for n in _names(lanes)]

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, k, seed, lanes) for t in texts(batch.column(0))], np.uint64).reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(np.ascontiguousarray(fp[:, i])) for i in range(lanes))], names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def _every_fourth(x: np.ndarray, first: int) -> np.ndarray:
    """16 bits: the bits of x at first, first + 4, ..."""
    y = (x >> np.uint64(first)) & np.uint64(0x1111111111111111)
    for shift, mask in ((3, 0x0303030303030303), (6, 0x000F000F000F000F), (12, 0x000000FF000000FF), (24, 0xFFFF)):
        y = (y | (y >> np.uint64(shift))) & np.uint64(mask)
    return y


def parts_of(fp: np.ndarray) -> list[np.ndarray]:
    """Parts of 32 bits of fingerprints (rows x lanes)."""
    out = [(fp[:, lane] >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF) for lane in range(fp.shape[1]) for half in range(2)]
    if fp.shape[1] == 2:
        out += [_every_fourth(fp[:, 0], i) | (_every_fourth(fp[:, 1], i) << np.uint64(16)) for i in range(4)]
    return [p.astype(np.int64) for p in out]


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row of fp): every anchor within 2 of a part of unsigned fingerprints (rows x lanes)."""
    keys, places = [], []
    everyone = np.arange(len(fp))
    for part, x in enumerate(parts_of(fp)):
        word, free = x & 0x7FFFFFFF, x >> 31
        s = _SYNDROME[0][word & 255] ^ _SYNDROME[1][(word >> 8) & 255] ^ _SYNDROME[2][(word >> 16) & 255] ^ _SYNDROME[3][(word >> 24) & 255]
        s = s.astype(np.int64)
        off = s > 0
        near = np.where(off, word ^ (1 << np.maximum(s - 1, 0)), word)
        tag = part << 40
        keys += [tag | (free << 31) | near, tag | ((1 - free) << 31) | near]
        places += [everyone, everyone]
        for i in range(1, 32):
            j = i ^ s
            ok = off & (j > i)
            w = word[ok] ^ (1 << (i - 1)) ^ (1 << (j[ok] - 1))
            keys.append(tag | (free[ok] << 31) | w)
            places.append(everyone[ok])
    return np.concatenate(keys), np.concatenate(places)


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits; the last axis holds the lanes."""
    out = np.bitwise_count(a[..., 0] ^ b[..., 0])
    for lane in range(1, a.shape[-1]):
        out = out + np.bitwise_count(a[..., lane] ^ b[..., lane])
    return out


def _star(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Each member of a group with the least member of its component there."""
    m = len(fp)
    near = _differ(fp[:, None], fp[None, :]) <= radius
    label = np.arange(m)
    while True:
        new = np.where(near, label[None, :], m).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(i), int(label[i])) for i in range(m) if label[i] != i]


def _pairs(anchor: np.ndarray, fp: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links in complete, sorted groups."""
    left, right = [], []
    cuts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[cuts, len(anchor)])
    length = np.repeat(sizes, sizes)
    small = np.flatnonzero((length > 1) & (length <= 16))
    for d in range(1, 16):
        i = small[small + d < len(anchor)]
        i = i[anchor[i] == anchor[i + d]]
        if not len(i):
            break
        i = i[_differ(fp[i], fp[i + d]) <= radius]
        left.append(fp[i])
        right.append(fp[i + d])
    for at, n in zip(cuts[sizes > 16], sizes[sizes > 16]):
        group = fp[at : at + n]
        if star := _star(group, radius):
            a, b = np.array(star).T
            left.append(group[a])
            right.append(group[b])
    return left, right


def _link_schema(lanes: int) -> str:
    return "kind int, anchor long, " + ", ".join(f"{side}{n} long" for side in "ab" for n in _names(lanes))


def _link_batch(kind: int, anchor: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    lanes = a.shape[1]
    columns = [np.ascontiguousarray(x[:, i]).view(np.int64) for x in (a, b) for i in range(lanes)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(anchor), *map(pa.array, columns)], names=["kind", "anchor", *(side + n for side in "ab" for n in _names(lanes))])


def _compare(radius: int, block: int, lanes: int):
    """Partition sorted by anchor: links of kind 0; members of an anchor above ``block`` come back as kind 1."""

    def run(batches):
        held_a, held_f, large = np.zeros(0, np.int64), np.zeros((0, lanes), np.uint64), None

        def done(a, f):
            left, right = _pairs(a, f, radius)
            if left:
                x, y = np.concatenate(left), np.concatenate(right)
                yield _link_batch(0, np.zeros(len(x), np.int64), x, y)

        for batch in batches:
            a = np.concatenate([held_a, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([held_f, np.stack([batch.column(1 + i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(lanes)], axis=1)])
            if not len(a):
                continue
            if large is not None:
                n = int(np.searchsorted(a, large, "right"))
                yield _link_batch(1, a[:n], f[:n], f[:n])
                a, f = a[n:], f[n:]
                if len(a):
                    large = None
                else:
                    held_a, held_f = a, f
                    continue
            last = int(np.searchsorted(a, a[-1], "left"))
            yield from whole(a[:last], f[:last], done)
            held_a, held_f = a[last:], f[last:]
            if len(held_a) > block:
                large = held_a[0]
                yield _link_batch(1, held_a, held_f, held_f)
                held_a, held_f = held_a[:0], held_f[:0]
        yield from whole(held_a, held_f, done)

    def whole(a, f, done):
        if not len(a):
            return
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        sizes = np.diff(np.r_[cuts, len(a)])
        keep = np.repeat(sizes <= block, sizes)
        if not keep.all():
            yield _link_batch(1, a[~keep], f[~keep], f[~keep])
        yield from done(a[keep], f[keep])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK, lanes: int = 1) -> DataFrame:
    """(af0, ..., bf0, ...) of fingerprints that meet at an anchor and differ in ``radius`` bits or fewer: not every pair,
    but all that connects them. An anchor of m blocks compares m * m / 2 pairs of blocks, each a task's group of its own."""
    if lanes == 1 and radius > 4 or lanes > 2:
        raise ValueError("one lane covers up to 4 differing bits; there are two lanes at most")
    names = _names(lanes)
    sides = [side + n for side in "ab" for n in names]

    def spread(batches):
        for batch in batches:
            fp = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(lanes)], axis=1)
            for i in range(0, len(fp), 5_000):
                part = fp[i : i + 5_000]
                key, place = anchors_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(part[place, j].view(np.int64)) for j in range(lanes))], names=["anchor", *names])

    members = distinct.select(*names).mapInArrow(spread, "anchor long, " + ", ".join(f"{n} long" for n in names))
    found = cut(members.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(radius, block, lanes), _link_schema(lanes)).distinct())
    # Large anchors: members are dealt to blocks, and each pair of blocks is one group.
    large = found.where("kind = 1").select("anchor", *[F.col("a" + n).alias(n) for n in names])
    blocks = large.groupBy("anchor").agg(F.ceil(F.count("*") / block).cast("int").alias("m"))
    dealt = large.join(blocks, "anchor").withColumn("i", F.pmod(F.xxhash64(*names), F.col("m")))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1))
    paired = dealt.select("anchor", *names, "i", each.alias("j")).select(F.xxhash64("anchor", F.least("i", "j"), F.greatest("i", "j")).alias("anchor"), *names)
    rest = paired.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(radius, 1 << 30, lanes), _link_schema(lanes))
    return found.where("kind = 0").select(*sides).union(rest.select(*sides)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars; root is the least node.

    Each round is aggregations and joins on edges; what a hot node gathers is only its minimum.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select("b", "m").toDF("a", "b")
        e = stored(small.union(low.toDF("a", "b")).where("a <> b").distinct())
        mark = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return e.toDF("node", "root")
        seen = mark


def _rooted(distinct: DataFrame, radius: int, block: int, lanes: int) -> DataFrame:
    """``distinct`` (node long, f0, ...) with the root of each one's component."""
    names = _names(lanes)
    found = links(distinct, radius, block, lanes)
    for side in "ab":
        found = found.join(distinct.select(F.col("node").alias(side), *[F.col(n).alias(side + n) for n in names]), [side + n for n in names])
    joined = components(found.select("a", "b"))
    return cut(distinct.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")))


def _large(rooted: DataFrame) -> DataFrame:
    sizes = rooted.groupBy("root").agg(F.count("*").alias("n"))
    return sizes.where(F.col("n") > max(1, rooted.count() // SPREAD)).select("root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = RADIUS, seed: int = 42, block: int = BLOCK, lanes: int = 1) -> DataFrame:
    """(id_col, fingerprint hex, component_id) for each row; component_id is the least id of the component."""
    names = _names(lanes)
    prints = cut(fingerprints(docs.select(F.col(text_col).cast("binary").alias("t"), F.col(id_col).alias("id")), k, seed, lanes))
    distinct = cut(prints.groupBy(*names).agg(F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()))
    rooted = _rooted(distinct, radius, block, lanes)
    of = spread_join(rooted.select(*names, "root"), rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root", _large(rooted))
    hex_ = F.concat(*[F.lower(F.lpad(F.hex(n), 16, "0")) for n in reversed(names)])
    return prints.join(of, names).select(F.col("id").alias(id_col), hex_.alias("fingerprint"), "component_id")


def _parity() -> list[str]:
    return [f"g{i}" for i in range(PARITY)]


def _sets(sets: list[np.ndarray], similarity: float, late: Lookup, ranks: np.ndarray) -> list[pa.Array]:
    """Of sorted sets: 128 bits that name the set, its size, its parity bits, and the prefix that a similar set meets."""
    n = np.array([len(u) for u in sets], np.int64)
    u, row, start = np.concatenate(sets), np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    names = []
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(u ^ np.uint64(salt)), dtype=np.uint64)])
        names.append(total[start + n] - total[start])
    width = 64 * PARITY
    odd = np.bincount(row * width + (u % np.uint64(width)).astype(np.int64), minlength=len(n) * width) & 1
    odd = np.packbits(odd.astype(np.uint8).reshape(-1, width), axis=1, bitorder="little").view(np.int64)
    found = late.find(u)
    if (found >= 0).any():
        u = u[np.lexsort((np.where(found >= 0, ranks[found], -1), row))]
    most = np.where(n > 0, n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1, 0)
    first = u[np.arange(len(u)) - start[row] < most[row]]
    prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(most)]).astype(np.int32)), pa.array(first.view(np.int64)))
    return [*(pa.array(x.view(np.int64)) for x in names), pa.array(n), *(pa.array(np.ascontiguousarray(odd[:, i])) for i in range(PARITY)), prefix]


def _late(rows: DataFrame, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that are frequent in a sample of the texts, and their ranks by frequency."""

    def run(batches):
        for batch in batches:
            for t in texts(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(shingles(t, k, seed)).view(np.int64))], names=["h"])

    some = rows.where(F.pmod(F.xxhash64("t"), F.lit(SAMPLE)) == 0).select("t").mapInArrow(run, "h long")
    often = some.groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= OFTEN).orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    h = often["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], (len(h) - 1 - np.arange(len(h)))[order]


def _prints_and_sets(rows: DataFrame, k: int, seed: int, lanes: int, similarity: float) -> DataFrame:
    """(t, order) as order, f0, ..., and what ``_sets`` gives."""
    frequent = rows.sparkSession.sparkContext.broadcast(_late(rows, k, seed))
    names = ["order", *_names(lanes), "s0", "s1", "n", *_parity()]
    order_type = rows.schema["order"].dataType
    schema = T.StructType([T.StructField("order", order_type), *(T.StructField(c, T.LongType()) for c in names[1:]), T.StructField("prefix", T.ArrayType(T.LongType()))])

    def run(batches):
        keys, ranks = frequent.value
        late = Lookup(keys)
        for batch in batches:
            held, at, size = [], 0, 0

            def done(end):
                fp = np.array([_folded(h, lanes) for h in held], np.uint64).reshape(-1, lanes).view(np.int64)
                prints = [pa.array(np.ascontiguousarray(fp[:, i])) for i in range(lanes)]
                own = _sets([np.unique(h) for h in held], similarity, late, ranks)
                return pa.RecordBatch.from_arrays([batch.column(1).slice(at, end - at), *prints, *own], names=[*names, "prefix"])

            for i, t in enumerate(texts(batch.column(0))):
                held.append(shingles(t, k, seed))
                size += len(held[-1])
                if size >= _SLICE or len(held) >= 2048:
                    yield done(i + 1)
                    held, at, size = [], i + 1, 0
            if held:
                yield done(at + len(held))

    return rows.mapInArrow(run, schema)


def _may_be_similar(similarity: float, parity: list[str]):
    """By sizes and parity bits: the union less the intersection is at most this share of both sizes."""
    share = (1 - similarity) / (1 + similarity)
    differ = sum((F.bit_count(F.col("a" + g).bitwiseXOR(F.col("b" + g))) for g in parity), F.lit(0))
    return (F.least("an", "bn") >= similarity * F.greatest("an", "bn") - 1e-9) & (differ <= share * (F.col("an") + F.col("bn")) + 1e-9)


def _sides(df: DataFrame, on: list[str]) -> list[DataFrame]:
    return [df.select(*on, *[F.col(c).alias(side + c) for c in df.columns if c not in on]) for side in "ab"]


def _meetings(members: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """(a, b): sets of different components that meet at a shingle and that sizes and parity bits do not tell apart.

    members: (h, id, n, root, g0, ...). A shingle with m blocks of members compares pairs of blocks.
    """
    few = [g for g in _parity() if g in members.columns]
    at = cut(members.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c")).where("lo < hi").select("h", "c"))
    near = (F.col("aid") < F.col("bid")) & (F.col("aroot") != F.col("broot")) & _may_be_similar(similarity, few)
    a, b = _sides(members.join(at.where(F.col("c") <= block).select("h"), "h"), ["h"])
    pairs = a.join(b, "h").where(near).select("aid", "bid")
    if not (large := at.where(F.col("c") > block)).isEmpty():  # one shingle in ``block`` members at most
        m = F.broadcast(large.select("h", F.ceil(F.col("c") / block).cast("long").alias("m")))
        dealt = members.join(m, "h").withColumn("i", F.pmod(F.xxhash64("id"), F.col("m")))
        dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
        a, b = _sides(dealt.withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j")).drop("m", "j"), ["h", "lo", "hi"])
        pairs = pairs.union(a.join(b, ["h", "lo", "hi"]).where(near & ((F.col("ai") != F.col("bi")) | (F.col("lo") == F.col("hi")))).select("aid", "bid"))
    pairs = cut(pairs.distinct())
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(side + "id"), *[F.col(c).alias(side + c) for c in ("n", *_parity())]), side + "id")
    return cut(pairs.where(_may_be_similar(similarity, _parity())).select(F.col("aid").alias("a"), F.col("bid").alias("b")))


def _compared(pairs: DataFrame, keys: DataFrame, rows: DataFrame, k: int, seed: int, made, test) -> DataFrame:
    """Those (a, b) whose sets pass ``test``, by the bytes ``made`` of each set. keys: (id, k), a row of each set; rows: (h, k, t)."""
    wanted = stored(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct().join(keys, "id"))
    place = rows.sparkSession.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64("k").alias("h"))))

    def read(batches):
        for batch in batches:
            here = np.flatnonzero(passes(place.value, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
            some = batch.take(pa.array(here))
            for name, t in zip(some.column(1).to_pylist(), texts(some.column(2))):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([made(np.unique(shingles(t, k, seed)))])], names=["k", "u"])

    def compare(batches):
        for batch in batches:
            ok = [test(p, q) for p, q in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    own = stored(wanted.join(rows.mapInArrow(read, "k string, u binary"), "k").dropDuplicates(["id"]).select("id", "u"))
    dealt, hot = _dealt(pairs)
    for side in "ab":
        table = own.select(F.col("id").alias(side), F.col("u").alias("u" + side))
        if hot is None:
            dealt = dealt.join(table, side)
            continue
        parts = F.broadcast(hot.where(F.col("side") == side).select(F.col("id").alias(side), "parts"))
        every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part" + side)
        dealt = dealt.join(table.join(parts, side, "left").select(side, "u" + side, every), [side, "part" + side])
    return stored(dealt.select("a", "b", "ua", "ub").mapInArrow(compare, "a long, b long"))


def _dealt(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``pairs`` with parta and partb, and (side, id, parts) of the sets that are in over 1 / SPREAD of them (fewer than SPREAD a
    side): such a set goes to so many parts, so that no task meets it with all its partners. None: no set is in so many."""
    n = pairs.count()
    share, out = max(BLOCK, n // SPREAD), pairs
    if n <= share:
        return pairs, None
    often = lambda side: pairs.groupBy(F.col(side).alias("id")).agg(F.ceil(F.count("*") / share).cast("int").alias("parts")).where("parts > 1").select(F.lit(side).alias("side"), "id", "parts")
    hot = stored(often("a").union(often("b")))
    for side, other in ("ab", "ba"):
        parts = F.broadcast(hot.where(F.col("side") == side).select(F.col("id").alias(side), "parts"))
        part = F.coalesce(F.pmod(F.xxhash64(other), F.col("parts")), F.lit(0)).cast("int").alias("part" + side)
        out = out.join(parts, side, "left").select(*out.columns, part)
    return out, hot


def _similar(pairs: DataFrame, keys: DataFrame, rows: DataFrame, k: int, seed: int, similarity: float) -> DataFrame:
    """Those (a, b) whose sets, taken from the texts again, have the similarity: by more parity bits first, then whole."""

    def odd(u):
        bits = np.bincount((u % np.uint64(8 * WIDE)).astype(np.int64), minlength=8 * WIDE) & 1
        return len(u).to_bytes(8, "little") + np.packbits(bits.astype(np.uint8)).tobytes()

    def near(p, q):
        differ = int(np.bitwise_count(np.frombuffer(p, np.uint64, offset=8) ^ np.frombuffer(q, np.uint64, offset=8)).sum())
        both = int.from_bytes(p[:8], "little") + int.from_bytes(q[:8], "little")
        return differ <= both * (1 - similarity) / (1 + similarity) + 1e-9

    def similar(p, q):
        p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
        both = len(np.intersect1d(p, q, assume_unique=True))
        return both / (len(p) + len(q) - both) >= similarity

    return _compared(_compared(pairs, keys, rows, k, seed, odd, near), keys, rows, k, seed, np.ndarray.tobytes, similar)


def _joined(rooted: DataFrame, prints: DataFrame, rows: DataFrame, k: int, seed: int, similarity: float, block: int, names: list[str]) -> DataFrame:
    """(node, least, root) of ``rooted`` with components joined that hold texts of equal or similar shingle sets."""
    of = prints.groupBy("s0", "s1", *names).agg(F.min("order.k").alias("k"), *[F.first(c).alias(c) for c in ("n", *_parity())])
    of = cut(of.join(rooted.select(*names, "node"), names).drop(*names))
    sets = cut(of.groupBy("s0", "s1").agg(F.min(F.struct("node", "k")).alias("o"), *[F.first(c).alias(c) for c in ("n", *_parity())]).select("s0", "s1", "o.node", "o.k", "n", *_parity()).withColumn("id", F.monotonically_increasing_id()))
    rooted = _merged(rooted.select("node", "least", "root"), of.select("s0", "s1", F.col("node").alias("a")).join(sets.select("s0", "s1", F.col("node").alias("b")), ["s0", "s1"]).where("a <> b").select("a", "b"))
    # A set goes by 64 bits here: should two share them, both meet all that either meets.
    shared = prints.select(F.explode("prefix").alias("h"), "s0").repartition("h").sortWithinPartitions("h", "s0").mapInArrow(shared_rows, "h long, s0 long")
    few = _parity()[:FEW]
    members = cut(shared.join(sets.where("n > 0").select("s0", "id", "node", "n", *few), "s0").drop("s0"))
    for every in (False, True):
        own = members.join(rooted.select("node", "root"), "node").drop("node")
        if not every:
            own = own.groupBy("h", "root").agg(F.array_distinct(F.array(F.min("id"), F.max("id"))).alias("id")).select("h", F.explode("id").alias("id"), "root").join(sets.select("id", "n", *few), "id")
        pairs = _meetings(cut(own), sets, similarity, block)
        if pairs.isEmpty():
            continue
        found = _similar(pairs, sets.select("id", "k"), rows, k, seed, similarity)
        for c in "ab":
            found = found.join(sets.select(F.col("id").alias(c), F.col("node").alias("n" + c)), c)
        rooted = _merged(rooted, found.select(F.col("na").alias("a"), F.col("nb").alias("b")))
    return rooted


def _merged(rooted: DataFrame, edges: DataFrame) -> DataFrame:
    """``rooted`` with the components at both ends of an edge as one."""
    for c in "ab":
        edges = edges.join(rooted.select(F.col("node").alias(c), F.col("root").alias("r" + c)), c)
    edges = cut(edges.where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if edges.isEmpty():
        return rooted
    to = components(edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    to = rooted.select("root").distinct().join(to, "root", "left").withColumn("to", F.coalesce("to", "root"))
    return cut(spread_join(rooted, cut(to), "root", _large(rooted)).drop("root").withColumnRenamed("to", "root"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, similarity: float = SIMILARITY, seed: int = 42, block: int = BLOCK, lanes: int = LANES) -> DataFrame:
    """One row of ``docs`` for each component: that of the least id (nulls last), then of the least row hash.

    Texts are linked if their sets of shingles have this Jaccard similarity or more, all of them, and if their fingerprints meet at an anchor and differ in ``radius_of(similarity)`` bits or fewer. Rows are told apart by id and text, so rows that repeat an id with other texts stay or go by their own texts.
    """
    names, key = _names(lanes), row_key(id_col, text_col)
    order = F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"), key.alias("k")).alias("order")
    prints = cut(_prints_and_sets(docs.select(F.col(text_col).cast("binary").alias("t"), order), k, seed, lanes, similarity))
    distinct = cut(prints.groupBy(*names).agg(F.min("order").alias("least")).withColumn("node", F.monotonically_increasing_id()))
    rows = docs.select(key.alias("k"), F.col(text_col).cast("binary").alias("t")).select(F.xxhash64("k").alias("h"), "k", "t")
    rooted = _joined(_rooted(distinct, radius_of(similarity, lanes), block, lanes), prints, rows, k, seed, similarity, block, names)
    first = cut(rooted.groupBy("root").agg(F.min("least").alias("o")).select(F.col("o.k").alias("key")))
    again = prints.groupBy(F.col("order.k").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key")
    kept = packed(docs, key).join(first, "key", "left_semi")
    once = kept.join(again, "key", "left_anti").select("doc")
    rows = once.union(kept.join(again, "key", "left_semi").groupBy("key").agg(F.first("doc").alias("doc")).select("doc"))
    return rows.select(unpacked(rows, docs))
