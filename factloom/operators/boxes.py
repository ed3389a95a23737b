"""Join of boxes that meet.

Boxes (x0, y0, x1, y1) are dealt to cells of a grid that fits their size: a box's level is the least l whose cells, ``cell * 2^l``
wide, are no smaller than the box, so it touches four cells at most. Two boxes are compared on the coarser of their levels;
for that a box is dealt to its own level and to the coarser ones that occur. A pair is kept in its first common cell only, so
no pair is made twice and none has to be made distinct. A large box does not spread over many cells, and many small ones are
compared with their neighbours only.

Where boxes are dense, pairs grow with the square of a page's boxes. ``meeting_sums`` gives what each box meets, in number and
area, without making pairs: boxes are cut by tiles about as large as they are, and in a tile both sums come from counts of
corners below corners (the boxes that begin before one's end, less those that end before its beginning, in x and y), found by
sorting. A tile's boxes are what a task holds; its work is m log m.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL = 16.0
#: Side of a tile of ``meeting_sums`` at least.
TILE = 128.0
SIDES = ("x0", "y0", "x1", "y1")


def _level(cell: float) -> Column:
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / cell
    return F.when(size > 1, F.ceil(F.log2(size))).otherwise(0).cast("int")


def _usable(boxes: DataFrame) -> DataFrame:
    return boxes.where(" and ".join(f"{c} is not null and not isnan({c})" for c in SIDES)).where("x1 >= x0 and y1 >= y0")


def _dealt(boxes: DataFrame, keys: list[str], levels: list[int], cell: float, side: str) -> DataFrame:
    own = [c for c in boxes.columns if c not in keys]
    usable = _usable(boxes).withColumn("__own", _level(cell))
    level = F.explode(F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: x >= F.col("__own"))).alias("__level")
    at = usable.select(*keys, *own, "__own", level)
    place = lambda c: F.floor(F.col(c) / (F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("__level"))))
    cells = lambda a, b: F.explode(F.sequence(place(a), place(b)))
    at = at.withColumn("__cx", cells("x0", "x1")).withColumn("__cy", cells("y0", "y1"))
    first = [place("x0").alias(f"__{side}x"), place("y0").alias(f"__{side}y")]
    return at.select(*keys, "__level", "__cx", "__cy", *first, F.col("__own").alias(f"__{side}"), *[F.col(c).alias(side + c) for c in own])


def meeting(a: DataFrame, b: DataFrame, keys: list[str], cell: float = CELL) -> DataFrame:
    """Pairs of boxes of a and b with equal keys that have a point in common, edges included: the keys, then the other columns
    of each side behind the letters a and b. Boxes with a null, NaN or negative side meet nothing."""
    sizes = [_usable(df).select(_level(cell).alias("l")) for df in (a, b)]
    levels = sorted(r.l for r in sizes[0].union(sizes[1]).distinct().collect())  # powers of two between the sizes: a few dozen
    on = [*keys, "__level", "__cx", "__cy"]
    met = _dealt(a, keys, levels, cell, "a").join(_dealt(b, keys, levels, cell, "b"), on)
    coarser = F.col("__level") == F.greatest("__a", "__b")
    once = (F.col("__cx") == F.greatest("__ax", "__bx")) & (F.col("__cy") == F.greatest("__ay", "__by"))
    touch = (F.col("ax0") <= F.col("bx1")) & (F.col("bx0") <= F.col("ax1")) & (F.col("ay0") <= F.col("by1")) & (F.col("by0") <= F.col("ay1"))
    return met.where(coarser & once & touch).select(*keys, *["a" + c for c in a.columns if c not in keys], *["b" + c for c in b.columns if c not in keys])


def _tiled(boxes: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """Each box with the tiles that it touches."""
    out = _usable(boxes).withColumns({c: F.col(c).cast("double") for c in SIDES})
    for c in "xy":
        out = out.withColumn(f"__t{c}", F.explode(F.sequence(F.floor(F.col(c + "0") / tile), F.floor(F.col(c + "1") / tile))))
    return out


def _below(px, py, weights, qx, qy) -> np.ndarray:
    """Sums of the rows of ``weights`` of points (px, py) that lie below each (qx, qy) in both orders; places of points and queries
    differ. Halves, quarters, ... of the rows in y: a point and a query meet once, in the two parts of a part."""
    n, m = len(px), len(px) + len(qx)
    x, y = np.concatenate([px, qx]), np.concatenate([py, qy])
    place = np.empty(m, np.int64)
    place[np.argsort(y, kind="stable")] = np.arange(m)
    by_x = np.argsort(x, kind="stable")
    out = np.zeros((len(qx), weights.shape[1]))
    for level in range(max(m - 1, 0).bit_length()):
        part = place[by_x] >> level
        order = by_x[np.argsort((part >> 1).astype(np.uint16 if part.max() < 1 << 17 else np.int64), kind="stable")]
        part = place[order] >> level
        left = np.flatnonzero((order < n) & (part % 2 == 0))
        right = np.flatnonzero((order >= n) & (part % 2 == 1))
        if len(left) and len(right):
            upto = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[order[left]], axis=0)])
            first = np.searchsorted(part[left] >> 1, part[right] >> 1)
            out[order[right] - n] += upto[np.searchsorted(left, right)] - upto[first]
    return out


def _tile_sums(a: np.ndarray, b: np.ndarray, corner: np.ndarray, tile: float) -> tuple[np.ndarray, np.ndarray]:
    """For each box of a (rows x0, y0, x1, y1): how many of b it meets first in the tile at this corner, and the area that they
    have in common there."""
    ends = [(i, j) for i in (0, 1) for j in (0, 1)]
    before = {side: box[:2] < corner[:, None] for side, box in (("a", a), ("b", b))}  # it begins before the tile
    ranks = []
    for axis in (0, 1):
        at, kind = [], []
        for side, box in (("b", b), ("a", a)):
            for e in ends:
                end = e[axis]
                out = before[side][axis] if not end else np.zeros(box.shape[1], bool)
                at.append(np.where(out, -np.inf, box[axis + 2 * end]))
                # Behind all that b brings along comes what a brings along; where places are equal, b begins, then come a's sides, then b ends.
                kind.append(np.where(out, int(side == "a"), 3 if side == "a" else 4 if end else 2))
        at, kind = np.concatenate(at), np.concatenate(kind)
        order = np.lexsort((kind, at))
        new = np.r_[True, (at[order][1:] != at[order][:-1]) | (kind[order][1:] != kind[order][:-1])]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        ranks.append(rank)
    n, (rx, ry) = 4 * b.shape[1], ranks
    own, other = (np.clip(box - np.r_[corner, corner][:, None], 0, tile) for box in (a, b))
    which = np.repeat(np.arange(4), b.shape[1])
    px, py = (np.concatenate([other[axis + 2 * e[axis]] for e in ends]) for axis in (0, 1))
    sign = np.where((which == 0) | (which == 3), 1.0, -1.0)
    weights = np.column_stack([*(which == i for i in range(4)), sign, sign * px, sign * py, sign * px * py]).astype(float)
    got = _below(rx[:n], ry[:n], weights, rx[n:], ry[n:]).reshape(4, a.shape[1], 8)
    count, area = np.zeros(a.shape[1]), np.zeros(a.shape[1])
    for (i, j), s in zip(ends, got):
        plus = 1 if i == j else -1
        # Before a's beginning end some of b; where a begins before the tile, those that do so, too, are left out in place of them.
        bi, bj = (np.where(before["a"][axis] | (end == 1), 0, 1) for axis, end in ((0, i), (1, j)))
        count += plus * s[np.arange(a.shape[1]), 2 * bi + bj]
        qx, qy = own[2 * i], own[1 + 2 * j]
        area += plus * (qx * qy * s[:, 4] - qy * s[:, 5] - qx * s[:, 6] + s[:, 7])
    return np.rint(count).astype(np.int64), area


def meeting_sums(a: DataFrame, b: DataFrame, keys: list[str], tile: float = TILE) -> DataFrame:
    """How many boxes of b with equal keys each box of a meets (``meets``), edges included, and its area in common with them
    (``area``, each of b's on its own), without the pairs. The columns of a but for its sides; a box's sums come in parts, one for
    each tile where it meets any for the first time or has area in common. Areas are exact where places are whole numbers."""
    sides = [_usable(df).select(*SIDES) for df in (a, b)]
    square = sides[0].union(sides[1]).agg(F.avg(F.pow(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.lit(2.0)))).first()[0]
    while tile < math.sqrt(square or 0.0):  # so that a box touches about four tiles, or fewer
        tile *= 2
    on = [*keys, "__tx", "__ty"]
    kept = [c for c in a.columns if c not in SIDES]

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        count, area = np.zeros(mine.num_rows, np.int64), np.zeros(mine.num_rows)
        if mine.num_rows and theirs.num_rows:
            corner = np.array([mine.column(c)[0].as_py() * tile for c in on[-2:]])
            count, area = _tile_sums(*(np.stack([t.column(c).to_numpy() for c in SIDES]) for t in (mine, theirs)), corner, tile)
        out = mine.select(kept).append_column("meets", pa.array(count)).append_column("area", pa.array(area))
        return out.filter(pa.array((count > 0) | (area != 0)))

    schema = ", ".join(f"`{c}` {a.schema[c].dataType.simpleString()}" for c in kept) + ", meets long, area double"
    left, right = _tiled(a, keys, tile), _tiled(b.select(*keys, *SIDES), keys, tile)
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, schema)
