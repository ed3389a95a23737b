"""Ruled tables found on a page: line segments to rulings, rulings to tables.

segments: (document_id, page, x0, y0, x1, y1) as drawn, in any direction, thin filled boxes included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import boxes
from factloom.operators.links import components
from factloom.operators.lineage import stored

KEY = ["document_id", "page"]
#: Thickness of a line, and distance of lines that are one; gaps along a line that are bridged; how far a line may end
#: before the line it meets; the least length of a line. All in points.
SNAP, JOIN, REACH, LENGTH = 2.0, 3.0, 2.0, 8.0
#: Lines of each axis that a table has at least.
LEAST_H, LEAST_V = 3, 2


def rulings(segments: DataFrame, snap: float = SNAP, join: float = JOIN, length: float = LENGTH) -> DataFrame:
    """(document_id, page, axis H | V, at, start, stop): segments along one line merged where they touch or nearly do.

    Positions within ``snap`` of the one before are one line, named by the least; along it, pieces with gaps of up to
    ``join`` are one ruling. Rulings shorter than ``length`` and oblique segments are left out.
    """
    s = segments.select(*KEY, *[F.least(a, b).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"))], *[F.greatest(a, b).alias(b) for a, b in (("x0", "x1"), ("y0", "y1"))])
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    flat = s.where((h <= snap) & (w > h)).select(*KEY, F.lit("H").alias("axis"), ((F.col("y0") + F.col("y1")) / 2).alias("at"), F.col("x0").alias("start"), F.col("x1").alias("stop"))
    tall = s.where((w <= snap) & (h > w)).select(*KEY, F.lit("V").alias("axis"), ((F.col("x0") + F.col("x1")) / 2).alias("at"), F.col("y0").alias("start"), F.col("y1").alias("stop"))
    across = Window.partitionBy(*KEY, "axis").orderBy("at")
    upto = Window.unboundedPreceding, Window.currentRow
    drawn = flat.unionByName(tall).distinct()  # what is drawn again changes no line: a page's work grows with its distinct segments
    lines = drawn.withColumn("new", F.coalesce(F.col("at") - F.lag("at").over(across) > snap, F.lit(True)).cast("int"))
    flagged = Window.partitionBy(*KEY, "axis").orderBy("at", F.desc("new"))  # of equal positions the one that begins a line comes first
    lines = lines.withColumn("line", F.sum("new").over(flagged.rowsBetween(*upto)))
    along = Window.partitionBy(*KEY, "axis", "line").orderBy("start", "stop")
    before = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    pieces = lines.withColumn("new", F.coalesce(F.col("start") - before > join, F.lit(True)).cast("int"))
    flagged = Window.partitionBy(*KEY, "axis", "line").orderBy("start", F.desc("new"))
    pieces = pieces.withColumn("piece", F.sum("new").over(flagged.rowsBetween(*upto)))
    whole = pieces.groupBy(*KEY, "axis", "line", "piece").agg(F.min("at").alias("at"), F.min("start").alias("start"), F.max("stop").alias("stop"))
    return whole.where(F.col("stop") - F.col("start") >= length).select(*KEY, "axis", "at", "start", "stop")


def _strips(lines: DataFrame, axis: str, reach: float) -> DataFrame:
    """Rulings of an axis as boxes without a height (H) or a width (V), ``reach`` longer at both ends."""
    a, b, at = F.col("start") - reach, F.col("stop") + reach, F.col("at")
    sides = (a, at, b, at) if axis == "H" else (at, a, at, b)
    return lines.where(F.col("axis") == axis).select(*KEY, "id", *[c.alias(n) for c, n in zip(sides, boxes.SIDES)])


def tables(lines: DataFrame, reach: float = REACH, least_h: int = LEAST_H, least_v: int = LEAST_V) -> DataFrame:
    """(document_id, page, table_no, axis, at, start, stop): rulings that cross, directly or by others, are one table.

    Crossings come from a join of boxes, tables are their components; one with fewer than ``least_h`` or ``least_v`` lines is
    none. Tables of a page are numbered from the top, then from the left, then by their other corners.
    """
    r = stored(lines.withColumn("id", F.monotonically_increasing_id()))
    crossings = boxes.meeting(_strips(r, "H", reach), _strips(r, "V", reach), KEY)
    of = r.join(components(crossings.select(F.col("aid").alias("a"), F.col("bid").alias("b"))).withColumnRenamed("node", "id"), "id")
    places = lambda axis: F.count_distinct(F.when(F.col("axis") == axis, F.col("at")))
    of_ = lambda axis, c="at": F.when(F.col("axis") == axis, F.col(c))
    corners = [F.min(of_("H")).alias("top"), F.min(of_("V")).alias("left"), F.max(of_("H")).alias("bottom"), F.max(of_("V")).alias("right"), F.min(of_("H", "start")).alias("first")]
    whole = of.groupBy(*KEY, "root").agg(places("H").alias("h"), places("V").alias("v"), *corners).where((F.col("h") >= least_h) & (F.col("v") >= least_v))
    number = (F.row_number().over(Window.partitionBy(*KEY).orderBy("top", "left", "bottom", "right", "first", "root")) - 1).cast("int")
    return of.join(whole.select(*KEY, "root", number.alias("table_no")), [*KEY, "root"]).select(*KEY, "table_no", "axis", "at", "start", "stop")


def find(segments: DataFrame) -> DataFrame:
    """Tables of all pages from what is drawn on them."""
    return tables(rulings(segments))
