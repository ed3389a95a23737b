"""Tables from words: ink bands give rows and columns, words go to the cells that hold their centres.

words: (document_id, page, pos, text, x0, y0, x1, y1). Everything is keyed by page, so pages are rebuilt side by side and a
page is the largest thing that a task holds.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import boxes
from factloom.operators.lineage import spread

KEY = ["document_id", "page"]
ROW_CORRIDOR, COLUMN_CORRIDOR, MIN_WORDS, OVERLAP = 2, 5, 12, 0.45
#: Images of a smaller area, in square points, are decoration.
DECORATIVE = 4000.0


def bands_of_slots(slots: DataFrame, keys: list[str], corridor: int, low: str = "low", high: str = "high", last: str = "last_slot", trailing: str | None = None) -> DataFrame:
    """Bands of occupied slots: (keys, band, start, stop); a run of ``corridor`` empty slots ends one.

    The last band ends at the extent's end, unless ``trailing`` slots without enough ink follow it.
    """
    w = Window.partitionBy(*keys).orderBy("slot")
    new = F.coalesce(F.col("slot") - F.lag("slot").over(w) - 1 >= corridor, F.lit(True)).cast("int")
    b = slots.withColumn("__new", new).withColumn("band", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1)
    g = b.groupBy(*keys, "band").agg(F.min("slot").alias("a"), F.max("slot").alias("z"), F.first(low).alias("low"), F.first(high).alias("high"), F.first(last).alias("n"))
    final = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("band").desc())) == 1
    ends = final & (F.col("n") - 1 - F.col("z") < corridor)
    return g.select(*keys, F.col("band").cast("int").alias("band"), (F.col("low") + F.col("a")).alias("start"), F.when(ends, F.col("high")).otherwise(F.col("low") + F.col("z") + 1).alias("stop"))


def _extent(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(a).alias("low"), F.max(b).alias("high")).where("high > low").withColumn("last_slot", (F.col("high") - F.col("low")).cast("int") + 2)


def ink_bands(df: DataFrame, keys: list[str], a: str, b: str, corridor: int) -> DataFrame:
    """Bands along one axis of intervals [a, b]: gaps and islands on the intervals themselves, by one shuffle."""
    own = Window.partitionBy(*keys)
    e = spread(df.select(*keys, a, b), keys).select(*keys, a, b, F.min(a).over(own).alias("low"), F.max(b).over(own).alias("high")).where("high > low").withColumn("n", (F.col("high") - F.col("low")).cast("int") + 2)
    e = e.select(*keys, "low", "high", "n", (F.col(a) - F.col("low")).cast("int").alias("s"), F.least((F.col(b) - F.col("low")).cast("int"), F.col("n") - 1).alias("e"))
    w = own.orderBy("s", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("s") - before - 1 >= corridor, F.lit(True)).cast("int")
    banded = e.withColumn("new", new).withColumn("band", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1)
    g = banded.groupBy(*keys, "band").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.first("low").alias("low"), F.first("high").alias("high"), F.first("n").alias("n"))
    ends = (F.col("e") == F.max("e").over(own)) & (F.col("n") - 1 - F.col("e") < corridor)
    return g.select(*keys, F.col("band").cast("int").alias("band"), (F.col("low") + F.col("s")).alias("start"), F.when(ends, F.col("high")).otherwise(F.col("low") + F.col("e") + 1).alias("stop"))


def _place(value: Column, bands: Column) -> Column:
    """Number of the band that holds a value, the nearest one else; of equals the first."""
    d = F.transform(bands, lambda s: F.struct(F.when((value >= s.start) & (value <= s.stop), -1.0).otherwise(F.least(F.abs(value - s.start), F.abs(value - s.stop))).alias("d"), s.band.alias("band")))
    return F.array_min(d).band


def _listed(bands: DataFrame, name: str) -> DataFrame:
    return bands.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("band", "start", "stop"))).alias(name))


def column_bounds(words: DataFrame, rows: DataFrame) -> DataFrame:
    """Columns: x positions that have ink in at least max(2, 15 %) of the row bands."""
    w = words.join(_listed(rows, "rows"), KEY).withColumn("cy", (F.col("y0") + F.col("y1")) / 2)
    w = w.withColumn("r", F.explode(F.filter("rows", lambda s: (F.col("cy") >= s.start) & (F.col("cy") <= s.stop))))
    e = w.join(_extent(words, KEY, "x0", "x1"), KEY)
    slots = e.select(*KEY, "low", "high", "last_slot", F.size("rows").alias("n_rows"), F.col("r.band").alias("row"), F.explode(F.sequence((F.col("x0") - F.col("low")).cast("int"), F.least((F.col("x1") - F.col("low")).cast("int"), F.col("last_slot") - 1))).alias("slot")).distinct()
    inked = slots.groupBy(*KEY, "slot", "low", "high", "last_slot", "n_rows").agg(F.count("*").alias("n")).where(F.col("n") >= F.greatest(F.lit(2), F.rint(F.col("n_rows") * 0.15).cast("int")))
    return bands_of_slots(inked, KEY, COLUMN_CORRIDOR)


def cells(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((document_id, page, row, cells array, straddles), columns) before header and body are told apart."""
    enough = words.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") >= MIN_WORDS).select(*KEY)
    words = words.join(enough, KEY, "left_semi")
    rows = ink_bands(words, KEY, "y0", "y1", ROW_CORRIDOR)
    columns = column_bounds(words, rows)
    w = words.join(_listed(rows, "rows"), KEY).join(_listed(columns, "cols"), KEY).where((F.size("rows") >= 2) & (F.size("cols") >= 3))
    touched = F.size(F.filter("cols", lambda s: (F.col("x1") > s.start + 2.0) & (F.col("x0") < s.stop - 2.0)))
    w = w.select(*KEY, "pos", "text", _place((F.col("y0") + F.col("y1")) / 2, F.col("rows")).alias("row"), _place((F.col("x0") + F.col("x1")) / 2, F.col("cols")).alias("col"), (touched > 1).alias("straddles"), F.size("cols").alias("n_cols"))
    one = w.groupBy(*KEY, "row", "col", "n_cols").agg(F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x.text), " ")).alias("text"), F.count_if("straddles").alias("s"))
    row = one.groupBy(*KEY, "row", "n_cols").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("m"), F.sum("s").alias("straddles"))
    row = row.withColumn("cells", F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit("")))).where(F.exists("cells", lambda c: c != ""))
    row = row.withColumn("idx", F.row_number().over(Window.partitionBy(*KEY).orderBy("row")) - 1)
    return row.select(*KEY, "idx", "cells", "straddles"), columns


def _filled(c: Column) -> Column:
    return F.filter(c, lambda x: F.trim(x) != "")


def reconstruct(words: DataFrame) -> DataFrame:
    """Long grids: (document_id, page, row_no, is_header, cells)."""
    row, _ = cells(words)
    filled = _filled(F.col("cells"))
    digit = F.exists(filled, lambda x: x.rlike(r"\p{Nd}"))
    plain = ~F.exists(filled, lambda x: (F.length(x) > 40) | F.contains(x, F.lit("@")) | x.rlike(r"\p{Nd}"))
    row = row.withColumn("n", F.size(filled)).withColumn("tabular", (F.size(filled) >= 3) & (F.col("straddles") == 0)).withColumn("data", (F.size(filled) >= 3) & digit).withColumn("headerish", (F.size(filled) >= 2) & plain).withColumn("band", (F.size(filled) >= 2) & (F.col("straddles") >= 1) & plain)
    page, w = Window.partitionBy(*KEY), Window.partitionBy(*KEY).orderBy("idx")
    # Longest span of tabular rows, one odd row inside allowed: islands of tabular rows at most two apart.
    t = row.where("tabular").withColumn("__new", F.coalesce(F.col("idx") - F.lag("idx").over(w) > 2, F.lit(True)).cast("int")).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    span = t.groupBy(*KEY, "island").agg(F.min("idx").alias("a"), (F.max("idx") + 1).alias("z")).groupBy(*KEY).agg(F.max_by(F.struct("a", "z"), F.struct((F.col("z") - F.col("a")).alias("len"), (-F.col("a")).alias("first"))).alias("span"))
    row = row.join(span, KEY, "left").withColumn("a", F.coalesce(F.col("span.a"), F.lit(0))).withColumn("z", F.coalesce(F.col("span.z"), F.max("idx").over(page) + 1))
    inside = (F.col("idx") >= F.col("a")) & (F.col("idx") < F.col("z"))
    row = row.withColumn("wide", F.count_if(inside & (F.col("n") >= 3)).over(page)).where("wide >= 3")
    row = row.withColumn("body", F.min(F.when(inside & F.col("data"), F.col("idx"))).over(page))
    # Header: label-like rows right above the first data row, and group bands right above those.
    last_bad = F.max(F.when(inside & (F.col("idx") < F.col("body")) & ~F.col("headerish"), F.col("idx"))).over(page)
    row = row.withColumn("body0", F.coalesce("body", F.col("a") + 1)).withColumn("head", F.when(F.col("body").isNull(), F.col("a")).otherwise(F.greatest(F.col("a"), F.coalesce(last_bad + 1, F.col("a")))))
    not_band = F.max(F.when((F.col("idx") < F.col("head")) & ~F.col("band"), F.col("idx"))).over(page)
    row = row.withColumn("top", F.least(F.col("head"), F.coalesce(not_band + 1, F.lit(0))))
    row = row.where((F.col("idx") >= F.col("top")) & (F.col("idx") < F.col("z"))).withColumn("is_header", F.col("idx") < F.col("body0"))
    # Wrapped rows: an empty first cell continues the row above if that one has a first cell.
    body = row.where(~F.col("is_header"))
    first = F.trim(F.get("cells", F.lit(0))) != ""
    run = Window.partitionBy(*KEY).orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = (first | ~F.coalesce(F.bool_or(first).over(run), F.lit(False))).cast("int")
    body = body.withColumn("__s", starts).withColumn("g", F.sum("__s").over(run))
    merged = body.select(*KEY, "g", "idx", F.posexplode("cells").alias("col", "text")).where(F.trim("text") != "").groupBy(*KEY, "g", "col").agg(F.min("idx").alias("idx"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x.text), "\n").alias("text"))
    width = row.groupBy(*KEY).agg(F.max(F.size("cells")).alias("n_cols"))
    lines = merged.groupBy(*KEY, "g").agg(F.min("idx").alias("idx"), F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("m")).join(width, KEY)
    lines = lines.select(*KEY, "idx", F.lit(False).alias("is_header"), F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))).alias("cells"))
    out = row.where("is_header").select(*KEY, "idx", "is_header", "cells").unionByName(lines)
    return out.withColumn("row_no", F.row_number().over(Window.partitionBy(*KEY).orderBy("idx")) - 1).select(*KEY, F.col("row_no").cast("int").alias("row_no"), "is_header", "cells")


def header_paths(grid: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """(keys, col, header): header rows filled to the right, joined downwards without repeats, repeats numbered."""
    cell = grid.where("is_header").select(*keys, "row_no", F.posexplode("cells").alias("col", "text"))
    w = Window.partitionBy(*keys, "row_no").orderBy("col").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cell = cell.withColumn("text", F.coalesce(F.last(F.when(F.col("text") != "", F.col("text")), ignorenulls=True).over(w), F.lit("")))
    path = F.array_sort(F.collect_list(F.struct("row_no", "text")))
    g = cell.groupBy(*keys, "col").agg(path.alias("p"))
    join = F.aggregate(F.filter(F.transform("p", lambda x: x.text), lambda x: x != ""), F.array().cast("array<string>"), lambda a, x: F.when((F.size(a) > 0) & (F.element_at(F.concat(a, F.array(F.lit(""))), F.size(a)) == x), a).otherwise(F.concat(a, F.array(x))))
    g = g.withColumn("parts", join).withColumn("name", F.when(F.size("parts") > 0, F.array_join("parts", " / ")).otherwise(F.concat(F.lit("column_"), (F.col("col") + 1).cast("string"))))
    n = F.row_number().over(Window.partitionBy(*keys, "name").orderBy("col"))
    return g.withColumn("n", n).select(*keys, "col", F.when(F.col("n") == 1, F.col("name")).otherwise(F.concat("name", F.lit(" ("), F.col("n").cast("string"), F.lit(")"))).alias("header"))


def cluster_rows(words: DataFrame) -> DataFrame:
    """words with ``line_no``: a word joins the first open row that its height overlaps by 45 %, rows growing as they go.

    The result depends on the order, so it is a sequential pass in a grouped function, a page at a time.
    """

    def rows(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y0", "x0", "pos"], kind="stable").reset_index(drop=True)
        open_: list[list[float]] = []
        at = []
        for y0, y1 in zip(pdf["y0"], pdf["y1"]):
            for i, (a, b) in enumerate(open_):
                low = min(y1 - y0, b - a)
                if low > 0 and max(0.0, min(y1, b) - max(y0, a)) / low >= OVERLAP:
                    open_[i] = [min(a, y0), max(b, y1)]
                    at.append(i)
                    break
            else:
                open_.append([y0, y1])
                at.append(len(open_) - 1)
        rank = {i: r for r, i in enumerate(sorted(range(len(open_)), key=lambda i: open_[i][0]))}
        pdf["line_no"] = pd.Series([rank[i] for i in at], dtype="int32")
        return pdf

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.groupBy(*KEY).applyInPandas(rows, f"{fields}, line_no int")


def lines_of(words: DataFrame) -> DataFrame:
    """Lines with text, box, mean confidence and cells cut at wide gaps. words need line_no and confidence."""
    w = Window.partitionBy(*KEY, "line_no").orderBy("x0", "pos")
    gap = F.col("x0") - F.lag("x1").over(w)
    g = words.withColumn("gap", gap)
    ordinary = g.where((F.col("gap") > 0) & (F.col("gap") < 40)).withColumn("r", F.row_number().over(Window.partitionBy(*KEY).orderBy("gap"))).withColumn("n", F.count("*").over(Window.partitionBy(*KEY))).where(F.col("r") == F.floor(F.col("n") / 4) + 1).select(*KEY, F.greatest(F.lit(1.5), F.col("gap")).alias("typical"))
    g = g.join(ordinary, KEY, "left").withColumn("typical", F.coalesce("typical", F.lit(4.0)))
    wide = F.coalesce(F.col("gap") >= F.greatest(F.lit(5.0), F.col("typical") * 2.2), F.lit(False)).cast("int")
    g = g.withColumn("__w", wide).withColumn("cell", F.sum("__w").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    text = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "pos", "text"))), lambda x: x.text), " ")
    box = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    parts = g.groupBy(*KEY, "line_no", "cell").agg(text().alias("part"))
    parts = parts.groupBy(*KEY, "line_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "part"))), lambda x: x.part).alias("cells"))
    whole = g.groupBy(*KEY, "line_no").agg(text().alias("text"), *box, F.round(F.avg("confidence"), 4).alias("ocr_confidence"))
    return whole.join(parts, [*KEY, "line_no"])


def _before(words: DataFrame, lines: DataFrame, own: list[str], low: str, high: str, name: str) -> DataFrame:
    """words with ``name``: how many lines (own, at) of their table lie at or before their centre, less one. Lines and centres
    pass once, in order, so no word is held against all lines of its table."""
    centres = words.withColumn("__at", (F.col(low) + F.col(high)) / 2).withColumn("__line", F.lit(0))
    both = centres.unionByName(lines.select(*own, F.col("at").alias("__at"), F.lit(1).alias("__line")), allowMissingColumns=True)
    run = Window.partitionBy(*own).orderBy("__at", F.desc("__line")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(name, F.sum("__line").over(run).cast("int") - 1).where("__line = 0").drop("__at", "__line")


def ruled_tables(words: DataFrame, rulings: DataFrame) -> DataFrame:
    """Grids (as ``reconstruct`` gives them, and grid_no) of tables with ruled lines.

    rulings: (document_id, page, axis, at): the y of horizontal (H) and the x of vertical (V) lines of one table a page; or,
    as ``rulings.find`` gives them, (document_id, page, table_no, axis, at, start, stop) of any number of tables. A cell lies
    between two lines of each axis; a word belongs to the cell that holds its centre, words outside are left out. A word in
    several tables' boxes goes to the smallest. The first row is the header, wrapped rows stay apart, a table with fewer
    than two rows is no grid. Rows are numbered through a page.
    """
    several = "table_no" in rulings.columns
    own = [*KEY, "grid_no"]
    at = rulings.select(*KEY, (F.col("table_no") if several else F.lit(0)).alias("grid_no"), "axis", F.col("at").cast("double").alias("at")).where("at is not null").distinct()
    of = lambda axis: F.when(F.col("axis") == axis, F.col("at"))
    lines = at.groupBy(*own).agg(F.count(of("H")).alias("h"), F.count(of("V")).alias("v"), F.min(of("V")).alias("x0"), F.min(of("H")).alias("y0"), F.max(of("V")).alias("x1"), F.max(of("H")).alias("y1")).where("h >= 3 and v >= 2")
    if several:  # words meet the boxes of tables by place, not all tables of their page
        frame = lines.select(*own, "x0", "y0", "x1", "y1")
        x, y = ((F.col(a) + F.col(b)) / 2 for a, b in (("x0", "x1"), ("y0", "y1")))
        centres = words.select(*KEY, "pos", F.col("text"), x.alias("cx"), y.alias("cy"), *("x0", "y0", "x1", "y1")).withColumn("word", F.monotonically_increasing_id())
        points = centres.select(*KEY, "word", "pos", "text", *[F.col(c).alias("w" + c) for c in ("x0", "y0", "x1", "y1")], F.col("cx").alias("x0"), F.col("cy").alias("y0"), F.col("cx").alias("x1"), F.col("cy").alias("y1"))
        inside = boxes.meeting(points, frame, KEY)
        area = (F.col("bx1") - F.col("bx0")) * (F.col("by1") - F.col("by0"))
        best = F.min_by(F.struct("apos", "atext", "awx0", "awy0", "awx1", "awy1", "bgrid_no"), F.struct(area, "bgrid_no")).alias("w")
        placed = inside.groupBy(*KEY, "aword").agg(best)
        words = placed.select(*KEY, F.col("w.apos").alias("pos"), F.col("w.atext").alias("text"), *[F.col("w.aw" + c).alias(c) for c in ("x0", "y0", "x1", "y1")], F.col("w.bgrid_no").alias("grid_no"))
    else:
        words = words.select(*KEY, F.lit(0).alias("grid_no"), "pos", "text", "x0", "y0", "x1", "y1")
    w = words.join(lines.select(*own, "h", "v"), own)
    w = _before(_before(w, at.where("axis = 'H'"), own, "y0", "y1", "row"), at.where("axis = 'V'"), own, "x0", "x1", "col")
    w = w.where("row >= 0 and row < h - 1 and col >= 0 and col < v - 1")
    cell = w.groupBy(*own, "row", "col", (F.col("v") - 1).cast("int").alias("n")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x.text), " ").alias("text"))
    row = cell.groupBy(*own, "row", "n").agg(F.map_from_entries(F.collect_list(F.struct("col", "text"))).alias("m"))
    row = row.withColumn("rows", F.count("*").over(Window.partitionBy(*own))).where("rows >= 2")
    row = row.withColumn("first", F.row_number().over(Window.partitionBy(*own).orderBy("row")) == 1)
    row = row.withColumn("row_no", (F.row_number().over(Window.partitionBy(*KEY).orderBy("grid_no", "row")) - 1).cast("int"))
    return row.select(*own, "row_no", F.col("first").alias("is_header"), F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))).alias("cells"))


def grids(words: DataFrame, rulings: DataFrame | None = None) -> DataFrame:
    """Ruled grids first; pages without one are rebuilt from where their words stand."""
    if rulings is None:
        return reconstruct(words).withColumn("grid_no", F.lit(0))
    ruled = ruled_tables(words, rulings)
    own = reconstruct(words.join(ruled.select(*KEY).distinct(), KEY, "left_anti")).withColumn("grid_no", F.lit(0))
    return ruled.unionByName(own.select(*ruled.columns))


def page_words(native: DataFrame, read: DataFrame, images: DataFrame, least_area: float = DECORATIVE) -> DataFrame:
    """Native words and those read in images (``region`` is the image's number); small images are decoration and left out.

    images: (document_id, page, region, x0, y0, x1, y1).
    """
    large = images.where((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) >= least_area).select(*KEY, "region").distinct()
    seen = read.join(large, [*KEY, "region"], "left_semi")
    return native.withColumn("layer", F.lit("NATIVE")).unionByName(seen.drop("region").withColumn("layer", F.lit("OCR")), allowMissingColumns=True)


def lines_by_first_word(words: DataFrame) -> DataFrame:
    """words with ``line_no``: a word joins the first line whose first word its height overlaps by 45 %; lines from the top.

    Unlike in ``cluster_rows`` a line does not grow, so slanted text does not chain two lines together. The result depends
    on the order, so it is a sequential pass, a page at a time.
    """

    def lines(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y0", "x0", "pos"], kind="stable").reset_index(drop=True)
        heads: list[tuple[float, float]] = []
        at = []
        for y0, y1 in zip(pdf["y0"], pdf["y1"]):
            shared = ((min(y1, b) - max(y0, a), min(y1 - y0, b - a)) for a, b in heads)
            line = next((i for i, (common, low) in enumerate(shared) if low > 0 and common / low >= OVERLAP), len(heads))
            if line == len(heads):
                heads.append((y0, y1))
            at.append(line)
        pdf["line_no"] = pd.Series(at, dtype="int32")
        return pdf

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.groupBy(*KEY).applyInPandas(lines, f"{fields}, line_no int")


def native_lines(words: DataFrame) -> DataFrame:
    """words (block, line) with line_no: lines in the order of the y of their first word, blank words left out."""
    w = words.where(F.trim("text") != "")
    firsts = w.groupBy(*KEY, "block", "line").agg(F.min_by("y0", "pos").alias("fy")).withColumn("line_no", (F.row_number().over(Window.partitionBy(*KEY).orderBy("fy", "block", "line")) - 1).cast("int")).drop("fy")
    return w.join(firsts, [*KEY, "block", "line"])


def best_reading(attempts: DataFrame, least: float = 0.8) -> DataFrame:
    """OCR attempts (document_id, page, region, tier, orientation, mean_confidence): the first that is good enough, else the best."""
    good = F.min(F.when(F.col("mean_confidence") >= least, F.struct("tier", "orientation", "mean_confidence")))
    best = F.max_by(F.struct("tier", "orientation", "mean_confidence"), F.struct("mean_confidence", (-F.col("tier")).alias("t"), (-F.col("orientation")).alias("o")))
    g = attempts.groupBy(*KEY, "region").agg(F.coalesce(good, best).alias("b"), F.count("*").alias("attempts"))
    return g.select(*KEY, "region", "b.tier", "b.orientation", "b.mean_confidence", "attempts", (F.col("b.mean_confidence") < 0.6).alias("needs_vision_fallback"))


def enhancement_plan(metrics: DataFrame) -> DataFrame:
    """Image metrics (blur, skew_degrees, noise, contrast, dpi, inverted) to the operations that an image needs, in order."""
    ops = [("invert", F.col("inverted")), ("deskew", F.abs("skew_degrees") > 0.5), ("upscale", F.col("dpi") < 200), ("denoise", F.col("noise") > 12.0), ("clahe", F.col("contrast") < 40.0), ("unsharp", F.col("blur") < 100.0)]
    return metrics.withColumn("operations", F.array_compact(F.array(*[F.when(c, n) for n, c in ops])))
