"""Instructions from pages: a table row, a section of a form, or a paragraph becomes one chunk each.

Every cutter returns (document_id, page, ord, layout, text, pages, header_context, cells, key_values, ocr_confidence);
``locate`` joins them by page layout, scores them, drops what is not relevant with a reason, stitches table rows that a page
break cut, and numbers the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import collapse_whitespace, strip
from factloom.operators import grid as grids
from factloom.operators import layout as pages
from factloom.operators.lineage import cut

FLOOR = 0.2
_CELLS, _PAIRS = "array<struct<header:string,value:string>>", "array<struct<section:string,key:string,value:string>>"


def table_chunks(grid: DataFrame) -> DataFrame:
    """One chunk per body row with two cells or more; a row with one is a banner."""
    own = ["document_id", "page", "grid_no"]
    grid = grid if "grid_no" in grid.columns else grid.withColumn("grid_no", F.lit(0))
    head = grids.header_paths(grid, own)
    heads = head.groupBy(*own).agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "header"))), lambda x: x.header).alias("header_context"))
    body = grid.where(~F.col("is_header")).join(heads, own, "left")
    named = F.zip_with("cells", F.coalesce("header_context", F.array().cast("array<string>")), lambda v, h: F.struct(h.alias("header"), v.alias("value")))
    named = F.transform(named, lambda c, i: F.struct(F.coalesce(c.header, F.concat(F.lit("column_"), (i + 1).cast("string"))).alias("header"), c.value.alias("value")))
    some = F.filter(named, lambda c: strip(F.coalesce(c.value, F.lit(""))) != "")
    out = body.withColumn("cells", some.cast(_CELLS)).where(F.size("cells") >= 2)
    text = F.array_join(F.transform("cells", lambda c: F.concat(c.header, F.lit(": "), c.value)), "\n")
    return out.select("document_id", "page", F.col("row_no").alias("ord"), F.lit("TABLE_ROW").alias("layout"), text.alias("text"), F.array("page").alias("pages"), F.coalesce("header_context", F.array().cast("array<string>")).alias("header_context"), "cells", F.array().cast(_PAIRS).alias("key_values"), F.lit(1.0).alias("ocr_confidence"))


def form_chunks(lines: DataFrame) -> DataFrame:
    """Sections that hold an identifier of their own and repeat each other's labels are one chunk each; else the page is one."""
    key = ["document_id", "page"]
    pairs = cut(pages.key_values(lines))
    kinds = pages.evidence_kinds(pairs, [*key, "section"], "value")
    strong = kinds.where(F.size(F.array_intersect("evidence_kinds", F.split(F.lit(" ".join(pages.STRONG_KINDS)), " "))) > 0).select(*key, "section", F.lit(True).alias("strong"))
    strong = cut(strong)
    labels = pairs.join(strong, [*key, "section"]).select(*key, "section", F.lower(collapse_whitespace(F.col("key"))).alias("label")).distinct()
    n_sections = labels.select(*key, "section").distinct().groupBy(*key).agg(F.count("*").alias("n_sections"))
    per_label = labels.groupBy(*key, "label").agg(F.count("*").alias("n")).join(n_sections, key)
    shared = per_label.groupBy(*key).agg(F.count_if(F.col("n") == F.col("n_sections")).alias("shared"), F.max("n_sections").alias("n_sections"))
    smallest = labels.groupBy(*key, "section").agg(F.count("*").alias("n")).groupBy(*key).agg(F.min("n").alias("smallest"))
    split = shared.join(smallest, key).where((F.col("n_sections") == 1) | (F.col("shared") >= F.greatest(F.lit(1), F.floor(F.col("smallest") / 2)))).select(*key, F.lit(True).alias("by_section"))
    tagged = pages.with_sections(lines).join(pairs.select(*key).distinct(), key, "left_semi").join(split, key, "left")
    # Where sections stand alone, each strong one also gets the lines of the others that are weak.
    groups = strong.join(split, key, "left_semi").select(*key, F.col("section").alias("grp"))
    weak = tagged.where("by_section").join(strong, [*key, "section"], "left")
    own = weak.where("strong").withColumn("grp", F.col("section"))
    common = weak.where("strong is null").join(groups, key)
    whole = tagged.where("by_section is null").withColumn("grp", F.lit(""))
    cols = [*key, "grp", "line_no", "text"]
    members = own.select(cols).unionByName(common.select(cols)).unionByName(whole.select(cols))
    text = pages.joined_text(members, [*key, "grp"], ["line_no"])
    numbered = members.select(*key, "grp", "line_no").distinct().join(pairs, [*key, "line_no"]).groupBy(*key, "grp").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "section", "key", "value"))), lambda x: F.struct(x.section.alias("section"), x["key"].alias("key"), x.value.alias("value"))).cast(_PAIRS).alias("key_values"), F.min("line_no").alias("ord"))
    out = text.join(numbered, [*key, "grp"])
    return out.select(*key, "ord", F.lit("FORM_KEY_VALUE").alias("layout"), "text", F.array("page").alias("pages"), F.when(F.col("grp") != "", F.array("grp")).otherwise(F.array().cast("array<string>")).alias("header_context"), F.array().cast(_CELLS).alias("cells"), "key_values", F.lit(1.0).alias("ocr_confidence"))


def narrative_chunks(lines: DataFrame) -> DataFrame:
    """Paragraphs that hold an identifier."""
    key = ["document_id", "page", "paragraph"]
    p = pages.joined_text(pages.paragraphs(lines), key, ["line_no"])
    k = pages.evidence_kinds(p, key).where(F.arrays_overlap("evidence_kinds", F.split(F.lit(" ".join(pages.STRONG_KINDS)), " ")))
    p = p.join(k, key, "left_semi")
    return p.select("document_id", "page", F.col("paragraph").cast("int").alias("ord"), F.when(F.col("text").rlike(pages.SWIFT_TAG), "SWIFT_MESSAGE").otherwise("NARRATIVE").alias("layout"), "text", F.array("page").alias("pages"), F.array().cast("array<string>").alias("header_context"), F.array().cast(_CELLS).alias("cells"), F.array().cast(_PAIRS).alias("key_values"), F.lit(1.0).alias("ocr_confidence"))


def _populated(cells: str):
    return F.array_distinct(F.transform(F.filter(cells, lambda c: strip(F.coalesce(c.value, F.lit(""))) != ""), lambda c: c.header))


def stitch(chunks: DataFrame, order: str = "seq") -> DataFrame:
    """Rows of a table that a page break cut in two are one chunk.

    Whether a chunk goes on in the next is decided for all neighbours at once; of a run of such neighbours the first and
    second are one, the third and fourth, and so on.
    """
    w = Window.partitionBy("document_id").orderBy(order)
    c = chunks.withColumn("__h", _populated("cells"))
    nxt = {x: F.lead(x).over(w) for x in ("header_context", "pages", "__h")}
    new_page = F.size(F.array_except(nxt["pages"], F.col("pages"))) > 0
    apart = (F.size(nxt["__h"]) > 0) & (F.size(F.array_intersect(nxt["__h"], F.col("__h"))) == 0)
    lead = F.get("header_context", F.lit(0))
    leads = F.coalesce(F.array_contains("__h", lead) & ~F.array_contains(nxt["__h"], lead) & (lead != ""), F.lit(False))
    c = c.withColumn("__go", F.coalesce(F.col("header_context").eqNullSafe(nxt["header_context"]) & new_page & apart & (leads | (F.size(nxt["__h"]) < F.size("__h") / 2)), F.lit(False)))
    # Number the links of each run of continuations; links of odd number join.
    c = c.withColumn("__stop", F.sum((~F.col("__go")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    c = c.withColumn("__nth", F.row_number().over(Window.partitionBy("document_id", F.coalesce("__stop", F.lit(0))).orderBy(order)))
    c = c.withColumn("__second", (F.col("__nth") % 2 == 0))
    c = c.withColumn("__pair", F.sum((~F.col("__second")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = lambda x: F.min_by(x, order).alias(x)
    kinds = "evidence_kinds" in chunks.columns
    g = c.groupBy("document_id", "__pair").agg(
        F.min(order).alias(order), F.count("*").alias("__n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x.text), "\n").alias("text"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), first("header_context"), first("layout"), first("key_values"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, "cells"))), lambda x: x.cells)).alias("cells"),
        F.min("ocr_confidence").alias("ocr_confidence"), F.bool_or("is_amendment").alias("is_amendment"), F.max("relevance").alias("relevance"), *([F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence_kinds")))).alias("evidence_kinds")] if kinds else []),
    )
    return g.withColumn("stitched", F.col("__n") > 1).drop("__n", "__pair")


def locate(lines: DataFrame, grid: DataFrame | None = None, floor: float = FLOOR) -> tuple[DataFrame, DataFrame]:
    """(chunks numbered per document, skipped regions with reasons)."""
    key = ["document_id", "page"]
    info = None
    if grid is not None:
        info = grid.groupBy(*key).agg(F.bool_or(~F.col("is_header")).alias("has_body"), F.max(F.size("cells")).alias("column_count"))
    kinds = cut(pages.page_layouts(lines, info))
    of = lambda df, *names: df.join(kinds.where(F.col("layout").isin(*names)).select(*key), key, "left_semi")
    made = form_chunks(of(lines, "FORM_KEY_VALUE")).unionByName(narrative_chunks(of(lines, "NARRATIVE", "SWIFT_MESSAGE", "SECTION_BLOCK")))
    if grid is not None:
        made = made.unionByName(table_chunks(of(grid, "TABLE_ROW")))
    ident = ["document_id", "page", "ord", "layout"]
    made = cut(made)
    found = pages.evidence_kinds(made, ident)
    made = made.join(found, ident, "left").withColumn("evidence_kinds", F.coalesce("evidence_kinds", F.array().cast("array<string>")))
    made = cut(made.withColumn("relevance", F.round(pages.relevance(F.col("text"), F.col("evidence_kinds")), 4)).withColumn("is_amendment", pages.is_amendment(F.col("text"))))
    low = made.where(F.col("relevance") < floor).select("document_id", "page", F.format_string("page %d: relevance %.2f below %.2f", "page", "relevance", F.lit(float(floor))).alias("reason"))
    none = kinds.where("layout = 'UNRECOGNISED'").select("document_id", "page", F.format_string("page %d: no recognised layout", "page").alias("reason"))
    kept = made.where(F.col("relevance") >= floor).withColumn("seq", F.row_number().over(Window.partitionBy("document_id").orderBy("page", "ord")))
    out = stitch(kept).withColumn("record_index", (F.row_number().over(Window.partitionBy("document_id").orderBy("seq")) - 1).cast("int")).drop("seq")
    return out, low.unionByName(none)


def no_instructions(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents without a chunk, as rows."""
    return documents.select("document_id").distinct().join(chunks.select("document_id"), "document_id", "left_anti").withColumn("status", F.lit("NO_INSTRUCTIONS_FOUND"))


def fill(chunks: DataFrame, descriptors: DataFrame) -> DataFrame:
    """The default filler: cells and key/value pairs copied to the paths of their descriptors; paths without a value are empty facts."""
    from factloom.operators.harvest import group_and_label, path_of

    c = chunks.select("document_id", "record_index", "pages", F.posexplode_outer("cells").alias("pos", "cell")).where("cell is not null").withColumn("g", group_and_label(F.col("cell.header")))
    cells = c.select("document_id", "record_index", "pages", "pos", path_of(F.col("g.group_path"), F.col("g.label")).alias("path"), F.col("cell.value").alias("value"), F.concat("cell.header", F.lit(": "), "cell.value").alias("evidence"))
    k = chunks.select("document_id", "record_index", "pages", F.posexplode_outer("key_values").alias("pos", "kv")).where("kv is not null")
    group = F.when(F.coalesce("kv.section", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array("kv.section"))
    pairs = k.select("document_id", "record_index", "pages", "pos", path_of(group, F.col("kv.key")).alias("path"), F.col("kv.value").alias("value"), F.concat("kv.key", F.lit(": "), "kv.value").alias("evidence"))
    given = cells.unionByName(pairs)
    given = given.withColumn("ordinal", (F.row_number().over(Window.partitionBy("document_id", "record_index", "path").orderBy("pos")) - 1).cast("int"))
    grid = chunks.select("document_id", "record_index").join(descriptors.select("document_id", "path"), "document_id")
    out = grid.join(given, ["document_id", "record_index", "path"], "left")
    absent = F.coalesce(strip(F.col("value")), F.lit("")) == ""
    return out.select("document_id", "record_index", "path", F.coalesce("ordinal", F.lit(0)).alias("ordinal"), F.coalesce("value", F.lit("")).alias("value"), F.when(absent, "NOT_APPLICABLE").otherwise("VALIDATED").alias("status"), F.when(absent, 0.0).otherwise(1.0).alias("confidence"), F.coalesce("evidence", F.lit("")).alias("evidence"), F.coalesce("pages", F.array().cast("array<int>")).alias("page"))
