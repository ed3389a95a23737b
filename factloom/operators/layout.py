"""Pages from layers, lines from words, sections, key/value pairs, and page layouts.

layers: (document_id, page, kind NATIVE_TEXT | IMAGE | VECTOR, x0, y0, x1, y1, char_count). lines: (document_id, page,
line_no, text, y0, y1, cells array<string>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import collapse_whitespace, fold, strip
from factloom.operators import boxes

# Thresholds of page classes, and the shapes of pairs and of message tags.
MIN_CHARS, COMBO, IMAGE_SHARE = 24, 0.15, 0.05
KEY_VALUE = r"^\s*([^:：]{2,60})[:：]\s*(.+?)\s*$"
SWIFT_TAG = r":[0-9]{2}[A-Z]?:"


def area(b: Column) -> Column:
    return F.greatest(b.x1 - b.x0, F.lit(0.0)) * F.greatest(b.y1 - b.y0, F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    """Common area of two boxes."""
    return F.greatest(F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0), F.lit(0.0)) * F.greatest(F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0), F.lit(0.0))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Share of a's own area that b covers."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def vertical_overlap(a: Column, b: Column) -> Column:
    """Common height as a share of the shorter box."""
    low = F.least(a.y1 - a.y0, b.y1 - b.y0)
    return F.when(low > 0, F.greatest(F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0), F.lit(0.0)) / low).otherwise(0.0)


def union_box(*cols: str) -> list[Column]:
    """Aggregates of the box around all boxes of a group."""
    return [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]


def classify_pages(layers: DataFrame, sizes: DataFrame) -> DataFrame:
    """Page classes. sizes: (document_id, page, width, height)."""
    box = F.struct("x0", "y0", "x1", "y1")
    texts = layers.where("kind = 'NATIVE_TEXT'").select("document_id", "page", "char_count", box.alias("b"), F.monotonically_increasing_id().alias("i"))
    images = layers.where("kind = 'IMAGE'").select("document_id", "page", box.alias("m"))
    flat = lambda df, b: df.select("document_id", "page", *[F.col(f"{b}.{c}").cast("double").alias(c) for c in boxes.SIDES])
    met = boxes.meeting(flat(texts, "b"), flat(images, "m"), ["document_id", "page"])
    side = lambda s: F.struct(*[F.col(s + c).alias(c) for c in boxes.SIDES])
    on = met.groupBy("document_id", "page").agg(F.max(overlap_ratio(side("a"), side("b"))).alias("overlap"))
    t = texts.groupBy("document_id", "page").agg(F.sum("char_count").alias("native_chars"))
    m = layers.where("kind = 'IMAGE'").groupBy("document_id", "page").agg(*union_box(), F.count("*").alias("images"))
    p = sizes.join(t, ["document_id", "page"], "left").join(m, ["document_id", "page"], "left").join(on, ["document_id", "page"], "left")
    ratio = F.when(F.col("width") * F.col("height") > 0, F.coalesce(F.greatest(F.col("x1") - F.col("x0"), F.lit(0.0)) * F.greatest(F.col("y1") - F.col("y0"), F.lit(0.0)), F.lit(0.0)) / (F.col("width") * F.col("height"))).otherwise(0.0)
    p = p.withColumn("native_chars", F.coalesce("native_chars", F.lit(0)).cast("long")).withColumn("image_area_ratio", F.round(F.least(ratio, F.lit(1.0)), 4))
    has, img = F.col("native_chars") >= MIN_CHARS, F.coalesce("images", F.lit(0)) > 0
    combo = F.coalesce(F.col("overlap") >= COMBO, F.lit(False))
    kind = F.when(~has & ~img, "EMPTY").when(has & (combo | (img & (F.col("image_area_ratio") >= IMAGE_SHARE))), "MIXED").when(has, "NATIVE").otherwise("SCANNED")
    return p.select("document_id", "page", kind.alias("page_class"), "width", "height", "native_chars", "image_area_ratio")


def composition(pages: DataFrame) -> DataFrame:
    """Per document: pages of each class."""
    return pages.groupBy("document_id").agg(F.count("*").alias("page_count"), *[F.count_if(F.col("page_class") == k).alias(n) for k, n in (("NATIVE", "native_text_pages"), ("SCANNED", "scanned_pages"), ("MIXED", "mixed_pages"), ("EMPTY", "empty_pages"))])


def is_heading(text: Column) -> Column:
    t = strip(text)
    return (F.length(t) <= 30) & ~F.contains(t, F.lit(":")) & (F.size(F.split(t, r"\s+", -1)) <= 3) & ~t.rlike(r"\p{Nd}") & (F.upper(t) == t) & t.rlike(r"\p{L}")


def with_sections(lines: DataFrame) -> DataFrame:
    """Non-blank lines with the last heading above, itself included."""
    w = Window.partitionBy("document_id", "page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = lines.where(strip(F.col("text")) != "").withColumn("heading", is_heading(F.col("text")))
    return t.withColumn("section", F.coalesce(F.last(F.when(F.col("heading"), strip(F.col("text"))), ignorenulls=True).over(w), F.lit("")))


def key_values(lines: DataFrame) -> DataFrame:
    """(document_id, page, line_no, section, key, value)"""
    t = with_sections(lines).where(~F.col("heading")).withColumn("t", strip(F.col("text")))
    hit = F.col("t").rlike(KEY_VALUE)
    key, value = strip(F.regexp_extract("t", KEY_VALUE, 1)), strip(F.regexp_extract("t", KEY_VALUE, 2))
    marked = hit & (key != "") & (value != "")
    two = F.size("cells") == 2
    a, b = strip(F.get("cells", F.lit(0))), strip(F.get("cells", F.lit(1)))
    beside = F.coalesce(two & (a != "") & (b != "") & (F.length(a) <= 40), F.lit(False))
    return t.where(marked | beside).select("document_id", "page", "line_no", "section", F.when(marked, key).otherwise(a).alias("key"), F.when(marked, value).otherwise(b).alias("value"))


def page_layouts(lines: DataFrame, grids: DataFrame | None = None) -> DataFrame:
    """(document_id, page, layout). grids: (document_id, page, has_body, column_count)."""
    some = strip(F.col("text")) != ""
    p = lines.groupBy("document_id", "page").agg(F.count_if(some).alias("n_lines"), F.bool_or(F.col("text").rlike(SWIFT_TAG)).alias("swift"))
    kv = key_values(lines).groupBy("document_id", "page").agg(F.count("*").alias("n_pairs"))
    p = p.join(kv, ["document_id", "page"], "left").withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))
    if grids is not None:
        g = grids.where("has_body").groupBy("document_id", "page").agg(F.max("column_count").alias("columns"))
        p = p.join(g, ["document_id", "page"], "full")
    else:
        p = p.withColumn("columns", F.lit(None).cast("int"))
    form = (F.col("n_pairs") > 0) & (F.col("n_pairs") >= F.greatest(F.lit(3), F.floor(F.col("n_lines") / 4)))
    kind = F.when(F.col("columns") >= 3, "TABLE_ROW").when(F.col("swift"), "SWIFT_MESSAGE").when(form, "FORM_KEY_VALUE").when(F.col("columns").isNotNull(), "SECTION_BLOCK").when(F.col("n_lines") > 0, "NARRATIVE").otherwise("UNRECOGNISED")
    return p.select("document_id", "page", kind.alias("layout"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))


def dominant_layout(layouts: DataFrame) -> DataFrame:
    """The most frequent layout of a document; of equals the one of the first page."""
    n = layouts.groupBy("document_id", "layout").agg(F.count("*").alias("n"), F.min("page").alias("first"))
    return n.groupBy("document_id").agg(F.max_by("layout", F.struct("n", (-F.col("first")).alias("f"))).alias("dominant_layout"))


def paragraphs(lines: DataFrame) -> DataFrame:
    """Lines with the number of their paragraph: a gap of more than 1.4 line heights starts one."""
    w = Window.partitionBy("document_id", "page").orderBy("line_no")
    gap = F.col("y0") - F.lag("y1").over(w)
    cut = F.coalesce(gap > (F.col("y1") - F.col("y0")) * 1.4, F.lit(False)).cast("int")
    return lines.withColumn("__cut", cut).withColumn("paragraph", F.sum("__cut").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__cut")


def joined_text(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Lines of a group joined in order."""
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda x: x.text), "\n").alias("text"))


# Words of amendments and of front matter.
AMENDMENT = ("amendment", "amend", "amended", "addendum", "supersedes", "superseding", "revision", "revised", "change", "changes", "changed", "update", "updated", "modification", "modificacion", "enmienda", "anderung", "aenderung", "modifica", "aggiornamento", "alteracao")
FRONT_MATTER = ("disclaimer", "confidential", "confidentiality", "unsubscribe", "sent from", "original message", "forwarded message", "kind regards", "best regards", "privacy notice", "table of contents", "page", "aviso legal")
STRONG_KINDS = ("BIC", "IBAN", "ACCOUNT_NUMBER", "SORT_CODE", "PARTICIPANT_ID", "ISIN", "LEI")
SUPPORTING_KINDS = ("COUNTRY", "CURRENCY", "DATE")


def is_amendment(text: Column) -> Column:
    """A word of the text, folded, is one of an amendment's."""
    words = F.transform(F.split(text, r"(?U)[^\w]+", -1), lambda w: F.regexp_replace(F.lower(F.translate(w, "ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖòóôõöÙÚÛÜùúûüÝýÿŠšŽž", "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOoooooUUUUuuuuYyySsZz")), "[^0-9a-z]", ""))
    return F.arrays_overlap(words, F.split(F.lit(" ".join(AMENDMENT)), " "))


def relevance(text: Column, kinds: Column) -> Column:
    """How much a region looks like settlement data, 0 to 1."""
    of = lambda names: F.size(F.array_intersect(kinds, F.split(F.lit(" ".join(names)), " ")))
    base = F.least(F.lit(1.0), of(STRONG_KINDS) * 0.4 + of(SUPPORTING_KINDS) * 0.12)
    folded = fold(text)
    plain = [t.replace(" ", "") for t in FRONT_MATTER]
    hits = sum((F.contains(folded, F.lit(t)).cast("int") for t in plain), F.lit(0))
    mail = F.when(text.rlike(r"(?i)^\s*(from|to|cc|bcc|sent|subject|date)\s*:"), 2).otherwise(0)
    return F.greatest(F.lit(0.0), base - (hits + mail) * 0.12)


def evidence_kinds(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per key: strong and supporting kinds among the tokens of its text. Distinct tokens are judged once."""
    from factloom.operators.kinds import infer_kind_scalar

    tokens = texts.select(*keys, F.explode(F.array_distinct(F.split(collapse_whitespace(F.col(text)), r"[\s,;|]+", -1))).alias("token")).where(F.length("token") >= 2)
    known = tokens.select("token").distinct().withColumn("kind", infer_kind_scalar(F.col("token"))["kind"]).where(F.col("kind").isin(*STRONG_KINDS, *SUPPORTING_KINDS))
    return tokens.join(known, "token").groupBy(*keys).agg(F.array_sort(F.collect_set("kind")).alias("evidence_kinds"))
