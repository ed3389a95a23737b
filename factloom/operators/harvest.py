"""Schema discovery: field candidates of four kinds of layouts, merged to one descriptor per path.

chunks: (document_id, record_index, layout, text, pages array<int>, cells array<struct<header, value>>, key_values
array<struct<section, key, value>>). A candidate's samples are the first twelve values in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import collapse_whitespace, is_null_token, slugify, strip
from factloom.operators.kinds import infer_kind_scalar, infer_kinds

SAMPLES = 12
# What message tags mean.
SWIFT_TAGS = {
    "95P": ("Party BIC", "BIC"),
    "95Q": ("Party Name And Address", "ORG_NAME"),
    "95R": ("Party Proprietary Identification", "PARTICIPANT_ID"),
    "97A": ("Safekeeping Account", "ACCOUNT_NUMBER"),
    "97B": ("Safekeeping Account Proprietary", "ACCOUNT_NUMBER"),
    "22F": ("Indicator", "ENUM"),
    "35B": ("Identification Of Financial Instrument", "ISIN"),
    "36B": ("Quantity Of Financial Instrument", "FREE_TEXT"),
    "98A": ("Date", "DATE"),
    "19A": ("Amount", "FREE_TEXT"),
    "16R": ("Start Of Block", "ENUM"),
    "16S": ("End Of Block", "ENUM"),
    "20C": ("Reference", "FREE_TEXT"),
    "94": ("Place", "FREE_TEXT"),
}
SWIFT_LINE = r"^:([0-9]{2}[A-Z]?)::?([A-Z]{4})?/?/?(.*)$"
TOKEN = r"[A-Z0-9][A-Z0-9./-]{2,}"


def group_and_label(header: Column) -> Column:
    """struct(group_path, label) of a composed header."""
    parts = F.filter(F.transform(F.split(header, " / ", -1), collapse_whitespace), lambda x: x != "")
    n = F.size(parts)
    return F.struct(F.when(n > 1, F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<string>")).alias("group_path"), F.when(n > 0, F.get(parts, n - 1)).otherwise("field").alias("label"))


def path_of(group_path: Column, label: Column) -> Column:
    return F.concat_ws(".", F.transform(group_path, lambda g: slugify(g, inside=True)), F.array(slugify(label)))


def first_samples(values: DataFrame, keys: list[str], order: list[str], count: Column) -> DataFrame:
    """Per key: the first samples in order, all pages, the count. Only the first twelve rows of a field are gathered."""
    w = Window.partitionBy(*keys).orderBy(*order)
    some = values.where("sample is not null").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= SAMPLES)
    top = some.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rn", "sample"))), lambda x: x.sample).alias("sample_values"))
    pages = values.select(*keys, F.explode_outer("pages").alias("page")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("page")).alias("pages"))
    totals = values.groupBy(*keys).agg(count.cast("long").alias("occurrences"))
    out = totals.join(pages, keys, "left").join(top, keys, "left")
    return out.withColumn("sample_values", F.coalesce("sample_values", F.array().cast("array<string>")))


def harvest_table(chunks: DataFrame) -> DataFrame:
    cells = chunks.select("document_id", "record_index", "pages", F.posexplode("cells").alias("pos", "cell")).select("document_id", "record_index", "pages", "pos", F.col("cell.header").alias("header"), F.when(~is_null_token(F.col("cell.value")), F.col("cell.value")).alias("sample"))
    out = first_samples(cells, ["document_id", "header"], ["record_index", "pos"], F.count("sample")).withColumn("g", group_and_label(F.col("header")))
    return out.select("document_id", F.col("g.group_path").alias("group_path"), F.col("g.label").alias("label"), "sample_values", "pages", F.lit("table_header").alias("source_pattern"), F.lit(None).cast("string").alias("kind_hint"), "occurrences")


def harvest_key_values(chunks: DataFrame) -> DataFrame:
    """Here absent values count as occurrences, too."""
    kv = chunks.select("document_id", "record_index", "pages", F.posexplode("key_values").alias("pos", "kv")).select("document_id", "record_index", "pages", "pos", F.col("kv.section").alias("section"), F.col("kv.key").alias("key"), F.when(~is_null_token(F.col("kv.value")), F.col("kv.value")).alias("sample"))
    out = first_samples(kv, ["document_id", "section", "key"], ["record_index", "pos"], F.count(F.lit(1)))
    group = F.when(F.coalesce("section", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array("section"))
    return out.select("document_id", group.alias("group_path"), F.col("key").alias("label"), "sample_values", "pages", F.lit("key_value").alias("source_pattern"), F.lit(None).cast("string").alias("kind_hint"), "occurrences")


def swift_fields(text: DataFrame) -> DataFrame:
    """(document_id, record_index, pages, pos, tag, qualifier, label, kind_hint, sample) of message lines."""
    lines = text.select("document_id", "record_index", "pages", F.posexplode(F.split("text", r"\r\n|[\n\r]", -1)).alias("pos", "raw")).withColumn("line", strip(F.col("raw"))).where(F.col("line").rlike(SWIFT_LINE))
    got = lines.select("document_id", "record_index", "pages", "pos", F.regexp_extract("line", SWIFT_LINE, 1).alias("tag"), F.regexp_extract("line", SWIFT_LINE, 2).alias("qualifier"), collapse_whitespace(F.regexp_extract("line", SWIFT_LINE, 3)).alias("sample")).where("sample <> ''")
    names = F.str_to_map(F.lit(";".join(f"{k}={v[0]}" for k, v in SWIFT_TAGS.items())), F.lit(";"), F.lit("="))
    kinds = F.str_to_map(F.lit(";".join(f"{k}={v[1]}" for k, v in SWIFT_TAGS.items())), F.lit(";"), F.lit("="))
    label = F.coalesce(F.try_element_at(names, F.col("tag")), F.concat(F.lit("SWIFT Tag "), F.col("tag")))
    return got.withColumn("label", F.when(F.col("qualifier") != "", F.concat(label, F.lit(" ("), F.col("qualifier"), F.lit(")"))).otherwise(label)).withColumn("kind_hint", F.coalesce(F.try_element_at(kinds, F.col("tag")), F.lit("UNKNOWN")))


def harvest_swift(chunks: DataFrame) -> DataFrame:
    got = swift_fields(chunks.where("layout = 'SWIFT_MESSAGE'")).withColumn("part", F.when(F.col("qualifier") != "", F.col("qualifier")).otherwise(F.col("tag")))
    keys = ["document_id", "part", "label"]
    out = first_samples(got, keys, ["record_index", "pos"], F.count("sample")).join(got.groupBy(*keys).agg(F.max_by("kind_hint", F.struct("record_index", "pos")).alias("kind_hint")), keys)
    return out.select("document_id", F.array(F.lit("SWIFT Message")).alias("group_path"), "label", "sample_values", "pages", F.lit("swift_tag").alias("source_pattern"), "kind_hint", "occurrences")


def narrative_tokens(text: DataFrame) -> DataFrame:
    """(document_id, record_index, pages, pos, label, sample, kind): recognised tokens with the words before them.

    The gaps of a split and the matches put together in turn give each token's prefix.
    """
    lines = text.select("document_id", "record_index", "pages", F.posexplode(F.split("text", r"\r\n|[\n\r]", -1)).alias("line_no", "line")).where(F.col("line").rlike(TOKEN))
    parts = lines.select("document_id", "record_index", "pages", "line_no", F.split("line", TOKEN, -1).alias("gaps"), F.regexp_extract_all("line", F.lit(TOKEN), F.lit(0)).alias("hits"))
    each = parts.select("document_id", "record_index", "pages", "line_no", "gaps", "hits", F.posexplode("hits").alias("i", "hit"))
    before = F.array_join(F.zip_with(F.slice("gaps", F.lit(1), F.col("i") + 1), F.slice("hits", F.lit(1), F.col("i")), lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    each = each.select("document_id", "record_index", "pages", (F.col("line_no") * 100000 + F.col("i")).alias("pos"), F.regexp_replace("hit", r"^[.,;]+|[.,;]+$", "").alias("sample"), before.alias("before"))
    each = each.withColumn("kind", infer_kind_scalar(F.col("sample"))["kind"]).where(~F.col("kind").isin("FREE_TEXT", "UNKNOWN"))
    words = F.filter(F.split(collapse_whitespace(F.col("before")), " ", -1), lambda w: w != "")
    label = F.regexp_replace(F.array_join(F.slice(words, F.greatest(F.size(words) - 3, F.lit(1)), F.lit(4)), " "), r"^[:,. ]+|[:,. ]+$", "")
    return each.withColumn("label", F.when(label != "", label).otherwise(F.replace(F.initcap(F.replace(F.col("kind"), F.lit("_"), F.lit(" "))), F.lit("  "), F.lit(" "))))


def harvest_narrative(chunks: DataFrame) -> DataFrame:
    out = first_samples(narrative_tokens(chunks), ["document_id", "label"], ["record_index", "pos"], F.count("sample"))
    return out.select("document_id", F.array().cast("array<string>").alias("group_path"), "label", "sample_values", "pages", F.lit("narrative_adjacency").alias("source_pattern"), F.lit(None).cast("string").alias("kind_hint"), "occurrences")


def dedup_same_concept(candidates: DataFrame) -> DataFrame:
    """Candidates of one document with one name and one set of values are one field: the most general grouping stays."""
    c = candidates.withColumn("name", slugify(F.col("label"))).withColumn("path", path_of(F.col("group_path"), F.col("label")))
    c = c.withColumn("signature", F.array_sort(F.array_distinct(F.filter(F.transform("sample_values", strip), lambda x: x != ""))))
    some = F.size("signature") > 0
    first = F.struct(F.size("group_path").alias("depth"), "path", "source_pattern")
    cols = candidates.columns
    merged = c.where(some).groupBy("document_id", "name", "signature").agg(
        F.min_by(F.struct(*cols), first).alias("w"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.max("occurrences").alias("occurrences"), F.min_by("kind_hint", F.when(F.col("kind_hint").isNotNull(), first)).alias("kind_hint")
    )
    kept = merged.select(*[F.col(x) if x in ("document_id", "pages", "occurrences", "kind_hint") else F.col(f"w.{x}").alias(x) for x in cols])
    return kept.unionByName(c.where(~some).select(*cols))


def merge_paths(candidates: DataFrame) -> DataFrame:
    """One candidate per path: samples in order of the harvesters, first twelve distinct; occurrences add up."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ("table_header", "key_value", "swift_tag", "narrative_adjacency")]), F.col("source_pattern"))
    c = candidates.withColumn("path", path_of(F.col("group_path"), F.col("label"))).withColumn("__r", F.struct(rank.alias("r"), "label"))
    g = c.groupBy("document_id", "path").agg(
        F.min_by(F.struct("group_path", "label", "source_pattern"), "__r").alias("f"), F.array_sort(F.collect_list(F.struct("__r", "sample_values"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.sum("occurrences").alias("occurrences"), F.min_by("kind_hint", F.when(F.col("kind_hint").isNotNull(), F.col("__r"))).alias("kind_hint"),
    )
    samples = F.slice(F.array_distinct(F.flatten(F.transform("s", lambda x: x.sample_values))), 1, SAMPLES)
    return g.select("document_id", "path", "f.group_path", "f.label", samples.alias("sample_values"), "pages", "f.source_pattern", "kind_hint", "occurrences")


def harvest(chunks: DataFrame) -> DataFrame:
    """All candidates, one per document and path."""
    tabular = chunks.where(F.coalesce(F.size("cells"), F.lit(0)) > 0)
    keyed = chunks.where(F.coalesce(F.size("key_values"), F.lit(0)) > 0)
    bare = chunks.where((F.coalesce(F.size("cells"), F.lit(0)) <= 0) & (F.coalesce(F.size("key_values"), F.lit(0)) <= 0) & (F.col("layout") != "SWIFT_MESSAGE"))
    found = harvest_table(tabular).unionByName(harvest_key_values(keyed)).unionByName(harvest_swift(chunks)).unionByName(harvest_narrative(bare)).unionByName(harvest_narrative(keyed))
    return merge_paths(dedup_same_concept(found))


def describe(candidates: DataFrame) -> DataFrame:
    """Descriptors: the kind a message tag states goes before the kind that the samples show."""
    cells = candidates.select("document_id", "path", "label", F.explode_outer("sample_values").alias("value"))
    kinds = infer_kinds(cells, ["document_id", "path"]).drop("label")
    out = candidates.join(kinds, ["document_id", "path"], "left")
    hinted = F.col("kind_hint").isNotNull() & (F.col("kind_hint") != "UNKNOWN")
    confidence = F.when(hinted, F.greatest(F.lit(0.6), F.col("kind_confidence"))).otherwise(F.col("kind_confidence"))
    return out.withColumn("kind_confidence", confidence).withColumn("kind", F.when(hinted, F.col("kind_hint")).otherwise(F.col("kind"))).withColumn("name", slugify(F.col("label")))


def repeating_unit(descriptors: DataFrame) -> DataFrame:
    """Per document: kinds that anchor an instruction and kinds that it must hold."""
    pick = lambda names: F.filter(F.array(*[F.lit(x) for x in names]), lambda k: F.array_contains("kinds", k))
    k = descriptors.groupBy("document_id").agg(F.collect_set("kind").alias("kinds"))
    return k.select("document_id", pick(("COUNTRY", "CURRENCY")).alias("anchor_kinds"), pick(("BIC", "ACCOUNT_NUMBER", "IBAN")).alias("required_kinds"))


#: Members of a field that its schema's hash covers, in the order of the JSON, and the form's version.
HASHED, HASH_VERSION = ("cardinality", "charset", "enum_values", "exact_length", "kind", "label", "max_length", "min_length", "path"), 2


def descriptor_hash(descriptors: DataFrame) -> DataFrame:
    """SHA-256 of each document's schema: its repeating unit, the form's version and its fields with their hints, sorted by path."""
    field = F.struct("path", F.to_json(F.struct(*HASHED), {"ignoreNullFields": "false"}).alias("j"))
    fields = descriptors.groupBy("document_id").agg(F.array_sort(F.collect_list(field)).alias("f"), F.count("*").alias("n_fields")).join(repeating_unit(descriptors), "document_id")
    head = F.concat(F.lit('{"anchor_kinds":'), F.to_json("anchor_kinds"), F.lit(',"required_kinds":'), F.to_json("required_kinds"), F.lit(f',"version":{HASH_VERSION},"fields":['))
    whole = F.concat(head, F.array_join(F.transform("f", lambda x: x.j), ","), F.lit("]}"))
    return fields.select("document_id", F.sha2(whole.cast("binary"), 256).alias("descriptor_hash"), "n_fields")


def unique_paths(descriptors: DataFrame) -> DataFrame:
    """``descriptors``; a document that states a path more than once fails the task that meets it."""
    n = F.count("*").over(Window.partitionBy("document_id", "path"))
    return descriptors.withColumn("path", F.when(n > 1, F.raise_error(F.concat(F.lit("path stated twice: "), "path")).cast("string")).otherwise(F.col("path")))


def duplicate_paths(descriptors: DataFrame) -> DataFrame:
    """Paths that a document states more than once; must be empty."""
    return descriptors.groupBy("document_id", "path").agg(F.count("*").alias("n")).where("n > 1")


def merge_descriptors(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two schemas by path: the surer kind wins (UNKNOWN never), weaker hints win, several values beat one."""
    both = first.withColumn("__o", F.lit(0)).unionByName(second.withColumn("__o", F.lit(1)), allowMissingColumns=True)
    best = F.struct((F.col("kind") != "UNKNOWN").alias("known"), "kind_confidence", (-F.col("__o")).alias("o"))
    same = lambda c: F.when((F.count_distinct(c) == 1) & (F.count(c) == F.count("*")), F.max(c))
    return both.groupBy("document_id", "path").agg(
        F.min_by("label", "__o").alias("label"), F.max_by("kind", best).alias("kind"), F.max_by("kind_confidence", best).alias("kind_confidence"), F.when(F.bool_or(F.col("cardinality") == "MULTI"), "MULTI").otherwise("SINGLE").alias("cardinality"),
        same("exact_length").alias("exact_length"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), F.when(F.count_distinct("charset") > 1, "any").otherwise(F.max("charset")).alias("charset"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("enum_values")))).alias("enum_values"), F.array_sort(F.collect_set("label")).alias("aliases"),
    )


def apply_proposals(descriptors: DataFrame, proposals: DataFrame) -> DataFrame:
    """Fields that a model proposes (document_id, label, group_path, kind), blank, overlong and repeated ones left out, then harvested fields that it dropped."""
    p = proposals.withColumn("label", collapse_whitespace(F.coalesce("label", F.lit("")))).where((F.col("label") != "") & (F.length("label") <= 80))
    p = p.withColumn("path", path_of(F.col("group_path"), F.col("label"))).withColumn("name", slugify(F.col("label"))).dropDuplicates(["document_id", "path"])
    known = descriptors.withColumn("__n", F.row_number().over(Window.partitionBy("document_id", "name").orderBy(F.col("path").desc()))).where("__n = 1")
    extra = [c for c in descriptors.columns if c not in ("document_id", "path", "name", "label", "group_path", "kind")]
    own = p.select("document_id", "path", "name", "label", "group_path", F.col("kind").alias("__kind")).join(known.select("document_id", "name", F.col("kind").alias("__known"), *extra), ["document_id", "name"], "left")
    sure = (F.coalesce("kind_confidence", F.lit(0.0)) >= 0.8) & F.col("__known").isNotNull()
    own = own.withColumn("kind", F.when(sure, F.col("__known")).otherwise(F.col("__kind")))
    kept = descriptors.join(p.select("document_id", "path"), ["document_id", "path"], "left_anti").join(p.select("document_id", "name"), ["document_id", "name"], "left_anti")
    return own.select(*descriptors.columns).unionByName(kept.select(*descriptors.columns))
