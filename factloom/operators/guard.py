"""Extraction guard: findings about facts that their source does not bear out. Findings are rows, one per problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import fold, strip, substring_present

#: Kinds that identify an instruction, those whose failures show that the reference data has drifted, and when that is so.
DRIFT_KINDS = ("BIC", "IBAN", "ISIN", "LEI")
DRIFT_SHARE, DRIFT_LEAST = 0.5, 6
BLOCKING = ("HALLUCINATED_VALUE", "SCHEMA_REJECTED")
_COLUMNS = ("document_id", "record_index", "path", "issue", "message")


def _row(df: DataFrame, issue: str, message) -> DataFrame:
    return df.select("document_id", "record_index", "path", F.lit(issue).alias("issue"), message.alias("message"), F.lit(issue in BLOCKING).alias("blocks"))


def untraced(facts: DataFrame, chunks: DataFrame) -> DataFrame:
    """Values and evidence that their chunk's text does not hold. Exact matches are decided in the JVM."""
    f = facts.where(F.coalesce(strip(F.col("value")), F.lit("")) != "").join(chunks.select("document_id", "record_index", F.col("text").alias("__text")), ["document_id", "record_index"])
    # Values that fold to nothing can't be looked up: they count as present, and are marked.
    f = f.withColumn("unverifiable", fold(F.col("value")) == "").withColumn("__there", substring_present(F.col("value"), F.col("__text")))
    gone = _row(f.where(~F.col("__there")), "HALLUCINATED_VALUE", F.lit("the value does not occur in the source text"))
    cited = f.where((strip(F.coalesce("evidence", F.lit(""))) != "") & ~F.contains(fold(F.col("__text")), fold(F.col("evidence"))))
    return gone.unionByName(_row(cited, "UNSUPPORTED_EVIDENCE", F.lit("the evidence does not occur in the source text")))


def missing_citation(facts: DataFrame) -> DataFrame:
    some = facts.where((F.coalesce(strip(F.col("value")), F.lit("")) != "") & (F.coalesce(F.size("page"), F.lit(0)) <= 0))
    return _row(some, "MISSING_CITATION", F.lit("no page is cited"))


def identities(facts: DataFrame, kinds: DataFrame) -> DataFrame:
    """(document_id, record_index, identity): sorted upper-case values of the anchor kinds, repeats kept."""
    k = kinds.where(F.col("kind").isin("COUNTRY", "CURRENCY")).select("document_id", "path")
    v = facts.join(k, ["document_id", "path"], "left_semi").where(F.coalesce(strip(F.col("value")), F.lit("")) != "")
    return v.groupBy("document_id", "record_index").agg(F.array_sort(F.collect_list(F.upper(strip(F.col("value"))))).alias("identity"))


def conflicts(facts: DataFrame, kinds: DataFrame) -> DataFrame:
    """Instructions of one identity whose shared fields differ from the first one's: a duplicate or a conflict.

    Each identity's first record is a window minimum; its values are joined to the others' by path, so a group of n records
    makes n comparisons, not n * n.
    """
    ident = identities(facts, kinds).withColumn("first", F.min("record_index").over(Window.partitionBy("document_id", "identity")))
    later = ident.where("record_index > first")
    v = facts.where(F.coalesce(strip(F.col("value")), F.lit("")) != "").select("document_id", "record_index", "path", F.upper(strip(F.col("value"))).alias("v"))
    mine = later.join(v, ["document_id", "record_index"])
    theirs = v.select("document_id", F.col("record_index").alias("first"), "path", F.col("v").alias("w"))
    both = mine.join(theirs, ["document_id", "first", "path"])
    g = both.groupBy("document_id", "record_index", "first").agg(F.count("*").alias("shared"), F.array_sort(F.collect_set(F.when(F.col("v") != F.col("w"), F.col("path")))).alias("different"))
    issue = F.when(F.size("different") > 0, "CONFLICTING_INSTRUCTION").otherwise("DUPLICATE_INSTRUCTION")
    text = F.when(F.size("different") > 0, F.concat(F.lit("differs from record "), F.col("first").cast("string"), F.lit(" in "), F.array_join(F.slice("different", 1, 5), ", "))).otherwise(F.concat(F.lit("repeats record "), F.col("first").cast("string")))
    return g.select("document_id", "record_index", F.lit(None).cast("string").alias("path"), issue.alias("issue"), text.alias("message"), F.lit(False).alias("blocks"))


def drift(validated: DataFrame) -> DataFrame:
    """Per document: whether so many identifiers fail that the reference data, not the document, is in doubt."""
    ids = validated.where(F.col("kind").isin(*DRIFT_KINDS) & (F.coalesce(strip(F.col("value")), F.lit("")) != ""))
    g = ids.groupBy("document_id").agg(F.count("*").alias("identifiers"), F.count_if(F.col("verdict.outcome") == "FAILED").alias("failing"))
    verdict = F.when(F.col("identifiers") < DRIFT_LEAST, "INDETERMINATE").when(F.col("failing") / F.col("identifiers") >= DRIFT_SHARE, "DRIFT").otherwise("OK")
    return g.withColumn("drift", verdict)


def rejected(chunks: DataFrame, facts: DataFrame) -> DataFrame:
    """Records for which no facts came back."""
    none = chunks.select("document_id", "record_index").join(facts.select("document_id", "record_index").distinct(), ["document_id", "record_index"], "left_anti")
    return _row(none.withColumn("path", F.lit(None).cast("string")), "SCHEMA_REJECTED", F.lit("no record was extracted"))


def guard(facts: DataFrame, chunks: DataFrame, kinds: DataFrame) -> DataFrame:
    """All findings."""
    return untraced(facts, chunks).unionByName(missing_citation(facts)).unionByName(conflicts(facts, kinds)).unionByName(rejected(chunks, facts))


def issue_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("document_id", "issue").agg(F.count("*").alias("n"), F.bool_or("blocks").alias("blocks"))


def resolve_pages(facts: DataFrame, page_texts: DataFrame) -> DataFrame:
    """facts with the pages of their chunk whose text holds the value; else those cited that the chunk has; else the chunk's."""
    p = facts.select("document_id", "record_index", "path", "ordinal", "value", "page", F.explode_outer("chunk_pages").alias("p")).join(page_texts.select("document_id", F.col("page").alias("p"), F.col("text").alias("t")), ["document_id", "p"], "left")
    some = F.coalesce(strip(F.col("value")), F.lit("")) != ""
    held = p.where(some & F.col("t").isNotNull() & (fold(F.col("value")) != "")).withColumn("on", F.contains(fold(F.col("t")), fold(F.col("value")))).where("on").groupBy("document_id", "record_index", "path", "ordinal").agg(F.array_sort(F.collect_set("p")).alias("__held"))
    out = facts.join(held, ["document_id", "record_index", "path", "ordinal"], "left")
    cited = F.array_intersect("page", "chunk_pages")
    return out.withColumn("page", F.when(F.col("__held").isNotNull(), F.col("__held")).when(F.size(cited) > 0, F.array_sort(cited)).otherwise(F.array_sort(F.array_distinct("chunk_pages")))).drop("__held")
