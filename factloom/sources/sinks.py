"""Sinks: one JSON document per source document, its sidecar, and the masked form."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.operators.lineage import cut, stored

#: Bytes of a file of packed documents.
TARGET = 128 * 1024 * 1024


def row_analysis(index: Column, total: Column, layout: Column, pages: Column, populated: Column, stitched: Column) -> Column:
    """Parts that do not apply are left out."""
    return F.concat_ws(" | ", F.format_string("instruction %d of %d", index + 1, total), F.concat(F.lit("layout "), layout), F.concat(F.lit("page "), F.array_join(F.transform(pages, lambda p: p.cast("string")), ", ")), F.format_string("%d field(s) populated", populated), F.when(stitched, F.lit("stitched across a page break")))


def document_analysis(composition: DataFrame) -> DataFrame:
    part = lambda n, name: F.when(F.col(n) > 0, F.format_string(f"%d {name} page(s)", n))
    return composition.withColumn("document_analysis", F.concat_ws(" | ", F.format_string("%d page(s)", "page_count"), part("native_text_pages", "native"), part("scanned_pages", "scanned"), part("mixed_pages", "mixed"), part("empty_pages", "empty")))


def nest(paths: list[tuple[str, int, dict]]) -> dict:
    """Dotted paths to nested objects; a value in the way of an object gives way; several values of a path are a list."""
    out: dict = {}
    for path, _, leaf in sorted(paths, key=lambda p: (p[0], p[1])):
        *groups, name = path.split(".")
        node = out
        for g in groups:
            if not isinstance(node.get(g), dict) or "value" in node[g]:
                node[g] = {}
            node = node[g]
        if name in node and isinstance(node[name], list):
            node[name].append(leaf)
        elif name in node and "value" in node[name]:
            node[name] = [node[name], leaf]
        else:
            node[name] = leaf
    return out


def assemble(scored: DataFrame, composition: DataFrame, counts: DataFrame, hashes: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """(document_id, json): facts become records, records documents. Records are rendered one by one, then joined as text.

    scored: facts with blended confidence. records: (document_id, record_index, row_analysis).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for analysis, fields in zip(b["row_analysis"], b["fields"]):
                leaf = [(f["path"], f["ordinal"], {"value": f["value"], "status": f["status"], "confidence": f["confidence"], "evidence": f["evidence"], "page": [int(p) for p in f["page"]]}) for f in fields]
                texts.append(json.dumps({"rowAnalysis": analysis or "", **nest(leaf)}, ensure_ascii=False, indent=2))
            yield pd.DataFrame({"document_id": b["document_id"], "record_index": b["record_index"], "text": texts})

    field = F.struct("path", F.coalesce("ordinal", F.lit(0)).alias("ordinal"), "value", "status", F.col("blended").alias("confidence"), F.coalesce("evidence", F.lit("")).alias("evidence"), F.coalesce("page", F.array().cast("array<int>")).alias("page"))
    rec = scored.groupBy("document_id", "record_index").agg(F.array_sort(F.collect_list(field)).alias("fields"))
    rec = rec.join(records.select("document_id", "record_index", "row_analysis"), ["document_id", "record_index"], "left") if records is not None else rec.withColumn("row_analysis", F.lit(""))
    text = rec.select("document_id", "record_index", "row_analysis", "fields").mapInPandas(run, "document_id string, record_index int, text string")
    body = text.groupBy("document_id").agg(F.count("*").alias("instruction_count"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record_index", "text"))), lambda x: x.text), ",\n").alias("records"))
    d = document_analysis(composition).join(body, "document_id", "left").join(counts, "document_id", "left").join(hashes, "document_id", "left")
    head = F.struct(
        F.col("document_id").alias("documentName"), F.when(F.col("instruction_count").isNull(), "NO_INSTRUCTIONS_FOUND").otherwise("COMPLETED").alias("status"), F.col("document_analysis").alias("documentAnalysis"), F.col("page_count").alias("pageCount"), F.col("native_text_pages").alias("nativeTextPages"),
        F.col("scanned_pages").alias("scannedPages"), F.col("mixed_pages").alias("mixedPages"), F.coalesce("instruction_count", F.lit(0)).alias("instructionCount"),
        F.struct(*[F.coalesce(c, F.lit(0)).alias(n) for c, n in (("fields_validated", "fieldsValidated"), ("fields_failed", "fieldsFailed"), ("fields_not_applicable", "fieldsNotApplicable"), ("fields_queued_for_review", "fieldsQueuedForReview"))], F.col("descriptor_hash").alias("schemaDescriptorHash")).alias("extractionSummary"),
    )
    top = F.to_json(head)
    return d.select("document_id", F.concat(F.substr(top, F.lit(1), F.length(top) - 1), F.lit(',"settlementInstructionRecords":['), F.coalesce("records", F.lit("")), F.lit("]}")).alias("json"))


def sidecar(descriptors: DataFrame) -> DataFrame:
    """(document_id, json): the schema that was discovered."""
    field = F.struct("path", "label", "kind", "kind_confidence", "cardinality", "exact_length", "min_length", "max_length", "charset", "enum_values")
    return descriptors.groupBy("document_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(field)).alias("fields")), {"ignoreNullFields": "false"}).alias("json"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON text per document; the folder of a document is its id, so writers never meet."""
    documents.withColumnRenamed("json", "value").write.mode("overwrite").partitionBy("document_id").text(path)


def write_packed(documents: DataFrame, path: str, target: int = TARGET) -> None:
    """Documents in few files: one JSON text a line, sorted by id, about ``target`` bytes a file, below ``path``/data; below
    ``path``/index a row (document_id, part, start, bytes) for each: part is the number in the file's name.

    Files hold ranges of ids, so a job writes and commits as many files as the data fill, however many documents there are.
    The sorted rows are written once before, so that index and files describe the same ranges.
    """
    line = documents.select("document_id", F.regexp_replace("json", r"[\r\n]+ *", " ").alias("json"))  # line breaks in values are escaped
    line = stored(line)
    size = line.agg(F.coalesce(F.sum(F.octet_length("json") + 1), F.lit(0))).first()[0]
    files = max(1, math.ceil(size / target))
    dealt = line.repartitionByRange(files, "document_id").sortWithinPartitions("document_id", "json")
    dealt = cut(dealt.withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("part").orderBy("document_id", "json").rowsBetween(Window.unboundedPreceding, -1)
    index = dealt.select("document_id", "part", F.coalesce(F.sum(F.octet_length("json") + 1).over(before), F.lit(0)).cast("long").alias("start"), F.octet_length("json").alias("bytes"))
    dealt.select(F.col("json").alias("value")).write.mode("overwrite").text(f"{path}/data")
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_packed(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """(document_id, json) of a few documents, by the index: only files that hold one of them are opened."""
    found = spark.read.parquet(f"{path}/index").where(F.col("document_id").isin(ids))
    parts = sorted(r.part for r in found.select("part").distinct().collect())
    if not parts:
        return found.select("document_id", F.lit(None).cast("string").alias("json"))
    names = "{" + ",".join(f"part-{p:05d}*" for p in parts) + "}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(f"{path}/data")
    number = F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("int")
    text = F.substring(F.col("content"), (F.col("start") + 1).cast("int"), F.col("bytes")).cast("string")
    return files.select(number.alias("part"), "content").join(F.broadcast(found), "part").select("document_id", text.alias("json"))


def catalogue(descriptors: DataFrame) -> DataFrame:
    """(document_id, text): the fields as a model's prompt lists them."""
    line = F.concat(F.lit("- "), F.col("path"), F.lit(" ("), F.col("label"), F.lit("): "), F.col("kind"), F.when(F.col("cardinality") == "MULTI", ", several values").otherwise(""), F.coalesce(F.concat(F.lit(", exactly "), F.col("exact_length").cast("string"), F.lit(" characters")), F.lit("")))
    return descriptors.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", line.alias("line")))), lambda x: x.line), "\n").alias("text"))


def excerpts(chunks: DataFrame, most: int = 3, budget: int = 2600) -> DataFrame:
    """(document_id, text): the first chunks of a document, cut to a budget of characters in all, as a model's prompt shows them."""
    w = Window.partitionBy("document_id").orderBy("record_index")
    rank = F.row_number().over(w)
    # Which records come first is found without their texts, so that only the texts shown are sorted.
    upto = chunks.select("document_id", "record_index").withColumn("n", rank).where(F.col("n") <= most).groupBy(F.col("document_id").alias("of")).agg(F.max("record_index").alias("upto"))
    near = chunks.select("document_id", "record_index", "pages", "text").join(upto, F.col("document_id").eqNullSafe(F.col("of"))).where("record_index is null or record_index <= upto").drop("of", "upto")
    first = near.withColumn("n", rank).where(F.col("n") <= most)
    first = first.withColumn("left", F.lit(budget) - F.coalesce(F.sum(F.length("text")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("left > 0")
    part = F.concat(F.lit("[chunk "), F.col("n").cast("string"), F.lit(", page "), page_label(F.col("pages")), F.lit("]\n"), F.substr("text", F.lit(1), F.col("left").cast("int")))
    return first.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", part.alias("part")))), lambda x: x.part), "\n\n").alias("text"))


def page_label(pages: Column) -> Column:
    """Distinct pages in order, comma-joined."""
    return F.array_join(F.transform(F.array_sort(F.array_distinct(pages)), lambda p: p.cast("string")), ", ")
