"""The deterministic run from words on pages to documents: one plan per document set, no loop over documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import privacy
from factloom.functions.dims import KINDS
from factloom.operators import audit, chunk, grid, guard, harvest, layout, proposals, validate
from factloom.operators.lineage import cut
from factloom.operators.rulings import find as find_rulings
from factloom.sources import files, sinks

KEY = ["document_id", "record_index"]


@dataclass(frozen=True)
class Extraction:
    """All results of a run; each is a DataFrame and is computed only if it is used."""

    chunks: DataFrame
    skipped: DataFrame
    descriptors: DataFrame
    findings: DataFrame
    scored: DataFrame
    completeness: DataFrame
    queue: DataFrame
    drift: DataFrame
    composition: DataFrame
    injections: DataFrame
    prompts: DataFrame | None = None

    def documents(self, masked: bool = False) -> DataFrame:
        """(document_id, json); masked: personal values are replaced by stable tokens."""
        facts = privacy.mask_facts(self.scored, self.descriptors.select("document_id", "path", "kind")) if masked else self.scored
        total = self.chunks.groupBy("document_id").agg(F.count("*").cast("int").alias("total"))
        some = self.scored.groupBy(*KEY).agg(F.count_if(F.col("status") != "NOT_APPLICABLE").cast("int").alias("populated"))
        rows = self.chunks.join(total, "document_id").join(some, KEY, "left")
        rows = rows.select(*KEY, sinks.row_analysis(F.col("record_index"), F.col("total"), F.col("layout"), F.col("pages"), F.coalesce("populated", F.lit(0)), F.col("stitched")).alias("row_analysis"))
        return sinks.assemble(facts, self.composition, validate.status_counts(self.scored), harvest.descriptor_hash(self.descriptors), rows)

    def sidecars(self) -> DataFrame:
        return sinks.sidecar(self.descriptors)

    def audit_log(self, timestamp: Column | None = None, log: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
        """Entries of the run: one per chunk, per extracted field and per queued field, chained per document; values as hashes only."""
        when = (timestamp if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp")
        made = self.chunks.select(*KEY, F.lit("").alias("path"), F.lit(0).alias("step"), when, F.lit("CHUNK_CREATED").alias("event"), F.lit("locate").alias("stage"), F.col("layout").alias("outcome"), F.lit(None).cast("string").alias("value"), F.lit(None).cast("double").alias("confidence"))
        field = lambda df, step, event, stage: df.select(*KEY, "path", F.lit(step).alias("step"), when, F.lit(event).alias("event"), F.lit(stage).alias("stage"), F.col("status").alias("outcome"), "value", F.col("blended").alias("confidence"))
        seen = field(self.scored, 1, "FIELD_VALIDATED", "validate").unionByName(field(self.scored.where("needs_review"), 2, "REVIEW_ENQUEUED", "review"))
        events = made.unionByName(seen).withColumn("field_path", F.col("path"))
        return audit.append(events, ["record_index", "path", "step", "value"], log, ends)


def extract(words: DataFrame, pages: DataFrame | None = None, bics: DataFrame | None = None, accounts: dict[str, list[str]] | None = None, filler: Callable[[DataFrame, DataFrame], DataFrame] = chunk.fill, created_at: Column | None = None, rulings: DataFrame | None = None, segments: DataFrame | None = None, answers: DataFrame | None = None) -> Extraction:
    """Words (document_id, page, pos, text, x0, y0, x1, y1, confidence) to facts.

    pages: (document_id, page, page_class) of all pages; without it each page that has words counts as native. rulings:
    (document_id, page, axis, at) of ruled lines, whose tables go before those that only words show; or segments, lines as
    they are drawn (document_id, page, x0, y0, x1, y1), from which rulings and the tables they make are found. answers: what
    a model proposed, by prompt hash (``operators.proposals``); ``prompts`` of the result are those without one. filler: the
    step that gives a chunk's facts; the default copies cells and pairs to the paths of their descriptors.
    """
    words = words.where(F.coalesce(F.trim("text"), F.lit("")) != "")
    lines = cut(grid.lines_of(grid.cluster_rows(words)))
    texts = cut(page_texts(lines))
    if segments is not None:
        rulings = cut(find_rulings(segments))
    chunks, skipped = chunk.locate(lines, cut(grid.grids(words, rulings)))
    # What addresses a model is marked in what a model would read; cells and pairs keep their values.
    chunks = cut(privacy.sanitize_injection(chunks, "text").drop("injections"))
    descriptors = cut(harvest.describe(cut(harvest.harvest(chunks))))
    asked = None
    if answers is not None:
        asked = cut(proposals.prompts(sinks.catalogue(descriptors), sinks.excerpts(chunks)))
        descriptors = cut(proposals.merged(descriptors, cut(proposals.proposals(asked, answers)), list(KINDS)))
        asked = proposals.unanswered(asked, answers)
    facts = filler(chunks, descriptors).join(chunks.select(*KEY, F.col("pages").alias("chunk_pages")), KEY, "left")
    facts = cut(guard.resolve_pages(facts, texts).drop("chunk_pages"))
    kinds = descriptors.select("document_id", "path", "kind")
    findings = cut(guard.guard(facts, chunks, kinds))
    validated = validate.validate_facts(facts, descriptors, findings)
    scored = cut(validate.score_facts(validated, chunks, bics, accounts))
    required = harvest.repeating_unit(descriptors).select("document_id", "required_kinds")
    if pages is None:
        pages = words.select("document_id", "page").distinct().withColumn("page_class", F.lit("NATIVE"))
    return Extraction(chunks, skipped, descriptors, findings, scored, validate.record_completeness(scored, required, chunks), validate.review_queue(scored, created_at), guard.drift(scored), layout.composition(pages), injections(texts), asked)


def page_texts(lines: DataFrame) -> DataFrame:
    """(document_id, page, text): the lines of each page in order."""
    return lines.groupBy("document_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x.text), "\n").alias("text"))


def injections(texts: DataFrame) -> DataFrame:
    """(document_id, page, pattern, excerpt) of what addresses a model on a page."""
    found = privacy.sanitize_injection(texts, "text").where(F.size("injections") > 0)
    return found.select("document_id", "page", F.explode("injections").alias("i")).select("document_id", "page", "i.pattern", "i.excerpt")


def _run_of(result: Extraction) -> str:
    """A name of what the run found, so that the same run is known again."""
    facts = result.scored.select(F.xxhash64("document_id", "record_index", "path", "value", "status").cast("decimal(38,0)").alias("h"))
    return "%x" % (abs(int(facts.agg(F.coalesce(F.sum("h"), F.lit(0))).first()[0])) % (1 << 64))


def write(result: Extraction, folder: str, masked: bool = False, packed: bool = False) -> str:
    """All outputs below ``folder``; returns the run's name, which is made of what it found.

    Documents, schemas and skipped regions are those of the last run; ``packed`` puts documents and schemas of each run into
    few files with an index, side by side with those of other runs. Review entries and the audit log are appended, a folder
    per run. The log goes on from the tails that earlier runs left, a row per document; a run whose entries are there
    already adds nothing, and one that was cut off before its tails were written is completed from its own entries.
    """
    spark = result.scored.sparkSession
    run = _run_of(result)
    if packed:
        sinks.write_packed(result.documents(), f"{folder}/documents/run={run}")
        sinks.write_packed(result.sidecars(), f"{folder}/schemas/run={run}")
        if masked:
            sinks.write_packed(result.documents(masked=True), f"{folder}/masked/run={run}")
    else:
        sinks.write_documents(result.documents(), f"{folder}/documents")
        sinks.write_documents(result.sidecars(), f"{folder}/schemas")
        if masked:
            sinks.write_documents(result.documents(masked=True), f"{folder}/masked")
    result.queue.write.mode("overwrite").json(f"{folder}/review/run={run}")
    ends = tails_of(spark, folder)
    if not files.exists(spark, f"{folder}/tails/run={run}/_SUCCESS"):
        result.audit_log(ends=ends).write.mode("overwrite").json(f"{folder}/audit/run={run}", ignoreNullFields=False)
        _keep_tails(spark, folder, run)
    result.injections.write.mode("overwrite").json(f"{folder}/injections")
    result.skipped.write.mode("overwrite").json(f"{folder}/skipped")
    return run


_TAILS = "document_id string, sequence long, entry_hash string"


def _runs(spark, path: str) -> list[str]:
    """Names of complete runs below a folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in store.listStatus(where)] if store.exists(where) else []
    return sorted(n.partition("=")[2] for n in found if n.startswith("run=") and files.exists(spark, f"{path}/{n}/_SUCCESS"))


def _keep_tails(spark, folder: str, run: str) -> None:
    audit.tails(audit.read(spark, f"{folder}/audit/run={run}")).write.mode("overwrite").json(f"{folder}/tails/run={run}")


def tails_of(spark, folder: str) -> DataFrame | None:
    """(document_id, sequence, entry_hash): where the log of all runs ends; None: there is none. Entries are read only of runs
    that have no tails yet, since they were cut off in between."""
    have = _runs(spark, f"{folder}/tails")
    for run in sorted(set(_runs(spark, f"{folder}/audit")) - set(have)):
        _keep_tails(spark, folder, run)
        have.append(run)
    if not have:
        return None
    ends = audit.joined(spark.read.schema(_TAILS).json([f"{folder}/tails/run={n}" for n in have]))
    return cut(ends)


def earlier(spark, folder: str, run: str = "") -> DataFrame | None:
    """The audit log of all runs below ``folder`` but one; None: there is none yet."""
    own = [f"{folder}/audit/run={n}" for n in _runs(spark, f"{folder}/audit") if n != run]
    return audit.read(spark, own) if own else None
