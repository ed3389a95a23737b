"""Hash-chained audit log: append, resume, verify.

An entry's hash covers its canonical JSON, the hash of the entry before it included. Documents are chained side by side;
within one, a running hash passes over its new entries in order. Verification needs no fold: each entry's hash is recomputed
on its own, and links and gaps are one ``lag``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.text import hash_value, value_shape

GENESIS = "0" * 64
#: Columns that the hash covers, in the order of the canonical JSON; prev_hash stands among them by name.
FIELDS = ("confidence", "detail", "document_id", "event", "field_path", "model_id", "outcome", "page", "prev_hash", "prompt_version", "schema_descriptor_hash", "sequence", "stage", "timestamp", "value_hash", "value_shape")
# Decision points.
EVENTS = (
    "DOCUMENT_ACCEPTED", "DOCUMENT_REJECTED", "REGION_CLASSIFIED", "OCR_COMPLETED", "OCR_RETRIED", "VISION_FALLBACK_INVOKED", "SCHEMA_DESCRIPTOR_BUILT", "CHUNK_CREATED", "FIELD_EXTRACTED",
    "EXTRACTION_GUARD_VERDICT", "FIELD_VALIDATED", "FIELD_ADJUDICATED", "REVIEW_ENQUEUED", "DOCUMENT_COMPLETED",
)


def canonical(columns: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys; nulls are written."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def prepared(events: DataFrame) -> DataFrame:
    """Events with all columns of the log; a value is kept as its hash and its shape only."""
    have = set(events.columns)
    text = F.col("value") if "value" in have else F.lit(None).cast("string")
    some = F.coalesce(text, F.lit("")) != ""
    defaults = {"confidence": "double", "detail": "map<string,string>", "field_path": "string", "model_id": "string", "outcome": "string", "page": "array<int>", "prompt_version": "string", "schema_descriptor_hash": "string", "stage": "string", "timestamp": "string", "event": "string"}
    out = events
    for name, kind in defaults.items():
        out = out.withColumn(name, F.col(name).cast(kind) if name in have else F.lit(None).cast(kind))
    return out.withColumn("value_hash", F.when(some, hash_value(text))).withColumn("value_shape", F.when(some, value_shape(text))).withColumn("page", F.coalesce("page", F.array().cast("array<int>"))).withColumn("detail", F.coalesce("detail", F.create_map().cast("map<string,string>")))


def tails(log: DataFrame) -> DataFrame:
    """(document_id, sequence, entry_hash) of each document's last entry: where a resumed run goes on."""
    return log.groupBy("document_id").agg(F.max("sequence").alias("sequence"), F.max_by("entry_hash", "sequence").alias("entry_hash"))


def append(events: DataFrame, order: list[str], log: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """New log entries for ``events`` of (document_id, event, ...), ordered by ``order`` within a document.

    They go on from where ``log`` ends, or from ``ends``, its tails, where these are kept.

    Each entry's own part is rendered to JSON first. A document's entries stand in order in one partition and a running
    hash passes over them: linear in entries, in constant memory, whatever the document's size.
    """
    e = prepared(events).withColumn("__rank", F.row_number().over(Window.partitionBy("document_id").orderBy(*order)))
    ends = tails(log) if ends is None and log is not None else ends
    last = ends.select("document_id", F.col("sequence").alias("__seq"), F.col("entry_hash").alias("__tail")) if ends is not None else None
    e = e.join(last, "document_id", "left") if last is not None else e.withColumn("__seq", F.lit(None).cast("long")).withColumn("__tail", F.lit(None).cast("string"))
    e = e.withColumn("sequence", F.coalesce(F.col("__seq").cast("long"), F.lit(-1).cast("long")) + F.col("__rank"))
    own = [c for c in FIELDS if c != "prev_hash"]
    # JSON with a place for the previous hash: keys are sorted, so the place is fixed.
    head = canonical({c: F.col(c) for c in own if c < "prev_hash"})
    tail = canonical({c: F.col(c) for c in own if c > "prev_hash"})
    e = e.withColumn("__a", F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"prev_hash":"'))).withColumn("__b", F.concat(F.lit('",'), F.substr(tail, F.lit(2))))
    e = e.select("document_id", "sequence", *[c for c in own if c not in ("sequence", "document_id")], "__tail", "__a", "__b")
    kept = e.columns[:-3]
    schema = T.StructType([*(e.schema[c] for c in kept), T.StructField("prev_hash", T.StringType()), T.StructField("entry_hash", T.StringType())])
    return e.repartition("document_id").sortWithinPartitions("document_id", "sequence").mapInArrow(_chained, schema)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of whole documents in order, with the hash before each and its own: one running hash, nothing gathered."""
    document, last = object(), GENESIS
    for batch in batches:
        before, own = [], []
        ids, tails_, heads, ends = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("document_id", "__tail", "__a", "__b"))
        for name, tail, a, b in zip(ids, tails_, heads, ends):
            if name != document:
                document, last = name, tail or GENESIS
            before.append(last)
            last = hashlib.sha256(f"{a}{last}{b}".encode()).hexdigest()
            own.append(last)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(before, pa.string()), pa.array(own, pa.string())], names=[*batch.schema.names[:-3], "prev_hash", "entry_hash"])


def joined(ends: DataFrame) -> DataFrame:
    """The last of several tails of a document, as tails."""
    last = ends.groupBy("document_id").agg(F.max(F.struct("sequence", "entry_hash")).alias("t"))
    return last.select("document_id", "t.sequence", "t.entry_hash")


def verify(log: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """Per document: intact, the first failing sequence and why; ``gap`` is where a sequence number is missing.

    since: tails up to which a log was found intact; only what comes after them is looked at. Entries before a tail are left
    out; a document without new entries has no row.
    """
    if since is not None:
        log = log.join(since.select("document_id", F.col("sequence").alias("__at"), F.col("entry_hash").alias("__hash")), "document_id", "left").where(F.col("sequence") > F.coalesce("__at", F.lit(-1)))
    else:
        log = log.withColumn("__at", F.lit(None).cast("long")).withColumn("__hash", F.lit(None).cast("string"))
    digest = F.sha2(canonical({c: F.col(c) for c in FIELDS}).cast("binary"), 256)
    w = Window.partitionBy("document_id").orderBy("sequence")
    checked = log.select("document_id", "sequence", "prev_hash", (digest != F.col("entry_hash")).alias("modified"), F.coalesce(F.lag("entry_hash").over(w), "__hash", F.lit(GENESIS)).alias("expected"), F.coalesce(F.lag("sequence").over(w) + 1, F.col("__at") + 1, F.lit(0)).alias("due"))
    fault = F.when(F.col("modified"), "hash_differs").when(F.col("prev_hash") != F.col("expected"), "link_differs")
    first = F.min(F.when(fault.isNotNull(), F.struct("sequence", fault.alias("why"))))
    return checked.groupBy("document_id").agg(F.count("*").alias("entries"), first.alias("f"), F.min(F.when(F.col("sequence") != F.col("due"), F.col("due"))).alias("gap")).select("document_id", "entries", F.col("f").isNull().alias("intact"), F.col("f.sequence").alias("failed_sequence"), F.col("f.why").alias("reason"), "gap")


def read(spark, path: str | list[str]) -> DataFrame:
    """A log as JSON lines, schema fixed."""
    schema = "document_id string, sequence long, timestamp string, event string, stage string, outcome string, field_path string, page array<int>, value_hash string, value_shape string, confidence double, model_id string, prompt_version string, schema_descriptor_hash string, detail map<string,string>, prev_hash string, entry_hash string"
    return spark.read.schema(schema).json(path)


def write(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").json(path, ignoreNullFields=False)
