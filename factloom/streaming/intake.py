"""Documents that arrive as files: the same plan per micro-batch.

The state of a document never spans batches: a file holds all words of its documents. Outputs go to one folder per batch,
in an overwrite, so a batch that is tried again after a lost driver replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.plans.extract import extract, write

WORDS = "document_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double, confidence double"


def words(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Words as Parquet files arrive in a folder."""
    return spark.readStream.schema(WORDS).option("maxFilesPerTrigger", max_files).parquet(folder)


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf", delay: str = "1 day") -> DataFrame:
    """Files as they arrive, each content once within ``delay`` of its copies."""
    seen = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return seen.withColumn("sha256", F.sha2("content", 256)).withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["sha256"])


def start(stream: DataFrame, out: str, checkpoint: str, masked: bool = False, decode: Callable[[DataFrame], DataFrame] | None = None, once: bool = True, **options) -> StreamingQuery:
    """Extract every batch below ``out/batch=<id>``. decode: rows of the stream to words. once: stop when all files are read."""

    def batch(df: DataFrame, number: int) -> None:
        if not df.isEmpty():
            write(extract(decode(df) if decode else df, **options), f"{out}/batch={number}", masked)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
