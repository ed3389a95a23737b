"""Sources: the input gate over a folder of files, reference data, JSON payloads; decoders are ports.

A port turns the bytes of a file into rows; it runs in ``mapInPandas`` on the executors. None is built in: PDF decoding and
OCR need libraries that this package does not bring.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BYTES, MAX_PAGES, MAGIC = 200 * 1024 * 1024, 1000, "%PDF-"
MAX_PATTERN_LINES = 10_000


class DecodePort(Protocol):
    """Says what is in a file: (status OK | CORRUPT | PASSWORD_REQUIRED, page_count)."""

    def inspect(self, content: bytes) -> tuple[str, int]: ...


class WordPort(Protocol):
    """Rows of words of a file: page, block, line, pos, text, x0, y0, x1, y1, confidence, layer."""

    def words(self, content: bytes) -> list[dict[str, Any]]: ...


class LanguageModelPort(Protocol):
    """The only surface to a model: a JSON answer to a prompt."""

    def complete_json(self, *, system: str, user: str, schema: dict[str, Any], max_tokens: int) -> dict[str, Any]: ...


def scan(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder with their bytes; a filter on length or time reaches the scan."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def document_id(path: Column, digest: Column) -> Column:
    """Readable stem and a part of the content's hash: the same content gets the same id."""
    clean = F.substring(F.regexp_replace(stem(path), r"[^0-9A-Za-z._-]+", "_"), 1, 60)
    return F.concat(F.when(clean == "", "document").otherwise(clean), F.lit("-"), F.substring(digest, 1, 10))


def gate(files: DataFrame, decoder: DecodePort | None = None, max_bytes: int = MAX_BYTES, max_pages: int = MAX_PAGES) -> DataFrame:
    """(path, document_id, outcome, sha256, size, page_count): refused files stay as rows. Cheap checks come before decoding."""
    head = F.substring(F.col("content"), 1, len(MAGIC))
    cheap = F.when(F.col("length") == 0, "EMPTY").when(F.col("length") > max_bytes, "TOO_LARGE").when(head != F.lit(MAGIC).cast("binary"), "NOT_A_PDF").otherwise("ACCEPTED")
    f = files.withColumn("outcome", cheap).withColumn("sha256", F.when(F.col("outcome") == "ACCEPTED", F.sha2("content", 256)))
    pages = F.lit(None).cast("int")
    if decoder is not None:
        def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                got = [decoder.inspect(bytes(c)) for c in b["content"]]
                yield pd.DataFrame({"path": b["path"], "__status": [s for s, _ in got], "__pages": [n for _, n in got]})

        seen = f.where("outcome = 'ACCEPTED'").select("path", "content").mapInPandas(inspect, "path string, __status string, __pages int")
        f = f.join(seen, "path", "left")
        pages = F.col("__pages")
        f = f.withColumn("outcome", F.when(F.col("outcome") != "ACCEPTED", F.col("outcome")).when(F.col("__status") != "OK", F.col("__status")).when(pages == 0, "CORRUPT").when(pages > max_pages, "TOO_MANY_PAGES").otherwise("ACCEPTED"))
    ident = F.when(F.col("outcome") == "ACCEPTED", document_id(F.col("path"), F.col("sha256"))).otherwise(stem(F.col("path")))
    return f.select("path", ident.alias("document_id"), "outcome", "sha256", F.col("length").alias("size"), pages.alias("page_count"))


def words(files: DataFrame, port: WordPort) -> DataFrame:
    """Words of accepted files (document_id, content)."""
    schema = "document_id string, page int, block int, line int, pos int, text string, x0 double, y0 double, x1 double, y1 double, confidence double, layer string"
    names = [c.split(" ")[0] for c in schema.split(", ")][1:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ident, content in zip(b["document_id"], b["content"]):
                yield pd.DataFrame(port.words(bytes(content)), columns=names).assign(document_id=ident)[["document_id", *names]]

    return files.select("document_id", "content").mapInPandas(run, schema)


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files that a former run has not finished: content addresses make it an anti join."""
    return files.join(done.select("document_id").distinct(), "document_id", "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


_MANIFEST = "document_id string, sha256 string, run string"


def finished(spark: SparkSession, folder: str) -> DataFrame:
    """(document_id, sha256, run) of all documents whose outputs below ``folder`` are complete."""
    path = f"{folder}/manifest"
    return spark.read.schema(_MANIFEST).json(path) if exists(spark, path) else spark.createDataFrame([], _MANIFEST)


def commit(accepted: DataFrame, folder: str, run: str) -> None:
    """Marks documents as finished, after their outputs; a file of the manifest appears whole or not at all."""
    accepted.select("document_id", "sha256", F.lit(run).alias("run")).distinct().write.mode("append").json(f"{folder}/manifest")


def bic_directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="bic string, institution string, country string").select(*[F.upper(F.trim(F.regexp_replace(c, "^﻿", ""))).alias(c) for c in ("bic", "institution", "country")])


def depositories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="country string, pset_bic string").select(*[F.upper(F.trim(F.regexp_replace(c, "^﻿", ""))).alias(c) for c in ("country", "pset_bic")])


def account_patterns(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Market to patterns, from a small YAML file of lists; read through Spark, so that any store will do. A file of over
    ``MAX_PATTERN_LINES`` lines is refused: patterns are driver-side configuration."""
    out: dict[str, list[str]] = {}
    market = None
    lines = spark.read.text(path).limit(MAX_PATTERN_LINES + 1).collect()
    if len(lines) > MAX_PATTERN_LINES:
        raise ValueError(f"{path} has more than {MAX_PATTERN_LINES} lines")
    for (line,) in lines:
        text = line.split("#")[0].rstrip() if not line.lstrip().startswith("-") else line.rstrip()
        if text and not text.startswith((" ", "-")) and text.endswith(":"):
            market = text[:-1].strip().upper()
            out[market] = []
        elif market and text.lstrip().startswith("-"):
            out[market].append(text.lstrip()[1:].strip().strip("'\""))
    return out


def leaves(payloads: DataFrame, key: str = "document", text: str = "json") -> DataFrame:
    """(key, path, record_index, value) of every leaf of JSON texts of any shape.

    An object with value, status, confidence and evidence is a leaf, and so is a bare string. The walk is over one text at a
    time and has no bound on depth, so it is a mapped function.
    """
    import json

    def walk(node: Any, path: str, record: int | None) -> Iterator[tuple[str, int | None, str]]:
        if isinstance(node, dict):
            if {"value", "status", "confidence", "evidence"} <= set(node):
                yield path, record, str(node["value"] or "")
                return
            for k, v in node.items():
                yield from walk(v, f"{path}.{k}" if path else str(k), record)
        elif isinstance(node, list):
            for i, v in enumerate(node):
                yield from walk(v, f"{path}[{i}]", i if record is None else record)
        elif isinstance(node, str):
            yield path, record, node

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *leaf) for k, t in zip(b["k"], b["t"]) if t for leaf in walk(json.loads(t.lstrip("﻿")), "", None)]
            yield pd.DataFrame(rows, columns=[key, "path", "record_index", "value"]).astype({"record_index": "Int32"})

    return payloads.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} string, path string, record_index int, value string")
