"""Command line: ``spark-submit factloom/cli.py`` or ``python -m factloom.cli``. Exit 0: done; 1: nothing usable; 2: usage."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from factloom.operators.lineage import cut
from factloom.plans import extract
from factloom.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="factloom", description="Turn documents into validated facts.")
    p.add_argument("paths", nargs="*", help="files; the folder is not read if any is given")
    p.add_argument("--input-dir", help="folder of files")
    p.add_argument("--words", help="Parquet of words, in place of files")
    p.add_argument("--port", help="module:attribute of the decoder that turns a file into words")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--bics", help="CSV bic,institution,country")
    p.add_argument("--accounts", help="YAML of market: patterns")
    p.add_argument("--masked-export", action="store_true")
    p.add_argument("--packed", action="store_true", help="documents in few files with an index; documents that a former run finished are left out")
    p.add_argument("--no-llm", action="store_true", help="deterministic parts only; this is so without a model port, too")
    p.add_argument("--no-ocr", action="store_true", help="leave out words whose source is OCR")
    p.add_argument("--log-level", default="ERROR", choices=("DEBUG", "INFO", "WARN", "ERROR"))
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.words and not (args.port and (args.paths or args.input_dir)):
        print("state --words, or --port with files or --input-dir", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("factloom").getOrCreate()
    spark.sparkContext.setLogLevel(args.log_level)
    accepted = None
    if args.words:
        words = spark.read.parquet(args.words)
    else:
        module, _, name = args.port.partition(":")
        port = getattr(importlib.import_module(module), name)
        read = spark.read.format("binaryFile").load(args.paths) if args.paths else files.scan(spark, args.input_dir)
        accepted = files.gate(read, port if hasattr(port, "inspect") else None)
        accepted.select("path", "document_id", "outcome", "sha256", "size", "page_count").write.mode("overwrite").json(f"{args.output_dir}/gate")
        accepted = cut(accepted.where("outcome = 'ACCEPTED'"))
        if args.packed:  # outputs of a run stay beside those of others, so what is finished needs no work
            accepted = files.pending(accepted, files.finished(spark, args.output_dir))
            if accepted.isEmpty():
                print("nothing new", file=sys.stderr)
                return 0
        words = files.words(read.join(accepted.select("path", "document_id"), "path"), port)
    if args.no_ocr and "source" in words.columns:
        words = words.where(F.coalesce(F.upper("source"), F.lit("")) != "OCR")
    result = extract.extract(words.withColumn("confidence", F.coalesce("confidence", F.lit(1.0))), bics=files.bic_directory(spark, args.bics) if args.bics else None, accounts=files.account_patterns(spark, args.accounts) if args.accounts else None)
    if result.chunks.isEmpty():
        print("no instructions found", file=sys.stderr)
        return 1
    run = extract.write(result, args.output_dir, args.masked_export, args.packed)
    if args.packed and accepted is not None:
        files.commit(accepted, args.output_dir, run)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
