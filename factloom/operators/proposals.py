"""Fields that a model proposes, as an input of the run.

A prompt is made of what was harvested and of a bounded excerpt; it is known by its hash. Answers are a table keyed by that
hash, so a run with the same answers gives the same schema, an answer serves every document with the same prompt, and
prompts without an answer are a result that can be put to a model outside the run.

answers: (prompt_hash, fields array<struct<label, group, kind, cardinality>>). An answer is taken whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import collapse_whitespace, slugify, strip
from factloom.operators.harvest import path_of

# The most fields of an answer, what a proposed kind is sure of, what outranks it.
MAX_FIELDS, LEAST_CONFIDENCE, SURE = 80, 0.4, 0.8


def prompts(catalogue: DataFrame, excerpts: DataFrame) -> DataFrame:
    """(document_id, prompt, prompt_hash) of (document_id, text) of both."""
    both = excerpts.withColumnRenamed("text", "excerpt").join(catalogue.withColumnRenamed("text", "fields"), "document_id", "left")
    prompt = F.concat(F.coalesce("fields", F.lit("")), F.lit("\n\n"), F.col("excerpt"))
    return both.select("document_id", prompt.alias("prompt")).withColumn("prompt_hash", F.sha2(F.col("prompt").cast("binary"), 256))


def judged(answers: DataFrame) -> DataFrame:
    """``answers`` with ``reason``, a code of the first rule that an answer breaks; null: none."""
    label = lambda f: strip(F.coalesce(f.label, F.lit("")))
    key = lambda f: F.concat(F.lower(strip(F.coalesce(f.group, F.lit("")))), F.lit("\n"), slugify(label(f), inside=True))
    n = F.coalesce(F.size("fields"), F.lit(0))
    blank = F.exists("fields", lambda f: label(f) == "")
    twice = F.size(F.array_distinct(F.transform("fields", key))) < n
    reason = F.when(n <= 0, "no_fields").when(n > MAX_FIELDS, "too_many_fields").when(blank, "blank_label").when(twice, "field_twice")
    return answers.withColumn("reason", reason)


def proposals(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """(document_id, path, name, label, group_path, kind, cardinality): fields of accepted answers, the first of each path. Of
    several answers to a prompt the first accepted one by its fields counts."""
    taken = judged(answers).where("reason is null").groupBy("prompt_hash").agg(F.min("fields").alias("fields"))
    f = asked.select("document_id", "prompt_hash").join(taken, "prompt_hash").select("document_id", F.posexplode("fields").alias("pos", "f"))
    groups = F.filter(F.transform(F.split(F.coalesce("f.group", F.lit("")), "/", -1), strip), lambda g: g != "")
    f = f.select("document_id", "pos", collapse_whitespace(F.col("f.label")).alias("label"), groups.alias("group_path"), "f.kind", F.upper("f.cardinality").alias("cardinality"))
    f = f.withColumn("path", path_of(F.col("group_path"), F.col("label"))).withColumn("name", slugify(F.col("label")))
    first = F.min(F.struct("pos", "name", "label", "group_path", "kind", "cardinality")).alias("f")
    return f.groupBy("document_id", "path").agg(first).select("document_id", "path", "f.name", "f.label", "f.group_path", "f.kind", "f.cardinality")


def merged(descriptors: DataFrame, proposed: DataFrame, kinds: list[str]) -> DataFrame:
    """Descriptors of what is proposed, with the evidence of a harvested field of the same name, then the harvested fields
    whose path and name no proposal has.

    A kind that samples make sure of (``SURE``) outranks the proposed one, and so does any where the proposed one is not
    among ``kinds``. Documents without proposals keep their descriptors.
    """
    taken = ("document_id", "path", "name", "label", "group_path", "kind", "kind_confidence", "cardinality")
    rest = [c for c in descriptors.columns if c not in taken]
    known = descriptors.groupBy("document_id", "name").agg(F.max(F.struct("path")).alias("__p"))
    known = descriptors.join(known.select("document_id", "name", F.col("__p.path").alias("path")), ["document_id", "name", "path"])
    known = known.select("document_id", "name", F.col("kind").alias("__kind"), F.col("kind_confidence").alias("__sure"), F.col("cardinality").alias("__card"), *rest)
    own = proposed.join(known, ["document_id", "name"], "left")
    sure = (F.col("__sure") >= SURE) & (F.col("__kind") != "UNKNOWN")
    kind = F.when(F.coalesce(sure, F.lit(False)), F.col("__kind")).when(F.col("kind").isin(kinds), F.col("kind")).otherwise(F.coalesce("__kind", F.lit("UNKNOWN")))
    own = own.withColumn("kind", kind).withColumn("kind_confidence", F.greatest(F.coalesce("__sure", F.lit(0.0)), F.lit(LEAST_CONFIDENCE)))
    own = own.withColumn("cardinality", F.when(F.col("cardinality") == "MULTI", "MULTI").otherwise(F.coalesce("__card", F.lit("SINGLE"))))
    kept = descriptors.join(proposed.select("document_id", "path"), ["document_id", "path"], "left_anti").join(proposed.select("document_id", "name"), ["document_id", "name"], "left_anti")
    return own.select(*[F.col(c).cast(descriptors.schema[c].dataType).alias(c) for c in descriptors.columns]).unionByName(kept.select(*descriptors.columns))


def unanswered(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """(prompt_hash, prompt), each once, without an accepted answer."""
    good = judged(answers).where("reason is null").select("prompt_hash").distinct()
    return asked.join(good, "prompt_hash", "left_anti").groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
