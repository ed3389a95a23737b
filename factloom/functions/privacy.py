"""Redaction of texts, masking of values, and the scan for embedded instructions. JVM expressions, but for
values masked in their own form, which are one pass over a value's characters in an Arrow UDF.

A pattern's matches are replaced by what is computed from each match: ``split`` gives the gaps, ``regexp_extract_all``
the matches, and both are put together again.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from factloom.functions.text import SALT_LOG, hash_value, let

# Patterns in the order in which they are applied.
PATTERNS = (
    ("IBAN", r"(?U)\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b"),
    ("EMAIL", r"(?U)\b[\w.+-]+@[\w-]+\.[\w.-]{2,}\b"),
    ("BIC", r"(?U)\b[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}(?:[A-Z0-9]{3})?\b"),
    ("LEI", r"(?U)\b[A-Z0-9]{18}\d{2}\b"),
    ("PHONE", r"(?U)(?<![\w.])\+\d[\d\s().-]{7,}\d(?![\w.])"),
    ("ACCOUNT", r"(?U)(?<![\w.])\d[\d\s-]{5,}\d(?![\w.])"),
)
# Texts that address a model instead of stating a fact.
INJECTIONS = (
    ("instruction_override", r"(?iU)\b(?:ignore|disregard|forget)\b[^.\n]{0,40}\b(?:previous|above|prior|all)\b[^.\n]{0,40}\b(?:instruction|prompt|rule)s?\b"),
    ("role_assertion", r"(?iU)\b(?:you are now|act as|from now on you)\b"),
    ("system_prompt_probe", r"(?iU)\b(?:system prompt|developer message|your instructions)\b"),
    ("output_hijack", r"(?iU)\b(?:respond only with|output exactly|return the following json)\b"),
    ("exfiltration", r"(?iU)\b(?:api[_ -]?key|secret|password)\b[^.\n]{0,20}\b(?:send|post|email|upload)\b"),
)
MARKER = "[text to a model left out]"
SALT_MASK = "factloom-mask-1"
# Kinds whose masked values keep their form, and kinds that become labelled tokens.
FORMAT_KINDS = ("BIC", "IBAN", "ACCOUNT_NUMBER", "SORT_CODE", "PARTICIPANT_ID", "LEI", "PHONE")
TOKEN_KINDS = ("PERSON_NAME", "ORG_NAME", "ADDRESS", "EMAIL")


def _redacted(c: Column, secrets: list[str] | None, length: int, salt: str) -> Column:
    """Registered secrets, then one pattern after the other, as tokens. A text is kept in pieces (text, token), so that no
    pattern reads a token: a hash of digits alone would pass for an account."""
    named = [("SECRET", r"\Q" + x.replace(r"\E", r"\E\\E\Q") + r"\E") for x in sorted({x for x in secrets or () if len(x) >= 8}, key=lambda x: (-len(x), x))]
    piece = lambda text, token: F.struct(text.alias("text"), F.lit(token).alias("token"))
    out = F.array(piece(c, False))

    def cutter(k, x):
        def cut(p):
            gaps, hits = F.split(p.text, x, -1), F.regexp_extract_all(p.text, F.lit(x), F.lit(0))
            token = lambda h: F.concat(F.lit(f"<{k}:"), hash_value(h, salt, length), F.lit(">"))
            both = F.zip_with(gaps, hits, lambda g, h: F.when(h.isNull(), F.array(piece(g, False))).otherwise(F.array(piece(g, False), piece(token(h), True))))
            return F.when(~p.token & p.text.rlike(x), F.flatten(both)).otherwise(F.array(p))

        return cut

    for kind, pattern in (*named, *PATTERNS):
        out = F.flatten(F.transform(out, cutter(kind, pattern)))
    return F.when(c.isNotNull(), F.array_join(F.transform(out, lambda p: p.text), ""))


def redact(df: DataFrame, column: str, secrets: list[str] | None = None, length: int = 12, salt: str = SALT_LOG) -> DataFrame:
    """``column`` with registered secrets (of eight characters or more, longest first) and shapes of personal data as tokens."""
    return df.withColumn(column, _redacted(F.col(column), secrets, length, salt))


def redact_all(df: DataFrame, secrets: list[str] | None = None) -> DataFrame:
    """Every string, in arrays, maps and structs, too."""

    def deep(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return _redacted(c, secrets, 12, SALT_LOG)
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: deep(x, kind.elementType))
        if isinstance(kind, T.MapType):
            return F.transform_values(c, lambda k, v: deep(v, kind.valueType))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[deep(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
        return c

    return df.select(*[deep(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def sanitize_injection(df: DataFrame, column: str) -> DataFrame:
    """``column`` with suspect spans marked, and ``injections``: array of (pattern, excerpt of 120 characters)."""
    out = df.withColumn("injections", F.array().cast("array<struct<pattern:string,excerpt:string>>"))
    named = lambda name: lambda h: F.struct(F.lit(name).alias("pattern"), F.substr(h, F.lit(1), F.lit(120)).alias("excerpt"))
    for name, pattern in INJECTIONS:
        hits = F.transform(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0)), named(name))
        out = out.withColumn("injections", F.when(F.col(column).rlike(pattern), F.concat("injections", hits)).otherwise(F.col("injections"))).withColumn(column, F.regexp_replace(column, pattern, MARKER))
    return out


def tokenised(kind: Column, value: Column, salt: str = SALT_MASK) -> Column:
    return F.concat(F.lit("<"), kind, F.lit("_"), F.substring(F.sha2(F.concat(F.lit(salt), value).cast("binary"), 256), 1, 10), F.lit(">"))


@functools.cache
def _class(x: str) -> str:
    """d for a decimal digit, u for an upper-case letter, l for another letter, else nothing."""
    c = unicodedata.category(x)
    return "d" if c == "Nd" else "u" if c == "Lu" else "l" if c[0] == "L" else ""


def _form_kept(v: str, salt: str) -> str:
    classes = [_class(x) for x in v]
    drawn = [str(int(h, 16) % 10) for h in hashlib.sha256((salt + v).encode()).hexdigest()]
    letters = [chr(65 + b % 26) for b in hashlib.sha256((salt + "alpha" + v).encode()).digest()]
    nd = classes.count("d")
    digit, letter = itertools.cycle(drawn[: max(nd, 1)]), itertools.cycle(letters[: max(len(v) - nd - classes.count(""), 1)])
    return "".join(next(digit) if c == "d" else next(letter) if c == "u" else next(letter).lower() if c else x for x, c in zip(v, classes))


def format_preserving(value: Column, salt: str = SALT_MASK) -> Column:
    """Digits become digits and letters letters of the same case, drawn in turn from hashes of the value: one pass over it."""

    @pandas_udf(T.StringType())
    def mask(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else _form_kept(v, salt))

    return mask(value.cast("string"))


def mask_value(kind: Column, value: Column, is_pii: Column, ner=None) -> Column:
    """Values of kinds without personal data stay; ner: an optional function for free text, else a token."""
    free = ner(value) if ner is not None else tokenised(kind, value)
    return F.when(~is_pii | (F.coalesce(value, F.lit("")) == ""), value).when(kind.isin(*FORMAT_KINDS), format_preserving(F.when(is_pii & kind.isin(*FORMAT_KINDS), value))).when(kind.isin(*TOKEN_KINDS), tokenised(kind, value)).otherwise(free)


def mask_facts(facts: DataFrame, kinds: DataFrame) -> DataFrame:
    """facts (document_id, path, value, evidence, ...) with values masked by the kind of their path; unknown paths count as UNKNOWN.

    The same value gets the same token everywhere, with no table of tokens; ``collisions`` finds two values with one token.
    """
    from factloom.functions.dims import PII_KINDS

    k = kinds.select("document_id", "path", F.col("kind").alias("__kind"))
    out = facts.join(k, ["document_id", "path"], "left").withColumn("__kind", F.coalesce("__kind", F.lit("UNKNOWN")))
    out = out.withColumn("__masked", mask_value(F.col("__kind"), F.col("value"), F.col("__kind").isin(*PII_KINDS)))
    if "evidence" in facts.columns:
        out = out.withColumn("evidence", F.when(F.coalesce(F.col("value"), F.lit("")) == "", F.col("evidence")).otherwise(F.replace(F.col("evidence"), F.col("value"), F.col("__masked"))))
    return out.withColumn("masked", ~F.col("value").eqNullSafe(F.col("__masked"))).withColumn("value", F.col("__masked")).withColumnRenamed("__kind", "masked_kind").drop("__masked")


def masking_stats(masked: DataFrame) -> DataFrame:
    """Per document: how many fields were masked, and of which kinds."""
    return masked.groupBy("document_id").agg(F.count_if("masked").alias("masked_field_count"), F.array_sort(F.collect_set(F.when(F.col("masked"), F.col("masked_kind")))).alias("masked_kinds"))


def collisions(values: DataFrame, token: str = "token", value: str = "value") -> DataFrame:
    """Tokens that stand for more than one value."""
    return values.select(token, value).distinct().groupBy(token).agg(F.count("*").alias("n_values")).where("n_values > 1")
