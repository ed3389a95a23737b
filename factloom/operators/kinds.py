"""Kind inference: what a field holds, from the shapes of its values.

A field's values are cut into segments; for each detector the share of segments that pass is one sum in a single
grouped aggregation, whatever the number of detectors, and an ordered CASE picks the first kind whose share is enough.
So a field with a billion values costs one partial aggregation per task and one row in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import checks
from factloom.functions.text import SPACE, charset_profile, let, strip

ACCEPT = 0.6

# Tokens of organisations, and label words with the kinds that they hint at, in order.
ORG_TOKENS = ("ag", "bank", "banca", "banco", "banque", "bv", "co", "company", "corp", "custody", "depository", "gmbh", "group", "holdings", "inc", "limited", "llc", "ltd", "nv", "plc", "sa", "sarl", "securities", "services", "spa", "trust", "trustee")
LABEL_HINTS = (
    ("ORG_NAME", ("bank", "custodian", "agent", "institution", "counterparty")),
    ("PERSON_NAME", ("contact", "signatory", "officer")),
    ("ADDRESS", ("address", "street", "city", "postcode", "zip", "domicile")),
    ("ACCOUNT_NUMBER", ("account", "acct", "ac", "cuenta", "konto", "compte")),
    ("PARTICIPANT_ID", ("participant", "member", "clearing", "psafe", "pset")),
    ("PHONE", ("phone", "tel", "telephone", "fax")),
    ("EMAIL", ("email", "mail")),
)

#: Detectors from the most to the least special.
DETECTORS = (
    ("COUNTRY", "country_name", checks.check_country_name),
    ("IBAN", "iban", checks.check_iban),
    ("ISIN", "isin", checks.check_isin),
    ("LEI", "lei", checks.check_lei),
    ("BIC", "bic", checks.check_bic),
    ("CFI", "cfi", checks.check_cfi),
    ("SORT_CODE", "sort_code", checks.check_sort_code),
    ("PERCENTAGE", "percentage", checks.check_percentage),
    ("CURRENCY", "currency", checks.check_currency),
    ("COUNTRY", "country", checks.check_country),
    ("DATE", "date", checks.check_date),
)
# Patterns of shapes without a checksum.
EMAIL = r"(?U)^[\w.+-]+@[\w-]+\.[\w.-]{2,}$"
PHONE = r"(?U)^\+?[\d\s().-]{7,}\d$"
ACCOUNT = r"(?U)^[A-Z]{0,4}\d[\d\s./-]{2,}[\dA-Z]$"
DIGIT_RUN = r"(?U)^\d[\d\s.-]{3,}\d$"
PARTICIPANT = r"^[A-Z0-9]{2,6}[-/]?[A-Z0-9]{0,6}$"


def segments(value: Column) -> Column:
    """The parts of a cell that are judged one by one."""
    v = strip(F.coalesce(value, F.lit("")))
    parts = F.filter(F.transform(F.split(v, rf"[\n;]|{SPACE}{{2,}}", -1), strip), lambda x: x != "")
    return F.when(v == "", F.array().cast("array<string>")).otherwise(F.when(F.size(parts) > 0, parts).otherwise(F.array(v)))


def multi_valued(value: Column) -> Column:
    """A cell that holds several values."""
    v = strip(F.coalesce(value, F.lit("")))
    parts = F.filter(F.transform(F.split(v, rf"{SPACE}{{2,}}[/;,]{SPACE}*|{SPACE}*;{SPACE}*", -1), strip), lambda x: F.length(x) >= 4)
    return F.contains(v, F.lit("\n")) | (F.size(parts) > 1)


def label_hint(label: Column) -> Column:
    words = F.split(F.lower(F.coalesce(label, F.lit(""))), "[^a-z]+", -1)
    out = None
    for kind, keys in LABEL_HINTS:
        hit = F.arrays_overlap(words, F.array(*[F.lit(k) for k in keys]))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def looks_like_org(value: Column) -> Column:
    words = F.transform(F.split(value, rf"{SPACE}+", -1), lambda w: F.lower(F.regexp_replace(w, r"^[.,]+|[.,]+$", "")))
    return F.arrays_overlap(words, F.array(*[F.lit(t) for t in ORG_TOKENS]))


def evidence(matched: Column, total: Column) -> Column:
    """Share of matches, scaled by how many values there are."""
    return F.round(F.least(F.lit(1.0), matched / total * F.least(F.lit(1.0), F.lit(0.55) + F.lit(0.15) * total)), 4)


def _flags(v: Column) -> dict[str, Column]:
    out = {name: check(v)["ok"] for _, name, check in DETECTORS}
    out |= {
        "email": v.rlike(EMAIL), "phone": v.rlike(PHONE), "plus": v.startswith("+"), "digits": v.rlike(DIGIT_RUN) | v.rlike(ACCOUNT), "org": looks_like_org(v),
        "short_id": v.rlike(PARTICIPANT) & F.length(v).between(2, 12), "any_digit": v.rlike(r"\p{Nd}"),
    }
    return out


def _decide(m: dict[str, Column], n: Column, distinct: Column, hint: Column) -> tuple[Column, Column]:
    """(kind, confidence) from the counts of matches."""
    share = lambda k: (m[k] > 0) & (m[k] / n >= ACCEPT)
    none = (n == 0) | n.isNull()
    rules: list[tuple[Column, Column, Column]] = [(none, F.coalesce(hint, F.lit("UNKNOWN")), F.when(hint.isNotNull(), 0.2).otherwise(0.0))]
    rules += [(share(name), F.lit(kind), evidence(m[name], n)) for kind, name, _ in DETECTORS]
    rules.append((share("email"), F.lit("EMAIL"), evidence(m["email"], n)))
    rules.append((share("phone") & ((m["plus"] == n) | F.coalesce(hint == "PHONE", F.lit(False))), F.lit("PHONE"), evidence(m["phone"], n)))
    rules.append((share("digits"), F.when(hint.isin("PARTICIPANT_ID", "ACCOUNT_NUMBER"), hint).otherwise("ACCOUNT_NUMBER"), evidence(m["digits"], n)))
    rules.append(((n >= 3) & (distinct <= F.greatest(F.lit(2), F.floor(n / 3))), F.lit("ENUM"), evidence(n, n) * 0.8))
    rules.append((share("org"), F.lit("ORG_NAME"), evidence(m["org"], n) * 0.9))
    rules.append((share("short_id") & F.coalesce(hint == "PARTICIPANT_ID", F.lit(False)), F.lit("PARTICIPANT_ID"), evidence(m["short_id"], n) * 0.8))
    numberless = hint.isin("ACCOUNT_NUMBER", "SORT_CODE", "PARTICIPANT_ID") & (m["any_digit"] == 0)
    weak = F.when(numberless, F.when(m["org"] > 0, "ORG_NAME")).otherwise(hint)
    kind = reduce(lambda a, r: a.when(r[0], r[1]), rules[1:], F.when(rules[0][0], rules[0][1])).otherwise(F.coalesce(weak, F.lit("FREE_TEXT")))
    sure = reduce(lambda a, r: a.when(r[0], r[2]), rules[1:], F.when(rules[0][0], rules[0][2])).otherwise(F.when(weak.isNotNull(), 0.35).otherwise(0.25))
    return kind, sure


def infer_kinds(cells: DataFrame, keys: list[str], value: str = "value", label: str | None = "label") -> DataFrame:
    """One row per field: kind, kind_confidence, cardinality, checked_values and the hints its values give.

    cells: one row per cell with ``keys`` (which name a field), ``value`` and ``label``. Hints hold at most the distinct
    values of an enumeration: they are gathered only while a field has few of them.
    """
    given = [F.col(k) for k in keys]
    name = F.col(label) if label else F.lit(None).cast("string")
    base = cells.select(*given, name.alias("__label"), strip(F.coalesce(F.col(value), F.lit(""))).alias("__v"))
    # One row per distinct cell, counted: repeated values are checked once. This aggregate combines before the shuffle.
    base = base.groupBy(*keys, "__label", "__v").agg(F.count("*").alias("__times"))
    parts = base.select(*given, "__label", "__times", multi_valued(F.col("__v")).alias("__multi"), F.explode_outer(segments(F.col("__v"))).alias("s"))
    marks = {k: F.coalesce(c, F.lit(False)) for k, c in _flags(F.col("s")).items()}
    flagged = parts.select(*given, "__label", "__multi", "s", "__times", *[c.alias(f"f_{k}") for k, c in marks.items()], charset_profile(F.col("s")).alias("__charset"))
    some = F.col("s").isNotNull()
    # Distinct values up to one more than an enumeration may have, through a grouped count, not a set of all values.
    counts = flagged.groupBy(*keys, "__label", "s").agg(
        F.sum(F.when(some, F.col("__times")).otherwise(0)).alias("t"), F.max("__multi").alias("multi"), F.first("__charset").alias("charset"), *[F.max(f"f_{k}").alias(k) for k in marks]
    )
    n = F.sum("t")
    agg = counts.groupBy(*keys).agg(
        F.max("__label").alias("label"), n.cast("long").alias("n"), F.count("s").alias("distinct_values"), F.max("multi").alias("multi"),
        *[F.sum(F.when(F.col(k), F.col("t")).otherwise(0)).alias(f"m_{k}") for k in marks],
        F.min(F.length("s")).alias("min_length"), F.max(F.length("s")).alias("max_length"),
        F.min(F.when(some, F.col("charset"))).alias("charset_min"), F.max(F.when(some, F.col("charset"))).alias("charset_max"),
    )
    hint = label_hint(F.col("label"))

    def choose(m):
        kind, sure = _decide({k: m[k] for k in marks}, m.n, m.distinct_values, m.hint)
        return F.struct(kind.alias("kind"), F.round(sure, 4).alias("sure"))

    found = let(F.struct(*[F.col(f"m_{k}").alias(k) for k in marks], "n", "distinct_values", hint.alias("hint")), choose)
    out = agg.withColumn("__k", found).withColumn("kind", F.col("__k.kind")).withColumn("kind_confidence", F.col("__k.sure"))
    enum = (F.col("kind") == "ENUM") | (F.col("kind").isin("FREE_TEXT", "UNKNOWN") & (F.col("distinct_values") <= 5) & (F.col("n") >= 3))
    out = out.withColumn("is_enum", enum & (F.col("n") > 0))
    # An enumeration has at most a third of its field's segments as values; only such fields gather theirs.
    values = counts.where(some).join(out.where("is_enum").select(*keys), keys, "left_semi").groupBy(*keys).agg(F.array_sort(F.collect_set("s")).alias("enum_values"))
    out = out.join(values, keys, "left")
    return out.select(
        *keys, "label", "kind", "kind_confidence", F.when(F.col("multi"), "MULTI").otherwise("SINGLE").alias("cardinality"), F.coalesce("n", F.lit(0)).cast("long").alias("checked_values"), F.col("distinct_values").cast("long").alias("distinct_values"),
        F.when(F.col("min_length") == F.col("max_length"), F.col("min_length")).alias("exact_length"), "min_length", "max_length",
        F.when(F.col("charset_min") == F.col("charset_max"), F.col("charset_min")).when(F.col("n") > 0, "any").alias("charset"), F.coalesce("enum_values", F.array().cast("array<string>")).alias("enum_values"),
    )


def infer_kind_scalar(value: Column, label: Column | None = None) -> Column:
    """struct(kind, confidence) of a single value without line breaks or separators: n = 1."""
    none = F.lit(None).cast("string")

    def decide(v):
        marks = {k: F.coalesce(c, F.lit(False)).cast("int").alias(k) for k, c in _flags(v).items()}
        hint = (label_hint(label) if label is not None else none).alias("hint")

        def choose(s):
            kind, sure = _decide({k: s[k] for k in marks}, F.when(v == "", 0).otherwise(1), F.lit(1), s.hint)
            return F.struct(kind.alias("kind"), F.round(sure, 4).alias("confidence"))

        return let(F.struct(*marks.values(), hint), choose)

    return let(strip(F.coalesce(value, F.lit(""))), decide)
