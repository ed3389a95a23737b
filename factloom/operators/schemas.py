"""Union of any number of versions of a schema, as one aggregation.

The merge state of a field and of a repeating unit is made of minima, maxima, sets and intersections, so it is the same in
whatever order and grouping versions come together. ``version`` orders them where the first one counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Layout of a unit that no pattern was found for.
UNRECOGNISED = "UNRECOGNISED"


def merge_fields(fields: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """fields: (keys, version, path, label, kind, kind_confidence, cardinality, exact_length, min_length, max_length, regex, charset,
    enum_values, aliases, pages) to one row for each path that any version has.

    The surest kind wins, with its confidence, UNKNOWN only if all say so, of equals the earliest. Hints weaken: an exact
    length or a pattern stays if all versions state the same one, ranges widen, values unite, charsets that differ become
    ``any``. Labels other than the earliest become aliases.
    """
    best = F.struct((F.col("kind") != "UNKNOWN").alias("known"), "kind_confidence", (-F.col(version)).alias("o"))
    same = lambda c: F.when((F.count_distinct(c) == 1) & (F.count(c) == F.count("*")), F.max(c)).alias(c)
    united = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(c), F.array().cast(fields.schema[c].dataType))))))
    g = fields.groupBy(*keys, "path").agg(
        F.min_by("label", version).alias("label"), F.max_by("kind", best).alias("kind"), F.max_by("kind_confidence", best).alias("kind_confidence"),
        F.when(F.bool_or(F.col("cardinality") == "MULTI"), "MULTI").otherwise("SINGLE").alias("cardinality"), same("exact_length"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), same("regex"),
        F.when(F.count_distinct(F.coalesce("charset", F.lit("any"))) > 1, "any").otherwise(F.max(F.coalesce("charset", F.lit("any")))).alias("charset"),
        united("enum_values").alias("enum_values"), F.collect_set("label").alias("__labels"), united("aliases").alias("aliases"), united("pages").alias("pages"), F.count("*").alias("versions"),
    )
    aliases = F.array_sort(F.array_union("aliases", F.array_remove("__labels", F.col("label"))))
    return g.withColumn("aliases", aliases).drop("__labels")


def merge_units(units: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """units: (keys, version, layout_pattern, anchor_kinds, required_kinds, notes) to one row per key.

    The earliest version with a layout gives the unit. Versions of another layout add their anchor kinds and leave only the
    required kinds that they share; versions of the same layout, and those without one, change nothing. Notes of all
    versions unite, each once, by the earliest version that has it.
    """
    order = F.struct((F.coalesce("layout_pattern", F.lit(UNRECOGNISED)) == UNRECOGNISED).alias("none"), F.col(version).alias("o"))
    whole = F.struct(F.coalesce("layout_pattern", F.lit(UNRECOGNISED)).alias("layout_pattern"), "anchor_kinds", "required_kinds")
    g = units.groupBy(*keys).agg(F.min_by(whole, order).alias("base"), F.collect_set(whole).alias("all"), F.count("*").alias("versions"))
    others = F.filter("all", lambda u: (u.layout_pattern != UNRECOGNISED) & (u.layout_pattern != F.col("base.layout_pattern")))
    anchors = F.aggregate(others, F.col("base.anchor_kinds"), lambda a, u: F.array_union(a, u.anchor_kinds))
    required = F.aggregate(others, F.col("base.required_kinds"), lambda a, u: F.array_intersect(a, u.required_kinds))
    sorted_ = lambda changed, kept: F.when(F.size(others) > 0, F.array_sort(changed)).otherwise(kept)
    out = g.select(*keys, F.col("base.layout_pattern").alias("layout_pattern"), sorted_(anchors, F.col("base.anchor_kinds")).alias("anchor_kinds"), sorted_(required, F.col("base.required_kinds")).alias("required_kinds"), "versions")
    said = units.select(*keys, version, F.posexplode("notes").alias("p", "note")).groupBy(*keys, "note").agg(F.min(F.struct(version, "p")).alias("o"))
    notes = said.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "note"))), lambda x: x.note).alias("notes"))
    return out.join(notes, keys, "left").withColumn("notes", F.coalesce("notes", F.array().cast("array<string>")))
