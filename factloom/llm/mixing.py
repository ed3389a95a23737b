"""Mixing sources to target weights.

Sources share all words by weight, no source above ``most`` times its own words; what is above goes to the others by
weight until none is above. Documents of a source stand in the order of a hash of their ids. That order is cut into
``2 ** 12`` ranges of the hash; the ranges' sums give each range's start, and a running sum within a range gives each
document's, so no task gets a whole source. A source takes its budget (its target, rounded) exactly: as many whole
epochs as fit, then documents in order until the budget is met; the last one gives the words that are missing.

Null text: size 0. Null source: the last source. A null id hashes as its text. Rows that repeat an id are ordered by size;
equal rows get the same parts in either order. No words at all: every target is 0. Texts of any length are counted whole
and not kept. Other columns are not read. An empty table gives an empty result. The table of sources is ordered in one
task: it holds a row per source and 4,096 ranges of each at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import cut, word_count

WEIGHTS = (5, 2, 1)
MOST = 3


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size). The table has one row per source.

    With sources by the ratio of their limit to their weight, those at their limit come first; each further one decides
    by the words and weights that are left for it and those behind it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("wleft", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    s = s.withColumn("full", F.col("cap") * F.col("wleft") <= F.col("w") * F.col("left"))
    # The first that is not full fixes the level for all behind it.
    level = F.min_by(F.struct("left", "wleft"), F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source")))).over(every)
    s = s.withColumn("level", level)
    share = (F.col("w") * F.col("level.left")).cast("double") / F.col("level.wleft").cast("double")
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "") -> DataFrame:
    """(id_col, source, size, source_size, target, taken) for each row."""
    # A null id is told apart by its text, so that rows without ids are not one range of one task.
    named = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("\0"), F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)))
    key = F.md5(F.concat(F.lit(seed), named).cast("binary"))
    base = cut(docs.select(F.col(id_col), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key")))
    base = base.withColumn("range", F.substring("key", 1, 3))
    sums = base.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    plan = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most)
    ranges = sums.withColumn("range_start", F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranges = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), "range_start").join(plan, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "range").orderBy("key", "size", id_col).rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(F.lit(0).cast("long"))
    rest = budget - epochs * F.col("source_size") - F.col("range_start") - F.col("in_range")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return placed.select(id_col, "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
