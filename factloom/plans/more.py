"""Further registered queries: validation, guard, stitching, comparison and composition over the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import checks
from factloom.operators import chunk, compare, guard, harvest, layout, validate
from factloom.sources import files, sinks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_counts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    status = F.element_at(F.array(*[F.lit(x) for x in ("VALIDATED", "FAILED", "NOT_APPLICABLE")]), (F.col("c_custkey") % 3 + 1).cast("int"))
    return validate.status_counts(c.select(F.col("c_nationkey").cast("string").alias("document_id"), status.alias("status"), (F.col("c_custkey") % 3 == 1).alias("needs_review")))


def record_completeness(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("d").alias("document_id"), F.col("c_custkey").alias("record_index"), "c_custkey")
    facts = c.select("document_id", "record_index", F.explode(F.array(F.struct(F.lit("CURRENCY").alias("kind"), F.when(F.col("c_custkey") % 4 != 3, "EUR").alias("value")), F.struct(F.lit("COUNTRY").alias("kind"), F.when(F.col("c_custkey") % 3 != 0, "FR").alias("value")))).alias("x")).select("document_id", "record_index", "x.*")
    required = spark.range(1).select(F.lit("d").alias("document_id"), F.array(F.lit("COUNTRY"), F.lit("CURRENCY")).alias("required_kinds"))
    amended = c.select("document_id", "record_index", (F.col("c_custkey") % 10 == 0).alias("is_amendment"))
    out = validate.record_completeness(facts, required, amended)
    return out.select("record_index", "outcome", "populated_fields", F.array_join("required_kinds_missing", ",").alias("missing"))


def guard_drift(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    value = F.concat(F.lit("BANK"), F.when(F.col("s_suppkey") % 7 < F.col("s_nationkey") % 5, "QQ").otherwise("DE"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"))
    v = s.select((F.col("s_nationkey") % 5).cast("string").alias("document_id"), F.lit("BIC").alias("kind"), value.alias("value"))
    return guard.drift(v.withColumn("verdict", F.struct(F.when(checks.check_bic(F.col("value"))["ok"], "PASSED").otherwise("FAILED").alias("outcome"))))


def untraced_values(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("d").alias("document_id"), F.col("c_custkey").alias("record_index"), "c_custkey", "c_name", "c_mktsegment")
    chunks = c.select("document_id", "record_index", F.concat_ws("\n", "c_name", "c_mktsegment").alias("text"))
    facts = c.select("document_id", "record_index", F.lit("name").alias("path"), F.when(F.col("c_custkey") % 3 == 0, "QXJZWVKY 998877").otherwise(F.col("c_name")).alias("value"), F.when(F.col("c_custkey") % 5 == 0, "not in the text").otherwise(F.col("c_mktsegment")).alias("evidence"))
    return guard.untraced(facts, chunks).select("record_index", "issue", "blocks")


def stitch_page_breaks(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    cell = lambda h, v: F.struct(F.lit(h).alias("header"), F.col(v).cast("string").alias("value"))
    whole = F.array(cell("Key", "n_nationkey"), cell("Name", "n_name"), cell("Region", "n_regionkey"))
    apart = F.col("n_nationkey") % 2 == 0
    rows = n.select("n_nationkey", F.posexplode(F.when(apart, F.array(F.slice(whole, 1, 2), F.slice(whole, 3, 1))).otherwise(F.array(whole))).alias("half", "cells"))
    text = F.array_join(F.transform("cells", lambda c: F.concat(c.header, F.lit(": "), c.value)), "\n")
    chunks = rows.select(F.lit("d").alias("document_id"), (F.col("n_nationkey") * 2 + F.col("half")).alias("seq"), F.array(*[F.lit(x) for x in ("Key", "Name", "Region")]).alias("header_context"), F.array(F.col("n_nationkey") * 2 + F.col("half")).alias("pages"), "cells", text.alias("text"), F.lit("TABLE_ROW").alias("layout"), F.array().cast(chunk._PAIRS).alias("key_values"), F.lit(1.0).alias("ocr_confidence"), F.lit(False).alias("is_amendment"), F.lit(1.0).alias("relevance"))
    return chunk.stitch(chunks).select(F.floor(F.col("seq") / 2).alias("n_nationkey"), "text", "stitched", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


def composition_summary(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("NATIVE", "SCANNED", "MIXED", "EMPTY")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return sinks.document_analysis(layout.composition(o.select(F.col("o_custkey").cast("string").alias("document_id"), kind.alias("page_class"))))


def compare_by_kind(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    fact = lambda form: p.select(F.lit("d").alias("document_id"), F.concat(F.lit("K"), F.col("p_size") % 3).alias("kind"), form.alias("form"))
    other = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_brand"), F.lit("x"))).otherwise(F.col("p_brand"))
    return compare.by_kind(compare.match(fact(F.col("p_brand")), fact(other), ["document_id"]), ["document_id"]).select("kind", "matched", "missing", "extra")


def expected_depository(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit(" n"), F.col("s_nationkey").cast("string")).alias("country"), F.concat(F.lit("pset"), (F.col("s_nationkey") + F.when(F.col("s_suppkey") % 4 == 0, 1).otherwise(0)).cast("string")).alias("pset_bic"))
    d = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country"), F.concat(F.lit("PSET"), F.col("n_nationkey").cast("string")).alias("pset_bic"))
    return validate.expected_depository(s, d).select("s_suppkey", "expected_pset", F.coalesce("pset_matches", F.lit(False)).alias("pset_matches"))


def swift_tags(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    text = F.concat(F.lit(":97A::SAFE//"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lit("\nfree text\n:95P::PSET//"), F.col("s_name"))
    return harvest.swift_fields(s.select(F.lit("d").alias("document_id"), F.col("s_suppkey").alias("record_index"), F.array(F.lit(1)).alias("pages"), text.alias("text"))).select("record_index", "tag", "qualifier", "label", "kind_hint", "sample")


def json_leaves(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    leaf = F.struct(F.col("c_mktsegment").alias("value"), F.lit("VALIDATED").alias("status"), F.lit(1.0).alias("confidence"), F.lit("").alias("evidence"))
    doc = F.to_json(F.struct(F.col("c_name").alias("name"), F.array(F.struct(F.struct(leaf.alias("segment")).alias("party"))).alias("records")))
    return files.leaves(c.select(F.col("c_custkey").cast("string").alias("document"), doc.alias("json"))).withColumn("record_index", F.coalesce("record_index", F.lit(-1)))


def prompt_excerpts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return sinks.excerpts(c.select(F.col("c_nationkey").cast("string").alias("document_id"), F.col("c_custkey").alias("record_index"), F.array((F.col("c_custkey") % 7).cast("int"), F.lit(2), F.lit(2)).alias("pages"), F.repeat(F.col("c_name"), (F.col("c_custkey") % 90).cast("int")).alias("text")))


def score_explained(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    part = lambda n: (F.col("c_custkey") % n) / F.lit(n)
    return c.select("c_custkey", validate.explained(part(4), part(8), part(2), F.lit(0.5), part(5)).alias("explained"))


QUERIES = {f.__name__: f for f in (status_counts, record_completeness, guard_drift, untraced_values, stitch_page_breaks, composition_summary, compare_by_kind, expected_depository, swift_tags, json_leaves, prompt_excerpts, score_explained)}

ORACLE = {
    "prompt_excerpts": """WITH c AS (SELECT c_nationkey::VARCHAR AS document_id, row_number() OVER w AS n, c_custkey % 7 AS p, repeat(c_name, (c_custkey % 90)::INT) AS t FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)),
        l AS (SELECT *, 2600 - coalesce(sum(length(t)) OVER (PARTITION BY document_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM c WHERE n <= 3)
        SELECT document_id, string_agg('[chunk ' || n || ', page ' || CASE WHEN p = 2 THEN '2' ELSE least(p, 2) || ', ' || greatest(p, 2) END || ']' || chr(10) || left(t, room::INT), chr(10) || chr(10) ORDER BY n) AS text FROM l WHERE room > 0 GROUP BY document_id""",
    "score_explained": "SELECT c_custkey, printf('ocr=%.2f model=%.2f format=%.2f reference=%.2f -> %.3f', (c_custkey % 4) / 4.0::DOUBLE, (c_custkey % 8) / 8.0::DOUBLE, (c_custkey % 2) / 2.0::DOUBLE, 0.5::DOUBLE, (c_custkey % 5) / 5.0::DOUBLE) AS explained FROM customer",
    "status_counts": "SELECT c_nationkey::VARCHAR AS document_id, count(*) FILTER (c_custkey % 3 = 0) AS fields_validated, count(*) FILTER (c_custkey % 3 = 1) AS fields_failed, count(*) FILTER (c_custkey % 3 = 2) AS fields_not_applicable, count(*) FILTER (c_custkey % 3 = 1) AS fields_queued_for_review FROM customer GROUP BY c_nationkey",
    "record_completeness": """WITH f AS (SELECT c_custkey AS k, c_custkey % 4 <> 3 AS cur, c_custkey % 3 <> 0 AS ctry FROM customer)
        SELECT k AS record_index, CASE WHEN k % 10 = 0 THEN 'PASSED' WHEN NOT cur AND NOT ctry THEN 'FAILED' WHEN NOT (cur AND ctry) THEN 'AMBIGUOUS' ELSE 'PASSED' END AS outcome, (cur::INT + ctry::INT)::BIGINT AS populated_fields, concat_ws(',', CASE WHEN NOT ctry THEN 'COUNTRY' END, CASE WHEN NOT cur THEN 'CURRENCY' END) AS missing FROM f""",
    "guard_drift": """WITH g AS (SELECT (s_nationkey % 5)::VARCHAR AS document_id, count(*) AS identifiers, count(*) FILTER (s_suppkey % 7 < s_nationkey % 5) AS failing FROM supplier GROUP BY 1)
        SELECT *, CASE WHEN identifiers < 6 THEN 'INDETERMINATE' WHEN failing::DOUBLE / identifiers >= 0.5 THEN 'DRIFT' ELSE 'OK' END AS drift FROM g""",
    "untraced_values": "SELECT c_custkey AS record_index, 'HALLUCINATED_VALUE' AS issue, true AS blocks FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'UNSUPPORTED_EVIDENCE', false FROM customer WHERE c_custkey % 5 = 0",
    "stitch_page_breaks": "SELECT n_nationkey::BIGINT AS n_nationkey, 'Key: ' || n_nationkey || chr(10) || 'Name: ' || n_name || chr(10) || 'Region: ' || n_regionkey AS text, n_nationkey % 2 = 0 AS stitched, CASE WHEN n_nationkey % 2 = 0 THEN (n_nationkey * 2) || ',' || (n_nationkey * 2 + 1) ELSE (n_nationkey * 2)::VARCHAR END AS pages FROM nation",
    "composition_summary": """WITH g AS (SELECT o_custkey::VARCHAR AS document_id, count(*) AS page_count, count(*) FILTER (o_orderkey % 4 = 0) AS native_text_pages, count(*) FILTER (o_orderkey % 4 = 1) AS scanned_pages, count(*) FILTER (o_orderkey % 4 = 2) AS mixed_pages, count(*) FILTER (o_orderkey % 4 = 3) AS empty_pages FROM orders GROUP BY 1)
        SELECT *, concat_ws(' | ', page_count || ' page(s)', CASE WHEN native_text_pages > 0 THEN native_text_pages || ' native page(s)' END, CASE WHEN scanned_pages > 0 THEN scanned_pages || ' scanned page(s)' END, CASE WHEN mixed_pages > 0 THEN mixed_pages || ' mixed page(s)' END, CASE WHEN empty_pages > 0 THEN empty_pages || ' empty page(s)' END) AS document_analysis FROM g""",
    "compare_by_kind": """WITH p AS (SELECT 'K' || (p_size % 3) AS kind, p_brand AS r, CASE WHEN p_partkey % 7 = 0 THEN p_brand || 'x' ELSE p_brand END AS a FROM part), r AS (SELECT kind, r AS f, count(*) AS n FROM p GROUP BY 1, 2), a AS (SELECT kind, a AS f, count(*) AS m FROM p GROUP BY 1, 2)
        SELECT kind, sum(least(coalesce(n, 0), coalesce(m, 0)))::BIGINT AS matched, sum(greatest(coalesce(n, 0) - coalesce(m, 0), 0))::BIGINT AS missing, sum(greatest(coalesce(m, 0) - coalesce(n, 0), 0))::BIGINT AS extra FROM r FULL JOIN a USING (kind, f) GROUP BY kind""",
    "expected_depository": "SELECT s_suppkey, CASE WHEN s_nationkey % 5 <> 0 THEN 'PSET' || s_nationkey END AS expected_pset, s_nationkey % 5 <> 0 AND s_suppkey % 4 <> 0 AS pset_matches FROM supplier",
    "swift_tags": """SELECT s_suppkey AS record_index, '97A' AS tag, 'SAFE' AS qualifier, 'Safekeeping Account (SAFE)' AS label, 'ACCOUNT_NUMBER' AS kind_hint, lpad(s_suppkey::VARCHAR, 8, '0') AS sample FROM supplier
        UNION ALL SELECT s_suppkey, '95P', 'PSET', 'Party BIC (PSET)', 'BIC', s_name FROM supplier""",
    "json_leaves": "SELECT c_custkey::VARCHAR AS document, 'name' AS path, -1 AS record_index, c_name AS value FROM customer UNION ALL SELECT c_custkey::VARCHAR, 'records[0].party.segment', 0, c_mktsegment FROM customer",
}
