import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from factloom.functions import checks, privacy, text
from factloom.operators import audit, chunk, compare, kinds
from factloom.plans import more, queries
from factloom.sources import files, sinks

QUERIES, ORACLE = queries.QUERIES | more.QUERIES, queries.ORACLE | more.ORACLE
SF = "/root/testdata/sf0.001"


def test_nothing_outside_imports_the_optional_subpackage():
    root = Path(__file__).resolve().parent.parent / "factloom"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts[:1]:
            assert not re.search(r"factloom\.llm|from \.*llm", f.read_text()), f


def test_kinds_of_single_values(spark):
    wanted = {
        "GB29NWBK60161331926819": "IBAN", "GB29NWBK60161331926818": "FREE_TEXT", "FRANCE": "COUNTRY", "CANADA": "COUNTRY", "NETHERLANDS": "COUNTRY", "INVLESMMXXX": "BIC", "US0378331005": "ISIN", "Create": "FREE_TEXT",
        "12-34-56": "SORT_CODE", "2025-04-05": "DATE", "EUR": "CURRENCY", "0654716099": "ACCOUNT_NUMBER", "529900T8BM49AURSDO55": "LEI", "+44 20 7946 0958": "PHONE", "a@b.co": "EMAIL", "Deutsche Bank AG": "ORG_NAME", "": "UNKNOWN",
    }
    df = spark.createDataFrame([(v,) for v in wanted], "v string")
    got = {r.v: r.k for r in df.select("v", kinds.infer_kind_scalar(F.col("v"))["kind"].alias("k")).collect()}
    assert got == wanted


def test_dates(spark):
    rows = {"05/04/2025": ("2025-04-05", True), "31/02/2024": (None, False), "29/02/2024": ("2024-02-29", False), "April 5, 2025": ("2025-04-05", False), "20250405": ("2025-04-05", False), "04/25/2025": ("2025-04-25", False), "x": (None, False)}
    df = spark.createDataFrame([(v,) for v in rows], "v string").select("v", checks.check_date(F.col("v")).alias("d")).select("v", "d.*").collect()
    assert {r.v: (r.normalised, bool(r.ok and r.reason)) for r in df} == rows


def test_redaction_is_stable_and_keeps_no_value(spark):
    raw = "pay GB29NWBK60161331926819 at INVLESMMXXX, mail settlements@examplebank.com, ref 4773002145, key sk-abcdef1234567890"
    df = spark.createDataFrame([(1, raw), (2, raw), (3, None), (4, "")], "i int, t string")
    out = [r.t for r in privacy.redact(df, "t", ["sk-abcdef1234567890", "short"]).orderBy("i").collect()]
    assert out[0] == out[1] and out[2] is None and out[3] == ""
    for secret in ("GB29NWBK60161331926819", "INVLESMMXXX", "settlements@", "4773002145", "sk-abc"):
        assert secret not in out[0]
    assert re.findall(r"<([A-Z]+):[0-9a-f]{12}>", out[0]) == ["IBAN", "BIC", "EMAIL", "ACCOUNT", "SECRET"]


def test_audit_chain_resumes_and_shows_tampering(spark):
    e = spark.createDataFrame([("d", i, "FIELD_EXTRACTED", "v%d" % i) for i in range(5)] + [("e", 0, "CHUNK_CREATED", None)], "document_id string, i int, event string, value string")
    first = audit.append(e.where("i < 3"), ["i"])
    log = first.unionByName(audit.append(e.where("i >= 3"), ["i"], first))
    seen = {r.document_id: r for r in audit.verify(log).collect()}
    assert seen["d"].entries == 5 and seen["d"].intact and seen["d"].gap is None and seen["e"].intact
    bad = log.withColumn("outcome", F.when((F.col("document_id") == "d") & (F.col("sequence") == 2), "other").otherwise(F.col("outcome")))
    r = {r.document_id: r for r in audit.verify(bad).collect()}["d"]
    assert not r.intact and r.failed_sequence == 2
    r = {r.document_id: r for r in audit.verify(log.where("sequence <> 1")).collect()}["d"]
    assert not r.intact and r.gap == 1


def test_shapes_and_similarity(spark):
    df = spark.createDataFrame([("0654716099", "BARCGB22", "BARCBG22")], "a string, b string, c string")
    r = df.select(text.value_shape(F.col("a")).alias("s"), text.similarity(F.col("b"), F.col("c")).alias("r"), text.substring_present(F.col("b"), F.lit("code BARCGB22XXX here")).alias("p"), text.slugify(F.lit("Local Sub A/C ")).alias("n")).first()
    assert (r.s, r.r, r.p, r.n) == ("len=10 classes=digit", 0.875, True, "local_sub_a_c")


def test_page_break_rows_are_stitched(spark):
    cell = lambda *hv: [{"header": h, "value": v} for h, v in hv]
    rows = [("d", 1, ["M", "A", "B"], cell(("M", "FR"), ("A", "1")), [1]), ("d", 2, ["M", "A", "B"], cell(("B", "2")), [2]), ("d", 3, ["M", "A", "B"], cell(("M", "DE"), ("A", "3")), [2])]
    df = spark.createDataFrame(rows, "document_id string, seq int, header_context array<string>, cells array<struct<header:string,value:string>>, pages array<int>")
    df = df.select("*", F.lit("t").alias("text"), F.lit("TABLE_ROW").alias("layout"), F.array().cast("array<struct<section:string,key:string,value:string>>").alias("key_values"), F.lit(1.0).alias("ocr_confidence"), F.lit(False).alias("is_amendment"), F.lit(1.0).alias("relevance"))
    out = chunk.stitch(df).orderBy("seq").collect()
    assert [(len(r.cells), r.pages, r.stitched) for r in out] == [(3, [1, 2], True), (2, [2], False)]


def test_near_misses(spark):
    kind = "document string, kind string, value string, form string"
    a = spark.createDataFrame([("d", "BIC", "BARCGB22", "barcgb22"), ("d", "BIC", "ZZZZDEFF", "zzzzdeff")], kind)
    b = spark.createDataFrame([("d", "BIC", "BARCBG22", "barcbg22"), ("d", "BIC", "QQQQFRPP", "qqqqfrpp")], kind)
    assert [(r.value, r.other, r.similarity) for r in compare.near_misses(a, b, ["document"]).collect()] == [("BARCGB22", "BARCBG22", 0.875)]


def test_gate_and_nesting(spark, tmp_path):
    (tmp_path / "good file.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "bad.pdf").write_bytes(b"text")
    found = files.scan(spark, str(tmp_path)).select("path", "length", "content")
    none = spark.createDataFrame([("/x/none.pdf", 0, bytearray())], found.schema)  # Spark's reader leaves out empty files
    out = {r.document_id.split("-")[0]: r.outcome for r in files.gate(found.union(none)).collect()}
    assert out == {"good_file": "ACCEPTED", "bad": "NOT_A_PDF", "none": "EMPTY"}
    leaf = {"value": "1"}
    assert sinks.nest([("a.b", 0, leaf), ("a.c", 0, leaf), ("d", 0, leaf), ("d", 1, leaf)]) == {"a": {"b": leaf, "c": leaf}, "d": [leaf, leaf]}


@pytest.mark.parametrize("name", ["check_codes", "ink_bands", "compare_multiset", "mask_format_preserving", *more.QUERIES])
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    key = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    assert key(ours) == key(theirs)
