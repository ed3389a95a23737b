"""Lines by their first word, pages of several layers, near misses, reports, model choice, names of countries."""

import hashlib
import random
import time
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F

from factloom.functions import dims, privacy, text
from factloom.operators import compare, grid, harvest, rulings
from factloom.sources import models, sinks

WORDS = "document_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double"


def test_lines_by_first_word_do_not_grow(spark):
    rows = [("d", 1, i, f"w{i}", i * 10.0, i * 4.0, i * 10.0 + 8, i * 4.0 + 10) for i in range(5)]
    got = {r.text: r.line_no for r in grid.lines_by_first_word(spark.createDataFrame(rows, WORDS)).collect()}
    assert got == {"w0": 0, "w1": 0, "w2": 1, "w3": 1, "w4": 2}
    assert len({r.line_no for r in grid.cluster_rows(spark.createDataFrame(rows, WORDS)).collect()}) == 1


def test_words_in_small_images_are_left_out(spark):
    native = spark.createDataFrame([("d", 1, 0, "own", 0.0, 0.0, 1.0, 1.0)], WORDS)
    read = native.select("document_id", "page", F.lit(1).alias("pos"), F.explode(F.array(F.lit("big"), F.lit("small"))).alias("text"), "x0", "y0", "x1", "y1").withColumn("region", F.when(F.col("text") == "big", 0).otherwise(1))
    images = spark.createDataFrame([("d", 1, 0, 0.0, 0.0, 100.0, 40.0), ("d", 1, 1, 0.0, 0.0, 100.0, 39.0)], "document_id string, page int, region int, x0 double, y0 double, x1 double, y1 double")
    assert {(r.text, r.layer) for r in grid.page_words(native, read, images).collect()} == {("own", "NATIVE"), ("big", "OCR")}


def test_near_misses_against_all_pairs(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcd12") for _ in range(rng.randint(3, 14))) for _ in range(40)]
    change = lambda s: "".join(c if rng.random() > 0.12 else rng.choice("abcd12") for c in s)
    left, right = sorted(set(base)), sorted({change(s) for s in base})
    want, pool = [], list(right)
    for a in left:
        scored = [(SequenceMatcher(None, a, b).ratio(), b) for b in pool]
        best = max((s for s, _ in scored), default=-1)
        if best >= 0.8:
            b = next(b for s, b in scored if s == best)
            want.append((a, b, round(best, 4)))
            pool.remove(b)
    frame = lambda own: spark.createDataFrame([("d", "BIC", v, v) for v in own], "doc string, kind string, value string, form string")
    near = compare.near_misses(frame(left), frame(right), ["doc"])
    assert sorted((r.value, r.other, r.similarity) for r in near.collect()) == want and len(want) > 10
    said = compare.rendered(compare.report(compare.match(frame(left), frame(right), ["doc"]), ["doc"]), near, ["doc"], 3).first().text.split("\n")
    assert len(said) == 4 and said[0].startswith("recall ") and all(s.startswith("1.00 BIC: ") for s in said[1:])


def test_provider_choice():
    made = {"x": lambda s: ("model", s["key"])}
    assert models.language_model({}, made) is None and models.language_model({"provider": "x", "key": 1}, made) == ("model", 1)
    with pytest.raises(ValueError):
        models.language_model({"provider": "y"}, made)


def test_every_country_has_a_name(spark):
    index = dims.country_index()
    assert len(set(dims.COUNTRY_CODES) - set(index.values())) <= 3 and index["iceland"] == "IS" and index["fji"] == "FJ"


def test_a_path_stated_twice_fails(spark):
    df = spark.createDataFrame([("d", "a"), ("d", "b"), ("e", "a")], "document_id string, path string")
    assert harvest.unique_paths(df).count() == 3
    with pytest.raises(Exception, match="stated twice"):
        harvest.unique_paths(df.union(df.limit(1))).collect()


def test_masking_is_linear_in_a_value(spark):
    """A value's hashes are taken once, not once for each of its characters."""
    odd = ["", None, "AbC-12", "Ünï 7٣x", "x" * 40 + "1" * 70, "123 € ǅ"]
    long = "Customer 0123456789/x-" * 5000
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*odd, long])], "i int, v string")
    start = time.monotonic()
    got = [r.m for r in df.withColumn("m", privacy.format_preserving(F.col("v"))).orderBy("i").collect()]
    assert time.monotonic() - start < 20 and got[:2] == ["", None]
    for v, m in zip([*odd, long][2:], got[2:]):
        assert len(v) == len(m) and all((x.isdecimal(), x.isalpha()) == (y.isdecimal(), y.isalpha()) and (x.isalpha() or x.isdecimal() or x == y) for x, y in zip(v, m))
    assert got[4][32:40] == got[4][:8] and got[4][104:] == got[4][40:46]
    d, a = (hashlib.sha256(("factloom-mask-1" + x + "AbC-12").encode()) for x in ("", "alpha"))
    letters = [chr(65 + b % 26) for b in a.digest()[:3]]
    assert got[2] == letters[0] + letters[1].lower() + letters[2] + "-" + "".join(str(int(h, 16) % 10) for h in d.hexdigest()[:2])


def test_ink_bands_are_spread_over_many_parts(spark):
    rows = spark.range(6000).select((F.col("id") % 3000).alias("k"), (F.col("id") % 7 * 30.0).alias("a"), (F.col("id") % 7 * 30.0 + 9).alias("b"))
    assert grid.ink_bands(rows, ["k"], "a", "b", 5).select(F.spark_partition_id().alias("p")).distinct().count() > 100


def test_ruled_cells_of_a_long_page(spark):
    """Words and lines of a page pass once: no word is held against all lines."""
    n = 30000
    line = spark.range(n + 1).select(F.lit("d").alias("document_id"), F.lit(1).alias("page"), F.lit("H").alias("axis"), (F.col("id") * 20.0).alias("at"))
    lines = line.union(spark.createDataFrame([("d", 1, "V", x) for x in (0.0, 100.0, 200.0)], line.schema))
    word = lambda c: spark.range(n).select(F.lit("d").alias("document_id"), F.lit(1).alias("page"), (F.col("id") * 2 + c).cast("int").alias("pos"), F.concat(F.lit(f"w{c}x"), F.col("id").cast("string")).alias("text"), F.lit(c * 100.0 + 5).alias("x0"), (F.col("id") * 20.0 + 3).alias("y0"), F.lit(c * 100.0 + 40).alias("x1"), (F.col("id") * 20.0 + 17).alias("y1"))
    start = time.monotonic()
    got = grid.ruled_tables(word(0).union(word(1)), lines).where("cells[0] = concat('w0x', row_no) and cells[1] = concat('w1x', row_no) and is_header = (row_no = 0)").count()
    assert got == n and time.monotonic() - start < 40


def test_a_word_on_a_line_or_outside(spark):
    lines = spark.createDataFrame([("d", 1, "H", y) for y in (0.0, 10.0, 20.0)] + [("d", 1, "V", x) for x in (0.0, 10.0, 20.0, 10.0)] + [("d", 1, "V", None)], "document_id string, page int, axis string, at double")
    at = {"on": (10.0, 10.0), "first": (0.0, 0.0), "last": (20.0, 5.0), "above": (5.0, -1.0), "nan": (float("nan"), 5.0), "null": (None, 5.0), "in": (15.0, 5.0)}
    words = spark.createDataFrame([("d", 1, i, t, x, y, x, y) for i, (t, (x, y)) in enumerate(at.items())], WORDS)
    assert [tuple(r.cells) for r in grid.ruled_tables(words, lines).orderBy("row_no").collect()] == [("first", "in"), ("", "on")]


def test_segments_drawn_again_are_not_sorted_again(spark, capsys):
    one = [("d", 1, 0.0, y, 50.0, y) for y in (0.0, 1.0, 30.0)] + [("d", 1, x, 0.0, x, 30.0) for x in (0.0, 50.0)]
    df = spark.createDataFrame(one * 50, "document_id string, page int, x0 double, y0 double, x1 double, y1 double")
    lines = rulings.rulings(df)
    assert sorted((r.axis, r.at) for r in lines.collect()) == [("H", 0.0), ("H", 30.0), ("V", 0.0), ("V", 50.0)]
    lines.explain()
    plan = capsys.readouterr().out
    assert "Aggregate" in plan[plan.rindex("Window") :]


def test_only_unusual_letters_reach_python(spark, monkeypatch):
    raw = ["plain", "Ünï", None, "", "ﬁx e\u0301\u0323 Ａ ① 한글 ǅ", "ß"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string")
    plain = lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))
    assert [r.p for r in df.withColumn("p", text.strip_accents(F.col("v"))).orderBy("i").collect()] == [plain(v) for v in raw]

    @F.pandas_udf("string")
    def strict(s: pd.Series) -> pd.Series:
        assert not any(v is not None and v.isascii() for v in s)
        return s

    monkeypatch.setattr(text, "_decomposed", strict)
    assert df.select(text.strip_accents(F.col("v"))).collect()


def test_excerpts_with_ties_and_nulls(spark):
    rows = [("a", i % 4 or None, [i], f"a{i % 4}") for i in range(8)] + [(None, 1, [1], "n"), ("b", None, [2], "x" * 3000), ("b", 9, [2], "no room")]
    got = {r.document_id: r.text for r in sinks.excerpts(spark.createDataFrame(rows, "document_id string, record_index int, pages array<int>, text string")).collect()}
    assert [t.split("\n")[1] for t in got["a"].split("\n\n")] == ["a0", "a0", "a1"] and got[None] == "[chunk 1, page 1]\nn" and got["b"] == "[chunk 1, page 2]\n" + "x" * 2600
