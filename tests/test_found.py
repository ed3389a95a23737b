"""Near misses by a similarity join, boxes by place, found tables, schemas of many versions, against plain Python."""

import functools
import random
import time
from collections import defaultdict
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from factloom.operators import boxes, compare, grid, links, proposals, rulings, schemas
from factloom.plans import extract


def greedy(missing, extra, least):
    """The sequential pass per kind, all pairs compared."""
    out = []
    for kind in {k for k, *_ in missing}:
        pool = sorted((v, f) for k, v, f in extra if k == kind)
        for value, form in sorted((v, f) for k, v, f in missing if k == kind):
            best, ratio = None, -1.0
            for i, (_, f) in enumerate(pool):
                if 2 * min(len(f), len(form)) < max(least, ratio) * (len(f) + len(form)):
                    continue
                match = SequenceMatcher(None, form, f)
                if match.quick_ratio() >= least and (found := match.ratio()) > ratio:
                    best, ratio = i, found
            if best is not None and ratio >= least:
                out.append((kind, value, pool.pop(best)[0], round(ratio, 4)))
    return sorted(out)


def _values(seed, n, letters, longest):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n // 2)]
    edit = lambda s: "".join(c if rng.random() > 0.1 else rng.choice(("", c + c, rng.choice(letters))) for c in s) or "x"
    rows = lambda: [(rng.choice("KL"), v.upper(), v) for v in (edit(rng.choice(base)) for _ in range(n))]
    return rows(), rows()


@pytest.mark.parametrize("seed, n, letters, longest, least", [(1, 1000, "abcdefgh12", 16, 0.8), (2, 250, "ab1", 6, 0.8), (3, 150, "abcd", 8, 0.6), (4, 300, "abcdef", 12, 0.9)])
def test_near_misses_equal_the_sequential_pass(spark, seed, n, letters, longest, least):
    missing, extra = _values(seed, n, letters, longest)
    df = lambda rows: spark.createDataFrame(rows, "kind string, value string, form string").repartition(4)
    got = sorted(tuple(r) for r in compare.near_misses(df(missing), df(extra), [], least).collect())
    assert got == greedy(missing, extra, least) and len(got) > 20


def test_near_misses_deal_common_grams(spark):
    rows = [("K", f"account {i:04d}", f"account {i:04d}") for i in range(120)]
    other = [("K", f"account {i:04d}x", f"account {i:04d}x") for i in range(0, 240, 2)]
    df = lambda rows: spark.createDataFrame(rows, "kind string, value string, form string").withColumn("id", F.monotonically_increasing_id())
    pairs = [compare.near_pairs(df(rows), df(other), ["kind"], 0.8, block).select(F.round(F.sum("ratio"), 6), F.count("*")).first() for block in (7, 4096)]
    assert pairs[0] == pairs[1] and pairs[0][1] > 120


def test_near_misses_by_subsequences_and_by_grams_are_the_same(spark):
    df = lambda rows: spark.createDataFrame(rows, "kind string, value string, form string").withColumn("id", F.monotonically_increasing_id())
    for seed, n, letters, longest, least in ((5, 300, "ab1", 7, 0.6), (6, 400, "abcdé€😀12", 14, 0.8), (7, 200, "ab", 9, 1.0)):
        missing, extra = (df([*rows, ("K", None, None), (None, "x", "x")]) for rows in _values(seed, n, letters, longest))
        got = [sorted(tuple(r) for r in compare.near_pairs(missing, extra, ["kind"], least, most=most).collect()) for most in (0, 20, 1000)]
        assert got[0] == got[1] == got[2] and len(got[0]) > 50
        forms = [{r.id: (r.kind, r.form) for r in side.where("form is not null and kind is not null").collect()} for side in (missing, extra)]
        want = [(a, b, SequenceMatcher(None, f, g).ratio()) for a, (k, f) in forms[0].items() for b, (m, g) in forms[1].items() if k == m]
        assert got[0] == sorted(x for x in want if x[2] >= least)


def test_meetings_of_near_misses_grow_with_the_rows(spark):
    """Random codes share pairs of characters with all others, but hardly ever a long subsequence."""
    code = F.substr(F.md5(F.col("id").cast("string")), F.lit(1), F.lit(11))
    df = lambda n: spark.range(n).select(F.lit("K").alias("kind"), "id", code.alias("form"))
    keys = [compare._subsequences(df(4000), ["kind"], {11: [9]}, name) for name in "me"]
    assert keys[0].join(keys[1], "h").where("m <> e").count() < 100


@functools.cache
def _boxes(seed, n):
    rng = random.Random(seed)
    size = lambda: rng.choice((0, rng.random(), rng.randint(1, 20), rng.randint(1, 3000)))
    out = []
    for i in range(n):
        x, y = rng.choice((rng.uniform(-500, 500), rng.randint(-20, 20) * 16.0)), rng.uniform(-500, 500)
        out.append((rng.randint(1, 2), i, x, y, x + size(), y + size()))
    return out


def test_meeting_boxes_equal_all_pairs(spark):
    a, b = _boxes(1, 150), _boxes(2, 150)
    bad = [(1, -1, None, 0.0, 1.0, 1.0), (1, -2, float("nan"), 0.0, 1.0, 1.0), (1, -3, 5.0, 0.0, 1.0, 1.0)]
    df = lambda rows: spark.createDataFrame([*rows, *bad], "page int, id int, x0 double, y0 double, x1 double, y1 double")
    for cell in (16.0, 0.25):
        got = sorted((r.aid, r.bid) for r in boxes.meeting(df(a), df(b), ["page"], cell).collect())
        assert got == sorted((i, j) for p, i, *s in a for q, j, *t in b if p == q and s[0] <= t[2] and t[0] <= s[2] and s[1] <= t[3] and t[1] <= s[3])
    assert boxes.meeting(df(a).where("false"), df(b), ["page"]).count() == 0


def test_sums_of_meetings_equal_all_pairs(spark):
    a, b = _boxes(1, 150), _boxes(2, 150)
    a = [*a, *[(3, 500 + i, float(i % 7 * 8), float(i % 5 * 8), float(i % 7 * 8 + i % 3 * 8), float(i % 5 * 8 + i % 4 * 8)) for i in range(60)], a[0]]
    b = [*b, *[(3, i, float(i % 6 * 8), float(i % 5 * 8 - 8), float(i % 6 * 8 + i % 4 * 8), float(i % 5 * 8)) for i in range(70)]]
    bad = [(1, -1, None, 0.0, 1.0, 1.0), (1, -2, float("nan"), 0.0, 1.0, 1.0), (1, -3, 5.0, 0.0, 1.0, 1.0)]
    df = lambda rows: spark.createDataFrame([*rows, *bad], "page int, id int, x0 double, y0 double, x1 double, y1 double")
    want = defaultdict(lambda: [0, 0.0])
    for p, i, *s in a:
        for q, _, *t in b:
            if p == q and s[0] <= t[2] and t[0] <= s[2] and s[1] <= t[3] and t[1] <= s[3]:
                want[p, i][0] += 1
                want[p, i][1] += (min(s[2], t[2]) - max(s[0], t[0])) * (min(s[3], t[3]) - max(s[1], t[1]))
    for tile in (8.0, 1024.0):
        sums = boxes.meeting_sums(df(a), df(b), ["page"], tile).groupBy("page", "id").agg(F.sum("meets").alias("n"), F.sum("area").alias("area")).where("n > 0").collect()
        assert {(r.page, r.id): r.n for r in sums} == {k: n for k, (n, _) in want.items()}
        assert all(r.area == pytest.approx(want[r.page, r.id][1], rel=1e-9, abs=1e-6) for r in sums)
    assert boxes.meeting_sums(df(a).where("false"), df(b), ["page"]).count() == 0


def test_sums_of_meetings_make_no_pairs(spark):
    """150,000 boxes that all meet each other: 22.5 billion pairs in one tile."""
    one = spark.range(150_000).select(F.lit(1).alias("page"), "id", *[F.lit(v).alias(c) for c, v in (("x0", 1.0), ("y0", 2.0), ("x1", 5.0), ("y1", 4.0))])
    got = boxes.meeting_sums(one, one, ["page"]).agg(F.min("meets"), F.sum("meets"), F.sum("area")).first()
    assert tuple(got) == (150_000, 150_000**2, 8.0 * 150_000**2)


def test_a_page_of_many_boxes_is_not_compared_in_pairs(spark):
    one = spark.range(10_000).select(F.lit(1).alias("page"), "id", ((F.col("id") % 100) * 12.0).alias("x0"), (F.floor(F.col("id") / 100) * 12.0).alias("y0")).withColumn("x1", F.col("x0") + 10).withColumn("y1", F.col("y0") + 10)
    large = spark.createDataFrame([(1, -1, 0.0, 0.0, 1200.0, 1200.0)], one.schema)
    met = boxes.meeting(one.unionByName(large), one.unionByName(large), ["page"])
    assert met.count() == 10_000 + 2 * 10_000 + 1  # each with itself and with the large one
    dealt = boxes._dealt(one, ["page"], [0, 7], 16.0, "a")
    per_cell = dealt.groupBy("__level", "__cx", "__cy").count().groupBy("__level").agg(F.sum(F.col("count") * F.col("count")).alias("pairs")).collect()
    assert {r["__level"]: r.pairs < 1_000_000 for r in per_cell}[0]  # of 100 million


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    names = list(range(400))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 300)] + [(names[i], names[i + 1]) for i in range(300, 380, 2)]
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    got = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == root and len(got) == len(root)
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _drawn_table(left, top, columns, rows, width=60.0, height=20.0, off=0.4):
    """Borders of each cell on its own, every other one backwards and slightly off."""
    out = []
    for r in range(rows):
        for c in range(columns):
            x, y, d = left + c * width, top + r * height, off * ((r + c) % 2)
            sides = [(x, y + d, x + width, y + d), (x, y + height, x + width, y + height), (x + d, y, x + d, y + height), (x + width, y + height, x + width, y)]
            out += [s if i % 2 else (s[2], s[3], s[0], s[1]) for i, s in enumerate(sides)]
    return out


def _page(spark):
    drawn = _drawn_table(50, 100, 3, 4) + _drawn_table(300, 110, 2, 3) + _drawn_table(50, 400, 2, 2)
    drawn += [(0.0, 700.0, 600.0, 700.0), (10.0, 10.0, 40.0, 45.0), (20.0, 20.0, 20.0, 23.0), (400.0, 300.0, 500.0, 300.0), (450.0, 280.0, 450.0, 320.0)]
    segments = spark.createDataFrame([("d", 1, *map(float, s)) for s in drawn], "document_id string, page int, x0 double, y0 double, x1 double, y1 double")
    words, pos = [], 0
    for left, top, columns, rows, name in ((50, 100, 3, 4, "a"), (300, 110, 2, 3, "b"), (50, 400, 2, 2, "c")):
        for r in range(rows):
            for c in range(columns):
                text = f"Head{c}" if r == 0 else f"{name}{r}{c}"
                words.append(("d", 1, pos, text, left + c * 60.0 + 5, top + r * 20.0 + 4, left + c * 60.0 + 40, top + r * 20.0 + 16, 1.0))
                pos += 1
    words.append(("d", 1, pos, "outside", 5.0, 600.0, 40.0, 612.0, 1.0))
    return segments, spark.createDataFrame(words, "document_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double, confidence double")


def test_three_tables_on_a_page_come_back_apart(spark):
    segments, words = _page(spark)
    found = rulings.find(segments)
    size = {r.table_no: (r.h, r.v) for r in found.groupBy("table_no").agg(F.count_if(F.col("axis") == "H").alias("h"), F.count_if(F.col("axis") == "V").alias("v")).collect()}
    assert size == {0: (5, 4), 1: (4, 3), 2: (3, 3)}
    got = [(r.grid_no, r.row_no, r.is_header, r.cells) for r in grid.ruled_tables(words, found).orderBy("row_no").collect()]
    want = [(g, n, r == 0, [f"Head{c}" if r == 0 else f"{t}{r}{c}" for c in range(columns)]) for n, (g, t, r, columns) in enumerate((g, t, r, columns) for g, (t, columns, rows) in enumerate((("a", 3, 4), ("b", 2, 3), ("c", 2, 2))) for r in range(rows))]
    assert got == want


def test_the_run_finds_tables_by_what_is_drawn(spark):
    segments, words = _page(spark)
    number = F.concat(F.lit("0654716"), F.translate("text", "abc", "123"))
    words = words.withColumn("text", F.when(F.col("text").rlike("^[abc][0-9]+$"), number).when(F.col("text") == "Head0", "Account").otherwise(F.col("text")))
    chunks = extract.extract(words, segments=segments).chunks.collect()
    cells = sorted([(c.header, c.value) for c in r.cells] for r in chunks if r.layout == "TABLE_ROW")
    assert len(cells) == 6 and [("Account", "0654716210"), ("Head1", "0654716211")] in cells and [("Account", "0654716130"), ("Head1", "0654716131"), ("Head2", "0654716132")] in cells


def _fold_units(units):
    units = [u for _, u in sorted(units.items())]
    layout, anchors, required, notes = units[0]
    for l, a, r, n in units[1:]:
        if layout == "UNRECOGNISED":
            layout, anchors, required = l, a, r
        elif l not in ("UNRECOGNISED", layout):
            anchors, required = sorted({*anchors, *a}), sorted({*required} & {*r})
        notes = list(dict.fromkeys([*notes, *n]))
    return layout, list(anchors), list(required), notes


def test_units_merge_as_they_fold_in_any_order(spark):
    rng = random.Random(8)
    some = lambda x: sorted(rng.sample([x + c for c in "abcd"], rng.randint(0, 4)))
    units = {s: {v: (rng.choice(("UNRECOGNISED", "TABLE_ROW", "FORM", "NARRATIVE")), some("A"), some("R"), rng.sample(["n1", "n2", "n3"], 2)) for v in range(7)} for s in range(40)}
    rows = [(s, v, *u) for s, own in units.items() for v, u in own.items()]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "s int, version int, layout_pattern string, anchor_kinds array<string>, required_kinds array<string>, notes array<string>").repartition(seed * 3)
        got = {r.s: (r.layout_pattern, r.anchor_kinds, r.required_kinds, r.notes) for r in schemas.merge_units(df, ["s"]).collect()}
        assert got == {s: _fold_units(u) for s, u in units.items()}


def test_fields_of_every_version_survive(spark):
    row = lambda v, path, kind, sure, **k: (v, path, k.get("label", path), kind, sure, k.get("cardinality", "SINGLE"), k.get("exact"), k.get("low"), k.get("high"), k.get("regex"), k.get("charset"), k.get("enums"), k.get("aliases"), [v])
    rows = [row(0, "a", "UNKNOWN", 0.9, exact=4, low=4, high=4, regex="x", charset="digit", label="A"), row(1, "a", "BIC", 0.5, exact=4, low=2, high=9, regex="x", charset="digit", label="A b", enums=["q"]), row(2, "a", "IBAN", 0.5, exact=4, cardinality="MULTI", regex="x", charset="alpha", aliases=["old"]), row(5, "b", "UNKNOWN", 0.1)]
    df = spark.createDataFrame(rows, "version int, path string, label string, kind string, kind_confidence double, cardinality string, exact_length int, min_length int, max_length int, regex string, charset string, enum_values array<string>, aliases array<string>, pages array<int>")
    got = {r.path: r for r in schemas.merge_fields(df, []).collect()}
    a = got["a"]
    assert (a.label, a.kind, a.kind_confidence, a.cardinality, a.exact_length, a.min_length, a.max_length, a.regex, a.charset, a.enum_values, a.aliases, a.pages, a.versions) == ("A", "BIC", 0.5, "MULTI", 4, 2, 9, "x", "any", ["q"], ["A b", "a", "old"], [0, 1, 2], 3)
    assert got["b"].kind == "UNKNOWN" and got["b"].versions == 1


def test_answers_are_taken_whole_or_not_at_all(spark):
    f = lambda label, group="", kind="BIC", card="SINGLE": (label, group, kind, card)
    rows = [("ok", [f("A b"), f("A b", "g")]), ("none", []), ("null", None), ("many", [f(f"x{i}") for i in range(81)]), ("blank", [f("a"), f(" \t")]), ("nolabel", [f(None)]), ("twice", [f("A b", " G "), f("a-B", "g")])]
    df = spark.createDataFrame(rows, "prompt_hash string, fields array<struct<label: string, group: string, kind: string, cardinality: string>>")
    got = {r.prompt_hash: r.reason for r in proposals.judged(df).collect()}
    assert got == {"ok": None, "none": "no_fields", "null": "no_fields", "many": "too_many_fields", "blank": "blank_label", "nolabel": "blank_label", "twice": "field_twice"}


def test_the_run_with_answers_and_without(spark):
    head, body = ["Market", "Currency", "Agent BIC", "Account"], [["France", "EUR", "BNPAFRPP", "0012345678"], ["Germany", "EUR", "DEUTDEFF", "0087654321"], ["Japan", "JPY", "BOTKJPJT", "0055512345"], ["Canada", "CAD", "ROYCCAT2", "0099911122"]]
    rows = [("d", 1, r * 4 + c, t, c * 150.0, r * 20.0, c * 150.0 + 60, r * 20.0 + 10, 1.0) for r, row in enumerate([head, *body]) for c, t in enumerate(row)]
    words = spark.createDataFrame(rows, "document_id string, page int, pos int, text string, x0 double, y0 double, x1 double, y1 double, confidence double")
    empty = spark.createDataFrame([], "prompt_hash string, fields array<struct<label: string, group: string, kind: string, cardinality: string>>")
    first = extract.extract(words, answers=empty)
    (asked,) = first.prompts.collect()
    assert "France" in asked.prompt and {r.path for r in first.descriptors.collect()} == {"market", "currency", "agent_bic", "account"}
    answer = spark.createDataFrame([(asked.prompt_hash, [("Account", "", "IBAN", "MULTI"), ("Settlement Date", "Trade", "DATE", "SINGLE")])], empty.schema)
    second = extract.extract(words, answers=answer)
    got = {r.path: (r.kind, r.cardinality) for r in second.descriptors.collect()}
    assert set(got) == {"market", "currency", "agent_bic", "account", "trade.settlement_date"} and got["trade.settlement_date"] == ("DATE", "SINGLE") and got["account"][1] == "MULTI"
    assert second.prompts.count() == 0
    values = {(r.path, r.value) for r in second.scored.collect()}
    assert ("account", "0012345678") in values and {s for p, s in ((r.path, r.status) for r in second.scored.collect()) if p == "trade.settlement_date"} == {"NOT_APPLICABLE"}
