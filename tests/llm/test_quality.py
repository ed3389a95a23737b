"""Distinct documents per line where lines travel together."""

import random
import time

import pytest

from factloom.llm import quality

SCHEMA = "doc_id long, text string, source string"


def _say(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(6)) for _ in range(n))


def test_a_long_shared_line_hides_no_other(spark):
    rng = random.Random(7)
    licence, second, banner = _say(rng, 40), _say(rng, 30), _say(rng, 9)
    rows = [(i, f"{banner}\n{licence}\n{second}\n{_say(rng, 25)}", "s") for i in range(40)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {r.removed_words for r in got.values()} == {79} and not any(r.kept for r in got.values())


def test_two_shared_lines_go_and_copies_stay(spark):
    rng = random.Random(8)
    header, footer, whole = _say(rng, 12), _say(rng, 10), "\n".join(_say(rng, 20) for _ in range(20))
    rows = [(i, f"{header}\n{_say(rng, 25)}\n{footer}", "s") for i in range(2000)] + [(5000 + i, whole + "\n" * (i % 3), "s") for i in range(40)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].removed_words == 22 and got[i].kept for i in range(2000))
    assert all(got[5000 + i].removed_words == 0 and got[5000 + i].kept for i in range(40))


@pytest.mark.parametrize("spread", [1, 16, 1 << 40])
def test_hot_lines_by_broadcast_or_shuffle_change_nothing(spark, monkeypatch, spread):
    rng = random.Random(9)
    shared = [_say(rng, 6) for _ in range(5)]
    rows = [(i % 300, "\n".join(x for k, x in enumerate(shared) if i % (k + 1) == 0) + "\n" + _say(rng, 22), ("s", "t", None)[i % 3]) for i in range(400)]
    monkeypatch.setattr(quality, "SPREAD", spread)
    lines, docs = {}, {}
    for _, text, host in rows:
        own = frozenset(text.split("\n")) - {""}
        docs.setdefault(host, set()).add(own)
        for x in own:
            lines.setdefault((host, x), set()).add(own)
    want = sorted(sum(6 for x in set(t.split("\n")) if x and len(lines[h, x]) > 20 and len(lines[h, x]) > 0.02 * len(docs[h])) for _, t, h in rows)
    assert sorted(r.removed_words for r in quality.assess(spark.createDataFrame(rows, SCHEMA)).collect()) == want and want[-1] > 20


def test_many_lines_are_linear_and_clean_takes_them_out(spark):
    """Texts of 30,000 shared lines each, 25 of them."""
    own = lambda i, j: " ".join(f"{i}x{j}y{k}" for k in range(7))
    say = "\n".join(f"Shared  line {i} of all" for i in range(30_000))
    rows = [(i, f"{say}\nshared line {i % 7} OF all\n\n" + "\n".join(own(i, j) for j in range(30_000)), "s") for i in range(25)]
    began = time.time()
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert {(r.removed_words, r.kept) for r in quality.assess(df).collect()} == {(150_005, True)}
    for r in quality.clean(df).collect():
        assert r.text == "\n" + "\n".join(own(r.doc_id, j) for j in range(30_000))
    assert time.time() - began < 90


def test_edges(spark):
    rng = random.Random(3)
    rows = [(None, None, None, 1, "a"), (1, "", "h", 2, "b"), (1, " \n\t", "h", 2, "b"), (2, "word " * 300_000, "h", 3, None), (3, "\n".join(_say(rng, 3) for _ in range(9)), None, 4, "d")]
    df = spark.createDataFrame([*rows, rows[4]], SCHEMA.replace("source string", "source string, key long, `over` string"))
    out = quality.clean(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [rows[4]] * 2
    got = sorted((r.n_words, r.n_repeat_words, r.kept) for r in quality.assess(df).collect())
    assert got == [(0, 0, False)] * 3 + [(27, 0, True)] * 2 + [(300_000, 300_000, False)]
    assert quality.assess(df.where("false")).count() == 0 and quality.clean(df.where("false")).count() == 0
