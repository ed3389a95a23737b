"""Chunks of lines against a plain restatement in Python, and passages of every shape."""

import random
import re
import time
from collections import Counter

import pytest

from factloom.llm import lines

SHARED = "\n".join(f"this shared line number {i} is the same wherever it is met" for i in range(6))


def _count(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def brute(rows, min_words=lines.MIN_WORDS, alone=lines.ALONE):
    """Texts without passages that an earlier place holds; ids are distinct and not null.

    A passage is any stretch of lines of two lines and min_words words or more, or a line of ``alone`` words; lines without
    words do not count, and go where both neighbours go as parts of passages."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        ls = text.split("\n")
        said = [p for p, line in enumerate(ls) if _count(line)]
        words, again, own = [_count(ls[p]) for p in said], set(), []
        for a in range(len(said)):
            total = 0
            for z in range(a, len(said)):
                total += words[z]
                if (z > a and total >= min_words) or (z == a and total >= alone):
                    own.append((a, z, tuple(ls[p] for p in said[a : z + 1])))
        for a, z, passage in sorted(own):  # by place: an earlier place in the same text counts, too
            if passage in seen:
                again |= set(range(a, z + 1))
            seen.add(passage)
        gone = {said[j] for j in again} | {p for j in again if j + 1 in again for p in range(said[j], said[j + 1])}
        out[i] = "\n".join(x for j, x in enumerate(ls) if j not in gone) if gone else text
    return out


def _texts():
    rng = random.Random(11)
    own = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(rng.choice((0, 1, 3, 8, 12, 40)))) for _ in range(60)]
    for i in range(150):
        picked = [rng.choice(own) for _ in range(rng.randint(0, 6))]
        start = rng.randrange(50)
        yield i, "\n".join(picked + (SHARED.split("\n") if i % 3 else []) + own[start : start + rng.randint(0, 8)])


def test_chunks_against_brute_force(spark):
    rows = list(_texts())
    want = brute(rows)
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want and sum(got[i] != t for i, t in rows) > 50


@pytest.mark.parametrize("spread, prefixes", [(1, 1 << 20), (16, 64), (1024, 1)])
def test_parts_of_a_hot_chunk_and_residues_change_nothing(spark, monkeypatch, spread, prefixes):
    rows = list(_texts())
    monkeypatch.setattr(lines, "SPREAD", spread)
    monkeypatch.setattr(lines, "PREFIXES", prefixes)
    assert {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute(rows)


def test_passages_of_every_shape_go_whole(spark):
    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(7)) for _ in range(n))
    rows, shapes = [], [(1, 55), (2, 28), (3, 18), (5, 11), (8, 7), (20, 3)]
    for k, (n, w) in enumerate(shapes):
        passage = "\n".join(say(w) for _ in range(n))
        rows += [(10 * k + j, f"{say(9)}\n{passage}\n{say(9)}") for j in range(4)]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        own = text.split("\n")
        assert got[i] == (text if i % 10 == 0 else f"{own[0]}\n{own[-1]}")


def test_edges(spark):
    long_ = "\n".join(f"line {i} of a very long text that nobody else has" for i in range(60_000))
    rows = [(None, "x", 1, 7, "a"), (1, None, None, None, None), (2, "", 0, 8, "b"), (3, "\n\n", 2, 9, "c"), (4, long_, len(long_), 1, "d"), (5, long_, len(long_), 1, "e"), (6, "x", 1, 1, "f"), (6, "x", 1, 1, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, key long, `runs.again` string")
    out = lines.dedup_lines(df)
    assert out.columns == df.columns
    got = Counter((r[0], r[1], r[2], r[3], r[4]) for r in out.collect())
    assert got == Counter((*r[:1], "" if r[0] == 5 else r[1], 0 if r[0] == 5 else r[2], *r[3:]) for r in rows)
    assert lines.dedup_lines(df.where("false")).count() == 0


def test_pairs_met_in_different_texts_are_no_passage(spark):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve up down", "left right here there then now ever")
    rows = [(1, f"{a}\n{b}"), (2, f"{b}\n{c}"), (3, f"{a}\n{b}\n{c}")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows) == brute(rows)
    rows.append((4, f"x\n{a}\n \n{b}\n\n{c}\n\ny"))  # all three lines again: 21 words
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and got[4] == "x\n\ny"


def test_work_is_linear_in_lines(spark):
    say = lambda n: "\n".join(f"line {i} of many short ones" for i in range(n))
    took = []
    for n in (1_000, 100_000):
        df = spark.createDataFrame([(1, say(n)), (2, say(n) + "\nend")], "doc_id long, text string")
        began = time.time()
        assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()} == {1: say(n), 2: "end"}
        took.append(time.time() - began)
    assert took[1] < took[0] + 30


def test_lines_do_not_travel(spark, monkeypatch):
    """Two rows that share a line of a megabyte: what is cut and joined on the way is small."""
    rng, sent, plain = random.Random(8), [], lines.cut
    rows = [(i, f"own {i}\n" + " ".join(f"{rng.getrandbits(40):x}" for _ in range(100_000))) for i in (1, 2)]
    rows[1] = (2, rows[1][1].split("\n")[0] + "\n" + rows[0][1].split("\n")[1])
    monkeypatch.setattr(lines, "cut", lambda df: sent.append(plain(df)) or sent[-1])
    assert {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1: rows[0][1], 2: "own 2"}
    assert len(sent) > 1 and sum(df.toArrow().nbytes for df in sent) < 100_000
