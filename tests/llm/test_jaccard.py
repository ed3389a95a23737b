import random
import re

import numpy as np
import pytest

from factloom.llm import jaccard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, n long"


def shingles(t, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda i: i if comp[i] == i else find(comp[i])
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                comp[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
    return w


def corpus(seed):
    """Bases with copies at many distances, chains of edits, a passage that all share, and short and empty texts."""
    rng = random.Random(seed)
    some = [f"w{i}" for i in range(400)]
    passage = [rng.choice(some) for _ in range(25)]
    out = []
    for _ in range(12):
        base = [rng.choice(some) for _ in range(rng.randint(20, 120))]
        out.append(base)
        for _ in range(rng.randint(0, 10)):
            out.append(edited(rng, base, rng.randint(0, 4)))
        for _ in range(rng.randint(0, 6)):
            out.append(edited(rng, out[-1], 1))
        out.append(base[: rng.randint(10, len(base))] + passage)
    out += [passage, passage + ["x"], ["a", "b"], ["A", "b"], ["a"], ["one", "two", "three", "four", "five"]]
    rows = [(i * 3 % 1009, rng.choice((" ", "\n", " \t ")).join(w)) for i, w in enumerate(out)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), rows[3], (rows[4][0], "another text of a repeated id here"), (None, rows[5][1]), (None, "nowhere else at all to be found")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0, "k", 1, 2) for d, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("seed, stars, block", [(1, 2, 2048), (2, 0, 2)])
def test_every_link_is_found(spark, seed, stars, block):
    rows = corpus(seed)
    got = jaccard.join(frame(spark, rows), stars=stars, block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)


def test_other_similarity(spark):
    rows = corpus(5)
    got = jaccard.join(frame(spark, rows), similarity=0.55).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows, 55)


def test_just_at_and_below_the_limit(spark):
    """Sets of 8 and 10 that share 8 (0.8 exactly), and of 8 and 11."""
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w[:12])), (2, " ".join(w[:14])), (3, " ".join(w[20:32])), (4, " ".join(w[20:35])), (5, " ".join(w[:4])), (6, "W0 w1\tw2\nw3")]
    got = {r.doc_id: r.component_id for r in jaccard.join(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_a_group_of_near_copies_in_chains(spark):
    """Each text is linked with its neighbours only; a star finds few of the links."""
    w = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(w[i * 2 : i * 2 + 60])) for i in range(100)]
    got = jaccard.join(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert {r.component_id for r in got} == {0}


def test_near_copies_below_the_limit_do_not_meet_in_pairs(spark, monkeypatch):
    """Texts with three edits each share most shingles, but two of them differ in six places: 60 of 146 shingles a side and more."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(100):
        w = list(base)
        for at in rng.sample(range(5, 145, 10), 3):
            w[at + rng.randrange(3)] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    met, meetings = [], jaccard._meetings
    monkeypatch.setattr(jaccard, "_meetings", lambda *a: met.append(meetings(*a)) or met[0])
    got = jaccard.join(frame(spark, rows), stars=0).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    sets = [shingles(t) for _, t in rows]
    similar = sum(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert met[0].count() < similar + 1000  # of 4950


def test_a_text_with_its_near_copies_is_joined_in_a_star(spark, monkeypatch):
    """Copies with up to five edits of one text: those with three lie just within the limit of it and beyond that of most others."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(1000, " ".join(base)), (1001, "w70 w71 w72 w73 w74 w75 w76")]
    for i in range(150):
        w = list(base)
        for at in rng.sample(range(5, 145, 10), rng.randint(1, 5)):
            w[at + rng.randrange(3)] = f"e{i}x{at}"
        rows.append((i, " ".join(w)))
    met, meetings = [], jaccard._meetings
    monkeypatch.setattr(jaccard, "_meetings", lambda *a: met.append(meetings(*a)) or met[0])
    got = jaccard.join(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert met[0].count() < 50


def test_counts_cover_every_text(spark):
    rows = corpus(4)
    table = jaccard.frequencies(frame(spark, rows).selectExpr("cast(text as binary) t"))
    assert table.sum() == sum(len(shingles(t)) for _, t in rows)
    rng = np.random.default_rng(1)
    for density in (0.001, 0.2, 0.9):
        chunk = np.where(rng.random(jaccard.CHUNK) < density, rng.integers(1, 2**40, jaccard.CHUNK), 0)
        assert (jaccard._unpacked(jaccard._packed(chunk)) == chunk).all()
        assert (jaccard._unpacked(jaccard._packed(chunk % 1000)) == chunk % 1000).all()


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i % 9973}x{i % 7}" for i in range(60000))
    rows = [(1, long), (2, long + " end"), (3, "short")]
    assert sorted((r.doc_id, r.component_id) for r in jaccard.join(frame(spark, rows)).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert jaccard.join(frame(spark, rows).where("false")).collect() == []
