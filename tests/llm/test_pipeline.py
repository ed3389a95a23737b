"""The pipeline against plain Python, stage by stage and as a whole."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from test_lines import brute as brute_lines
from test_simhash import brute_kept

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def changed(row, text):
    return row if text == row[1] else (row[0], text, row[2], row[3], len(text))


def quality(rows, items):
    own, count, whole, out = [], defaultdict(set), defaultdict(set), []
    for i, text, _, host, _ in rows:
        own.append([lower(" ".join(split(x))) for x in (text or "").split("\n") if split(x)])
        for x in own[-1]:
            count[host, x].add(frozenset(own[-1]))
            whole[host].add(frozenset(own[-1]))
    for row, lines in zip(rows, own):
        i, text, _, host, _ = row
        words = split(text)
        windows = Counter(tuple(words[a : a + 8]) for a in range(len(words) - 7))
        again = {b for a in range(len(words) - 7) if windows[tuple(words[a : a + 8])] > 1 for b in range(a, a + 8)}
        over = {x for x in set(lines) if len(count[host, x]) > 20 and len(count[host, x]) > len(whole[host]) * 0.02}
        removed = sum(len(x.split(" ")) for x in lines if x in over)
        if len(words) >= 20 and 100 * len(again) <= 30 * len(words) and len(words) - removed >= len(words) * 0.3:
            out.append(changed(row, "\n".join(x for x in text.split("\n") if lower(" ".join(split(x))) not in over)) if over else row)
    return out


def line_dedup(rows, items):
    texts = brute_lines([(r[0], r[1]) for r in rows if r[1] is not None])
    return [changed(r, texts.get(r[0])) if r[1] is not None else r for r in rows]


def near_dedup(rows, items):
    groups = brute_kept([(r[0], r[1]) for r in rows], 23)
    least = {min(i for i, _ in own) for own in groups.values()}
    return [r for r in rows if r[0] in least]


def decontamination(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    tests = {tuple(w[a : a + 10]) for w in map(words, items) for a in range(max(1, len(w) - 9)) if w}
    return [r for r in rows if not any(tuple(w[a : a + n]) in tests for w in [words(r[1])] for n in {len(t) for t in tests} for a in range(len(w) - n + 1))]


def mixture(rows, items):
    size, per = {r[0]: len(split(r[1])) for r in rows}, Counter()
    for r in rows:
        per[r[3]] += size[r[0]]
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        left = sum(per.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 3 * per[s]}
        target |= {s: 3 * per[s] for s in full} if full else share
        free = free - full if full else set()
    out = []
    for s in names:
        budget, before = math.floor(target[s] + 0.5), 0
        epochs = budget // per[s] if per[s] else 0
        for r in sorted((r for r in rows if r[3] == s), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            n = size[r[0]]
            out.append((r[0], s, n, per[s], round(target[s], 6), epochs * n + max(0, min(n, budget - epochs * per[s] - before))))
            before += n
    return out


BRUTE = [quality, line_dedup, near_dedup, decontamination, mixture]


def _documents():
    rng = random.Random(23)
    vocabulary = ["".join(rng.choice("abcdefghijklmnoprstuvwéü") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    banner, passage, item = "Accept ALL cookies " + say(14), say(60), say(25)
    block = "\n".join(say(9) for _ in range(7))
    rows = []
    for i in range(190):
        body = "\n".join(say(rng.randint(5, 28)) for _ in range(rng.randint(2, 7)))
        if i % 4 == 0:
            body = f"{banner}\n{body}"
        if i % 12 == 1:
            body += f"\n{passage}"
        if i % 12 == 5:
            body = f"{body}\n{block}\n{say(8)}"
        if i % 25 == 7:
            body += "\n" + say(4) + " " + " ".join(item.split(" ")[3:18]) + " " + say(3)
        rows.append([i, body, "en", ("a", "a", "a", "b", None)[i % 5] if i % 4 else "a", 0])
    long_ = " ".join(say(200).split(" "))
    rows += [[300 + i, f"{long_} {say(1)}", "en", "b", 0] for i in range(4)] + [[400, rows[9][1], "de", "a", 0], [401, None, None, None, None], [402, "", "en", "c", 0], [403, " \n\t", "en", "c", 0], [404, f"{banner}\n{say(4)}", "en", "a", 0], [405, (say(9) + " ") * 1 + "x y z w v u t s " * 12, "en", "a", 0]]
    return [tuple([*r[:4], None if r[4] is None else len(r[1])]) for r in rows], [item, say(4), "", None]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, items = _documents()
    folder = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, items


def _plain(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_each_stage_on_all_that_its_predecessor_kept(spark, tables):
    folder, rows, items = tables
    kept = []
    for (_, stage), brute in zip(corpus_pipeline.STAGES, BRUTE):
        want = sorted(brute(rows, items))
        assert _plain(stage(spark, spark.createDataFrame(rows, SCHEMA), folder)) == want
        kept.append((len(rows), len(want), sum(a != b for a, b in zip(sorted(rows), want))))
        rows = [tuple(r) for r in want]
    # Each stage had something to do: rejected documents, removed lines, copies, hit documents.
    assert kept[0][1] < kept[0][0] and kept[1][1] == kept[1][0] and kept[1][2] > 10
    assert kept[2][1] < kept[2][0] and kept[3][1] < kept[3][0] and kept[4][1] == kept[4][0]


def test_the_whole_run(spark, tables):
    folder, rows, items = tables
    for brute in BRUTE:
        rows = brute(rows, items)
    assert _plain(corpus_pipeline.run(spark, folder)) == sorted(rows)
