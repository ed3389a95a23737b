import random
import re
from collections import Counter, defaultdict

import pytest

from factloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, item string, value string, term string, n long"


def brute(docs, min_docs=3, ranks=200):
    docs = [((t or ""), lang or "", s or "") for t, lang, s in docs]
    low = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    terms = [[low(w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, _, _ in docs]
    out = set()
    for lang in {d[1] for d in docs}:
        own = [(s, w) for (_, x, s), w in zip(docs, terms) if x == lang]
        df, every, of = Counter(), Counter(), defaultdict(Counter)
        for s, w in own:
            df.update(set(w))
            every.update(w)
            of[s].update(w)
        kept = [w for w in df if df[w] >= min_docs]
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c[x] for x in kept) + len(kept)) for w in kept}
        p, q = {s: share(of[s]) for s in of}, share(every)
        f = lambda a, b: (a - b) ** 2 // b
        for s in of:
            pair = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in of if o != s]
            term = [(f(p[s][w], q[w]), w) for w in kept if of[s][w] and p[s][w] > q[w]]
            for part, rows, most in (("pair", pair, None), ("term", term, ranks)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(rows[:most])}
    return out


def documents(seed, n):
    rng = random.Random(seed)
    words = [w + x for w in ("a", "B", "é", "ÉÖ", "zz", "日本") for x in ("", "a", "b", "c", "é", "aaaa", "aaab", "aaaaz")]
    out = []
    for _ in range(n):
        own = rng.sample(words, rng.randint(1, len(words)))
        text = rng.choice((" ", "1", "\n", "_-")).join(rng.choice(own) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice((text, text, text, text, None, "")), rng.choice(("en", "en", "de", None)), rng.choice(("s", "S", "t", "u", "é", None))))
    return out + [("only once", "xx", "s"), ("0 1", "xx", "t"), (None, None, None), ("Ω" * 50000 + " end", "en", "s")]


def frame(spark, docs):
    return spark.createDataFrame([(i, *d, 1, "k", "i", "v", "t", 5) for i, d in enumerate(docs)], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed, few, ranks", [(1, 4096, 200), (2, 3, 4), (3, 1, 2), (4, 0, 7)])
def test_audit_is_exact(spark, seed, few, ranks):
    docs = documents(seed, 150)
    got = divergence.audit(frame(spark, docs), ranks=ranks, few=few)
    assert {tuple(r) for r in got.collect()} == brute(docs, ranks=ranks)


def test_repeated_rows_count_and_empty_tables_give_nothing(spark):
    docs = [("same words here", "en", "a")] * 3 + [("same other", "en", "b")]
    got = [tuple(r) for r in divergence.audit(frame(spark, docs)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs)
    assert divergence.audit(frame(spark, docs).where("false")).collect() == []


def test_top_by_passes_over_values_and_bytes(spark):
    """The k-th value is shared, and items share long prefixes; nothing is ranked before the last pass."""
    rng = random.Random(7)
    rows = [(g, v, p + str(i)) for g in "ab" for i in range(300) for v, p in [(rng.choice((0, 5, 5, 5, 70000, 2**40, 2**60)), rng.choice(("x" * 9, "x" * 8 + "é", "")))]]
    df = spark.createDataFrame(rows, "key string, value long, item string")
    hot = df.where("key = 'a'").select("key").distinct()
    for k in (1, 37, 150, 299, 300, 500):
        got = divergence.top(df, hot, k=k, few=0).collect()
        for g in "ab":
            want = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k]
            assert sorted(want) == sorted((r.key, r.value, r.item) for r in got if r.key == g)


def test_ranks_go_on_over_ranges(spark):
    rows = [(g, v % 7, f"i{v}") for g in "ab" for v in range(500)]
    got = divergence.ranked(spark.createDataFrame(rows, "g string, value long, item string").repartition(4), ["g"], "value", "item").collect()
    for g in "ab":
        want = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))
        assert [(r.value, r.item) for r in sorted((r for r in got if r.g == g), key=lambda r: r.rank)] == [r[1:] for r in want]
        assert sorted(r.rank for r in got if r.g == g) == list(range(1, 501))
