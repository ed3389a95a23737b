"""The suffix tree against a plain restatement with dictionaries, its growth, and its gain on held-out texts."""

import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import suffix_tree

START, END = "<start>", "<end>"


def brute(rows, depth, least, entry_least, gain, strength):
    """log10 probability of each text, and the contexts that are retained."""
    tokens = {i: [START, *t.split(), END] for i, t in rows}
    train = [tokens[i] for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(x for t in train for x in t[1:])
    n, v = sum(c.values()), len(c)
    counts = defaultdict(Counter)
    for t in train:
        for at in range(1, len(t)):
            for d in range(1, min(depth, at) + 1):
                counts[tuple(t[at - d : at])][t[at]] += 1
    total = {ctx: sum(x.values()) for ctx, x in counts.items()}
    held = {ctx: {w: k for w, k in x.items() if k >= entry_least} for ctx, x in counts.items() if total[ctx] >= least}
    held = {ctx: x for ctx, x in held.items() if x}

    def p(ctx, w):
        if not ctx:
            return (c[w] + 1) / (n + v + 1)
        own = held[ctx]
        return (own.get(w, 0) + (total[ctx] - sum(own.values()) + strength) * p(ctx[1:], w)) / (total[ctx] + strength)

    kept = set()
    for ctx, own in held.items():
        rest = total[ctx] - sum(own.values())
        g = sum(k * math.log(k / total[ctx] / p(ctx[1:], w)) for w, k in own.items())
        if rest:
            g += rest * math.log(rest / total[ctx] / (1 - sum(p(ctx[1:], w) for w in own)))
        if g > gain * len(own):
            kept |= {ctx[j:] for j in range(len(ctx))}

    def score(t):
        return sum(math.log10(p(max((s for d in range(1, min(depth, at) + 1) if (s := tuple(t[at - d : at])) in kept), key=len, default=()), t[at])) for at in range(1, len(t)))

    mass = [abs(sum(p(ctx, w) for w in c) + p(ctx, "never seen") - 1) for ctx in held]
    return {i: score(t) for i, t in tokens.items()}, kept, max(mass, default=0.0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    follows = {w: rng.sample("alpha beta gamma delta epsilon zeta eta theta".split(), 3) for w in "alpha beta gamma delta epsilon zeta eta theta".split()}
    out = []
    for i in range(160):
        words = [rng.choice(list(follows))]
        while len(words) < rng.randint(1, 40):
            words.append(f"rare{rng.randint(0, 60)}" if rng.random() < 0.08 else follows.get(words[-1], ["eta"])[0] if len(words) > 2 and words[-2] == "beta" else rng.choice(follows.get(words[-1], list(follows))))
        out.append((i, " ".join(words)))
    return [*out, (500, ""), (501, "unseen words only here")]


def scored(spark, rows, **options):
    return {r.doc_id: r.score for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **options).collect()}


@pytest.mark.parametrize("depth, least, entry_least, gain, strength", [(3, 12, 3, 0.3, 4.0), (2, 20, 5, 0.2, 20.0), (1, 400, 100, 1.0, 1.0)])
def test_scores(spark, rows, depth, least, entry_least, gain, strength):
    want, kept, off = brute(rows, depth, least, entry_least, gain, strength)
    assert off < 1e-9 and (max(map(len, kept), default=0) == depth if depth > 1 else not kept)
    for local in (1e-6, 0.05):  # nearly all terms added where the text is; most of them by the join
        got = scored(spark, rows, depth=depth, least=least, entry_least=entry_least, local_share=local, gain=gain, strength=strength)
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 for i in want), (depth, local)


def test_a_crowded_bitmap_changes_nothing(spark, rows, monkeypatch):
    want = scored(spark, rows, least=12, entry_least=3, local_share=0.05)
    monkeypatch.setattr(suffix_tree, "BITS", 7)
    got = scored(spark, rows, least=12, entry_least=3, local_share=0.05)
    assert all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_states_grow_and_beat_the_unigram_base(spark):
    states = []
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        model = suffix_tree.fit(docs.where(~suffix_tree.held_out(F.col("doc_id"))).select(F.col("text").cast("binary").alias("t")))
        states.append(sum(model.states()))
    assert 0 < states[0] < states[1] / 2 and states[1] < states[2] / 2, states
    base, score, n = suffix_tree.score(docs).where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    print(states, base / n, score / n)
    assert (score - base) / n > 0.15  # log10 a token


def test_a_state_stays_however_large_the_corpus(spark):
    """A context seen 110 times is a state beside 33 million other tokens, too."""
    few = spark.range(110).select(F.lit("left right").cast("binary").alias("t"))
    many = spark.range(64).select(F.repeat(F.lit("a "), 1 << 19).cast("binary").alias("t"))
    wanted = {"left", "right"}
    for texts in (few, few.union(many)):
        model = suffix_tree.fit(texts, depth=1)
        h = spark.createDataFrame([(w,) for w in sorted(wanted)], "t string").select(F.col("t").cast("binary"))
        own = [b for b in h.mapInArrow(suffix_tree._count_words, "h long, c long").where("c = 1").join(model.levels[0], F.col("h") == F.col("ctx")).collect()]
        assert len(own) == len(wanted), (model.tokens, model.states())


def test_counting_and_dealing_are_exact_and_need_no_stable_sort():
    rng = np.random.default_rng(5)
    key = rng.integers(0, 50_000, 200_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counter = suffix_tree._Counter(1, most=1 << 30)
    for part in np.array_split(key, 7):
        counter.add(part, part + np.uint64(1))
    got, times, after = counter.take()
    want, counts = np.unique(key, return_counts=True)
    assert (got == want).all() and (times == counts).all() and times.dtype == np.int64 and (after == want + np.uint64(1)).all()
    assert counter.take() is None
    counter.add(key[:0], key[:0])
    counter.add(key[:0], key[:0])
    assert not len(counter.take()[0])
    for most in (900, 1 << 17):
        rows = rng.integers(0, most, len(key))
        by = suffix_tree._by_row(rows, key, most)
        order = np.lexsort((key, rows))
        assert (rows[by] == rows[order]).all() and (key[by] == key[order]).all() and (np.sort(by) == np.arange(len(key))).all()

    def took(f):
        f()
        began = time.perf_counter()
        for _ in range(5):
            f()
        return time.perf_counter() - began

    assert took(lambda: suffix_tree._Counter(0).add(key)) < 0.6 * took(lambda: np.unique(key, return_index=True, return_counts=True))


def test_what_is_shuffled_for_a_pair_is_small(spark):
    """400,000 tokens of 2,000 frequent words, nearly all pairs different: rows of hashes and counts took about 14 bytes each."""
    rng = np.random.default_rng(8)
    texts = [(" ".join(f"w{x}" for x in rng.integers(0, 2_000, 1_000)),) for _ in range(400)]
    docs = spark.createDataFrame(texts, "t string").repartition(4).select(F.col("t").cast("binary").alias("t")).cache()
    docs.count()

    def written():
        spark.range(10).count()
        time.sleep(1)
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite()

    before = written()
    model = suffix_tree.fit(docs, depth=1)
    took = written() - before
    docs.unpersist()
    assert model.tokens == 400_400 and 0 < took < 5 * 400_000, took


def test_blocks_of_counts_come_back_whole():
    rng = np.random.default_rng(9)
    for high in (1, 1 << 20, 1 << 63):
        for n in (0, 1, 1000):
            columns = [np.sort(rng.integers(0, high, n, np.uint64)), rng.integers(0, 1 << 64, n, np.uint64), np.ones(n, np.uint64)]
            size, block = suffix_tree.pack(columns)
            assert all((a == b).all() and len(a) == n for a, b in zip(suffix_tree.unpack(size, block, 3), columns))
    for keys in (1, 2, 3, 1000, 1 << 16):
        coding = suffix_tree.Coding(rng.integers(0, 1 << 64, keys, np.uint64))
        parts = next(m for m in (4, 3, 2) if coding.fits(m))
        assert parts == 4 and (keys < 1 << 16 or not coding.fits(5))
        of = [coding.lookup.keys[rng.integers(0, keys, 500)] for _ in range(parts)]
        code = coding.encode([coding.lookup.find(x) for x in of])
        assert all((a == b).all() for a, b in zip(coding.decode(code, parts), of))
