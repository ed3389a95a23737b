"""Two lanes: fingerprints, parts and anchors by plain enumeration, kept rows, and recall at the wanted similarity."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from factloom.llm import simhash

M = (1 << 64) - 1


def mixed(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & M
    h = (h ^ h >> 27) * 0x94D049BB133111EB & M
    return h ^ h >> 31


def print_of(text, k=5):
    """All 128 bits as one number."""
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").split()
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    h = [x | mixed(x ^ 0x9E3779B97F4A7C15 >> 1) << 64 for x in h]
    return sum(1 << b for b in range(128) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts(p):
    words = [p >> 32 * i & 0xFFFFFFFF for i in range(4)]
    return words + [sum((p >> (4 * j + i) & 1) << j for j in range(32)) for i in range(4)]


def anchors(x):
    """Words within 2 of x whose first 31 bits are in the Hamming code: the places of their ones XOR to 0."""
    near = {x} | {x ^ 1 << i for i in range(32)} | {x ^ 1 << i ^ 1 << j for i, j in combinations(range(32), 2)}
    return {y for y in near if not np.bitwise_xor.reduce([i + 1 for i in range(31) if y >> i & 1] or [0])}


def linked(prints, radius):
    """Pairs that meet at an anchor of one of the parts and differ in ``radius`` bits or fewer."""
    at = defaultdict(set)
    for i, p in enumerate(prints):
        for n, x in enumerate(parts(p)):
            for y in anchors(x):
                at[n, y].add(i)
    return {(i, j) for own in at.values() for i in own for j in own if i < j and (prints[i] ^ prints[j]).bit_count() <= radius}


def test_parts_and_anchors():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 2**64, (40, 2), dtype=np.uint64)
    whole = [int(a) | int(b) << 64 for a, b in fp]
    assert [[int(p[i]) for p in simhash.parts_of(fp)] for i in range(40)] == [parts(w) for w in whole]
    keys, places = simhash.anchors_of(fp)
    got = defaultdict(set)
    for k, p in zip(keys.tolist(), places.tolist()):
        got[p].add((k >> 40, k & 0xFFFFFFFF))
    assert all(got[i] == {(n, y) for n, x in enumerate(parts(w)) for y in anchors(x)} for i, w in enumerate(whole))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    say = lambda n: [rng.choice("".join(map(chr, range(97, 123)))) * 2 + str(rng.randint(0, 99)) for _ in range(n)]
    out = []
    for g in range(14):
        base = say(150)
        for c in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.choice((0, 1, 2, 4, 30))):
                own[rng.randrange(150)] = "Zz"
            out.append(" ".join(own))
    return [(i, t) for i, t in enumerate(out)] + [(300, None), (301, ""), (302, " \n"), (None, out[0]), (5, "another text of id five here now"), (7, out[7]), (7, out[7])]


def brute_kept(rows, radius):
    prints = [print_of(t) for _, t in rows]
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in [*linked(prints, radius), *((i, j) for j in range(len(rows)) for i in range(j) if prints[i] == prints[j])]:
        root[find(j)] = find(i)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    return groups


@pytest.mark.parametrize("block", [3, 2048])
def test_one_of_each_group_stays(spark, rows, block):
    radius = simhash.radius_of(0.8)
    assert radius == 23
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, root string")
    got = simhash.keep_one(df.repartition(3), block=block)
    assert got.columns == df.columns
    groups = brute_kept(rows, radius)
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == len(groups) < len(rows) - 20
    for own in groups.values():
        least = min((i is None, i) for i, _ in own)
        assert sum((r in own) and (r[0] is None, r[0]) == least for r in set(kept)) == 1
    assert simhash.keep_one(df.where("false")).count() == 0


def test_recall_at_the_similarity(spark):
    """Of pairs of different texts with a Jaccard similarity of 0.8 or more, the share that ends in one component."""
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null").select("doc_id", "text")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(d, k=5, radius=simhash.radius_of(0.8), lanes=2).collect()}
    sets, at = {}, defaultdict(list)
    for i, t in {t: (i, t) for i, t in d.collect()}.values():
        w = t.lower().split()
        s = {" ".join(w[a : a + 5]) for a in range(len(w) - 4)}
        if len(s) > 15:
            sets[i] = s
            for x in sorted(xxhash.xxh64_intdigest(y) for y in s)[:8]:
                at[x].append(i)
    pairs = {(a, b) for own in at.values() if len(own) < 60 for a, b in combinations(sorted(own), 2)}
    seen = Counter()
    for a, b in pairs:
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        band = 0.9 if j >= 0.9 else 0.8 if j >= 0.8 else 0.6 if j >= 0.6 else 0.3 if j >= 0.3 else 0
        seen[band, got[a] == got[b]] += 1
    print(sorted(seen.items()))
    share = lambda b: seen[b, True] / max(1, seen[b, True] + seen[b, False])
    assert share(0.9) >= 0.9 and share(0.8) >= 0.6 and share(0) < 0.01


@pytest.mark.parametrize("block, sample", [(3, 16), (2048, 1)])  # a shared shingle in blocks, in any order; frequent shingles last
def test_no_pair_of_the_similarity_is_left_out(spark, monkeypatch, block, sample):
    monkeypatch.setattr(simhash, "SAMPLE", sample, raising=False)
    rng = random.Random(5)
    say = lambda n: [str(rng.randint(0, 9999)) for _ in range(n)]
    passage, texts = say(8), []
    for _ in range(60):
        base = say(12) + passage + say(12)
        texts += [base, say(1) + base[1:-2] + say(2), [*base[:-2], *say(6)]]  # similarities of 0.81 and below 0.8
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, "two words"), (901, "TWO  words"), (902, "two"), (903, "a b a b a b a b a b"), (904, "a b a b a b a b")]
    sets = [{" ".join(w[a : a + 5]) for a in range(max(1, len(w) - 4))} for w in (t.lower().split() for _, t in rows)]
    near = {(a, b) for a, b in combinations(range(len(rows)), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    prints = [print_of(t) for _, t in rows]
    by_prints = linked(prints, simhash.radius_of(0.8))
    assert len(near - by_prints) > 5
    root = list(range(len(rows)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in near | by_prints:
        root[max(find(i), find(j))] = min(find(i), find(j))
    want = [rows[i][0] for i in range(len(rows)) if find(i) == i]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), block=block)
    assert sorted(r.doc_id for r in got.collect()) == want
