import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from factloom.llm import chat, decontaminate, langid, lines, mixing, pii, quality, simhash, suffix_tree, urls
from factloom.llm.common import NOT_SPACE, Lookup, Tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, host string"
rng = random.Random(5)
WORDS = ["the", "of", "and", "Ändern", "über", "alpha", "beta", "gamma", "x1", "y2", "zeta", "rho", "été", "12", "a-b"]


def words(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [words(rng.randint(1, 60)) for _ in range(12)]
    near = base[0] + " extra"
    return [*base, base[0], base[1], near, None, "", " \n\t", "one", "a\nb\n" + base[2] + "\nb", base[3] + "\n" + base[3], "Ω" * 3000 + " " + words(400)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], (None, "s1", "s2", "s3")[i % 4], 0, 1.0, "k", "h") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], (None, "no id at all", None, None, None, None, None, None)], SCHEMA)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_print(t):
    w = split(lower(t))
    sh = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_is_exact(docs, texts):
    got = simhash.near_duplicates(docs, block=4).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [brute_print(t) for _, t in rows]
    comp = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    wanted = []
    for (i, _), f, c in zip(rows, prints, comp):
        ids = [x for (x, _), d in zip(rows, comp) if d == c and x is not None]
        wanted.append((i, f"{f:016x}", min(ids) if ids else None))
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)


def test_anchors_lose_no_link():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**64, 3000, dtype=np.uint64)
    b = a.copy()
    for k in range(4):
        b ^= np.uint64(1) << r.integers(0, 64, len(a), dtype=np.uint64)
    ka, pa = simhash.anchors_of(a[:, None])
    kb, pb = simhash.anchors_of(b[:, None])
    left, right = [set() for _ in a], [set() for _ in a]
    for s, k, p in ((left, ka, pa), (right, kb, pb)):
        for x, i in zip(k.tolist(), p.tolist()):
            s[i].add(x)
    assert all(x & y for x, y in zip(left, right)) and max(map(len, left)) <= 34


def test_quality_counts(docs):
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in quality.assess(docs).collect())

    def brute(t):
        w = split(t)
        n = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        ls = [x for x in (t or "").split("\n") if split(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), len(hit)

    assert got == sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect())


def test_boilerplate_depletes_but_copies_do_not(spark):
    shared = "Accept all cookies and read our privacy notice before you go on to the site that you wanted to see today please"
    rows = [(i, f"{shared}\n{words(4)} {i}", "en", "s", 0, None, None, None) for i in range(40)] + [(100 + i, "the same whole text " + "of many words " * 6, "en", "s", 0, None, None, None) for i in range(40)]
    got = {r.doc_id: r for r in quality.assess(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[3].kept and not got[3].base_failed and got[100].removed_words == 0


def test_decontamination_is_exact(spark, docs):
    texts = [r.text for r in docs.collect()]
    long_ = [t for t in texts if len(split(t)) > 14]
    items = [(1, long_[0]), (2, " ".join(split(long_[1])[2:13])), (3, "gamma x1"), (4, None), (5, ""), (6, "never seen words"), (None, "one"), (1, "zeta rho"), (7, " ".join(split(long_[2])[:5]))]
    got = decontaminate.hits(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    def brute(t):
        w, hit, ids = tokens(t), set(), set()
        for i, x in items:
            v = tokens(x)
            n = min(10, len(v))
            for a in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[a : a + n]:
                        hit |= set(range(p, p + n))
                        ids.add("" if i is None else str(i))
        return len(w), len(hit), sorted(ids)

    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r.item_ids)) for r in got) == sorted(str((r.doc_id, *brute(r.text))) for r in docs.collect())


def test_base_spans_are_the_rules():
    def brute(t):
        out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
        digits = lambda s: "".join(c for c in s if c.isdigit())
        out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
        out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m.group())) <= 15]
        return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))

    for _ in range(4000):
        t = "".join(rng.choice("aZ0159..@@+- ()é%_") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@" * 10_000) == []


def test_pii_adds_spans_and_keeps_base(spark):
    t = "call me at phone (212) 555-0143 or mail jo (at) example (dot) com, host 10.0.0.1, order 12 34"
    r = pii.detect(spark.createDataFrame([(1, t), (2, None)], "doc_id long, text string"), redact=True).orderBy("doc_id").collect()
    assert "phone:17:31" in r[0].spans and "email:" in r[0].spans and r[0].n_ip == 1 and "[PHONE]" in r[0].redacted
    assert (r[1].spans, r[1].base_sha256) == ("", hashlib.sha256(b"").hexdigest())


def test_base_score_and_distribution(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    token = lambda t: [*split(lower(t)), "<end>"]
    c = Counter(x for i, t in rows if not out(i) for x in token(t))
    n, v = sum(c.values()), len(c)
    wanted = {str((i, out(i), len(token(t)), sum(c[x] > 0 for x in token(t)), n)): sum(math.log10((c[x] + 1) / (n + v + 1)) for x in token(t)) for i, t in rows}
    for share in (1e-6, 0.9):  # counts looked up where the text is, and by join
        got = {str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)): (r.base_score, r.score) for r in suffix_tree.score(docs, least=5, entry_least=2, local_share=share).collect()}
        assert got.keys() == wanted.keys()
        assert all(abs(got[k][0] - wanted[k]) < 1e-6 and got[k][1] < 0 for k in wanted)


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "back\\slash <\\|", "", None, "\\n [\\INST]"]
    rows = [(c, i, r, t) for c in (1, None) for i, (r, t) in enumerate(zip(["user", "assistant", "a\nb", None, "assistant", "assistant"], said))] + [(1, 0, "user", said[0])]
    out = chat.render(chat.fold(chat.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    got = {r.conv_id: r for r in out.select("conv_id", chat.parse(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    for c in (1, None):
        own = sorted(((i, r or "", t or "") for x, i, r, t in rows if x == c))
        assert [(t.role, t.text) for t in got[c].turns] == [(r, t) for _, r, t in own]
        assert got[c].loss == "".join(t for _, r, t in own if r == "assistant")


def test_a_delta_at_its_message_s_number_counts(spark):
    e = [(1, 1, "message", "a", "user", "x"), (1, 1, "delta", "a", "user", "y"), (2, None, "message", "a", "user", "p"), (2, None, "delta", "a", "user", "q"), (2, 3, "delta", "a", "user", "r"), (3, 2, "edit", "a", "user", "new"), (3, 1, "message", "a", "user", "old"), (3, None, "delta", "a", "user", "lost"), (3, 2, "delta", "a", "user", "!")]
    df = spark.createDataFrame(e, "conv_id long, seq long, kind string, message string, role string, text string")
    assert {r.conv_id: r.text for r in chat.fold(df).collect()} == {1: "xy", 2: "pqr", 3: "new!"}
    assert chat.render(chat.fold(df.where("false"))).count() == 0


def test_chat_folds_deltas_edits_and_regenerations(spark):
    e = [(1, 1, "message", "a", "user", "hi"), (1, 2, "message", "b", "assistant", "he"), (1, 3, "delta", "b", "assistant", "llo"), (1, 4, "edit", "a", "user", "hi!"), (1, 5, "regenerate", "b", "assistant", ""), (1, 6, "delta", "b", "assistant", "new "), (1, 7, "delta", "b", "assistant", "one")]
    out = chat.fold(spark.createDataFrame(e, "conv_id long, seq long, kind string, message string, role string, text string")).orderBy("turn_order").collect()
    assert [(r.role, r.text) for r in out] == [("user", "hi!"), ("assistant", "new one")]


def test_mixing_meets_budgets(docs):
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        t = by.setdefault(r.source, [r.target, r.source_size, 0, 0])
        t[2] += r.taken
        t[3] += r.size
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(t[2] - t[0]) <= 0.5 and t[1] == t[3] for t in by.values())
    assert abs(sum(t[0] for t in by.values()) - sum(t[1] for t in by.values())) < 1e-6
    assert all(t[0] <= 3 * t[1] + 1e-9 for t in by.values())


def test_line_chunks(spark):
    passage = " ".join(f"w{i}" for i in range(55))
    short = "\n".join(f"line {i} of a passage with six words" for i in range(8))
    rows = [(1, f"a b c\n{passage}\nd e f"), (2, f"{passage}\nother"), (3, "x y\n" + short), (4, short + "\nz"), (5, None), (6, ""), (None, passage)]
    out = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].text == rows[0][1] and out[2].text == "other" and out[None].text == "" and out[5].text is None and out[6].text == ""
    assert out[4].text == "z"
    assert out[3].text == rows[2][1]


def test_languages_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out and lang_pred <> 'und'")
    n, good = got.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and good / n > 0.97


def test_urls(spark):
    want = {
        "http://a.Example.com/en/x?q": ("a.example.com", "/en/x", "example.com/en/", "block"), "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"), "http://x.com": ("x.com", "", None, "allow"),
        "http://x.com/": ("x.com", "/", "com/", "allow"), "http://b.net/fr/1": ("b.net", "/fr/1", "net/fr/", "block"), "nothing": ("", "", None, "allow"), "http://cheappillsspam.org/x": ("cheappillsspam.org", "/x", None, "block"), "http://notcom/": ("notcom", "/", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(want)] + [(99, None, None)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values()) and got[99] == ("", "", None, "allow")


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (pii.detect(none), simhash.near_duplicates(none), quality.assess(none), langid.identify(none), lines.dedup_lines(none), mixing.mix(none), suffix_tree.score(none), decontaminate.hits(none, items), urls.judge(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert df.count() == 0


def test_tokens_and_lookup():
    data = "Ab\x0bcd é  x".encode() + "y z".encode()
    t = Tokens(np.frombuffer(data, np.uint8), np.array([0, len(data) - 3, len(data)]), NOT_SPACE)
    assert [data[a:b].decode().lower() for a, b in zip(t.start, t.end)] == ["ab", "cd", "é", "x", "y", "z"] and t.counts().tolist() == [4, 2]
    keys = np.unique(np.random.default_rng(2).integers(0, 2**64, 5000, dtype=np.uint64))
    look = Lookup(keys[::2])
    assert (look.find(keys)[1::2] == -1).all() and (look.keys[look.find(keys[::2])] == keys[::2]).all()


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 50 and len(corpus_pipeline.STAGES) == 5
