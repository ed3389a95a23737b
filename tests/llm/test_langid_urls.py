"""The kernel, the ridge, the word search and the Bayes verdicts against plain restatements."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from factloom.llm import langid, urls

SAID = {"en": "the quick brown fox and the lazy dog went there with them", "de": "der schnelle braune Fuchs und die faule Hündin über Äcker", "el": "η γρήγορη καφέ αλεπού και το τεμπέλικο σκυλί", "zh": "那只敏捷的棕色狐狸跳过了懒狗然后睡觉"}


def _texts():
    rng = random.Random(4)
    for lang, said in SAID.items():
        words = said.split() if " " in said else list(said)
        for _ in range(30):
            yield " ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) + rng.choice(["", "!", " 12", "\n"]), lang


def _grams(text):
    """n-grams as strings; anything but letters is a blank, runs of blanks are one."""
    t = re.sub(r" +", " ", "".join(c if c.isalpha() else " " for c in f" {text.lower()} "))
    return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


def test_kernel_and_ridge_against_sets():
    texts, labels = zip(*_texts())
    model = langid.KernelRidge(list(texts), list(labels), landmarks=12)
    order = [[i for i, x in enumerate(labels) if x == l] for l in model.labels]
    pick = [order[k % 4][k // 4] for k in range(12)]
    marks = [_grams(texts[i]) for i in pick]
    vocabulary = set().union(*marks)
    assert abs(model.width - len(vocabulary)) <= 1  # two n-grams may share a place
    k = np.array([[len(_grams(t) & m) / math.sqrt(max(1, len(_grams(t) & vocabulary)) * len(m)) for m in marks] for t in texts])
    assert np.abs(k - model.kernel(list(texts))).max() < 0.02
    w = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(w)
    ok = values > 1e-8 * values.max()
    z = np.hstack([k @ vectors[:, ok] / np.sqrt(values[ok]), np.ones((len(k), 1))])
    y = np.array([[1.0 if l == m else -1.0 for m in model.labels] for l in labels])
    scores = z @ np.linalg.solve(z.T @ z + langid.RIDGE * len(z) * np.eye(z.shape[1]), z.T @ y)
    assert np.abs(scores - model.scores(list(texts))).max() < 0.05 and (scores.argmax(1) == model.scores(list(texts)).argmax(1)).all()


def test_edges_of_languages(spark):
    rows = [(i, t, l, 1) for i, (t, l) in enumerate(_texts())] + [(900, "½ ² ① 12 _", "en", 1), (901, None, "en", 1), (902, "", None, 1), (None, "der Fuchs und die Hündin", None, 1), (903, "那只懒狗", None, 1), (904, "the fox " * 100_000, None, 1)]
    rows += rows[:5] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = Counter((r.doc_id, r.lang_pred) for r in langid.identify(df, per_language=20).collect())
    pred = {i: l for i, l in got}
    assert sum(got.values()) == len(rows) and {pred[i] for i in (900, 901, 902)} == {"und"} and (pred[None], pred[903], pred[904]) == ("de", "zh", "en")
    one, two = ([(r.text, r.label) for r in sorted(langid.sample(df.repartition(n), "doc_id", "text", "lang", 10).collect(), key=lambda r: (r.k, r.label))] for n in (1, 7))
    assert one == two and Counter(l for _, l in one) == {l: 10 for l in SAID}
    assert langid.identify(df.where("false")).count() == 0


def test_word_search_against_all_splits():
    rng = random.Random(3)
    counts = {"cheap": 50, "pills": 40, "spam": 30, "a": 9, "chea": 2, "p": 3, "pam": 4, "überall": 6}
    seg = urls.Segmenter(counts)

    def cost(parts):
        return sum(-math.log(counts[w] / seg.total) if w in counts else math.log(seg.total) + 2.5 * len(w) for w in parts)

    for _ in range(120):
        run = "".join(rng.choice(["cheap", "pills", "spam", "a", "p", "x", "über", "all"]) for _ in range(rng.randint(1, 4)))[:12]
        every = [[run[i:j] for i, j in zip([0, *cut], [*cut, len(run)])] for bits in range(1 << (len(run) - 1)) for cut in [[k + 1 for k in range(len(run) - 1) if bits >> k & 1]]]
        assert abs(cost(seg._split(run)) - min(map(cost, every))) < 1e-9
    assert seg.words("cheappillsspam.org", "/%C3%BCberall/1") == ["cheap", "pills", "spam", "org", "überall"]


def test_verdicts_against_counting(spark):
    rng = random.Random(5)
    hosts = ["casino-win.org", "ads.track-win.org", "μουσείο.org", "city-museum.org", "a.net", "музей.net"]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['x', 'garden', 'fr/y'])}/{rng.randint(0, 3)}", f"<TITLE>{rng.choice(['city museum', 'win big', 'Музей'])}</TITLE>", "w") for i in range(300)]
    rows += [(None, None, None, None), (1, "no scheme", None, None), (1, "no scheme", None, None), (2, "http://" + "long" * 50_000 + ".org/", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    got = urls.judge(df).collect()
    assert len(got) == len(rows)
    segmenter, bayes = urls.fit(df)
    words = [segmenter.words(*urls.split_url(u)) for _, u, _, _ in rows]
    bad = [not set(urls.BAD_WORDS).isdisjoint(w) for w in words]
    good_n, bad_n = (Counter(w for ws, b in zip(words, bad) if b == k for w in ws) for k in (False, True))
    vocabulary = set(good_n) | set(bad_n) | set(urls.BAD_WORDS)
    for w in urls.BAD_WORDS:
        bad_n[w] = max(bad_n[w], 1)
    prior = math.log((sum(bad) + 1) / (sum(bool(w) for w, b in zip(words, bad) if not b) + 1))

    def odds(ws):
        p = lambda n, w: math.log((n[w] + 0.5) / (sum(n[x] for x in vocabulary) + 0.5 * (len(vocabulary) + 1)))
        return prior + sum(p(bad_n, w) - p(good_n, w) for w in ws)

    for r in got:
        ws = r.words.split()
        host, path = urls.split_url(next(u for i, u, _, _ in rows if i == r.page_id and (u is None or urls.split_url(u) == (r.host, r.path))))
        assert (r.host, r.path) == (host, path) and (r.log_odds is None) == (not ws)
        if ws:
            assert abs(r.log_odds - odds(ws)) < 1e-6 * len(ws)
        if r.rule is None:
            assert r.verdict == ("block" if ws and odds(ws) > 0 else "allow")
    said = {r.host: r.verdict for r in got if r.rule is None}
    assert said["casino-win.org"] == "block" and said["μουσείο.org"] == "allow" and said["city-museum.org"] == "allow"
    assert urls.judge(df.where("false")).count() == 0
