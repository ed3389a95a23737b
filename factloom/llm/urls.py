"""URL filters: rules first, then host word segmentation with multinomial naive Bayes.

A rule is a host and a path, joined (``net/fr/``); it fits its host and all subdomains if the url's path starts with its
path, and the longest fitting rule decides. For other urls the labels of the host and the parts of the path are split
into words by a unigram Viterbi search, and multinomial naive Bayes scores the words.

Unigrams are the words of all titles and url paths, counted by one aggregation over all rows. Naive Bayes counts the words
of all rows, too: a row is bad if one of ``BAD_WORDS`` is among its words, so words that keep such company (``win`` beside
``casino``) count as well. The rules' own verdicts are no labels: they tell top-level domains and languages apart, not bad
sites from good ones. Of both tables the words in a share of ``SHARE`` or more of all words are used (at most 1 / SHARE
of them); rarer ones are unknown words to the search and say nothing to the verdict. ``BAD_WORDS`` and ``COMMON_WORDS``
hold ``FLOOR`` of all words each at least.

Letters are those of any script; percent-encoded paths are decoded for their words. Null urls and urls without ``://``
have an empty host and path, fit no rule, have no words and are allowed, as is any url without words. Repeated rows are
counted and judged one by one; other columns are not read; an empty table gives an empty result. A url of any length is
read whole: the search looks back 63 letters at each, the longest label of a host.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Mapping
from urllib.parse import unquote

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import cut

#: (verdict, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
BAD_WORDS = ("spam", "farm", "pills", "cheap", "casino", "poker", "porn", "xxx", "adult", "viagra", "malware", "phish", "warez", "crack", "betting", "bets", "gamble", "loan", "escort", "hack", "fake", "ads", "jackpot", "payday", "keygen", "torrent", "popup", "clickbait", "counterfeit", "replica")
COMMON_WORDS = ("news", "blog", "mail", "shop", "home", "page", "world", "info", "data", "book", "music", "photo", "school", "health", "science", "travel", "food", "sport", "weather", "history", "library", "museum", "university", "city", "garden", "best", "free", "online", "web", "site", "net", "www", "en", "de", "fr", "es", "html", "example", "org", "com", "the", "and", "of", "for", "to", "in")
SHARE, FLOOR = 1e-6, 1e-4
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_WIDEST = 63


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path)"""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


class Rules:
    def __init__(self, rules=RULES):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((rule, slash + path, verdict))

    def decide(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict): looks up the host and each of its parents."""
        best, at = (None, None), 0
        while host:
            for rule, prefix, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(prefix) and (best[0] is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
            at = host.find(".", at) + 1
            if not at:
                break
        return best


def letters(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


class Segmenter:
    """Most probable split of a run of letters under a unigram model; unknown words cost more the longer they are."""

    def __init__(self, counts: Mapping[str, int]):
        self.total = sum(counts.values()) or 1
        self.cost = {w: -math.log(c / self.total) for w, c in counts.items()}

    def __getstate__(self):
        return {"total": self.total, "cost": self.cost}

    @functools.cached_property
    def split(self):
        return functools.lru_cache(50_000)(self._split)

    def _unknown(self, n: int) -> float:
        return math.log(self.total) + 2.5 * n

    def _split(self, run: str) -> tuple[str, ...]:
        best, back = [0.0] + [math.inf] * len(run), [0] * (len(run) + 1)
        for j in range(1, len(run) + 1):
            for i in range(max(0, j - _WIDEST), j):
                c = best[i] + self.cost.get(run[i:j], self._unknown(j - i))
                if c < best[j]:
                    best[j], back[j] = c, i
        out, j = [], len(run)
        while j:
            out.append(run[back[j] : j])
            j = back[j]
        return tuple(reversed(out))

    def words(self, host: str, path: str) -> list[str]:
        return [w for run in letters(host) + letters(unquote(path)) for w in self.split(run)]


class NaiveBayes:
    """Multinomial: per class, words counted over its rows, smoothed by ``smooth``; the prior is the rows' share."""

    def __init__(self, counts: Mapping[str, tuple[int, int]], rows: tuple[int, int], smooth: float = 0.5):
        size = len(counts) + 1
        total = [sum(c[k] for c in counts.values()) + smooth * size for k in (0, 1)]
        self.prior = math.log((rows[1] + 1) / (rows[0] + 1))
        self.odds = {w: math.log((c[1] + smooth) / total[1]) - math.log((c[0] + smooth) / total[0]) for w, c in counts.items()}

    def log_odds(self, words: list[str]) -> float:
        """Log odds of bad; words never seen say nothing."""
        return self.prior + sum(self.odds.get(w, 0.0) for w in words)


def unigrams(pages: DataFrame, url_col: str = "url", html_col: str | None = "html", share: float = SHARE) -> dict[str, int]:
    """Counts of the words of all titles and paths that hold a share, with the floor of the listed words."""

    def run(batches):
        for batch in batches:
            words = [w for url in batch.column(0).to_pylist() for w in letters(unquote(split_url(url)[1]))]
            words += [w for title in batch.column(1).to_pylist() for w in letters(title or "")]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["w"])

    title = F.regexp_extract(html_col, r"(?is)<title[^>]*>([^<]*)", 1) if html_col else F.lit("")
    counted = cut(pages.select(F.col(url_col), title.alias("title")).mapInArrow(run, "w string").groupBy("w").agg(F.count("*").alias("n")))
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = {w: n for w, n in counted.where(F.col("n") >= share * total).collect()}
    least = int(FLOOR * total) + 1
    return out | {w: max(out.get(w, 0), least) for w in COMMON_WORDS + BAD_WORDS}


def fit(pages: DataFrame, url_col: str = "url", html_col: str | None = "html", share: float = SHARE, bad_words: tuple[str, ...] = BAD_WORDS) -> tuple[Segmenter, NaiveBayes]:
    """Both models, of all rows. No more than 2 / share words come to the driver."""
    segmenter = Segmenter(unigrams(pages, url_col, html_col, share))
    sent, bad = pages.sparkSession.sparkContext.broadcast(segmenter), set(bad_words)

    def run(batches):
        for batch in batches:
            words, kinds, firsts = [], [], []
            for url in batch.column(0).to_pylist():
                own = sent.value.words(*split_url(url))
                words += own
                kinds += [not bad.isdisjoint(own)] * len(own)
                firsts += [i == 0 for i in range(len(own))]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(kinds, pa.bool_()), pa.array(firsts, pa.bool_())], names=["w", "bad", "first"])

    seen = pages.select(url_col).mapInArrow(run, "w string, bad boolean, first boolean")
    one = lambda c: F.sum(c.cast("long"))
    counted = cut(seen.groupBy("w").agg(one(~F.col("bad")).alias("good"), one(F.col("bad")).alias("bad"), one(F.col("first") & ~F.col("bad")).alias("good_rows"), one(F.col("first") & F.col("bad")).alias("bad_rows")))
    total, good, ill = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("good") + F.col("bad"), "good_rows", "bad_rows")]).first()
    counts = {w: (g, b) for w, g, b in counted.where(F.col("good") + F.col("bad") >= share * total).select("w", "good", "bad").collect()}
    for w in bad_words:  # so that a table without bad rows knows them
        g, b = counts.get(w, (0, 0))
        counts[w] = (g, max(b, 1))
    return segmenter, NaiveBayes(counts, (good, max(ill, 1)))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", rules=RULES, limit: float = 0.0, share: float = SHARE, bad_words: tuple[str, ...] = BAD_WORDS) -> DataFrame:
    """(id_col, host, path, rule, verdict, log_odds, words) for each row; log_odds and words say what the method found."""
    fitted = pages.sparkSession.sparkContext.broadcast(fit(pages, url_col, html_col, share, bad_words))
    schema = T.StructType([T.StructField(id_col, pages.schema[id_col].dataType), *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")), T.StructField("log_odds", T.DoubleType()), T.StructField("words", T.StringType())])

    def run(batches):
        segmenter, bayes = fitted.value
        table = Rules(rules)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = split_url(url)
                rule, verdict = table.decide(host, path)
                words = segmenter.words(host, path)
                odds = bayes.log_odds(words) if words else -math.inf
                out.append((host, path, rule, verdict or ("block" if odds > limit else "allow"), odds if words else None, " ".join(words)))
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), pa.float64() if i == 4 else pa.string()) for i, c in enumerate(cols))], names=schema.names)

    return pages.select(id_col, url_col).mapInArrow(run, schema)
