"""PII: candidate gradient boosting.

High-recall generators propose spans that may overlap, of every kind in several spellings: emails (spoken or bracketed at
and dot, spaces around them), IPs (bracketed dots, IPv6), cards (13 to 19 digits, any separators, failing Luhn, too),
phones (national forms, runs of digits) and secrets (what is assigned to a token, key or password, long runs of hex or
base64). Boosted trees score each span from its format and its context; the least calibrated score with the wanted
precision on examples held out, per kind, is the threshold; of overlapping spans that pass, the highest score is redacted.
Spans that the fixed rules (``base_spans``) find are always redacted.

The classifier is fitted on a bounded set: ``TRAIN`` examples a kind, put into sentences of at most ``SENTENCES`` texts of
the corpus, those with the least hashes (of each, 400 characters around its middle, where the fixed rules find nothing).
Labels come from how an example was made: real forms and respelled ones against corrupted ones, other numbers and spans
cut wrong. Of the examples a third fits the trees, a third the scale, a third the thresholds.

Generators look at whole texts and run in time linear in the text. Null and empty texts have no spans. Repeated rows are
judged one by one. Of equal scores the span that starts first wins. Other columns are not read. Empty table: empty result.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import ipaddress
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import quoted

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
#: Examples of each kind, texts whose sentences they are put into, and the precision that thresholds are set for.
TRAIN, SENTENCES, PRECISION = 1500, 400, 0.96
#: No threshold is lower, whatever the precision.
LEAST_SCORE = 0.2

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Without one of these a text has no span.
_ANY = re.compile(r"[0-9@]|[(\[{<]\s?(?i:at)\s?[)\]}>]|\s(?i:dot)\s|[A-Za-z0-9+/_-]{24}|(?i:token|secret|key|passw|pwd|auth|bearer)")
_AT = re.compile(r"\s?[(\[{<]\s?(?i:at)\s?[)\]}>]\s?|\s(?i:at)\s|\s?@\s")
_AFTER_AT = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\s?[(\[{<]\s?(?i:dot)\s?[)\]}>]\s?|\s(?i:dot)\s|\.)[A-Za-z0-9-]{1,63})+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: Loose phones and cards by their number of groups; a match starts at every group, so spans overlap.
_LOOSE_PHONE = [re.compile(r"(?<![0-9A-Za-z])(?=((?:\(?[0-9]{2,5}\)?[ ./-]{1,2}){%d}[0-9]{2,8})(?![0-9A-Za-z]))" % n) for n in range(1, 5)]
_LOOSE_CARD = [re.compile(r"(?<![0-9A-Za-z])(?=([0-9]{4}(?:[ ./_-]{1,3}[0-9]{3,7}){%d})(?![0-9A-Za-z]))" % n) for n in range(2, 5)]
_RUN = re.compile(r"(?<![0-9A-Za-z.,])[0-9]{7,19}(?![0-9A-Za-z]|[.,][0-9])")
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?: ?(?:\[\.\]|\(\.\)|\{\.\}|\.) ?[0-9]{1,3}){3}(?![0-9A-Za-z])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_ASSIGNED = re.compile(r"(?i)(?<![a-z])(?:api[ _-]?key|access[ _-]?key|private[ _-]?key|secret|token|password|passwd|passphrase|pwd|auth|bearer)[\"']?\s?(?:[:=]|is)?\s?[\"']?([^\s\"',;<>]{6,})")
_OPAQUE = re.compile(r"(?<![0-9A-Za-z+/_-])(?:[0-9A-Fa-f]{32,}|(?:AKIA|ASIA)[0-9A-Z]{16}|(?:sk|pk|rk|gh[pousr]|xox[abp])[-_][A-Za-z0-9_-]{16,}|[A-Za-z0-9+/_-]{32,}={0,2})(?![0-9A-Za-z+/_-])")
_WORDS = {"email": ("mail", "e-mail", "email", "contact", "write", "reach", "courriel", "correo"), "ip": ("ip", "host", "server", "address", "from", "login"), "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"), "phone": ("tel", "phone", "call", "mobile", "fax", "cell", "dial", "telefon", "numero"), "secret": ("token", "secret", "key", "password", "passwd", "pwd", "auth", "bearer")}
_OTHER = ("version", "order", "invoice", "isbn", "page", "date", "total", "ssn", "id", "serial", "ref", "sha", "commit", "time")
_DATE = re.compile(r"(19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](19|20)[0-9]{2}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed rules: leftmost non-overlapping per kind, failing matches dropped."""
    out = []
    at, floor = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        while start > floor and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if domain and start < at:
            out.append(("email", start, domain.end()))
            floor = domain.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that may be personal data, overlapping ones included."""
    out = []
    for kind, patterns in (("phone", _LOOSE_PHONE), ("card", _LOOSE_CARD)):
        out += [(kind, *m.span(1)) for pattern in patterns for m in pattern.finditer(text)]
    for m in _RUN.finditer(text):
        n = m.end() - m.start()
        out += [(kind, *m.span()) for kind, least, most in (("card", 13, 19), ("phone", 7, 15)) if least <= n <= most]
    out += [("ip", *m.span()) for pattern in (_LOOSE_IP, _IPV6) for m in pattern.finditer(text)]
    for at in _AT.finditer(text):
        behind = _AFTER_AT.match(text, at.end())
        start = at.start()
        while start > 0 and at.start() - start < 64 and text[start - 1] in _LOCAL:
            start -= 1
        if behind and start < at.start():
            # The last word may belong to the sentence: each shorter domain is a candidate, too.
            ends = [behind.end()] + [behind.start() + d.start() for d in re.finditer(r"\s?[(\[{<]\s?(?i:dot)\s?[)\]}>]\s?|\s(?i:dot)\s|\.", behind.group())][1:]
            out += [("email", start, e) for e in ends]
    out += [("secret", *m.span(1)) for m in _ASSIGNED.finditer(text)]
    out += [("secret", *m.span()) for m in _OPAQUE.finditer(text)]
    return list(dict.fromkeys(out))


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def _ipv6(s: str) -> bool:
    try:
        ipaddress.IPv6Address(s)
        return True
    except ValueError:
        return False


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    s, d = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - 30) : start].lower(), text[end : end + 15].lower()
    parts = re.findall(r"[0-9]+", s)
    near = before + " " + after
    words = set(re.findall(r"[a-z-]+", before))
    upper, lower = sum("A" <= c <= "Z" for c in s), sum("a" <= c <= "z" for c in s)
    return [
        float(KINDS.index(kind)), len(s), len(d), len(parts), float(max(map(len, parts), default=0)), float(min(map(len, parts), default=0)), float(len({len(p) for p in parts})), float(13 <= len(d) <= 19 and luhn(d)),
        float(len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)), float("(" in s), float("." in s), float("-" in s), float(" " in s), float("/" in s), float("[" in s),
        *(float(any(w in words for w in _WORDS[k])) for k in KINDS), float(any(w in near for w in _OTHER)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(bool(re.search(r"[0-9)][./-]$|\($", before))), float(bool(re.match(r"[./-][0-9(]|\)", after))), float(len(set(re.findall(r"[ ./-]+", s)))),
        float(bool(re.search(r"[0-9]\)? $", before))), float(bool(re.match(r" \(?[0-9]", after))), float(before.rstrip()[-1:] in "$€£#=\""), float(s[:1] == "("), float(bool(_DATE.fullmatch(s))),
        float(kind == "ip" and ":" in s and _ipv6(s)), _entropy(s) if kind == "secret" else 0.0, upper / len(s), lower / len(s), float(s[:1] == "0"), float("3" <= d[:1] <= "6"), float([len(p) for p in parts] == [3, 2, 4]), float(bool(re.search(r"[=:][\s\"']*$", before))),
        float(len(re.findall(r"(?i)dot|\.", s))), float(bool(re.search(r"(?i)(com|org|net|edu|gov|io|info|de|fr|es|uk|eu)$", s))), float(bool(re.search(r"(?i)[(\[{<]\s?(at|dot)", s))), float(bool(re.fullmatch(r"[a-z]+", s))),
    ]


def _examples(rng: random.Random, n: int, sentences: tuple[str, ...]) -> list[tuple[str, str, int, int, int]]:
    """(text, kind, start, end, label): made spans inside sentences."""
    word = lambda: "".join(rng.choice(("th", "re", "on", "an", "er", "in", "ou", "le", "st", "ch")) for _ in range(rng.randint(1, 4)))
    pick = lambda k, of="0123456789": "".join(rng.choice(of) for _ in range(k))
    spoken = lambda: rng.choice((" (at) ", "(at)", " [at] ", "[at]", " at ", " @ ", " AT ", " {at} "))
    dotted = lambda: rng.choice((" (dot) ", ".", " [dot] ", " dot ", "[dot]", " DOT "))
    tops = ("com", "org", "net", "de", "fr", "edu", "io")

    def card(good: bool = True) -> str:
        size = rng.choice((16, 16, 16, 15, 13, 19))
        d = str(rng.choice((3, 4, 5, 6))) + pick(size - 2)
        return next(d + c for c in rng.sample("0123456789", 10) if luhn(d + c) == good)

    def grouped(d: str, by: str) -> str:
        return by.join(d[i : i + 4] for i in range(0, len(d), 4))

    separators = (".", "  ", "/", " - ", "_", " / ", "..")
    good = {
        "email": lambda: f"{word()}{rng.choice(('', '.' + word(), pick(2)))}{spoken()}{word()}{rng.choice(('', dotted() + word()))}{dotted()}{rng.choice(tops)}",
        "ip": lambda: rng.choice((rng.choice(("[.]", "(.)", " . ", "{.}")).join(str(rng.randint(0, 255)) for _ in range(4)), ":".join(f"{rng.randrange(65536):x}" for _ in range(8)), f"{rng.randrange(8192, 65536):x}:{rng.randrange(65536):x}::{rng.randrange(1, 65536):x}")),
        "card": lambda: rng.choice((grouped(card(), rng.choice(separators)), card())),
        "phone": lambda: rng.choice((f"({pick(3)}) {pick(3)}-{pick(4)}", f"{pick(3)}-{pick(3)}-{pick(4)}", f"{pick(3)}.{pick(3)}.{pick(4)}", f"0{pick(3)} {pick(6)}", f"0{pick(2)} {pick(2)} {pick(2)} {pick(2)} {pick(2)}"[0:14], f"00{pick(2)} {pick(3)} {pick(7)}", f"0{pick(4)}/{pick(6)}", f"({pick(3)}) {pick(7)}")),
        "secret": lambda: rng.choice((pick(rng.choice((32, 40, 64)), "0123456789abcdef"), pick(rng.choice((32, 40)), "0123456789ABCDEF"), "AKIA" + pick(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), "sk-" + pick(24, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789"), pick(36, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"), pick(10, "abcdefghijkmnpqrstuvwxyzABCDEFG0123456789!#%&*"))),
    }
    bad = {
        "email": lambda: rng.choice((f"{word()}{rng.choice((' at ', ' (at) '))}{word()}.{word()}", f"{word()} at {word()} dot {word()}{word()}", f"{word()} at {pick(1)}.{pick(2)}", f"{word()} @ {pick(2)}.{pick(2)}")),
        "ip": lambda: rng.choice((" . ".join(str(rng.randint(256, 999)) for _ in range(4)), ":".join(pick(2) for _ in range(3)), f"{rng.randint(0, 23)}:{pick(2)}:{pick(2)}", "::", ":".join(pick(1) for _ in range(3)), f"{pick(2)}:{pick(2)}:{pick(2)}:{pick(2)}")),
        "card": lambda: rng.choice((grouped(card(False), rng.choice((*separators, " ", "-"))), card(False), card(False))),
        "phone": lambda: rng.choice((f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{pick(2)}.{pick(2)}.{pick(4)}", f"{pick(4)} {pick(4)} {pick(4)}", f"{pick(2)} {pick(2)}", f"{pick(3)} {pick(3)}", " ".join(pick(rng.choice((1, 2, 2, 3))) for _ in range(rng.randint(2, 5))), f"{pick(5)} / {pick(5)}", f"{pick(3)}-{pick(2)}-{pick(4)}", pick(rng.randint(7, 15)), " ".join(pick(2) for _ in range(rng.randint(3, 4))), grouped(card(), rng.choice((".", "  ", "/", " "))))),
        "secret": lambda: rng.choice((word() + word() + word(), word() + "ly", "-".join(word() for _ in range(7)), "/".join(word() for _ in range(8)), "_" * 32, "=" * 6 + word(), word() + "." + word(), "-" * 40)),
    }
    out = []
    for kind in KINDS:
        for i in range(n):
            label = i % 2
            s = (good if label else bad)[kind]()
            lead, tail = word() + " " + word(), word()
            if sentences:
                own = rng.choice(sentences).split()
                cut = rng.randrange(len(own) + 1)
                lead, tail = " ".join(own[max(0, cut - 8) : cut]), " ".join(own[cut : cut + 5])
            lead += " " if lead else ""
            # A number that fails Luhn or is a bare run of digits is personal where the words say so, and only there.
            named = rng.random() < 0.6 if label else False
            if not label and (kind == "card" or kind == "phone" and re.fullmatch(r"[0-9]{10,15}", s)) and rng.random() < 0.3:
                label, named = 1, True
            if kind == "secret" and (label and len(s) < 12 or not label and rng.random() < 0.3):
                named = True
            if named:
                sign = rng.choice(("=", " = ", ": ", ':"', ' = "', " ")) if kind == "secret" else rng.choice((" ", ": "))
                lead += rng.choice(_WORDS[kind]) + sign
            elif not label and rng.random() < 0.4:
                lead += rng.choice(_OTHER) + " "
            start, whole = len(lead), s
            if kind in ("card", "phone") and rng.random() < 0.4:  # one of several numbers; bad: a span cut across them
                other = rng.choice((good[kind](), " ".join(pick(2) for _ in range(rng.randint(1, 5)))))
                s = s if label else good[kind]()
                first = rng.random() < 0.5
                whole, start = (f"{s} {other}", start) if first else (f"{other} {s}", start + len(other) + 1)
            text = lead + whole + rng.choice((" ", ", ", ". ", '" ' if lead.endswith('"') else " ")) + tail
            end = start + len(s)
            proposed = [c for c in candidates(text) if c[0] == kind and c[1] < end and start < c[2]]
            wrong = [c for c in proposed if c[1:] != (start, end)]
            if not label and whole != s or label and kind == "email" and wrong and rng.random() < 0.3:
                if wrong:
                    _, start, end = rng.choice(wrong)
                    label = 0
            elif (kind, start, end) not in proposed:
                continue  # no generator proposes it, so nothing is to be learned from it
            out.append((text, kind, start, end, label))
    rng.shuffle(out)
    return out


class Boosted:
    """Gradient boosting of trees of depth 4 on the logistic loss, with a Platt scale fitted on held-out examples."""

    def __init__(self, rounds: int = 80, rate: float = 0.2, depth: int = 4):
        self.rounds, self.rate, self.depth = rounds, rate, depth
        self.trees: list[tuple] = []

    def _grow(self, x, g, h, depth):
        value = float(g.sum() / (h.sum() + 1.0))
        if depth == 0 or len(g) < 10:
            return value
        best, split, total = 1e-6, None, g.sum() ** 2 / (h.sum() + 1.0)
        for f in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[:, f], (0.1, 0.25, 0.5, 0.75, 0.9))):
                left = x[:, f] <= cut
                if 5 <= left.sum() <= len(g) - 5:
                    gain = g[left].sum() ** 2 / (h[left].sum() + 1.0) + g[~left].sum() ** 2 / (h[~left].sum() + 1.0) - total
                    if gain > best:
                        best, split = gain, (f, float(cut), left)
        if split is None:
            return value
        f, cut, left = split
        return (f, cut, self._grow(x[left], g[left], h[left], depth - 1), self._grow(x[~left], g[~left], h[~left], depth - 1))

    def _apply(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, cut, a, b = tree
        left, out = x[:, f] <= cut, np.empty(len(x))
        out[left], out[~left] = self._apply(a, x[left]), self._apply(b, x[~left])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        s = np.zeros(len(y))
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-s))
            self.trees.append(self._grow(x, y - p, p * (1 - p), self.depth))
            s += self.rate * self._apply(self.trees[-1], x)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return sum((self.rate * self._apply(t, x) for t in self.trees), np.zeros(len(x)))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        s, self.scale = self.raw(x), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-(self.scale[0] * s + self.scale[1])))
            w = p * (1 - p) + 1e-9
            grad = np.array([((p - y) * s).sum() + 1e-3 * (self.scale[0] - 1), (p - y).sum()])
            hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum()]]) + 1e-6 * np.eye(2)
            self.scale = self.scale - np.linalg.solve(hess, grad)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * self.raw(x) + self.scale[1], -50, 50)))


def sentences(docs: DataFrame, text_col: str = "text", most: int = SENTENCES) -> tuple[str, ...]:
    """Middles of the texts with the least hashes, without what the fixed rules find."""
    text = quoted(text_col)
    middle = F.substring(text, F.greatest(F.lit(1), F.floor(F.length(text) / 2 - 200)).cast("int"), F.lit(400))
    got = docs.where(text.isNotNull()).select(F.xxhash64(F.lit(1), text).alias("k"), middle.alias("s")).orderBy("k", "s").limit(most).collect()
    return tuple(s for _, s in got if s.split() and not re.search(r"[0-9@]{3}", s))


@functools.lru_cache(maxsize=4)
def model(made_in: tuple[str, ...] = (), seed: int = 11, train: int = TRAIN, precision: float = PRECISION) -> tuple[Boosted, dict[str, float]]:
    """The trees and each kind's threshold; the same for the same sentences."""
    made = _examples(random.Random(seed), train, made_in)
    x = np.array([features(t, k, a, b) for t, k, a, b, _ in made])
    y = np.array([float(v) for *_, v in made])
    part = np.arange(len(y)) % 3
    trees = Boosted().fit(x[part == 0], y[part == 0]).calibrate(x[part == 1], y[part == 1])
    p, limits = trees.probability(x), {}
    for i, kind in enumerate(KINDS):
        own = (part == 2) & (x[:, 0] == i)
        order = np.argsort(-p[own])
        good = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        fine = np.flatnonzero(good >= precision)
        limits[kind] = float(max(LEAST_SCORE, p[own][order][fine[-1]])) if len(fine) else 1.1
    return trees, limits


def find(text: str, boosted: Boosted, limits: dict[str, float]) -> tuple[list, list]:
    """(base spans, all spans), each by start, then kind."""
    if not _ANY.search(text):
        return [], []
    base = base_spans(text)
    more = candidates(text)
    spans = list(base)
    if more:
        p = boosted.probability(np.array([features(text, *c) for c in more]))
        taken = Taken((a, b) for _, a, b in base)
        for i in np.lexsort((np.array([c[1] for c in more]), -p)):
            kind, a, b = more[i]
            if p[i] >= limits[kind] and taken.free(a, b):
                spans.append((kind, a, b))
                taken.add(a, b)
    return base, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


class Taken:
    """Places that are taken, as disjoint ranges by start."""

    def __init__(self, ranges):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(ranges):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = bisect.bisect_right(self.ends, a)
        return i == len(self.starts) or self.starts[i] >= b

    def add(self, a: int, b: int) -> None:
        """A range that is free."""
        i = bisect.bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping base spans the first one counts."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone of base spans, base_sha256, spans, n_spans[, redacted]) for each row."""
    spark = docs.sparkSession
    fitted = spark.sparkContext.broadcast(model(sentences(docs, text_col)))
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(f"n_{k}", T.LongType()) for k in BASE), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_spans", T.LongType())]
    if redact:
        fields.append(T.StructField("redacted", T.StringType()))
    names = [f.name for f in fields]

    def listed(spans):
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def run(batches):
        trees, limits = fitted.value
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in names[1:]}
            for text in batch.column(1):
                text = text.as_py() or ""
                base, spans = find(text, trees, limits)
                counts = Counter(k for k, _, _ in base)
                for k in BASE:
                    rows[f"n_{k}"].append(counts[k])
                rows["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                rows["spans"].append(listed(spans))
                rows["n_spans"].append(len(spans))
                if redact:
                    rows["redacted"].append(redacted(text, spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in rows.items())], names=names)

    return docs.select(quoted(id_col), quoted(text_col)).mapInArrow(run, T.StructType(fields))
