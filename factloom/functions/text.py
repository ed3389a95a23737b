"""Scalar text functions as Column builders.

All of them are JVM expressions except the compatibility decomposition of non-ASCII text and the similarity ratio, for
which Spark has no function; those are Arrow UDFs, and rows that are ASCII or decided by ``contains`` never reach them.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: White space as Python's ``\s`` sees it (the JVM's ``\s`` with (?U) leaves out the four separators \x1c-\x1f).
SPACE = r"[\s\x1c-\x1f\x85   -     　]"

# What counts as absent when fields are harvested, and when results are compared.
HARVEST_NULLS = ("-", "--", "---", "n/a", "na", "none", "nil", "n.a.", "", "–", "—")
SALT_LOG = "factloom-log-1"


def let(value: Column, f) -> Column:
    """f(value) with ``value`` evaluated once, however often f uses it: the expression tree stays small."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def text_or(c: Column | str, other: str = "") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(other))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def collapse_whitespace(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"{SPACE}+", " "))


def split_lines(c: Column) -> Column:
    """Lines that are not blank, white space collapsed."""
    return F.filter(F.transform(F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]", -1), collapse_whitespace), lambda x: x != "")


@functools.lru_cache(1 << 16)
def _plain(x: str) -> str:
    """A character's decomposition. Marks only move among marks, which are dropped, so a text's is that of its characters."""
    return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))


_NOT_ASCII = re.compile(r"[^\x00-\x7f]")


@pandas_udf(T.StringType())
def _decomposed(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _NOT_ASCII.sub(lambda m: _plain(m.group()), v))


# Latin letters with a mark and the letters that they decompose to.
_MARKED = "ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖòóôõöÙÚÛÜùúûüÝýÿŠšŽž"
_PLAIN = "AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOoooooUUUUuuuuYyySsZz"


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks. Usual Latin letters are mapped in the JVM."""
    mapped = F.translate(c, _MARKED, _PLAIN)
    odd = F.coalesce(mapped.rlike(r"[^\x00-\x7F]"), F.lit(False))
    return F.coalesce(_decomposed(F.when(odd, mapped)), mapped)  # a Python function is evaluated for all rows: others are null there


def fold(c: Column) -> Column:
    """Accent-free, lower-case letters and digits only: two spellings of a value fold alike."""
    return F.regexp_replace(F.lower(strip_accents(c)), r"[^0-9a-z]+", "")


def slugify(c: Column, inside: bool = False) -> Column:
    """Label to a stable snake_case name; a label without Latin letters or digits gets a name from its hash.

    inside: the column is a lambda's, where no Python function may run; only usual Latin letters lose their marks.
    """
    plain = F.regexp_replace(F.translate(c, _MARKED, _PLAIN) if inside else strip_accents(c), r"[^\x00-\x7F]", "")
    name = F.lower(F.regexp_replace(F.regexp_replace(plain, r"[^0-9a-zA-Z]+", "_"), r"^_+|_+$", ""))
    return F.when(name == "", F.concat(F.lit("field_"), F.substring(F.sha2(c.cast("binary"), 256), 1, 10))).when(name.rlike("^[0-9]"), F.concat(F.lit("f_"), name)).otherwise(name)


def normalise_identifier(c: Column) -> Column:
    """Upper case, without white space and the separators . _ / -"""
    return F.upper(F.regexp_replace(c, rf"{SPACE}|[._/-]", ""))


def has_lower(c: Column) -> Column:
    """A lower-case letter: prose, not a code."""
    return c.rlike(r"\p{Ll}")


def charset_profile(c: Column) -> Column:
    s = F.regexp_replace(c, rf"{SPACE}", "")
    alnum = s.rlike(r"^[\p{L}\p{N}]+$")
    return (
        F.when(s == "", "empty")
        .when(s.rlike(r"^\p{Nd}+$"), "digits")
        .when(s.rlike(r"^\p{L}+$"), F.when(~has_lower(s) & s.rlike(r"\p{Lu}"), "upper_alpha").otherwise("alpha"))
        .when(alnum, F.when(F.upper(s) == s, "upper_alnum").otherwise("alnum"))
        .otherwise("any")
    )


def value_shape(c: Column) -> Column:
    """Length and character classes, which tell nothing of the value itself."""
    classes = F.concat_ws("+", F.when(c.rlike(r"\p{Nd}"), "digit"), F.when(c.rlike(r"\p{Lu}"), "upper"), F.when(c.rlike(r"\p{Ll}"), "lower"), F.when(c.rlike(rf"[^\p{{L}}\p{{N}}\s\x1c-\x1f\x85   -     　]"), "punct"))
    return F.when(c == "", "len=0").otherwise(F.concat(F.lit("len="), F.length(c).cast("string"), F.lit(" classes="), F.when(classes == "", "space").otherwise(classes)))


def hash_value(c: Column, salt: str = SALT_LOG, length: int = 12) -> Column:
    return F.substring(F.sha2(F.concat(F.lit(salt), c).cast("binary"), 256), 1, length)


def is_null_token(c: Column) -> Column:
    return F.lower(collapse_whitespace(c)).isin(*HARVEST_NULLS)


def is_probably_label(c: Column) -> Column:
    t = collapse_whitespace(c)
    letters = F.length(F.regexp_replace(t, r"\P{L}", ""))
    short = F.size(F.split(t, " ", -1)) <= 6
    return (t != "") & (F.length(t) <= 60) & (t.rlike(r"[:：]\s*$") | (short & (letters >= F.greatest(F.lit(2), F.floor(F.length(t) / 2)))))


@pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def ratio_from(least: float):
    """Matching-block ratio of two strings where it is ``least`` or more, else null; its bounds by letters go first."""

    @pandas_udf(T.DoubleType())
    def near(a: pd.Series, b: pd.Series) -> pd.Series:
        out, match, last = [], SequenceMatcher(None), None
        for x, y in zip(a, b):
            if y != last:  # a matcher indexes its second text once
                match.set_seq2(y)
                last = y
            match.set_seq1(x)
            found = match.ratio() if match.quick_ratio() >= least else 0.0
            out.append(found if found >= least else None)
        return pd.Series(out, dtype="float64")

    return near


def similarity(a: Column, b: Column) -> Column:
    """Matching-block ratio of the folded strings."""
    x, y = fold(a), fold(b)
    return F.when(x == y, F.lit(1.0)).otherwise(_ratio(x, y))


def _windowed(min_ratio: float):
    @pandas_udf(T.BooleanType())
    def near(needle: pd.Series, hay: pd.Series) -> pd.Series:
        out = []
        for n, h in zip(needle, hay):
            if n is None or h is None:
                out.append(False)
                continue
            step = max(1, len(n) // 4)
            match = SequenceMatcher(None, n, "", autojunk=True)
            found = False
            for at in range(0, len(h) - len(n) + 1, step):
                match.set_seqs(n, h[at : at + len(n)])
                if match.real_quick_ratio() >= min_ratio and match.quick_ratio() >= min_ratio and match.ratio() >= min_ratio:
                    found = True
                    break
            out.append(found)
        return pd.Series(out, dtype=bool)

    return near


def substring_present(needle: Column, hay: Column, min_ratio: float = 0.9) -> Column:
    """Whether a value stands in a text, up to small reading errors. Only rows without the exact value go to Python."""
    n, h = fold(needle), fold(hay)
    return F.when(n == "", F.lit(True)).when(F.contains(h, n), F.lit(True)).when(F.length(n) > F.length(h), F.lit(False)).otherwise(_windowed(min_ratio)(n, h))
