"""Text forms that operators compare, as column expressions; Arrow functions only where Spark has none (NFKC, sequence matching)."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType

from .match import matched_from

HANGUL = r"[가-힣]"
# What is no digit, Latin letter or Hangul syllable, named by what it is: with a class by what it is not, the same takes ten times as long.
_OTHER = r"[\x00-/:-@\[-`{-\x{ABFF}\x{D7A4}-\x{10FFFF}]+"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# Letters whose folded form is not their lower case.
FOLDED = {"ß": "ss", "ς": "σ", "ſ": "s", "ŉ": "ʼn", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}


def casefold(c: Column) -> Column:
    """Lower case, by which forms of a letter are one: sharp s and ligatures are looked for only in texts that have one."""
    low = F.lower(c)
    folded = low
    for letter, form in FOLDED.items():
        folded = F.replace(folded, F.lit(letter), F.lit(form))
    return F.when(F.rlike(low, F.lit(f"[{''.join(FOLDED)}]")), folded).otherwise(low)


def no_space_lower(c: Column) -> Column:
    """White space dropped, case folded."""
    return casefold(no_space(c))


def no_space(c: Column) -> Column:
    return F.regexp_replace(_text(c), r"(?U)\s+", "")


def plain(c: Column) -> Column:
    """Digits, Latin letters and Hangul syllables only, lower case."""
    return F.lower(F.regexp_replace(_text(c), _OTHER, ""))


def one_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(_text(c), r"(?U)\s+", " "))


def nullable(c: Column) -> Column:
    """Trimmed; empty is null."""
    t = F.trim(_text(c))
    return F.when(t != "", t)


def safe_name(c: Column) -> Column:
    return F.regexp_replace(_text(c), r"(?U)[^\w.-]", "_")


def quote_key(c: Column, strict: bool = True) -> Column:
    """What a quote is compared by: no line breaks, closing dots, white space or bars; loosely, no punctuation at all."""
    t = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(_text(c), r"(?i)<br\s*/?>", "")), r"(?:…|\.{3})+\s*$", ""), r"(?U)[\s|]+", "")
    return t if strict else F.regexp_replace(t, _OTHER, "")


@pandas_udf(StringType())
def nfkc_alnum(texts: pd.Series) -> pd.Series:
    """NFKC, letters and digits only, case folded."""
    return texts.fillna("").map(lambda t: "".join(c for c in unicodedata.normalize("NFKC", t) if c.isalnum()).casefold())


@pandas_udf(StringType())
def nfkc_content(texts: pd.Series) -> pd.Series:
    """As nfkc_alnum, without private-use characters."""
    return texts.fillna("").map(lambda t: "".join(c for c in unicodedata.normalize("NFKC", t) if c.isalnum() and unicodedata.category(c) != "Co").casefold())


def ratio(a: str, b: str, junk: bool = True) -> float:
    """1 for two empty texts, 0 for one; else twice the matched characters by all."""
    if not a or not b or a == b:
        return float(a == b)
    return SequenceMatcher(None, a, b, autojunk=junk).ratio()


def ratio_from(a: str, b: str, least: float) -> float:
    """ratio() without junk where it is `least` or more, else 0. Given up as soon as what is left to match cannot lift it so far."""
    if not a or not b or a == b:
        return float(a == b)
    total = len(a) + len(b)
    if 2.0 * min(len(a), len(b)) / total < least:
        return 0.0
    found = 2.0 * matched_from(a, b, least * total / 2 - 0.5) / total
    return found if found >= least else 0.0


def seq_ratio_from(a: Column | str, b: Column | str, least: float) -> Column:
    """The sequence matcher's ratio without junk where it is `least` or more, else 0."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([ratio_from(p or "", q or "", least) for p, q in zip(x, y, strict=True)], dtype="float64")

    return pandas_udf(run, DoubleType())(a, b)


def _ratios(a: pd.Series, b: pd.Series, junk: bool) -> pd.Series:
    return pd.Series([ratio(x or "", y or "", junk) for x, y in zip(a, b, strict=True)], dtype="float64")


@pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _ratios(a, b, True)


@pandas_udf(DoubleType())
def seq_ratio_all(a: pd.Series, b: pd.Series) -> pd.Series:
    """Frequent characters of long texts count too."""
    return _ratios(a, b, False)


def balance(a: Column, b: Column) -> Column:
    n, m = F.length(a), F.length(b)
    return F.least(n, m).cast("double") / F.greatest(F.lit(1), n, m)


def char_counts(c: Column) -> Column:
    """How often a text has each of its characters, as a map: to be worked out once for a text that is compared with many."""
    chars = F.filter(F.array_distinct(F.split(c, "")), lambda x: x != "")
    return F.map_from_arrays(chars, F.transform(chars, lambda x: F.length(c) - F.length(F.replace(c, x, F.lit("")))))


def counts_coverage(a: Column, b: Column, length: Column) -> Column:
    """multiset_coverage() of two texts by their char_counts(), length being that of the first."""
    both = F.aggregate(F.map_entries(a), F.lit(0), lambda n, e: n + F.least(e["value"], F.coalesce(F.try_element_at(b, e["key"]), F.lit(0))))
    return F.when(length > 0, both / length).otherwise(F.lit(0.0))


def multiset_coverage(a: Column, b: Column) -> Column:
    """Share of a's characters, repeats included, that b has too; an empty a gives 0."""

    def both(total: Column, char: Column) -> Column:
        count = lambda t: F.length(t) - F.length(F.replace(t, char, F.lit("")))
        return total + F.when(char == "", F.lit(0)).otherwise(F.least(count(a), count(b))).cast("double")

    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0.0), both)
    return F.when(F.length(a) > 0, shared / F.length(a)).otherwise(F.lit(0.0))
