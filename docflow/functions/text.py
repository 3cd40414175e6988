"""Scalar expressions over text: sizes, tokens, terms, n-grams, stop words and stems."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the frequent English words that the analyzer leaves out by default.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "were", "with")
WHITE_SPACE = r"(?U)[\s\x1c-\x1f]+"


def n_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def n_tokens(text: Column) -> Column:
    """Runs of characters between Unicode white space."""
    return F.size(F.filter(F.split(text, WHITE_SPACE), lambda x: x != "")).cast("long")


def terms(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """Lower-case runs of letters and digits, in order; null gives no terms."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop_words)) if stop_words else found


def ngrams(term: Column, least: int, most: int, prefix_only: bool = False) -> Column:
    """All n-grams of the lengths from least to most, by length and then place; only those at the start if prefix_only."""

    def of_length(n: Column) -> Column:
        last = F.lit(1) if prefix_only else F.length(term) - n + 1
        return F.when(F.length(term) >= n, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(term, i, n))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(F.sequence(F.lit(least), F.lit(most)), of_length))


def n_ngrams(found: Column, least: int, most: int, prefix_only: bool = False) -> Column:
    """How many n-grams the terms have, without making them."""

    def of_term(t: Column) -> Column:
        n = F.length(t)
        return sum((F.greatest(F.lit(0), F.least(F.lit(1), n - k + 1) if prefix_only else n - k + 1) for k in range(least, most + 1)), F.lit(0))

    return F.aggregate(found, F.lit(0), lambda s, t: s + of_term(t))


def ngram_frequency(whole: Column, gram: str, prefix_only: bool = False) -> Column:
    """How often an n-gram stands in terms, each of which follows a line feed in `whole`."""
    return F.regexp_count(whole, F.lit(rf"\n\Q{gram}\E" if prefix_only else rf"(?=\Q{gram}\E)"))


def contains_all(found: Column, wanted: list[str]) -> Column:
    return F.forall(F.array(*map(F.lit, wanted)), lambda t: F.array_contains(found, t)) if wanted else F.lit(True)


def contains_any(found: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(found, F.array(*map(F.lit, wanted))) if wanted else F.lit(False)


def joined(found: Column) -> Column:
    """The terms in one text, each after a line feed."""
    return F.concat(F.lit("\n"), F.array_join(found, "\n"))


def contains_phrase(found: Column, wanted: list[str | list[str]]) -> Column:
    """Whether the terms stand one after the other; a list stands for any of its terms. Terms hold no line feed: the joined terms are searched once."""
    if not wanted:
        return F.lit(True)
    whole = F.concat(joined(found), F.lit("\n"))
    if all(isinstance(w, str) for w in wanted):
        return F.contains(whole, F.lit("\n" + "\n".join(wanted) + "\n"))
    places = ["(?:" + "|".join(rf"\Q{t}\E" for t in ([w] if isinstance(w, str) else w)) + ")" if w else "(?!)" for w in wanted]
    return whole.rlike("\n" + "\n".join(places) + "\n")


def _measure(stem: str) -> int:
    kinds = ["v" if _vowel(stem, i) else "c" for i in range(len(stem))]
    return sum(a == "v" and b == "c" for a, b in zip(kinds, kinds[1:]))


def _vowel(w: str, i: int) -> bool:
    return w[i] in "aeiou" or w[i] == "y" and i > 0 and not _vowel(w, i - 1)


def _has_vowel(w: str) -> bool:
    return any(_vowel(w, i) for i in range(len(w)))


def _short_end(w: str) -> bool:
    n = len(w)
    return n >= 3 and not _vowel(w, n - 1) and _vowel(w, n - 2) and not _vowel(w, n - 3) and w[-1] not in "wxy"


# The suffix tables of Porter's published algorithm.
STEP_2 = "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble"
STEP_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def porter(w: str) -> str:
    """The stem of an English word by Porter's algorithm."""
    if len(w) <= 2 or not w.isascii() or not w.isalpha():
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and _has_vowel(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and not _vowel(w, len(w) - 1) and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _short_end(w):
                    w += "e"
                break
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for table in (STEP_2, STEP_3):
        for pair in sorted(table.split(), key=lambda p: -len(p.split(":")[0])):
            end, new = pair.split(":")
            if w.endswith(end):
                w = w[: -len(end)] + new if _measure(w[: -len(end)]) > 0 else w
                break
    for end in sorted(STEP_4.split(), key=len, reverse=True):
        if w.endswith(end):
            stem = w[: -len(end)]
            if _measure(stem) > 1 and (end != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e"):
        stem = w[:-1]
        if _measure(stem) > 1 or _measure(stem) == 1 and not _short_end(stem):
            w = stem
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stemmer():
    """An Arrow-batched function from a term to its stem, for columns of distinct terms."""

    def stem(words: pd.Series) -> pd.Series:
        return words.map(lambda w: None if w is None else porter(w))

    stem.__annotations__ = {"words": pd.Series, "return": pd.Series}
    return F.pandas_udf(stem, "string")
