"""Fuzzy string scores that Spark lacks, as Arrow-batched functions, and phonetic keys as built-in expressions."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import linkage_name, parse_address


def jaro_winkler_of(a: str, b: str, weight: float = 0.1, most: int = 4) -> float:
    """Jaro similarity raised by the common prefix (at most four characters), whatever the Jaro similarity is."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken, mine = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                mine.append(x)
                break
    m = len(mine)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(mine, (y for y, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    while prefix < min(most, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * weight * (1 - jaro)


def _pairwise(score):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _pairwise(jaro_winkler_of)(a, b)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all, by longest matching blocks; the order of the arguments matters."""
    return _pairwise(lambda x, y: SequenceMatcher(None, x, y).ratio())(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """sequence_ratio of the sorted lower-case words."""
    key = lambda c: F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), " ")), " ")
    return sequence_ratio(key(a), key(b))


@F.pandas_udf(T.StringType())
def to_ascii(c: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks; characters without an ASCII form are dropped."""
    return c.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


# Consonant classes of the phonetic key.
SOUND_CLASSES = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}


def phonetic_key(c: Column) -> Column:
    """A letter and three digits: the first character of a word, then the classes of the others, repeats in a row once.

    Unlike F.soundex, the first letter's own class doesn't silence the next letter, and vowels don't part repeats. The empty
    word gives 0000.
    """
    word = F.upper(c)
    table = F.create_map(*[F.lit(x) for group, digit in SOUND_CLASSES.items() for letter in group for x in (letter, digit)])
    rest = F.filter(F.split(F.substring(word, 2, 1 << 20), ""), lambda x: x != "")
    digits = F.filter(F.transform(rest, lambda x: F.try_element_at(table, x)), lambda x: x.isNotNull())
    once = F.filter(digits, lambda d, i: (i == 0) | (d != F.get(digits, i - 1)))
    return F.when(word == "", F.lit("0000")).otherwise(F.concat(F.substring(word, 1, 1), F.rpad(F.array_join(F.slice(once, 1, 3), ""), 3, "0")))


def block_keys(name: Column) -> Column:
    """The phonetic keys of the first two words of over two letters of the linkage_name, joined by a bar; XXXX if there is none."""
    words = F.filter(F.split(linkage_name(name), " "), lambda w: F.length(w) > 2)
    return F.when(F.size(words) == 0, F.lit("XXXX")).otherwise(F.array_join(F.transform(F.slice(words, 1, 2), phonetic_key), "|"))


def street_block_key(address: Column) -> Column:
    """The phonetic key of the first word of an address's street name; XXXX if there is none."""
    first = F.substring_index(parse_address(address)["stem"], " ", 1)
    return F.coalesce(phonetic_key(first), F.lit("XXXX"))


# Words of an organisation's name that say nothing, and words that tell its page.
EMPTY_WORDS = ("inc", "llc", "church", "ministries", "org", "corporation")
PAGE_WORDS = ("church", "ministry", "worship", "sunday", "service", "pastor", "congregation", "chapel", "gospel")


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?i)\b({'|'.join(EMPTY_WORDS)})\b\.?", ""), r"\s+", " "))


def title_score(title: Column, name: Column) -> Column:
    """How well a page title fits a name, 0 to 1; 0 for nulls and empty texts.

    1.0: equal but for EMPTY_WORDS and white space; 0.9: the title holds the name; 0.8 and 0.6: it has at least 70 % and
    50 % of the name's distinct words; else 0.7 of sequence_ratio, to two places.
    """
    t, n = F.lower(F.trim(title)), F.lower(F.trim(name))
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit("[a-z0-9]+"), 0))
    share = F.try_divide(F.size(F.array_intersect(words(n), words(t))).cast("double"), F.size(words(n)))
    missing = F.coalesce(F.length(title) == 0, F.lit(True)) | F.coalesce(F.length(name) == 0, F.lit(True))
    out = F.when(missing, 0.0).when(_plain(t) == _plain(n), 1.0).when(F.contains(t, n), 0.9)
    return out.when(share >= 0.7, 0.8).when(share >= 0.5, 0.6).otherwise(F.round(sequence_ratio(t, n) * 0.7, 2))


def match_score(name: Column, city: Column, state: Column, title: Column, description: Column, body: Column) -> Column:
    """A struct (score, is_match): half the title score, 0.15 for the city and 0.10 for the state anywhere in the page, 0.05
    for each of PAGE_WORDS in its body, 0.25 at most; one at most in all, to two places; a match from 0.5 on.

    Place names count only on pages with a title. Nulls are empty texts.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    page = F.when(text(title) != "", F.lower(F.concat_ws(" ", text(title), text(description), text(body)))).otherwise(F.lit(""))
    has = lambda c, points: F.when((text(c) != "") & F.contains(page, F.lower(text(c))), points).otherwise(0.0)
    told = sum((F.contains(F.lower(text(body)), F.lit(w)).cast("int") for w in PAGE_WORDS), F.lit(0))
    total = title_score(title, name) * 0.5 + has(city, 0.15) + has(state, 0.10) + F.least(told * 0.05, F.lit(0.25))
    return F.struct(F.round(F.least(total, F.lit(1.0)), 2).alias("score"), (F.round(total, 9) >= 0.5).alias("is_match"))


def result_score(name: Column, url: Column, title: Column) -> Column:
    """How well a search result fits a name: the title's score if over 0.5, else the larger of it and 0.6 of the share of the
    name's runs of letters a-z that have over three letters and stand in the URL; to two places. Nulls are empty texts."""
    by_title = title_score(title, name)
    pieces = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    told = F.size(F.filter(pieces, lambda p: (F.length(p) > 3) & F.contains(F.lower(F.coalesce(url, F.lit(""))), p)))
    share = told / F.greatest(F.size(pieces), F.lit(1))
    return F.when(by_title > 0.5, by_title).otherwise(F.round(F.greatest(by_title, share * 0.6), 2))
