"""Labels of organisations from their pages and from knowledge graphs, and audits of fields."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# JSON-LD fields that name a denomination, in the order in which they are tried.
JSONLD_FIELDS = ("denomination", "religiousDenomination", "denominationalAffiliation", "affiliation")
DEEPEST = 5


def crawl_jsonld(data: object, depth: int = 0) -> str | None:
    """The first of JSONLD_FIELDS with a text of over two characters, in this object or, depth first, in those below it."""
    if depth > DEEPEST:
        return None
    if isinstance(data, dict):
        own = next((v for k in JSONLD_FIELDS if isinstance(v := data.get(k), str) and len(v) > 2), None)
        if own:
            return own
    below = data.values() if isinstance(data, dict) else data if isinstance(data, list) else ()
    return next((found for x in below if (found := crawl_jsonld(x, depth + 1))), None)


@F.pandas_udf(T.StringType())
def jsonld_label(blocks: pd.Series) -> pd.Series:
    """The label of the first of a page's JSON-LD blocks that has one; blocks that are no JSON are passed over."""

    def first(texts) -> str | None:
        for text in [] if texts is None else texts:
            try:
                found = crawl_jsonld(json.loads(text))
            except ValueError:
                continue
            if found:
                return found
        return None

    return blocks.map(first)


def keyword_label(text: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """The label of the first rule of which any keyword is in the text, as upper case; null if none is."""
    up, out = F.upper(text), None
    for words, label in rules:
        hit = up.rlike("|".join(rf"\Q{w.upper()}\E" for w in words))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def webpage_label(html: Column, title: Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """A struct (label, method): from JSON-LD, else keywords of the page, else of its title, else unknown.

    method: jsonld, body_keyword, title_keyword, no_match, or no_content for null and empty pages. Python runs only over
    the JSON-LD blocks.
    """
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*type=\"application/ld\+json\"[^>]*>(.*?)</script>"), 1)
    pair = lambda label, method: F.struct(label.alias("label"), F.lit(method).alias("method"))
    ld, body, head = jsonld_label(blocks), keyword_label(html, rules), keyword_label(title, rules)
    out = F.when(F.coalesce(html, F.lit("")) == "", pair(F.lit("unknown"), "no_content")).when(ld.isNotNull(), pair(ld, "jsonld"))
    return out.when(body.isNotNull(), pair(body, "body_keyword")).when(head.isNotNull(), pair(head, "title_keyword")).otherwise(pair(F.lit("unknown"), "no_match"))


def graph_label(description: Column, categories: Column, words: Sequence[tuple[str, Sequence[str]]], kinds: Mapping[str, str]) -> Column:
    """The label of a knowledge-graph entry, null if unknown: by words in its description, else by the first of its
    categories (structs with name and id) whose name, or else id, kinds has; `unknown` in kinds is no label."""
    by_word = keyword_label(description, [(w, label) for label, w in words])
    table = F.create_map(*[F.lit(x) for k, v in kinds.items() if v != "unknown" for x in (k, v)])
    known = lambda c: F.try_element_at(table, F.lower(F.coalesce(c, F.lit(""))))
    found = F.filter(F.transform(categories, lambda c: F.coalesce(known(c["name"]), known(c["id"]))), lambda x: x.isNotNull())
    return F.coalesce(by_word, F.get(found, F.lit(0)))


def field_confidence(website: Column, email: Column, checked: Column, lat: Column, lon: Column, source: Column) -> Column:
    """A struct (website, email, geocode) of confidences: 0.7 for a website, 0.3 for a blank one; the checker's figure over 0,
    else 0.5 for an e-mail; 0.95 for a street match, 0.6 for a ZIP's centre, 0.3 for other coordinates; null for nothing."""
    return F.struct(
        F.when(website != "", 0.7).when(website.isNotNull(), 0.3).alias("website"),
        F.when(checked > 0, checked).when(email != "", 0.5).alias("email"),
        F.when(source == "census_street", 0.95).when(source == "zip_centroid", 0.6).when(lat.isNotNull() & lon.isNotNull(), 0.3).alias("geocode"),
    )


def with_source(sources: Column, name: str) -> Column:
    """A comma list with one more name behind it; null and empty lists begin with it."""
    return F.concat_ws(",", F.nullif(sources, F.lit("")), F.lit(name))


# Names of nodes that look like leftovers.
SUSPICIOUS = r"(?i)\?|unknown|n/a|tbd|xxx|test|temp|delete|misc$|^node |^\d+$"


def suspicious_name(name: Column) -> Column:
    return F.coalesce(name.rlike(SUSPICIOUS), F.lit(False))
