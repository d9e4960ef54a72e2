"""Cleaning and parsing of names, addresses, contacts and pages, as expressions of built-in functions.

Null in gives null out unless said otherwise; texts that become empty become null where the docstring says so.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal words that end or fill names.
LEGAL_WORDS = ("INC", "LLC", "CORP", "CORPORATION", "ORG")

# Words that end a street's name, and directions before it.
STREET_SUFFIXES = ("AVENUE", "STREET", "BOULEVARD", "ROAD", "DRIVE", "PLACE", "COURT", "LANE", "TERRACE", "PARKWAY", "SQUARE")
DIRECTIONS = ("NORTH", "SOUTH", "EAST", "WEST")

# Scripts and their Unicode ranges, in the order in which they are listed.
SCRIPTS = {
    "Cyrillic": "\u0400-\u04FF", "Greek": "\u0370-\u03FF", "Arabic": "\u0600-\u06FF", "Hebrew": "\u0590-\u05FF",
    "CJK": "\u4E00-\u9FFF\u3400-\u4DBF", "Hiragana": "\u3040-\u309F", "Katakana": "\u30A0-\u30FF", "Hangul": "\uAC00-\uD7AF",
    "Thai": "\u0E00-\u0E7F", "Tamil": "\u0B80-\u0BFF", "Gurmukhi": "\u0A00-\u0A7F", "Bengali": "\u0980-\u09FF",
    "Devanagari": "\u0900-\u097F", "Georgian": "\u10A0-\u10FF", "Armenian": "\u0530-\u058F", "Myanmar": "\u1000-\u109F",
    "Khmer": "\u1780-\u17FF", "Lao": "\u0E80-\u0EFF", "Sinhala": "\u0D80-\u0DFF", "Tibetan": "\u0F00-\u0FFF", "Ethiopic": "\u1200-\u137F",
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def squeeze(c: Column) -> Column:
    """White space runs become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_text(c: Column) -> Column:
    """Squeezed, without commas, semicolons and colons at the end."""
    return F.rtrim(F.regexp_replace(squeeze(c), r"[\s,;:]+$", ""))


def clean_label(c: Column) -> Column:
    """clean_text, with doubled apostrophes halved and a code of capitals and digits in parentheses at the end, as (X20), dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(clean_text(c), "''", "'"), r"\s*\([A-Z0-9]+\)\s*$", ""))


def clean_name(c: Column) -> Column:
    """clean_text without legal words, wherever they stand, and without parentheses, which become a blank."""
    bare = F.regexp_replace(clean_text(c), rf"(?i)\b(?:{'|'.join(LEGAL_WORDS)})\b\.?", "")
    return squeeze(F.regexp_replace(bare, r"\s*\(.*?\)\s*", " "))


def match_name(c: Column) -> Column:
    """Upper case; after the first word INC, LLC, CORP, PC, PA and THE become blanks, then A and AN between words; no leading THE."""
    words = F.upper(F.trim(c))
    for gone in (r"\s+INC\b", r"\s+LLC\b", r"\s+CORP\b", r"\s+PC\b", r"\s+PA\b", r"\s+THE\b", r"\s+A\s+", r"\s+AN\s+"):
        words = F.regexp_replace(words, gone, " ")
    return F.regexp_replace(squeeze(words), r"^THE\s+", "")


def expand_words(c: Column, table: dict[str, str]) -> Column:
    """Each blank-separated word replaced by its entry in table."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.try_element_at(entries, w), w)), " ")


# Abbreviations in names and addresses of old directories.
DIRECTORY_WORDS = {"ST": "STREET", "MT": "MOUNT", "AVE": "AVENUE", "AV": "AVENUE", "BLVD": "BOULEVARD", "N": "NORTH", "S": "SOUTH", "E": "EAST", "W": "WEST", "CH": "CHURCH"}


def linkage_name(c: Column) -> Column:
    """Upper case, punctuation as blanks, abbreviations spelled out, ST as STREET; empty for null. A key: all sources go through it."""
    return F.coalesce(expand_words(squeeze(F.regexp_replace(F.upper(c), r"[^\p{L}\p{N}_\s]", " ")), DIRECTORY_WORDS), F.lit(""))


def content_words(c: Column, stop: tuple[str, ...], least: int = 3) -> Column:
    """The distinct lower-case words of at least `least` characters that are not in stop, in order."""
    words = F.split(squeeze(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= least) & ~w.isin(*stop)))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct entries of two arrays; 0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def clean_domain(c: Column) -> Column:
    """The host of a URL or domain: lower case, without scheme, user, port, path and www. Empty becomes null."""
    host = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(host, r"[/?#].*$", ""), r"^[^@]*@", "")
    return null_if_empty(F.regexp_replace(F.regexp_replace(host, r":\d+$", ""), r"^www\.", ""))


def ensure_url(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t == "", F.lit(None).cast("string")).when(F.lower(t).rlike(r"^https?://"), t).otherwise(F.concat(F.lit("https://"), t))


def _ten_digits(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    return F.when(F.length(digits) == 10, digits).when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10))


def clean_phone(c: Column) -> Column:
    """(XXX) XXX-XXXX for ten digits, with or without a leading 1; anything else is trimmed."""
    d = _ten_digits(c)
    return F.when(d.isNotNull(), F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))).otherwise(F.trim(c))


def phone_e164(c: Column) -> Column:
    """A struct (phone, confidence): +1 and ten digits at 1.0, else the text at 0.3; null for nulls and blanks."""
    d = _ten_digits(c)
    found = F.when(d.isNotNull(), F.struct(F.concat(F.lit("+1"), d).alias("phone"), F.lit(1.0).alias("confidence")))
    return found.when(F.trim(c) != "", F.struct(F.trim(c).alias("phone"), F.lit(0.3).alias("confidence")))


def clean_zip(c: Column) -> Column:
    """The first five digits; null if there is none."""
    return null_if_empty(F.substring(F.regexp_replace(c, r"\D", ""), 1, 5))


def zip_key(c: Column) -> Column:
    """ZIP for lookups: what stands before +4, padded to five digits."""
    return F.lpad(F.trim(F.substring_index(c, "-", 1)), 5, "0")


def clean_email(c: Column) -> Column:
    """Lower case, without mailto:, brackets around it, notes in parentheses and dots at the end."""
    t = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^mailto:", ""), r"^<(.*)>$", "$1")
    return F.regexp_replace(F.trim(F.regexp_replace(t, r"\s*\(.*?\)\s*", "")), r"\.+$", "")


# How likely a person answers, by the part before the @.
MAILBOX_SCORES = {
    "pastor": 1.0, "reverend": 1.0, "rev": 1.0, "fr": 0.9, "father": 0.9, "minister": 1.0, "vicar": 1.0, "rector": 1.0,
    "canon": 0.9, "deacon": 0.9, "bishop": 1.0, "apostle": 0.9, "evangelist": 0.9, "admin": 0.7, "office": 0.7, "info": 0.6,
    "contact": 0.6, "hello": 0.5, "secretary": 0.8, "administrator": 0.7, "manager": 0.6, "youth": 0.7, "children": 0.7,
    "worship": 0.7, "music": 0.7, "outreach": 0.7, "missions": 0.7, "communications": 0.7, "webmaster": 0.4,
    "hostmaster": 0.3, "support": 0.4, "noreply": 0.0, "no-reply": 0.0, "donotreply": 0.0, "bounce": 0.0,
    "mailer-daemon": 0.0, "postmaster": 0.0,
}
# Mailbox providers, whose domains say nothing about an organisation.
FREE_MAIL = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "verizon.net", "comcast.net", "att.net", "msn.com", "live.com", "icloud.com", "mail.com")


def mailbox_score(local: Column) -> Column:
    """By the part before the @: its listed score, else 0.8 for a name or two names with a dot, of three letters or more, else 0.3."""
    local = F.lower(F.trim(local))
    table = F.create_map(*[F.lit(x) for pair in MAILBOX_SCORES.items() for x in pair])
    by_shape = F.when(local.rlike(r"^[a-z]+(\.[a-z]+)?$") & (F.length(local) > 2), 0.8).otherwise(0.3)
    return F.coalesce(F.try_element_at(table, local), by_shape)


def email_score(email: Column) -> Column:
    """0.6 mailbox score + 0.4 domain score (free mail 0.4, three dots or more 0.5, other 0.9), to two places.

    0 for null, empty and what has not one @ between two parts.
    """
    whole = F.trim(email)
    domain = F.lower(F.substring_index(whole, "@", -1))
    dots = F.length(domain) - F.length(F.replace(domain, F.lit("."), F.lit("")))
    by_domain = F.when(domain.isin(*FREE_MAIL), 0.4).when(dots > 2, 0.5).otherwise(0.9)
    score = F.round(mailbox_score(F.substring_index(whole, "@", 1)) * 0.6 + by_domain * 0.4, 2)
    return F.coalesce(F.when(whole.rlike(r"^[^@]+@[^@]+$"), score), F.lit(0.0))


def parse_address(c: Column) -> Column:
    """A struct (number, direction, stem, suffix) of a street address; parts that are missing are null.

    Words are those of linkage_name, so that the same abbreviations are spelled out in every place, and no others.
    """
    first, last = lambda ws: F.get(ws, F.lit(0)), lambda ws: F.get(ws, F.size(ws) - 1)
    after = lambda ws, found: F.when(found.isNotNull(), F.slice(ws, F.lit(2), F.size(ws))).otherwise(ws)

    def ended(ws: Column, number: Column, direction: Column) -> Column:
        suffix = F.when(last(ws).isin(*STREET_SUFFIXES), last(ws))
        stem = F.when(suffix.isNotNull(), F.slice(ws, F.lit(1), F.size(ws) - 1)).otherwise(ws)
        return F.struct(number.alias("number"), direction.alias("direction"), null_if_empty(F.array_join(stem, " ")).alias("stem"), suffix.alias("suffix"))

    def directed(ws: Column, number: Column) -> Column:
        direction = F.when(first(ws).isin(*DIRECTIONS), first(ws))
        return let(after(ws, direction), lambda rest: ended(rest, number, direction))

    def numbered(ws: Column) -> Column:
        number = F.when(first(ws).rlike(r"^\d+[A-Z]?$"), first(ws))
        return let(after(ws, number), lambda rest: directed(rest, number))

    return let(F.filter(F.split(linkage_name(c), " "), lambda w: w != ""), numbered)


def address_key(parsed: Column) -> Column:
    """The four parts of a parsed address in one text, parted by bars; missing parts are empty."""
    return F.concat_ws("|", *[F.coalesce(parsed[p], F.lit("")) for p in ("number", "direction", "stem", "suffix")])


def same_address(a: Column, b: Column) -> Column:
    """Whether two parsed addresses agree: equal direction and stem, numbers that don't contradict, and one known."""
    number = F.coalesce(a["number"] == b["number"], F.lit(True)) & (a["number"].isNotNull() | b["number"].isNotNull())
    return F.coalesce(a["direction"].eqNullSafe(b["direction"]) & (a["stem"] == b["stem"]) & number, F.lit(False))


def without_po_box(c: Column) -> Column:
    """An address of three comma parts or more that names a post-office box keeps the last three."""
    parts = F.transform(F.split(c, ","), lambda p: F.trim(p))
    boxed = F.upper(c).rlike(r"\b(PO BOX|P\.?O\.?\s*BOX|POB|BOX)\b") & (F.size(parts) >= 3)
    return F.when(boxed, F.array_join(F.slice(parts, -3, 3), ", ")).otherwise(c)


def split_city_state(c: Column) -> Column:
    """A struct (city, state) of `City, ST`; the state is null if the last part is no two letters."""
    state = F.upper(F.trim(F.element_at(F.split(c, ","), -1)))
    ok = state.rlike(r"^[A-Z]{2}$") & c.contains(",")
    return F.struct(F.when(ok, F.trim(F.regexp_replace(c, r",[^,]*$", ""))).otherwise(F.trim(c)).alias("city"), F.when(ok, state).alias("state"))


def split_address_line(c: Column) -> Column:
    """A struct (street, city, state, zip) of `street, city, ST, 12345[-6789]`.

    Parts between commas: the street is the first, the ZIP the last if it is one, then the state the last of the others if it
    is two capitals, and the city the second of what is left. Nulls and texts without a part give four nulls.
    """
    last = lambda a: F.get(a, F.size(a) - 1)
    before = lambda a, found: F.when(found.isNotNull(), F.slice(a, F.lit(1), F.size(a) - 1)).otherwise(a)

    def named(rest: Column, street: Column, state: Column, code: Column) -> Column:
        city = F.when(F.size(rest) > 1, F.get(rest, F.lit(1))).when(F.get(rest, F.lit(0)) != street, F.get(rest, F.lit(0)))
        return F.struct(street.alias("street"), city.alias("city"), state.alias("state"), code.alias("zip"))

    def stated(rest: Column, street: Column, code: Column) -> Column:
        state = F.when(last(rest).rlike(r"^[A-Z]{2}$"), last(rest))
        return let(before(rest, state), lambda others: named(others, street, state, code))

    def coded(parts: Column) -> Column:
        code = F.when(last(parts).rlike(r"^\d{5}(-\d{4})?$"), F.substring(last(parts), 1, 5))
        return let(before(parts, code), lambda rest: stated(rest, F.get(parts, F.lit(0)), code))

    split = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
    return let(split, coded)


def scripts_in(c: Column) -> Column:
    """The listed scripts of which the text holds a character, in the order of the list; empty for Latin text."""
    return F.array_compact(F.array(*[F.when(c.rlike(f"[{span}]"), F.lit(name)) for name, span in SCRIPTS.items()]))


def list_items(c: Column) -> Column:
    """The trimmed, non-empty items of a comma list, as an array."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def strip_tags(c: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags as blanks, common references decoded, white space squeezed."""
    t = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for code, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(code), F.lit(text))
    return squeeze(t)


def emails_in(c: Column) -> Column:
    """The distinct addresses in a text, lower case, sorted, without those of images."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}"), 0)
    return F.array_sort(F.array_distinct(F.filter(found, lambda e: ~e.rlike(r"\.(?:png|jpe?g|gif|svg|webp)$"))))


def phones_in(c: Column) -> Column:
    """The distinct ten-digit phone numbers in a text, formatted, sorted."""
    found = F.regexp_extract_all(c, F.lit(r"(?:\+?1[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b"), 0)
    return F.array_sort(F.array_distinct(F.transform(found, clean_phone)))


def social_links(c: Column) -> Column:
    """The distinct links to profiles on social networks in a page, sorted."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"https?://(?:www\.)?(?:facebook|instagram|twitter|youtube)\.com/[a-z0-9_./@-]+"), 0)
    return F.array_sort(F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"/+$", ""))))


def service_times(c: Column, most: int = 5) -> Column:
    """The first `most` distinct clock times with a day before them, as `sunday 10:30 am`. The cap is the feature."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"((?:sun|mon|tues|wednes|thurs|fri|satur)days?[^0-9<]{0,20}\d{1,2}(?::\d{2})?\s*[ap]\.?m)"), 1)
    return F.slice(F.array_distinct(F.transform(found, lambda t: squeeze(F.regexp_replace(t, r"[^a-z0-9: ]+", " ")))), 1, most)


def domain_guesses(name: Column, city: Column) -> Column:
    """Likely domains of an organisation: its joined words, their initials and the city, under .org, .com and .net."""
    words = F.split(squeeze(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", " ")), " ")
    joined, initials = F.array_join(words, ""), F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    place = F.regexp_replace(F.lower(city), r"[^a-z0-9]+", "")
    stems = F.array_distinct(F.array_compact(F.array(joined, F.concat(initials, place), F.concat(joined, place), F.array_join(words, "-"))))
    return F.flatten(F.transform(F.filter(stems, lambda s: F.length(s) >= 4), lambda s: F.array(*[F.concat(s, F.lit(end)) for end in (".org", ".com", ".net")])))


def without_suffixes(c: Column, suffixes: tuple[str, ...]) -> Column:
    """The text without any of the suffix words at its end, repeatedly."""
    return F.regexp_replace(c, rf"(?i)(?:[\s,]+(?:{'|'.join(suffixes)})\.?)+\s*$", "")
