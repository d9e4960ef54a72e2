"""What an organisation's page tells: activities, languages, affiliation, headcount, money, clergy, times and profiles.

Expressions of built-in functions. Null pages give empty lists, zero and false. A fact is what the page says somewhere; words
are looked for as parts of the lower-case page, markup included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

Words = Mapping[str, Sequence[str]]

# Activities and the words that tell them, in the order in which they are listed.
ACTIVITIES = {
    "youth": ("youth", "youth group", "teen", "student ministry", "youth ministry", "junior high", "high school"),
    "children": ("children", "kids", "kids ministry", "children's ministry", "nursery", "preschool", "childcare", "vbs", "vacation bible"),
    "food_pantry": ("food pantry", "food bank", "food ministry", "community meals", "soup kitchen", "food assistance"),
    "preschool": ("preschool", "pre-k", "pre k", "daycare", "child care", "early learning", "mother's day out", "mdo"),
    "daycare": ("daycare", "day care", "child development center", "cdc"),
    "worship_band": ("worship team", "worship band", "praise team", "choir", "worship ministry"),
    "small_groups": ("small group", "life group", "community group", "home group", "bible study", "discipleship"),
    "missions": ("missions", "mission trip", "global missions", "local missions", "outreach"),
    "counseling": ("counseling", "pastoral care", "support group", "grief share"),
    "seniors": ("senior", "seniors ministry", "golden age", "prime timers", "silver", "retiree"),
    "addiction": ("celebrate recovery", "aa meeting", "na meeting", "recovery ministry", "addiction"),
    "esl": ("esl", "english as a second", "english classes", "english language"),
    "recovery": ("recovery program", "recovery ministry", "12 step", "addiction help"),
    "men": ("men's ministry", "men of faith", "men's group", "iron sharpens"),
    "women": ("women's ministry", "women of faith", "women's group", "sisterhood"),
    "marriage": ("marriage ministry", "couples ministry", "marriage conference", "marriage retreat"),
    "college": ("college ministry", "campus ministry", "young adult", "university"),
    "music": ("music ministry", "worship ministry", "choir", "worship team", "praise team"),
    "sports": ("sports ministry", "upward", "sports camp", "athletic"),
    "summer_camp": ("summer camp", "vbs", "vacation bible school", "kids camp"),
}

# Languages of services and the words that tell them.
LANGUAGES = {
    "spanish": ("español", "spanish", "servicio en español", "iglesia", "hispanic", "latino"),
    "korean": ("한국어", "korean", "한글"),
    "chinese": ("中文", "chinese", "cantonese", "mandarin", "粵語"),
    "french": ("français", "french"),
    "vietnamese": ("tiếng việt", "vietnamese"),
    "portuguese": ("português", "portuguese", "brasil"),
    "tagalog": ("tagalog", "filipino"),
    "arabic": ("arabic", "العربية"),
    "russian": ("russian", "русский"),
}

# Affiliations and the words that tell them.
AFFILIATIONS = {
    "Southern Baptist": ("southern baptist", "sbc", "southern baptist convention"),
    "United Methodist": ("united methodist", "umc", "methodist church"),
    "Catholic": ("catholic", "roman catholic", "catholic church"),
    "Lutheran (ELCA)": ("elca", "evangelical lutheran", "lutheran church"),
    "Lutheran (LCMS)": ("lcms", "lutheran church missouri", "missouri synod"),
    "Presbyterian (PCUSA)": ("pcusa", "presbyterian church usa", "presbyterian church (u.s.a.)"),
    "Presbyterian (PCA)": ("pca", "presbyterian church in america"),
    "Anglican/Episcopal": ("anglican", "episcopal church", "anglican church", "episcopal"),
    "Pentecostal (AG)": ("assemblies of god", "ag church", "assemblies of god church"),
    "Pentecostal (COGIC)": ("cogic", "church of god in christ"),
    "Pentecostal (Church of God)": ("church of god", "cog", "church of god of prophecy"),
    "Non-denominational": ("non-denominational", "nondenominational", "independent church", "non denominational"),
    "Baptist (ABCUSA)": ("american baptist", "abcusa"),
    "Baptist (Independent)": ("independent baptist", "independent fundamental baptist"),
    "Christian Church (Disciples)": ("christian church", "disciples of christ", "doctrine"),
    "Church of Christ": ("church of christ", "churches of christ"),
    "Congregational": ("congregational", "ucc", "united church of christ"),
    "Seventh-day Adventist": ("seventh-day adventist", "sda church", "adventist"),
    "Mennonite": ("mennonite", "brethren"),
    "Nazarene": ("nazarene", "church of the nazarene"),
    "Salvation Army": ("salvation army",),
    "Evangelical Free": ("evangelical free", "efca"),
    "Wesleyan": ("wesleyan church", "wesleyan"),
    "Calvary Chapel": ("calvary chapel",),
    "Foursquare": ("foursquare church", "foursquare"),
    "Orthodox": ("orthodox church", "greek orthodox", "russian orthodox", "orthodox"),
    "Reformed": ("reformed church", "reformed", "crcna"),
}

# Words and platforms of online giving; words of a new foundation.
GIVING = (
    "give", "donate", "giving", "online giving", "tithe", "offering", "pushpay", "subsplash", "churchcenter", "planning center",
    "ministryarchives", "easyttithe", "vanco", "tithely",
)
NEW_PLANT = ("church plant", "new campus", "launching", "planting", "we started")

# Patterns of headcounts, in the order in which they are tried.
HEADCOUNTS = (
    r"(\d{2,4})\s*(?:\+|-)?\s*(?:average\s+)?attend",
    r"attendance\s*(?:of|:)?\s*(\d{2,4})",
    r"(\d{2,4})\s*(?:\+|-)?\s*members?",
    r"members?\s*(?:of|:)?\s*(\d{2,4})",
    r"(\d{2,4})\s*people\s+(?:call|attend|worship)",
    r"we\s+have\s+(?:about|around|approximately|over)\s+(\d{2,4})",
)

# Patterns of financial pages, with a name for each, and of amounts.
FINANCES = {
    "annual report": r"annual\s+(?:report|budget|financial)\s*(?:report|statement)?",
    "audited": r"audited\s+financial",
    "form 990": r"form\s+990",
    "budget": r"our\s+budget",
    "transparency": r"financial\s+transparency",
}
AMOUNTS = (
    r"(?:annual|yearly|budget|raised)\s*(?::|of|is|about|around|over)?\s*\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
    r"\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)\s*(?:annual|yearly|budget|raised)",
    r"(?:goal|target|need)\s*(?::|of)?\s*\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
    r"(?:raised|collected)\s*(?:over|about|around|more than)?\s*\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
    r"campaign\s*(?::|of)?\s*\$(\d{1,3}(?:,\d{3})*(?:\.\d{2})?)",
)

# Patterns of the names of clergy, and of the times of services.
CLERGY = (
    r"(?:Pastor|Rev\.?|Reverend|Dr\.?)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
    r"(?:Senior Pastor|Lead Pastor|Head Pastor)\s*:\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
    r"(?:Pastor|Rev\.?|Reverend)\s+([A-Z]\.?\s*[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)",
    r"(?:Rector|Vicar|Priest)\s+(?:-|–)?\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
    r"(?:Rev\.?|Reverend)\s+(?:Canon|Dr\.?)?\s*([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})",
)
SPANS = r"(\d{1,2}:\d{2}\s*(?:am|pm|AM|PM))\s*(?:-|–|to)?\s*(\d{1,2}:\d{2}\s*(?:am|pm|AM|PM))?"
SUNDAYS = r"(?:Sundays?|Sunday mornings?|Weekends?)\s*(?:at\s*)?(\d{1,2}(?::\d{2})?\s*(?:am|pm|AM|PM))"
HOURS = r"(\d{1,2})(?::\d{2})?\s*(?:am|pm)"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(group)), F.array().cast("array<string>"))


def _any_of(text: Column, words: Sequence[str]) -> Column:
    """Whether the text, a bound variable, holds any of the words; words that hold another of them add nothing."""
    out = F.lit(False)
    for w in words:
        if not any(v != w and v in w for v in words):
            out = out | F.contains(text, F.lit(w))
    return F.coalesce(out, F.lit(False))


def mentions(text: Column, table: Words) -> Column:
    """The labels of which the text holds any word, in the table's order. The text is taken as it is: lower it first."""
    return let(text, lambda t: F.array_compact(F.array(*[F.when(_any_of(t, words), F.lit(label)) for label, words in table.items()])))


def activities(html: Column, table: Words = ACTIVITIES) -> Column:
    return mentions(F.lower(html), table)


def languages(html: Column, table: Words = LANGUAGES) -> Column:
    return mentions(F.lower(html), table)


def affiliations(html: Column, text: Column, name: Column, table: Words = AFFILIATIONS) -> Column:
    """The affiliations that a page tells, by its text without markup or with it; then, marked `(from name)`, those that only the name tells."""
    told = mentions(F.concat_ws(" ", F.lower(text), F.lower(html)), table)
    marked = lambda t: F.transform(F.array_except(mentions(F.lower(name), table), t), lambda x: F.concat(x, F.lit(" (from name)")))
    return let(told, lambda t: F.concat(t, marked(t)))


def headcount(html: Column, least: int = 10, most: int = 50000) -> Column:
    """The first of HEADCOUNTS whose first hit lies within the bounds; 0 if none does."""
    number = lambda t, p: F.regexp_extract(t, "(?U)" + p, 1).try_cast("int")
    fits = lambda n: F.when(n.between(least, most), n)
    return let(F.lower(html), lambda t: F.coalesce(*[let(number(t, p), fits) for p in HEADCOUNTS], F.lit(0)))


def finances(html: Column, over: int = 1000, most: int = 3) -> Column:
    """A struct (signs, amount): the first `most` names of FINANCES that the page shows, and the largest whole amount of
    dollars over `over` beside a word of budgets or appeals, 0 if none. Amounts with cents don't count."""

    def read(text: Column) -> Column:
        signs = F.array_compact(F.array(*[F.when(text.rlike("(?U)" + p), F.lit(name)) for name, p in FINANCES.items()]))
        whole = F.filter(F.concat(*[_all(text, p) for p in AMOUNTS]), lambda a: ~F.contains(a, F.lit(".")))
        large = F.filter(F.transform(whole, lambda a: F.regexp_replace(a, ",", "").try_cast("long")), lambda n: n > over)
        return F.struct(F.slice(signs, 1, most).alias("signs"), F.coalesce(F.array_max(large), F.lit(0).cast("long")).alias("amount"))

    return let(F.lower(html), read)


def online_giving(html: Column) -> Column:
    """Whether a page takes gifts: by its words, or by a link to such a page."""
    link = F.coalesce(html.rlike(r"(?i)href=['\"][^'\"]*(?:give|donate|giving)[^'\"]*['\"]"), F.lit(False))
    return let(F.lower(html), lambda t: _any_of(t, GIVING)) | link


def clergy(html: Column, most: int = 5) -> Column:
    """The first `most` distinct names behind a clerical title, pattern by pattern. The cap is the feature."""
    return F.slice(F.array_distinct(F.concat(*[_all(html, p) for p in CLERGY])), 1, most)


def meeting_times(html: Column, earliest: int = 6, latest: int = 21, most: int = 5) -> Column:
    """The first `most` distinct times: those with minutes and their ends (`9:00 am - 10:15 am`), then those behind Sunday or
    weekend. One hour named with am or pm must lie within the bounds. The cap is the feature."""
    hours = lambda t: F.regexp_extract_all(F.lower(t), F.lit("(?U)" + HOURS), F.lit(1))

    def read(text: Column) -> Column:
        spans = F.zip_with(_all(text, SPANS, 1), _all(text, SPANS, 2), lambda a, b: F.when(b == "", a).otherwise(F.concat(a, F.lit(" - "), b)))
        times = F.transform(F.concat(spans, _all(text, SUNDAYS)), lambda t: F.trim(t))
        held = F.filter(times, lambda t: (F.length(t) > 3) & F.exists(hours(t), lambda h: h.try_cast("int").between(earliest, latest)))
        return F.slice(F.array_distinct(held), 1, most)

    return let(F.translate(html, "\n", " "), read)


def profiles(html: Column, platforms: Sequence[str] = ("facebook", "youtube", "instagram")) -> Column:
    """A struct with the first link of the page to each platform; empty if there is none."""

    def first(platform: str) -> Column:
        link = rf"""(?i)(?:href|src)=["'](https?://(?:www\.)?(?:{platform}\.com|{platform}\.org)[^"']*)["']"""
        return F.coalesce(F.regexp_extract(html, link, 1), F.lit("")).alias(platform)

    return F.struct(*map(first, platforms))


def new_plant(html: Column) -> Column:
    """Whether a page speaks of a new foundation."""
    return let(F.lower(html), lambda t: _any_of(t, NEW_PLANT))
