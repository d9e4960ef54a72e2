"""Main text of web pages: page structure first, nearest-URL page differencing for what structure leaves open.

Pages are sorted by host and URL path, and each page is aligned with the page before and after it on the same host by a
longest common subsequence of text lines. A line that both hold in order is furniture of the site and is deleted. Articles
quote shared passages too, so inside an article it takes the agreement of all neighbours, or a place at the article's ends.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialize
from ._lcs import common_places

#: A tag whose quotes close before another tag begins or ends: what almost all are. No part of it can be matched in two ways.
TAG = re.compile(r"""</?([a-zA-Z][\w:-]*)(?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+>""")
NAME = re.compile(r"</?([a-zA-Z][\w:-]*)")
STOP = re.compile(r"""[>"']""")
#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea title iframe svg math object select canvas noembed noframes xmp".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
HINT = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>/=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never part of an article.
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset head".split())
#: Words of class, id and role that name furniture.
NAMED = frozenset(
    """ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar aside widget menu nav navbar navigation
    breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login
    comment comments reply replies respond disqus share sharing social related recommended recommendations popup modal overlay copyright legal
    pagination pager toolbar skip search contentinfo complementary form""".split()
)
#: Those that inside an article also name parts of its text: headings, notes, forms of words.
TEXTUAL = frozenset("header masthead form notice notices alert legal copyright banner search skip social".split())
OPTIONAL_END = frozenset("p li dt dd tr td th option".split())


def tokens(page: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, name) of the markup of a page, in one pass: the name of a tag in lower case, with / before that of an end tag
    and + before that of an element whose content is no markup, which is part of the token; empty for comments and declarations.

    Quotes in a tag may hold angle brackets. A tag with a quote that never closes ends at its first >; one without any > is text,
    as is a < that begins no tag. Quotes that lead nowhere are remembered, so that no piece of a broken page is read again
    and again.
    """
    last = {c: page.rfind(c) for c in ">\"'"}
    lost: set[int] = set()  # opening quotes after which no tag ends

    def tag_end(i: int) -> int:
        passed = []
        while i <= last[">"]:
            m = STOP.search(page, i)
            if m.group() == ">":
                return m.end()
            at = m.start()
            if at in lost or last[m.group()] == at:
                break
            passed.append(at)
            i = page.find(m.group(), at + 1) + 1
        lost.update(passed)
        return 0

    at = page.find("<")
    while at >= 0:
        end, name = 0, ""
        m = TAG.match(page, at)
        if m:
            end = m.end()
        elif page.startswith("<!--", at) or page.startswith("<![CDATA[", at):
            close = "-->" if page[at + 2] == "-" else "]]>"
            found = page.find(close, at)
            end = found + len(close) if found >= 0 else len(page)
        elif page[at + 1 : at + 2] in ("!", "?"):
            end = page.find(">", at) + 1 if at < last[">"] else 0
        elif (m := NAME.match(page, at)) is not None:
            end = tag_end(m.end()) or (page.find(">", at) + 1 if at < last[">"] else 0)
        if end:
            if m:
                name = ("/" if page[at + 1] == "/" else "") + m.group(1).lower()
                if name in RAW:
                    close = RAW_END[name].search(page, end)
                    end, name = close.end() if close else len(page), f"+{name}"
            yield at, end, name
        at = page.find("<", end or at + 1)


OUTSIDE, INSIDE, DOUBTFUL = 0, 1, 2


def parse(page: str) -> tuple[list[str], list[int]]:
    """The text lines of a page that are not furniture by element or name, and for each line whether it lies in its article.

    Lines end at every element that is not inline. All articles of a page count, but those within elements named as
    furniture only if there are no others; without an article, `main` stands in for it. Unclosed elements end with the
    element around them. A name never drops an article that lies in no other, nor an element around an article or main.
    Else an element is dropped if its id, its role, its label or a whole token of its class names furniture. If only a
    part of one does, its lines in an article are DOUBTFUL (for the neighbours to decide); on a page without article and
    main it is dropped unless it holds most of the text.
    """
    lines: list[tuple[str, int, int, tuple[int, ...]]] = []  # text, number of the outermost article, of main, open named elements
    parts: list[str] = []
    stack: list[str] = []
    skip_at = -1  # depth of the open element whose content is left out
    article = main = articles = mains = 0
    named: list[tuple[int, int]] = []  # depth and number of the open named elements
    sure: list[bool] = []  # for each named element whether its name is certain
    around: dict[int, set[int]] = {}  # the named elements around each article
    wraps: set[int] = set()  # named elements around an article or main

    def flush() -> None:
        if parts:
            text = " ".join(html_module.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append((text, article, main, tuple(k for _, k in named)))

    def close(depth: int) -> None:
        nonlocal skip_at
        if skip_at >= depth:
            skip_at = -1
        while named and named[-1][0] >= depth:
            named.pop()

    at = 0
    opened: Counter[str] = Counter()  # how often each name is on the stack
    for start, end, name in tokens(page):
        if start > at and skip_at < 0:
            parts.append(page[at:start])
        at = end
        if name[:1] in ("", "+"):
            if name in {"+title", "+textarea", "+iframe", "+select", "+object", "+noscript"}:
                flush()
            continue
        tag, closing, name = page[start:end], name[0] == "/", name.lstrip("/")
        if name not in INLINE:
            if skip_at < 0:
                flush()
            else:
                parts.clear()
        if closing:
            if opened[name]:
                while stack:
                    top = stack.pop()
                    opened[top] -= 1
                    close(len(stack))
                    if top == name:
                        break
                if name == "article" and not opened["article"]:
                    article = 0
                if name == "main":
                    main = 0
            continue
        if name in VOID or tag.endswith("/>"):
            continue
        if name in OPTIONAL_END and stack and stack[-1] == name:
            opened[stack.pop()] -= 1
            close(len(stack))
        if skip_at < 0:
            if name not in {"html", "body"} and HIDDEN.search(tag) or name in FURNITURE and name != "form" or name == "header" and not article:
                flush()
                skip_at = len(stack)
            elif name == "article" and not article:
                articles += 1
                article = articles
                around[article] = {k for _, k in named}
                wraps |= around[article]
            elif name == "main":
                if not main:
                    mains += 1
                    main = mains
                    wraps |= {k for _, k in named}
            elif name not in {"html", "body"}:
                told = SURE if name == "form" else furniture(tag, bool(article or main))
                if told:
                    flush()
                    named.append((len(stack), len(sure)))
                    sure.append(told == SURE)
        stack.append(name)
        opened[name] += 1
    if skip_at < 0:
        parts.append(page[at:])
    flush()
    lines = [x for x in lines if not any(sure[k] and k not in wraps for k in x[3])]
    full = {a for _, a, _, _ in lines if a}
    free = {a for a in full if not any(sure[k] for k in around[a])} or full
    if full or any(n for _, _, n, _ in lines):
        kinds = [OUTSIDE if (a not in free if full else not n) else DOUBTFUL if any(k not in wraps for k in near) else INSIDE for _, a, n, near in lines]
        return [x[0] for x in lines], kinds
    size = sum(len(x[0]) for x in lines)
    held: dict[int, int] = {}
    for text, _, _, near in lines:
        for k in near:
            held[k] = held.get(k, 0) + len(text)
    lines = [x for x in lines if not any(2 * held[k] <= size for k in x[3])]
    return [x[0] for x in lines], [OUTSIDE] * len(lines)


PART, SURE = 1, 2


def furniture(tag: str, inside: bool) -> int:
    """Whether class, id, role or label of a tag names a menu, notice, advert or the like: SURE, by PART of a name, or not (0)."""
    told = 0
    for m in HINT.finditer(tag):
        value = m.group(1) or m.group(2) or m.group(3) or ""
        whole = value.lower().split() if m.group().lower().startswith("class") else [value.strip().lower()]
        if any(w in NAMED and not (inside and w in TEXTUAL) for w in whole):
            return SURE
        if any(w in NAMED for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())):
            told = PART
    return told


def kept_lines(lines: list[str], inside: list[int], shared: list[int], sides: int) -> list[bool]:
    """Which lines are text. shared: for each line the neighbours that have it (1 before, 2 after); sides: those there are.

    Article lines that all neighbours have are deleted, and those that one has if no unshared article line lies before
    them, or none after. A neighbour that has most of the text in question is another version of the article, not
    evidence of furniture, unless the other one agrees; an article that all neighbours have whole is kept. DOUBTFUL lines
    of an article are deleted if any neighbour has them that is not such a version.
    """
    if not any(inside):
        return [not x for x in shared]
    own = [i for i, x in enumerate(inside) if x]
    size = lambda places: sum(len(lines[i]) for i in places)
    common = {i for i in own if sides and shared[i] == sides}
    if len(common) == len(own) or sides < 3 and 2 * size(common) > size(own):
        common = set()
    rest = [i for i in own if i not in common]
    once = {k: [i for i in rest if shared[i] == k] for k in (1, 2)} if sides == 3 else {}
    loose = {i for places in once.values() if 2 * size(places) <= size(rest) for i in places}
    drop = common | {i for i in loose if inside[i] == DOUBTFUL}
    for run in (own, own[::-1]):
        for i in run:
            if i not in common and i not in loose:
                break
            drop.add(i)
    return [x > 0 and i not in drop for i, x in enumerate(inside)]


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars, n_lines, n_shared) for every row of pages; other columns are not read.

    The lines of a page travel compressed; only their hashes meet those of other pages.

    text: the kept lines in page order, joined by one blank; empty if html is null, empty or holds none. Of the lines of
    the page's article (or main element) those are deleted that `kept_lines` finds shared; on pages without one, lines are
    kept that are no furniture and that neither neighbour on the host shares. n_shared: lines that a neighbour shares,
    whether kept or not. Neighbours are the rows before and after in the order of (host, path, row); rows that repeat, ids
    that clash or are null and URLs that are null or have no host are each handled as rows of their own, the last two
    without neighbours. A neighbour with the same lines is the page once more: nothing is deleted for its sake.
    """
    from pyspark.sql import types as T

    ids = pages.select(F.col(id_col).alias("page")).schema["page"].dataType
    schema = T.StructType(
        [T.StructField("rid", T.LongType()), T.StructField("page", ids), T.StructField("url", T.StringType()), T.StructField("body", T.BinaryType()), T.StructField("inside", T.ArrayType(T.ByteType())), T.StructField("marks", T.ArrayType(T.LongType()))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            parsed = [parse(x.as_py() or "") for x in batch.column(3)]
            marks = [[xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t in lines] for lines, _ in parsed]
            bodies = [pack("\n".join(lines).encode("utf-8", "replace")) for lines, _ in parsed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(bodies, pa.binary()), pa.array([p[1] for p in parsed], pa.list_(pa.int8())), pa.array(marks, pa.list_(pa.int64()))], names=schema.names
            )

    raw = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    address = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    host = F.nullif(F.lower(F.regexp_extract("url", address + r"([^/?#]*)", 1)), F.lit(""))
    named = raw.mapInArrow(read, schema).withColumn("host", host).withColumn("path", F.regexp_extract("url", address + r"[^/?#]*([^?#]*)", 1))
    # the range partitioner samples its input, so every page is parsed twice; writing the parsed pages first would take
    # as much disk again as the exchange
    ordered = named.repartitionByRange("host", "path", "rid").sortWithinPartitions("host", "path", "rid")
    aligned = materialize(ordered.select("page", "url", "body", "inside", "host", "marks").mapInArrow(_align_in_order, _aligned_schema(schema)), "aligned-pages")
    edges = aligned.where("edge").join(_across_borders(aligned.where("edge")), ["part", "place"], "left")
    whole = aligned.where("NOT edge").select("page", "url", "body", "inside", "shared", "sides").unionByName(
        edges.select("page", "url", "body", "inside", F.coalesce(F.zip_with("shared", "more", lambda x, y: x.bitwiseOR(y)), "shared").alias("shared"), F.col("sides").bitwiseOR(F.coalesce("more_sides", F.lit(0).cast("tinyint"))).alias("sides"))
    )
    out_schema = T.StructType([schema["page"], schema["url"], T.StructField("text", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("n_chars", "n_lines", "n_shared")]])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, n_lines, n_shared = [], [], []
            for body, inside, shared, sides in zip(batch.column("body"), *(batch.column(n).to_pylist() for n in ("inside", "shared", "sides")), strict=True):
                lines = unpack(body.as_py()).decode().split("\n") if inside else []
                shared = shared or [0] * len(lines)
                keep = kept_lines(lines, inside, shared, sides)
                texts.append(" ".join(line for line, k in zip(lines, keep, strict=True) if k))
                n_lines.append(len(lines))
                n_shared.append(sum(x > 0 for x in shared))
            counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], n_lines, n_shared)]
            yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("url"), pa.array(texts, pa.string()), *counts], names=out_schema.names)

    done = whole.mapInArrow(assemble, out_schema)
    return done.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_lines", "n_shared")


def _aligned_schema(read_schema):
    from pyspark.sql import types as T

    more = [T.StructField("shared", T.ArrayType(T.ByteType())), T.StructField("sides", T.ByteType()), T.StructField("edge", T.BooleanType()), T.StructField("part", T.LongType()), T.StructField("place", T.LongType()), T.StructField("host", T.StringType()), T.StructField("marks", T.ArrayType(T.LongType()))]
    return T.StructType([*(read_schema[n] for n in ("page", "url", "body", "inside")), *more])


def _shared_mask(own: list[int], before: list[int] | None, after: list[int] | None) -> tuple[list[int], int]:
    """For each line 1 if the page before has it in order, plus 2 if the page after has; and the same for pages with lines.

    A neighbour with the very same lines is the page once more and says nothing about its furniture.
    """
    mask, sides = [0] * len(own), 0
    for side, other in ((1, before), (2, after)):
        if other and other != own:
            sides |= side
            for i in common_places(own, other):
                mask[i] |= side
    return mask, sides


def _align_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks, in rows sorted by host and path, the lines that the row before or after on the same host has too, in order.

    The first and the last row of a partition are edges: they keep their host and marks for the rows across the border.
    """
    from pyspark import TaskContext

    part, place = TaskContext.get().partitionId(), 0
    names = ["page", "url", "body", "inside", "shared", "sides", "edge", "part", "place", "host", "marks"]
    held: pa.RecordBatch | None = None  # the batch before, whose last row waits for its successor
    before: tuple = (None, [])

    def out(batch: pa.RecordBatch, after: tuple, last: bool) -> pa.RecordBatch:
        nonlocal before, place
        hosts, marks = batch.column(4).to_pylist(), [m or [] for m in batch.column(5).to_pylist()]
        rows = [before, *zip(hosts, marks, strict=True), after]
        masks = [_shared_mask(m, *(rows[i][1] if h is not None and rows[i][0] == h else None for i in (k, k + 2))) for k, (h, m) in enumerate(rows[1:-1])]
        n = len(batch)
        edge = [place + i == 0 or last and i + 1 == n for i in range(n)]
        kept = [(h, m) if e else (None, None) for h, m, e in zip(hosts, marks, edge, strict=True)]
        cols = [pa.array([m for m, _ in masks], pa.list_(pa.int8())), pa.array([s for _, s in masks], pa.int8()), pa.array(edge, pa.bool_()), pa.array([part] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), pa.array([k[0] for k in kept], pa.string()), pa.array([k[1] for k in kept], pa.list_(pa.int64()))]
        before, place = (hosts[-1], marks[-1]), place + n
        return pa.RecordBatch.from_arrays([*batch.columns[:4], *cols], names=names)

    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            yield out(held, (batch.column(4)[0].as_py(), batch.column(5)[0].as_py() or []), False)
        held = batch
    if held is not None:
        yield out(held, (None, []), True)


def _across_borders(edges: DataFrame) -> DataFrame:
    """(part, place, more, more_sides): what a partition's first row shares with the row before it, and its last with the row after.

    Every partition that has rows is numbered in their order; then first and last rows meet by that number.
    """
    order = edges.select("part").distinct().select("part", F.row_number().over(Window.orderBy("part")).alias("number"))  # a row a partition
    ends = edges.join(F.broadcast(order), "part").groupBy("number").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    rows = edges.join(F.broadcast(order), "part").join(ends, "number").select("part", "place", "host", "marks", "number", (F.col("place") == F.col("low")).alias("first"), (F.col("place") == F.col("high")).alias("last"))
    other = lambda at, step, name: rows.where(at).select((F.col("number") + step).alias("number"), F.col("host").alias(f"{name}_host"), F.col("marks").alias(f"{name}_marks"))
    near = rows.join(other("last", 1, "prior").withColumn("first", F.lit(True)), ["number", "first"], "left").join(other("first", -1, "later").withColumn("last", F.lit(True)), ["number", "last"], "left")
    meets = lambda side: F.when(F.col(f"{side}_host") == F.col("host"), F.col(f"{side}_marks"))
    near = near.select("part", "place", "marks", meets("prior").alias("prior"), meets("later").alias("later")).where("prior IS NOT NULL OR later IS NOT NULL")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_shared_mask(own or [], prior, later) for own, prior, later in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m for m, _ in out], pa.list_(pa.int8())), pa.array([s for _, s in out], pa.int8())], names=["part", "place", "more", "more_sides"])

    return near.mapInArrow(align, "part long, place long, more array<tinyint>, more_sides tinyint")
