"""Main texts of web pages: lines that a page shares with its nearest page are deleted, marked-up boilerplate goes too.

``parse`` cuts a page into lines (blocks of text) and notes what markup says of each: inside an article, inside a menu,
header, footer, sidebar, notice, advert, form or comments. ``shared_lines`` pairs each page with the page of its host
whose URL path is nearest and aligns the two pages' lines by their longest common subsequence. What is shared is deleted,
but for prose inside a declared article (paragraphs, headings, lists, quotations, tables, code): articles quote each
other, and copies of an article are articles. For pages that declare no article, differencing is what tells articles
from the rest, with the share of a line's text that is linked.

Pages are ordered by (host, path) over all partitions, so a host with a third of all pages is spread, and the nearest
path is next in that order; ``NEAR`` pages on either side are candidates, nearest first, passing over copies of the page.
Only hashes of lines are shuffled. Pages meet their deletions through a join that Spark makes a broadcast only if the
stored table of deletions is small.

Defined results: null html is empty; a page without text gives an empty text; pages without a host have no pair; equal
rows (URL and html) share one pairing and are returned each; rows with null or equal ids are pages of their own; an empty
table gives an empty result. Columns besides go along, and ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import pieces_of, store, trim

#: Elements by what HTML defines them to be; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math canvas object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption".split())
#: What an element's start ends, unless one of the bounds lies between.
ENDS = {"li": ("li", "ul ol menu"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "option": ("option", "select")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
#: Boilerplate by element; forms may hold a whole page, so they are only a hint, as classes and roles are.
BOILERPLATE = frozenset("head nav header footer aside button menu dialog audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CUES = frozenset(
    """ad ads advert adverts advertisement advertising advertorial adsense adslot banner promo promos promoted promotion sponsor sponsored sponsors
    nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidenav rail aside footer masthead topbar toolbar header cookie cookies consent gdpr
    notice notices notification alert popup modal overlay dialog newsletter subscribe subscription signup login paywall share sharing social related
    recommended recommendations teaser teasers comment comments commentlist disqus reply replies respond widget widgets pagination pager copyright legal disclaimer search""".split()
)
#: Words that say that something else has what they precede.
BESIDE = frozenset("has with no without".split())
#: Words beside which ``header`` is an article's own.
OWN_HEADER = frozenset("article post entry story".split())
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: Candidates on either side of a page, pages in one group of the pairing, and lines up to which a pair is aligned in one table.
NEAR, GROUP, TABLE = 8, 64, 4096
#: The part of a page's text that a copy shares: with the same title, and with another.
SAME_TITLE, COPY = 0.5, 0.9


@dataclass
class Line:
    text: str
    linked: float  # part of the text inside links
    prose: bool
    article: int  # 0: outside, 1: inside main, 2: inside an article
    outer: int  # boilerplate around the article: 0 none, 1 a form, 2 by hints, 3 by elements
    inner: bool  # boilerplate within the article


@dataclass
class Element:
    """An open element, with what holds for it through those around it."""

    name: str = ""
    article: int = 0
    outer: int = 0
    inner: bool = False
    header: bool = False
    heading: bool = False
    prose: bool = False
    link: bool = False


@dataclass
class Page:
    title: str = ""
    lines: list[Line] = field(default_factory=list)

    def chosen(self) -> list[tuple[int, bool]]:
        """(line, safe) of each line that markup keeps; safe lines stay though another page has them."""
        kept = [(k, x) for k, x in enumerate(self.lines) if not x.inner]
        for level in (2, 1):
            for outer in (0, 1, 2):
                found = [(k, x.prose) for k, x in kept if x.article == level and x.outer <= outer]
                if found:
                    return found
        text = [0, 0]
        for _, x in kept:
            if x.outer < 1 or x.outer == 1 and x.prose:
                text[x.outer] += len(x.text)
        most = 1 if text[1] > text[0] else 0  # a form around the whole page is none
        return [(k, False) for k, x in kept if not x.article and x.outer <= most and x.linked <= 0.5]


def hint(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether attributes hint at boilerplate, and whether they name the main part."""
    values = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    role = values.get("role", "").lower()
    main = role == "main" or "articlebody" in values.get("itemprop", "").lower()
    if role in ROLES or "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
        return True, main
    if name in ("html", "body"):
        return False, False
    words = [w.lower() for w in WORDS.findall(values.get("class", "") + " " + values.get("id", ""))]
    found = {w for before, w in zip(["", *words], words, strict=False) if before not in BESIDE}
    cues = found & CUES
    return bool(cues - {"header"} or (cues and not found & OWN_HEADER)), main


def parse(text: str) -> Page:
    """The page's title and lines. Broken markup ends where its surroundings end; an unclosed script goes to the end."""
    page, stack = Page(), [Element()]
    depth: dict[str, int] = {}  # open elements by name
    parts: list[str] = []
    size = linked = 0
    loose = False
    at, n = 0, len(text)

    def flush() -> None:
        nonlocal size, linked
        if parts:
            words = " ".join(entities.unescape("".join(parts)).split())
            if words:
                e = stack[-1]
                page.lines.append(Line(words, linked / max(size, 1), e.prose, e.article, e.outer, e.inner or e.header and not e.heading))
            parts.clear()
        size = linked = 0

    def say(words: str) -> None:
        nonlocal size, linked
        if words:
            parts.append(words)
            visible = len(words.strip())
            size += visible
            if stack[-1].link:
                linked += visible

    def cut(k: int) -> None:
        for e in stack[k:]:
            depth[e.name] -= 1
        del stack[k:]

    def close(k: int) -> None:
        flush()
        cut(k)

    while at < n:
        start = text.find("<", at)
        if start < 0:
            say(text[at:])
            break
        say(text[at:start])
        if text.startswith("<!--", start):
            at = (text.find("-->", start + 4) + 3) or n
            at = n if at < 3 else at
            continue
        if text.startswith(("<!", "<?"), start):
            at = text.find(">", start) + 1 or n
            continue
        tag = (LOOSE_TAG if loose else TAG).match(text, start)
        if not tag and not loose and text[start + 1 : start + 2].strip("/").isalpha():
            loose = True  # a quotation mark is missing: from here on tags end at the next bracket
            tag = LOOSE_TAG.match(text, start)
        if not tag:
            if re.match(r"</?[a-zA-Z]", text[start : start + 3]):  # cut off within a tag
                break
            say("<")
            at = start + 1
            continue
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        at = tag.end()
        if closing:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0) if depth.get(name) else 0
            if name in INLINE:
                if k and all(e.name in INLINE for e in stack[k:]):
                    cut(k)
            elif k:
                close(k)
            else:
                flush()
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(text, at)
                if name == "title" and not page.title:
                    page.title = " ".join(entities.unescape(text[at : end.start() if end else n]).split())
                at = (text.find(">", end.start()) + 1 or n) if end else n
            continue
        if name not in INLINE:
            if name in ENDS:
                gone, bounds = ENDS[name]
                for i in range(len(stack) - 1, 0, -1) if any(depth.get(x) for x in gone) else ():
                    if stack[i].name in bounds:
                        break
                    if stack[i].name in gone:
                        close(i)
                        break
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].name == "p":
                    close(i)
                    break
                if stack[i].name not in INLINE:
                    break
        hinted, main = hint(name, attributes) if attributes else (False, False)
        if name in ("article", "main") and (depth.get("nav") or depth.get("head") or depth.get("header")):
            k = next((i for i, e in enumerate(stack) if e.name in ("nav", "head") or (e.name == "header" and e.outer)), 0)
            if k:  # menus hold no articles: that one was not closed
                close(k)
        if name == "body" and depth.get("head"):
            close(next(i for i, e in enumerate(stack) if e.name == "head"))
        around = stack[-1]
        e = Element(name, around.article, around.outer, around.inner, around.header, around.heading or name in HEADINGS, around.prose or name in PROSE, around.link or name == "a")
        own = 0
        if name == "header" and around.article and not hinted:
            e.header, own = True, -1
        elif name in BOILERPLATE or hinted or name == "form":
            own = 3 if name in BOILERPLATE else 2 if hinted else 1
            if around.article:
                e.inner = True
            else:
                e.outer = max(e.outer, own)
        if not own:
            e.article = max(e.article, 2 if name == "article" else 1 if name == "main" or main else 0)
        if name in INLINE and name != "a" and not own:
            continue  # says nothing of its text
        stack.append(e)
        depth[name] = depth.get(name, 0) + 1
    flush()
    return page


def address(url: str | None) -> tuple[str, str]:
    """Host without ``www.``, and path with query."""
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^#]*)", url or "")
    return (m[1].lower().removeprefix("www."), m[2] or "/") if m else ("", "")


def advance(row: int, match: int, full: int) -> int:
    """One row of the bit-parallel table: zero bits count the length of the common subsequence."""
    both = row & match
    return ((row + both) | (row - both)) & full


def matches(a: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for i, x in enumerate(a):
        found[x] = found.get(x, 0) | 1 << i
    return found


def lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The longest common subsequence's length of each prefix of a and all of b."""
    full, where = (1 << len(a)) - 1, matches(a)
    row = full
    for x in b:
        row = advance(row, where.get(x, 0), full)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    either = set(a) & set(b)
    at = [i for i, x in enumerate(a) if x in either]  # all others are in no common subsequence
    x, y = [a[i] for i in at], [v for v in b if v in either]
    return [at[i] for i in _common(x, y)]


def _common(a: list[int], b: list[int]) -> list[int]:
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = [*range(head), *range(len(a) - tail, len(a))]
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if a and b:
        if len(a) * len(b) <= TABLE * TABLE:
            found += [head + i for i in _traced(a, b)]
        else:  # halves of b belong to two parts of a, found from the lengths of both sides
            half = len(b) // 2
            cut = int(np.argmax(lengths(a, b[:half]) + lengths(a[::-1], b[half:][::-1])[::-1]))
            found += [head + i for i in _common(a[:cut], b[:half])] + [head + cut + i for i in _common(a[cut:], b[half:])]
    return sorted(found)


def _traced(a: list[int], b: list[int]) -> list[int]:
    full, where = (1 << len(a)) - 1, matches(a)
    rows = [full]
    for x in b:
        rows.append(advance(rows[-1], where.get(x, 0), full))
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[j] >> (i - 1) & 1:
            i -= 1
            continue
        j -= 1
        if j and not rows[j] >> (i - 1) & 1:
            continue
        i -= 1
        found.append(i)
    return found[::-1]


def page_key(url: str | None, text: str) -> bytes:
    return hashlib.md5(f"{url}\0{text}".encode()).digest()


PAIRED = "key binary, host string, path string, title long, hashes array<long>, sizes array<int>, open array<int>"


def hashed(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Each page's lines as hashes and sizes, and which lines differencing may delete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch):
                rows = []
                for url, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    page = parse(text or "")
                    hashes = [xxhash.xxh64_intdigest(x.text) - (1 << 63) for x in page.lines]
                    title = xxhash.xxh64_intdigest(page.title) - (1 << 63) if page.title else None
                    rows.append((page_key(url, text or ""), *address(url), title, hashes, [len(x.text) for x in page.lines], [k for k, safe in page.chosen() if not safe]))
                kinds = [pa.binary(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in PAIRED.split(", ")])
        trim()

    return pages.select(url_col, html_col).mapInArrow(run, PAIRED)


def partner(rows: dict[int, dict], place: int) -> list[int]:
    """The lines of a page that its nearest page has too, if any of the pages around it is no copy."""
    own = rows[place]
    around = [rows[p] for p in range(place - NEAR, place + NEAR + 1) if p != place and p in rows and rows[p]["host"] == own["host"]]
    alike = lambda x: next((k for k, (c, d) in enumerate(zip(own["path"], x["path"], strict=False)) if c != d), min(len(own["path"]), len(x["path"])))
    total = sum(own["sizes"])
    for other in sorted(around, key=lambda x: (-alike(x), abs(x["place"] - place), x["place"])):
        shared = common(own["hashes"], other["hashes"])
        part = sum(own["sizes"][k] for k in shared)
        same = own["title"] is not None and own["title"] == other["title"]
        if part < (SAME_TITLE if same else COPY) * total:
            return shared
    return []


def shared_lines(lines: DataFrame) -> DataFrame:
    """key, gone: the lines that each page shares with its nearest page, of those that differencing may delete."""
    spark = lines.sparkSession
    ordered = lines.filter("host <> '' AND size(hashes) > 0").dropDuplicates(["key"]).repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    ordered = store(ordered.withColumn("at", F.monotonically_increasing_id()), "page-lines")
    part = F.shiftright("at", 33)
    counts = sorted(tuple(r) for r in ordered.groupBy(part.alias("part")).agg(F.count("*")).collect())  # a row for each partition
    starts = spark.createDataFrame([(p, int(s)) for (p, _), s in zip(counts, np.cumsum([0, *(n for _, n in counts)]), strict=False)], "part long, start long")
    placed = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    placed = placed.withColumn("place", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "start", "at")
    # each group of places, and NEAR places beyond its ends
    groups = F.array_distinct(F.transform(F.array(F.lit(-NEAR), F.lit(0), F.lit(NEAR)), lambda d: F.floor((F.col("place") + d) / GROUP)))
    spread = placed.select("*", F.explode(groups).alias("group"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = {r["place"]: r for r in table.to_pylist()}
        found = []
        for place, r in rows.items():
            if place // GROUP == key[0].as_py() and r["open"]:
                may = set(r["open"])
                gone = [k for k in partner(rows, place) if k in may]
                if gone:
                    found.append((r["key"], gone))
        return pa.table({"key": pa.array([k for k, _ in found], pa.binary()), "gone": pa.array([g for _, g in found], pa.list_(pa.int32()))})

    return spread.groupBy("group").applyInArrow(run, "key binary, gone array<int>")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages with the main ``text`` of each and its ``n_chars``."""
    pages = pages.drop("text", "n_chars")
    deletions = store(shared_lines(hashed(pages, url_col, html_col)), "page-deletions")
    given = pages.columns
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(url_col), F.lit("None")), F.lit("\0"), F.coalesce(F.col(html_col), F.lit(""))).cast("binary")))
    met = pages.withColumn("__key", key).join(deletions.select(F.col("key").alias("__key"), F.col("gone").alias("__gone")), "__key", "left").select(*given, "__gone")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields) + ", text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch):
                texts = []
                for text, gone in zip(part.column(given.index(html_col)).to_pylist(), part.column(len(given)).to_pylist(), strict=True):
                    page, without = parse(text or ""), set(gone or ())
                    texts.append(" ".join(page.lines[k].text for k, _ in page.chosen() if k not in without))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*given, "text", "n_chars"])
        trim()

    return met.mapInArrow(run, schema)
