"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from one template. A first pass turns every page into tokens, told
apart by the path of blocks they stand in: a block, and the whole text of a block. The
occurrence vector of a token says how often each page of the host has it; it is carried as a
commutative digest with the number of pages, so vectors of any length meet in one aggregate
row per token. Tokens with equal vectors form an equivalence class. Valid are classes of
enough tokens (a block has two, its start and end; a text has its words) on enough pages, any
number of times a page: the root class of all pages and the classes of some. A block is on
every page that has a block or text below it, so the paths nest each class in those of the
blocks above it.

Text of a valid class is part of the template (a notice, a tag line) if the class has a block,
or if most pages that have the text's block show that text; a text that only a smaller part of
them repeats is one value of a slot (an article that was published again). The second pass
extracts the slots: those in a main container (``main`` or ``article``) if enough pages of the
host have one there, else all, without the containers that name themselves navigation, header,
footer, sidebar, notice, advert, form or comments.

The template of a host has at most the tokens of its smallest page. It is joined to the pages
by host: broadcast by the planner when the table of hosts is small, else a merge join whose
hot hosts are split.

Defined cases: a null or empty page has an empty text; pages without a host, and hosts with
fewer than ``MIN_PAGES`` different pages, are read by their own markup; pages without a token
have no part in the template, and pages of equal tokens count once in it; broken markup is read as far as it goes (a block that is never
closed ends with its parent); extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import common as C

MIN_PAGES = 5
MIN_CLASS = 3

# --- Fixed values: HTML element kinds and naming habits ------------------------
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li option tr td th".split())
NEVER = frozenset(
    "head nav header footer aside form button select option datalist fieldset menu dialog noscript template object applet svg "
    "canvas audio video map".split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside rail footer foot header masthead comment comments disqus respond replies cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended widget pagination pager toc skip".split()
)
MAIN = frozenset(("main", "article"))
NAMED_FREELY = frozenset(("html", "body", "main", "article"))
PLACES = frozenset("top bottom left right main site page global primary secondary mobile desktop sticky fixed".split())
READERS = re.compile(
    r"(?:comments?|respond|replies|disqus|related|recommended)"
    r"(?:[-_]+(?:list|area|section|thread|body|posts?|articles?|stories|items|wrap|wrapper|container))?"
)
# -----------------------------------------------------------------------------

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^\"'>]|\"[^\"<]*\"|'[^'<]*')*+|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")


#: Why a block is no part of the main text: by its element, role or hiding (an article that
#: opens in it ends it: it was never closed), or as readers' comments or links to other pages.
_OUT, _BARRED = 1, 2


def _is_named(value: str) -> bool:
    """Whether a class or id names furniture: whole, by its leading part, or by its only
    part besides a place (``top-nav``)."""
    parts = [x for x in re.split(r"[^a-z0-9]+", value) if x]
    if parts and parts[0] in NEVER_NAMES:
        return True
    return len(parts) == 2 and parts[0] in PLACES and parts[1] in NEVER_NAMES


def _kind(name: str, attributes: str) -> tuple[str, int, bool]:
    """The label of a block in paths, whether it is no part of the main text, and whether
    its names say so (which holds unless the main container is in it)."""
    label, out, named = name, _BARRED if name == "aside" else _OUT if name in NEVER else 0, False
    if attributes and ("=" in attributes or "hidden" in attributes.lower()):
        for key, a, b, c in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), (a or b or c).lower()
            if key == "role":
                out = max(out, _OUT * (value.strip() in NEVER_ROLES))
            elif key in ("class", "id"):
                label += f".{value}"
                if name not in NAMED_FREELY or name == "article":
                    out = max(out, _BARRED * any(READERS.fullmatch(x) is not None for x in value.split()))
                if name not in NAMED_FREELY:
                    named = named or any(map(_is_named, value.split()))
            elif name not in ("html", "body"):
                unseen = key == "hidden" and not value.startswith(("until", "false"))
                unseen |= key == "aria-hidden" and value.strip() == "true" or key == "style" and bool(_UNSEEN.search(value))
                out = max(out, _OUT * unseen)
    return label, out, named


class _Block:
    __slots__ = ("element", "path", "inside", "out", "named", "names", "parent", "holds_main", "excluded")

    def __init__(self, element: str, path: str, inside: bool, out: int, named: bool, parent: _Block | None):
        self.element, self.path, self.inside, self.out, self.named, self.parent = element, path, inside, out, named, parent
        self.names = named + (parent.names if parent else 0)  # named blocks from here up
        self.holds_main = self.excluded = False


_PAGE = _Block("", "", False, 0, False, None)


def blocks(page: str | None):
    """Yield (path, text, inside main, excluded) for every start of a block (text None)
    and for every block's text, in page order."""
    found = list(_read(page))
    mains = [b for b, text in found if text is None and b.element in MAIN and not b.out]
    least = min((b.names for b in mains), default=0)
    for b in mains:
        # What the main container stands in is not furniture, whatever its name; of several
        # containers that of the fewest such names counts (others are teasers).
        while b is not None and b.names and not b.holds_main and (b.names <= least):
            b.holds_main, b = True, b.parent
    for b, text in found:
        if text is None:
            b.excluded = b.out > 0 or b.named and not b.holds_main or b.parent is not None and b.parent.excluded
        yield b.path, text, b.inside, b.excluded


def _read(page: str | None):
    """Yield (block, text): text None for its start."""
    stack: list[_Block] = []
    pieces: list[str] = []
    at, page = 0, page or ""

    def flush():
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                yield stack[-1] if stack else _PAGE, text

    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            pieces.append(page[at : m.start()])
        at = m.end()
        name = m[2].lower() if m[2] else ""
        if not name:
            if m[0].startswith("<![CDATA["):
                pieces.append(html.escape(m[0][9:-3]))
            continue
        if m[1]:
            if name in INLINE:
                continue
            if any(x.element == name for x in stack):
                yield from flush()
                while stack.pop().element != name:
                    pass
            elif name not in VOID:
                yield from flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            pieces.append(" ")
            continue
        if name in INLINE:
            if name in ("br", "wbr", "img"):
                pieces.append(" " if name != "wbr" else "")
            continue
        yield from flush()
        if name in VOID:
            continue
        label, out, named = _kind(name, m[3])
        last = stack[-1].element if stack else ""
        if last in PARAGRAPHS and (last == "p" or last[0] == "h" or last == name):
            stack.pop()
        if name in MAIN and not out:  # a menu or form that was never closed ends here
            while stack and stack[-1].out == _OUT:
                stack.pop()
        above = stack[-1] if stack else None
        here = _Block(
            name,
            f"{above.path if above else ''}/{label}",
            name in MAIN or above is not None and above.inside,
            max(out, above.out if above else 0),
            named,
            above,
        )
        stack.append(here)
        yield here, None
    if at < len(page):
        pieces.append(re.sub(r"</?[a-zA-Z!][^<>]*\Z", "", page[at:]))  # a tag cut off at the end
    yield from flush()


def _token(path: str, text: str | None) -> int:
    return xxhash.xxh64_intdigest(path if text is None else f"{path}\0{text}")


_FOUND = "host string, content long, found array<struct<token:bigint,block:bigint,n:int,size:int,is_main:boolean>>"


def _tokens(batches):
    """(host, page) -> host, a digest of the page's tokens, and the tokens: each with its
    block (0: it is a block), how often the page has it, its size and whether it is a main
    container. Pages without a token have no row."""
    for batch in batches:
        hosts, contents, ends, rows = [], [], [0], []
        for host, page in zip(*(c.to_pylist() for c in batch.columns)):
            counts: dict[tuple, int] = {}
            for path, text, _, never in blocks(page):
                if not never:
                    leaf = path.rsplit("/", 1)[-1].split(".")[0]
                    block = 0 if text is None else _token(path, None)
                    t = _token(path, text), block, 2 if text is None else len(text.split()), text is None and leaf in MAIN
                    counts[t] = counts.get(t, 0) + 1
            if counts:
                hosts.append(host)
                contents.append(xxhash.xxh64_intdigest(repr(sorted(counts.items()))))
                rows += [(*t, n) for t, n in counts.items()]
                ends.append(len(rows))
        token, block, size, is_main, n = zip(*rows) if rows else ((),) * 5
        found = pa.StructArray.from_arrays(
            [
                pa.array(np.array(token, np.uint64).view(np.int64)),
                pa.array(np.array(block, np.uint64).view(np.int64)),
                pa.array(n, pa.int32()),
                pa.array(size, pa.int32()),
                pa.array(is_main, pa.bool_()),
            ],
            names=["token", "block", "n", "size", "is_main"],
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(np.array(contents, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
            ],
            names=["host", "content", "found"],
        )


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS) -> DataFrame:
    """(host, html) -> one row per host with enough different pages: host, fixed (the text
    tokens of its template) and has_main (whether enough pages have a main container)."""
    counted = pages.where("host <> ''").select("host", "html").mapInArrow(_tokens, _FOUND)
    different = counted.groupBy("host", "content").agg(F.first("found").alias("found"))
    # The token 0 is the page itself; its class is the root.
    page = F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in (("token", 0, "long"), ("block", 0, "long"), ("n", 1, "int"), ("size", 1, "int"), ("is_main", False, "boolean"))])
    tokens = (
        different.select("host", "content", F.explode(F.concat(F.array(page), "found")).alias("x"))
        .select("host", "content", "x.*")
        .groupBy("host", "token", "block", "size", "is_main")
        .agg(F.count("*").alias("pages"), F.bit_xor(F.xxhash64("content", "n")).alias("vector"))
    )
    # A host's texts that few pages have matter only in that there are some.
    is_text = F.col("block") != 0
    often = C.cut(
        tokens.withColumn("rare", F.col("pages") < min_pages)
        .groupBy("host", *[F.when(~F.col("rare"), F.col(c)).alias(c) for c in ("token", "block", "size", "is_main", "pages", "vector")], "rare")
        .agg(F.max(is_text).alias("has_text")),
        "tokens",
    )
    common = often.where("NOT rare")
    classes = common.groupBy("host", "vector", "pages").agg(
        F.sum(F.col("size").cast("long")).alias("members"), F.max(~is_text).alias("has_block")
    )
    valid = classes.where(F.col("members") >= min_class).select("host", "vector", "pages", "has_block")
    slots = common.where(~is_text).select("host", F.col("token").alias("block"), F.col("pages").alias("of"))
    texts = common.where(is_text).join(valid, ["host", "vector", "pages"], "left").join(slots, ["host", "block"])
    constant = F.col("has_block") | (F.col("has_block").isNotNull() & (2 * F.col("pages") > F.col("of")))
    fixed = texts.groupBy("host").agg(
        F.collect_list(F.when(constant, F.col("token"))).alias("fixed"), F.max(~F.coalesce(constant, F.lit(False))).alias("varied")
    )
    hosts = often.groupBy("host").agg(
        F.max(F.coalesce(F.col("token") == 0, F.lit(False))).alias("enough"),
        F.max(F.coalesce("is_main", F.lit(False))).alias("has_main"),
        F.max(F.col("rare") & F.col("has_text")).alias("varied_rarely"),
    )
    varies = F.col("varied_rarely") | F.coalesce("varied", F.lit(False))
    return hosts.where("enough").join(fixed, "host", "left").select(
        "host", "has_main", F.when(varies, F.col("fixed")).otherwise(F.array().cast("array<bigint>")).alias("fixed")
    )


def main_text(page: str | None, fixed: frozenset = frozenset(), has_main: bool | None = None) -> str:
    """The text of the slots, blocks joined by a newline. Without a template (has_main
    None) the page's own markup tells whether there is a main container."""
    found = [(p, t, inside) for p, t, inside, never in blocks(page) if not never and t is not None]
    if has_main is not False and any(inside for *_, inside in found):
        found = [x for x in found if x[2]]
    if fixed:
        found = [x for x in found if _token(x[0], x[1]) not in fixed]
    return "\n".join(t for _, t, _ in found)


def _extract(batches):
    for batch in batches:
        ids, urls, pages, fixed, has_main = (batch.column(i) for i in range(5))
        sets: dict = {}
        out = []
        for page, tokens, main in zip(pages.to_pylist(), fixed.to_pylist(), has_main.to_pylist()):
            key = tuple(tokens or ())
            if key not in sets:
                sets[key] = frozenset(t % 2**64 for t in key)
            out.append(main_text(page, sets[key], main))
        yield pa.RecordBatch.from_arrays([ids, urls, pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: page_id, url, text."""
    C.bounded_batches(pages.sparkSession, 200)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.col(page).alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    known = C.cut(templates(rows), "templates")
    told = rows.join(known.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left")
    return told.select("page_id", "url", "html", "fixed", "has_main").mapInArrow(_extract, "page_id long, url string, text string")


C.ship(__name__)
