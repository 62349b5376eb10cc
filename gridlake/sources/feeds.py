"""RSS 2.0 / RSS 1.0 / Atom feed documents -> headlines.

A feed is one row ``(url, xml)``. Each document is parsed once, by an XML parser inside the task
that holds it, and its items are read from the tree: names count with their namespaces (a
``media:title`` is no title), items are found at whatever depth they stand, and what is only text
there (comments, CDATA) is no element. Neither ``from_xml`` (declared nesting, names by prefix) nor
``xpath`` (one list per path, not per item) can do that, so the walk is an Arrow-batched Python
node; titles are cleaned in it as well. RSS items are used when the document has any, else Atom
entries. A document that is not well-formed, or has neither, yields no items and one reject row,
so a broken feed never stops the others. Items keep their document position: the first item per
link wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.text import TAG_PATTERN, XML_ILLEGAL, url_host, xml_escape
from gridlake.functions.time import parse_feed_date
from gridlake.session import bound_arrow_batches

#: Feed documents that cross to Python at a time, and items that come back at a time.
FEEDS_AT_A_TIME = 64
ITEMS_AT_A_TIME = 500
# --- Fixed values: names in feeds -------------------------------------------------
INVALID_XML = "invalid_xml"
NO_ITEMS = "no_items"
ATOM_NS = "http://www.w3.org/2005/Atom"
RSS1_NS = "http://purl.org/rss/1.0/"
DC_DATE = "{http://purl.org/dc/elements/1.1/}date"
# -------------------------------------------------------------------------------
WALKED = "url string, pos int, title string, link string, date string, reason string"


def _walk_fn(titles: bool):
    # Nested, so that it travels to the Python workers by value.
    atom, rss1 = f"{{{ATOM_NS}}}", f"{{{RSS1_NS}}}"
    tag, at_a_time, dc_date = TAG_PATTERN, ITEMS_AT_A_TIME, DC_DATE
    invalid, none_there = INVALID_XML, NO_ITEMS

    def walk(batches):
        import html
        import re
        from xml.etree import ElementTree

        import pyarrow as pa

        tags = re.compile(tag)

        def clean(text):
            return " ".join(html.unescape(tags.sub("", text)).split()) if text else ""

        def first(item, *names):
            return next((t for t in map(item.findtext, names) if t), None)

        def rows(url, xml):
            try:
                root = ElementTree.fromstring(xml or "")
            except (ElementTree.ParseError, ValueError):
                yield url, None, None, None, None, invalid
                return
            own = ""
            items = root.findall(".//item")
            if not items and (items := root.findall(f".//{rss1}item")):
                own = rss1
            items = items or root.findall(f".//{atom}entry")
            if not items:
                yield url, None, None, None, None, none_there
            seen = set()
            for pos, item in enumerate(items):
                title = clean(first(item, f"{own}title", f"{atom}title"))
                named = item.find(f"{atom}link")
                link = (named.get("href") or "").strip() if named is not None else ""
                link = link or clean(item.findtext(f"{own}link"))
                if title and link and link not in seen:
                    seen.add(link)
                    date = first(item, "pubDate", f"{atom}updated", f"{atom}published", dc_date)
                    yield url, pos, title if titles else None, link, date, None

        def batch_of(held):
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string())
            names = ["url", "pos", "title", "link", "date", "reason"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

        held = []
        for batch in batches:
            for url, xml in zip(*batch.columns):
                for row in rows(url.as_py(), xml.as_py()):
                    held.append(row)
                    if len(held) >= at_a_time:
                        yield batch_of(held)
                        held = []
        if held:
            yield batch_of(held)

    walk.__name__ = "walk_with_titles" if titles else "walk_without_titles"
    return walk


def walked(feeds: DataFrame, titles: bool = True) -> DataFrame:
    """``(url, xml)`` -> a row per item with title and link, the first of a document's items with one link
    (reason null; title null unless ``titles``), and one per document without items (pos null), with the reason."""
    bound_arrow_batches(feeds.sparkSession, FEEDS_AT_A_TIME)
    return feeds.select("url", "xml").mapInArrow(_walk_fn(titles), WALKED)


def parse_feeds(feeds: DataFrame, titles: bool = True, tasks: int | None = None) -> DataFrame:
    """``(url, xml)`` -> ``(source, link, title, published_ts, pos, url)``.

    ``source`` is the feed URL's host. Titles and RSS links are cleaned
    (tags, entities, whitespace). A link with an ``href`` (Atom, also inside an RSS
    item) is preferred to a link text. Items without title or link are skipped, as are
    repeated links. Without ``titles`` they are null: no text leaves the parsing node.
    With ``tasks`` the rows are dealt by (source, link) over that many tasks, for what follows by
    that key; a repeated link of one URL (hence of one source) is in one of them.
    """
    items = walked(feeds, titles).where(F.col("reason").isNull())
    rows = items.select(
        url_host(F.col("url")).alias("source"), "url", "pos", "title", "link", parse_feed_date(F.col("date")).alias("published_ts")
    )
    if tasks:
        rows = rows.repartition(tasks, "source", "link")
    first = Window.partitionBy(*(["source", "link", "url"] if tasks else ["url", "link"])).orderBy("pos")
    return (
        rows.withColumn("__r", F.row_number().over(first))
        .where(F.col("__r") == 1)
        .select("source", "link", "title", "published_ts", "pos", "url")
    )


def first_headlines(feeds: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` headlines in (source, url, pos) order. Feeds are taken in that order, as
    many as headlines are wanted, then (where many are empty or broken) sixteen times as many,
    until they hold enough: the others are not read."""
    order = [url_host(F.col("url")), F.col("url")]
    n = limit
    while True:
        urls = [r.url for r in feeds.select("url").distinct().orderBy(*order).limit(n).collect()]  # n of them
        heads = parse_feeds(feeds.where(F.col("url").isin(urls)))
        if len(urls) < n or heads.count() >= limit:
            return heads.orderBy("source", "url", "pos").limit(limit)
        n *= 16


def feed_rejects(feeds: DataFrame) -> DataFrame:
    """One row per feed that is not well-formed XML or has no item at all:
    (source, url, reason)."""
    found = walked(feeds, titles=False).where(F.col("reason").isNotNull())
    return found.select(url_host(F.col("url")).alias("source"), "url", "reason")


#: What real feeds hold besides: names of other vocabularies, items that are only text.
MEDIA_NS = "https://ns.example/media"
DECOYS = (
    "<media:title>not the title</media:title><description><![CDATA[<item><title>inside</title><link>https://x.example/a</link></item>]]></description>"
    "<!-- <item><title>left out</title><link>https://x.example/b</link></item> -->"
)


def cdata(text):
    """Text as a CDATA section: nothing escaped, characters that XML 1.0 forbids dropped."""
    held = F.replace(F.regexp_replace(text, XML_ILLEGAL, ""), F.lit("]]>"), F.lit("]]]]><![CDATA[>"))
    return F.concat(F.lit("<![CDATA["), held, F.lit("]]>"))


def rss_item(title, link, date, in_cdata):
    held = F.when(in_cdata, cdata(title)).otherwise(xml_escape(title))
    return F.concat(
        F.lit(f"<item>{DECOYS}<title>"), held, F.lit("</title><link>"), xml_escape(link),
        F.lit("</link><pubDate>"), date, F.lit("</pubDate></item>"),
    )


def atom_entry(title, link, date, p):
    """An entry whose names have the prefix ``p``."""
    return F.concat(
        F.lit("<"), p, F.lit("entry><media:title>not the title</media:title><"), p, F.lit("title>"), xml_escape(title),
        F.lit("</"), p, F.lit("title><"), p, F.lit('link href="'), F.replace(xml_escape(link), F.lit('"'), F.lit("&quot;")),
        F.lit('"/><'), p, F.lit("updated>"), date, F.lit("</"), p, F.lit("updated></"), p, F.lit("entry>"),
    )


def block_of(item_id, block: int):
    return F.floor(F.col(item_id) / block)


def feed_url(source, b):
    return F.concat(F.lit("https://"), source, F.lit("/feed/"), b.cast("string"))


def render_feeds(items: DataFrame, block: int, marked: DataFrame | None = None) -> DataFrame:
    """Feed documents from headline rows ``(source, item_id, title, link,
    rss_date, atom_date)``: one document per (source, item_id div block),
    RSS for even blocks (every other title in CDATA, with prefixed and commented decoys) and
    Atom for odd ones (every other document with prefixed names); items in id order. A document
    holds at most ``block`` items. ``marked``: (source, block) of documents whose column ``marked``
    is true (they come by the same grouping, null sources and blocks too)."""
    b = block_of("item_id", block)
    prefix = F.when(b % 4 == 3, "a:").otherwise("")
    piece = F.when(b % 2 == 0, rss_item(F.col("title"), F.col("link"), F.col("rss_date"), F.col("item_id") % 2 == 1)).otherwise(
        atom_entry(F.col("title"), F.col("link"), F.col("atom_date"), prefix)
    )
    parts = items.select("source", b.alias("block"), F.struct(F.col("item_id"), piece.alias("xml")).alias("part"), F.lit(False).alias("mark"))
    if marked is not None:
        none = F.lit(None).cast(parts.schema["part"].dataType)
        parts = parts.unionByName(marked.select("source", "block", none.alias("part"), F.lit(True).alias("mark")))
    grouped = parts.groupBy("source", "block").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.max("mark").alias("marked")
    )
    body = F.array_join(F.transform(F.col("parts"), lambda p: p["xml"]), "")
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    media = f'xmlns:media="{MEDIA_NS}"'

    def whole(start, title, section, end):
        return F.concat(F.lit(f"{head}{start}<{title}>"), F.col("source"), F.lit(f"</{title}>{section}"), body, F.lit(end))

    rss = whole(f'<rss version="2.0" {media}><channel>', "title", "<section>", "</section></channel></rss>")
    prefixed = whole(f'<a:feed xmlns:a="{ATOM_NS}" {media}>', "a:title", "", "</a:feed>")
    plain = whole(f'<feed xmlns="{ATOM_NS}" {media}>', "title", "", "</feed>")
    xml = F.when(F.col("block") % 2 == 0, rss).when(F.col("block") % 4 == 3, prefixed).otherwise(plain)
    return grouped.select(
        feed_url(F.col("source"), F.col("block")).alias("url"),
        "block",
        xml.alias("xml"),
        "marked",
    )
