"""Feeds, classification and news merges, against plain Python over the whole fixture."""

from __future__ import annotations

import datetime as dt
import html
import re
from urllib.parse import urlparse

import duckdb
import pytest
from pyspark.sql import functions as F

from gridlake.functions.time import ts_literal
from gridlake.operators import news as N
from gridlake.plans.registry import all_queries
from gridlake.sources import feeds as FD
from gridlake.sources import fixtures as X
from tests.conftest import SF_MID

HARBOUR = """<rss version="2.0"><channel><title>Harbour</title><section>
<item><link>https://harbour.test/tide?a=1&amp;b=2</link><title> High &lt;i&gt;tide&lt;/i&gt;
 at caf&#233;</title><pubDate>Tue, 04 Mar 2025 23:30:00 +0100</pubDate></item></section>
<item><title>No address</title></item>
<item><title><![CDATA[<em>Cranes</em> &amp; cargo]]></title><link>https://harbour.test/cranes</link>
<pubDate>2025-03-05T06:15:00+02:00</pubDate></item>
<item><title>Tide again</title><link>https://harbour.test/tide?a=1&amp;b=2</link></item>
<item><title></title><link>https://harbour.test/untitled</link></item>
</channel></rss>"""

ORCHARD = """<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>Apples ripen</a:title>
<a:link href=" https://orchard.test/apples "/><a:updated></a:updated><a:published>2025-03-06T04:00:00Z</a:published></a:entry></a:feed>"""

BOTH_LINKS = """<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><item><title>Both</title>
<link>https://mixed.test/plain</link><atom:link href="https://mixed.test/atom"/></item></channel></rss>"""


def feeds(spark, docs):
    return spark.createDataFrame(docs, "url string, xml string")


def _items(spark, *docs):
    rows = FD.parse_feeds(feeds(spark, list(docs))).orderBy("url", "pos").collect()
    return [(r.source, r.link, r.title, r.published_ts) for r in rows]


def test_rss_items_at_any_depth(spark):
    assert _items(spark, ("https://harbour.test/feed.xml", HARBOUR)) == [
        ("harbour.test", "https://harbour.test/tide?a=1&b=2", "High tide at café", dt.datetime(2025, 3, 4, 22, 30)),
        ("harbour.test", "https://harbour.test/cranes", "Cranes & cargo", dt.datetime(2025, 3, 5, 4, 15)),
    ]


def test_prefixed_atom_and_atom_link_in_rss(spark):
    got = _items(spark, ("https://a.test/1", ORCHARD), ("https://b.test/2", BOTH_LINKS))
    assert got == [
        ("a.test", "https://orchard.test/apples", "Apples ripen", dt.datetime(2025, 3, 6, 4, 0)),
        ("b.test", "https://mixed.test/atom", "Both", None),
    ]


def _one(inner, root="rss", more=""):
    return f'<{root} xmlns:media="https://ns.test/m" {more}><channel>{inner}</channel></{root}>'


REAL = "<title>Real</title><link>https://r.test/1</link>"


@pytest.mark.parametrize("inner", [
    f"<item><media:title>Other</media:title>{REAL}</item>",  # a name of another vocabulary
    f"<item>{REAL}<media:title>Other</media:title><media:link>https://o.test</media:link></item>",
    f"<item><description><![CDATA[<item><title>In</title></item>]]></description>{REAL}</item>",  # an item in CDATA
    f"<!-- <item><title>Gone</title><link>https://g.test</link></item> --><item>{REAL}</item>",  # and in a comment
    f"<item><media:group><title>Deeper</title></media:group>{REAL}</item>",  # children only, not grandchildren
    f"<media:item><title>No</title><link>https://n.test</link></media:item><group><item>{REAL}</item></group>",
])
def test_names_nesting_and_text_that_looks_like_items(spark, inner):
    assert _items(spark, ("https://x.test/f", _one(inner))) == [("x.test", "https://r.test/1", "Real", None)]


def test_rss1_items_have_a_namespace_and_their_date(spark):
    rdf = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"
 xmlns:dc="http://purl.org/dc/elements/1.1/"><item><title>Old</title><link>https://o.test/1</link><dc:date>2025-01-02T03:04:05Z</dc:date></item></rdf:RDF>"""
    assert _items(spark, ("https://o.test/f", rdf)) == [("o.test", "https://o.test/1", "Old", dt.datetime(2025, 1, 2, 3, 4, 5))]


def test_feeds_equal_a_parse_by_hand(spark):
    """Random nestings of items, decoys, comments and CDATA against a reading by events."""
    import random
    from xml.parsers import expat

    rnd = random.Random(6)

    def text(k):
        raw = rnd.choice([f"t{k} &amp; caf&#233;", f"<![CDATA[<b>c{k}</b> ]]>", f"a{k}<!-- x -->b", ""])
        return raw

    def part(k, depth=0):
        kind = rnd.random()
        if kind < 0.25 and depth < 3:
            return f"<box>{''.join(part(10 * k + i, depth + 1) for i in range(3))}</box>"
        if kind < 0.4:
            return f"<!-- <item><title>{k}</title><link>https://c.test/{k}</link></item> -->"
        if kind < 0.5:
            return f"<box><![CDATA[<item><title>{k}</title></item>]]></box>"
        fields = [f"<m:title>decoy</m:title>", f"<title>{text(k)}</title>", f"<link>https://l.test/{rnd.randint(0, 30)}</link>"]
        rnd.shuffle(fields)
        return f"<item>{''.join(fields)}</item>"

    docs = [(f"https://f{n}.test/f", f'<rss xmlns:m="https://m.test">{"".join(part(k) for k in range(1, 12))}</rss>') for n in range(40)]

    def by_hand(xml):
        found, path, now, held = [], [], None, None
        p = expat.ParserCreate()

        def start(name, _):
            nonlocal now, held
            path.append(name)
            if name == "item":
                now = {}
            elif now is not None and path[-2] == "item" and name not in now:
                held = now.setdefault(name, [])

        def end(name):
            nonlocal now, held
            path.pop()
            held = None
            if name == "item":
                found.append({k: "".join(v) for k, v in now.items()})
                now = None

        def chars(data):
            if held is not None:
                held.append(data)

        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = start, end, chars
        p.Parse(xml, True)
        out = {}
        for item in found:
            title, link = _clean(item.get("title")), _clean(item.get("link"))
            if title and link:
                out.setdefault(link, title)
        return out

    got = {}
    for r in FD.parse_feeds(feeds(spark, docs)).collect():
        got.setdefault(r.url, {})[r.link] = r.title
    assert got == {url: want for url, xml in docs if (want := by_hand(xml))}


def test_statistics_need_no_titles(spark):
    heads = FD.parse_feeds(feeds(spark, [("https://harbour.test/feed.xml", HARBOUR)]), titles=False).orderBy("pos").collect()
    assert [(r.link, r.title) for r in heads] == [("https://harbour.test/tide?a=1&b=2", None), ("https://harbour.test/cranes", None)]
    for name in ("topic_counts", "ingest_counts", "news_by_day", "news_price_days"):
        plan = all_queries()[name].fn(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
        assert "walk_without_titles" in plan and "walk_with_titles" not in plan and "unescape" not in plan, name


def test_first_headlines_read_the_first_feeds_only(spark):
    empty = [(f"https://a{k}.test/f", "<rss><channel/></rss>") for k in range(30)]
    docs = feeds(spark, [*empty, ("https://harbour.test/feed.xml", HARBOUR), ("https://z.test/f", ORCHARD)])
    for limit in (1, 2, 3, 50):
        want = N.head(FD.parse_feeds(docs), limit).collect()
        assert FD.first_headlines(docs, limit).collect() == want


def test_broken_and_empty_feeds_are_isolated(spark):
    docs = feeds(spark, [
        ("https://ok.test/f", ORCHARD), ("https://cut.test/f", HARBOUR[:150]), ("https://none.test/f", "<rss><channel/></rss>"),
    ])
    assert [r.source for r in FD.parse_feeds(docs).collect()] == ["ok.test"]
    assert sorted((r.source, r.reason) for r in FD.feed_rejects(docs).collect()) == [
        ("cut.test", "invalid_xml"), ("none.test", "no_items"),
    ]


def test_rendered_titles_lose_only_what_xml_forbids(spark):
    from gridlake.functions.text import xml_escape

    row = spark.createDataFrame([("a\x01b\x0bc <d> & e",)], "t string").select(xml_escape("t").alias("x")).first()
    assert row.x == "abc &lt;d&gt; &amp; e"


ANSWER = "source string, link string, label string, confidence double, model string"
SEEN = ("2025-03-07 00:00:00", "2025-03-08 00:00:00")


def _heads(spark):
    rows = [("port", f"https://port.test/{k}", t, None) for k, t in (("a", "Ferry delayed"), ("b", "Recipe of the day"), ("c", "Untold"))]
    return spark.createDataFrame(rows, "source string, link string, title string, published_ts timestamp")


def test_unrelated_keeps_the_model_and_silence_clears_all(spark):
    rows = [("port", "https://port.test/a", "shipping", 0.75, "v2"), ("port", "https://port.test/b", "none of these", 0.99, "v2")]
    found = N.classify(_heads(spark), spark.createDataFrame(rows, ANSWER), ts_literal(SEEN[0])).collect()
    got = {r.link[-1]: (r.category, r.confidence, r.model, r.title) for r in found}
    assert got == {
        "a": ("shipping", 0.75, "v2", "Ferry delayed"),
        "b": (None, None, "v2", "Recipe of the day"),
        "c": (None, None, None, "Untold"),
    }


def test_a_silent_run_keeps_labels_only_when_asked(spark):
    answers = spark.createDataFrame([("port", "https://port.test/c", "shipping", 0.5, "v2")], ANSWER)
    answered = N.classify(_heads(spark), answers, ts_literal(SEEN[0]))
    silent = N.classify(_heads(spark), None, ts_literal(SEEN[1]))
    for keep, want in ((False, (None, None)), (True, ("shipping", "v2"))):
        merged = {r.link[-1]: (r.category, r.model) for r in N.merge_news(answered, silent, keep_label=keep).collect()}
        assert merged == {"a": (None, None), "b": (None, None), "c": want}
    assert N.ingest_counts(answered).first().asDict() == {"total": 3, "classified": 1, "other": 2}


def test_price_days_count_local_days_by_topic(spark):
    gold = spark.createDataFrame(
        [("R", dt.date(2025, 3, 8), 1.0, 0), ("R", dt.date(2025, 3, 9), 2.0, 1)],
        "region string, local_day date, avg_price double, negative_hours int",
    )
    # 23:30 UTC is half past midnight of the next day in Berlin.
    rows = [(dt.datetime(2025, 3, 8, 23, 30), "gas"), (dt.datetime(2025, 3, 9, 1, 0), "wind"), (dt.datetime(2025, 3, 9, 2, 0), None)]
    news = spark.createDataFrame(rows, "published_ts timestamp, category string")
    got = sorted((str(r.local_day), r.category or "", r.headlines) for r in N.price_days(gold, news).collect())
    assert got == [("2025-03-08", "", 0), ("2025-03-09", "gas", 1), ("2025-03-09", "wind", 1)]


# --- whole-fixture brute force --------------------------------------------------
_TAG = re.compile(r"<[^>]+>")


def _clean(text):
    if not text:
        return ""
    return re.sub(r"\s+", " ", html.unescape(_TAG.sub("", text))).strip()


@pytest.fixture(scope="module")
def docs():
    con = duckdb.connect()
    d = con.sql(f"SELECT doc_id, text, source FROM '{SF_MID}/documents.parquet'").fetchall()
    lab = {r[0]: (r[1], r[2]) for r in con.sql(f"SELECT doc_id, quality, toxic FROM '{SF_MID}/labels.parquet'").fetchall()}
    return d, lab


def _expected_headlines(docs):
    out = {}
    for doc_id, text, source in docs:
        title = _clean(text)
        if title:
            link = f"https://{source}/{doc_id}"
            out[(source, link)] = (title, dt.datetime(2024, 1, 1) + dt.timedelta(hours=doc_id % X.NEWS_HOURS), doc_id)
    return out


def _answer(doc_id, lab, outage):
    if (outage and doc_id % X.OUTAGE_MODULUS == 0) or doc_id not in lab:
        return None, None, None
    quality, toxic = lab[doc_id]
    if toxic == 1:
        return None, None, X.MODEL
    if quality == 1:
        return X.LABEL_QUALITY, X.CONFIDENCE_QUALITY, X.MODEL
    return X.LABEL_OTHER, X.CONFIDENCE_OTHER, X.MODEL


def test_feed_items_equal_brute_force(spark, docs):
    got = {(r.source, r.link): (r.title, r.published_ts) for r in all_queries()["feed_items"].fn(spark, SF_MID).collect()}
    want = {k: v[:2] for k, v in _expected_headlines(docs[0]).items()}
    assert got == want


def test_classified_and_merged_news_equal_brute_force(spark, docs):
    heads = _expected_headlines(docs[0])
    q = all_queries()
    run2 = {(r.source, r.link): (r.title, r.category, r.confidence, r.model) for r in q["classified_headlines"].fn(spark, SF_MID).collect()}
    want2 = {k: (v[0], *_answer(v[2], docs[1], True)) for k, v in heads.items()}
    assert run2 == want2
    merged = {(r.source, r.link): (r.title, r.category, r.confidence, r.model) for r in q["news_merge"].fn(spark, SF_MID).collect()}
    assert merged == want2
    latest = {(r.source, r.link): (r.title, r.category, r.confidence, r.model) for r in q["news_latest"].fn(spark, SF_MID).collect()}
    assert latest == want2
    kept = {(r.source, r.link): (r.category, r.model) for r in q["news_merge_keep_label"].fn(spark, SF_MID).collect()}
    want_kept = {}
    for k, v in heads.items():
        c2, _, m2 = _answer(v[2], docs[1], True)
        c1, _, m1 = _answer(v[2], docs[1], False)
        want_kept[k] = (c1, m1) if (m2 is None and m1 is not None) else (c2, m2)
    assert kept == want_kept


def test_page_headlines_equal_brute_force(spark):
    con = duckdb.connect()
    pages = con.sql(f"SELECT page_id, url, html FROM '{SF_MID}/pages.parquet'").fetchall()
    want = {}
    for page_id, url, page in pages:
        m = re.search(r"<title[^>]*>(.*?)</title>", page, re.S | re.I)
        want[page_id] = (urlparse(url).netloc or url, _clean(m.group(1) if m else ""))
    got = {r.page_id: (r.host, r.title) for r in all_queries()["page_headlines"].fn(spark, SF_MID).collect()}
    assert got == want


def test_head_limit(spark):
    heads = FD.parse_feeds(feeds(spark, [("https://harbour.test/feed.xml", HARBOUR)]))
    assert [N.head(heads, n).count() for n in (1, 0)] == [1, 2]


def test_fixture_feeds_and_their_broken_copies(spark, scratch, monkeypatch):
    """The copies are found without comparing texts: of the least (url, xml) of each block."""
    rows = [(i, f"text <{i}> & more", f"src{i % 3}") for i in range(0, 900, 7)]
    rows += [(5, "again", "src1"), (5, "again", "src1"), (150, None, "src0"), (151, "t", None), (152, None, None)]
    rows += [(None, "no id", "a-b"), (None, "x", "a"), (None, None, "a"), (-3, "below", "a")]
    every = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n", F.lit(1))
    asked, render = [], FD.render_feeds
    monkeypatch.setattr(FD, "render_feeds", lambda *a: asked.append(a) or render(*a))
    told = lambda df: sorted(map(repr, df.collect()))
    for name, docs in (("all", every), ("named", every.where("source IS NOT NULL")), ("none", every.where("false"))):
        docs.write.parquet(f"{scratch}/{name}/documents.parquet")
        got = X.feed_documents(spark, f"{scratch}/{name}")
        whole = render(*asked[-1][:2]).select("block", "url", "xml")
        least = whole.groupBy("block").agg(F.min(F.struct("url", "xml")).alias("f"))
        url = F.concat(F.lit(f"https://{X.BROKEN_FEED_HOST}/feed/"), F.col("block").cast("string"))
        broken = least.select(url.alias("url"), F.expr("substring(f.xml, 1, length(f.xml) div 2)").alias("xml"))
        assert told(got) == told(whole.select("url", "xml").union(broken)), name
        plan = got._jdf.queryExecution().executedPlan().toString()
        mins = [x for x in plan.split("\n") if "min(struct" in x]
        assert mins and not any("xml" in x for x in mins)


def _doc(*items):
    held = "".join(f"<item><title>{t}</title><link>{link}</link></item>" for t, link in items)
    return f"<rss><channel>{held}</channel></rss>"


def test_dealt_headlines_move_once(spark):
    """Repeated links, answers and the merge go by one dealing of the texts."""
    from gridlake.operators.revisions import revision_merge

    docs = feeds(spark, [
        ("https://a.test/1", _doc(("A", "l1"), ("B", "l1"), ("C", "l2"))), ("https://a.test/2", _doc(("D", "l1"))),
        ("https://a.test/1", _doc(("", "l9"), ("E", "l3"), ("F", "l3"), ("G", "l2"))), ("https://b.test/1", _doc(("H", "l1"))),
        (None, _doc(("I", "l1"))), ("https://bad.test", "<rss>"),
    ])
    plain, dealt = FD.parse_feeds(docs), FD.parse_feeds(docs, tasks=32)
    by_key = lambda df: sorted((str(r.url), r.link, r.pos) for r in df.collect())
    assert by_key(dealt) == by_key(plain) and len(by_key(plain)) == 6
    answers = spark.createDataFrame(
        [("a.test", "l1", "gas", 0.5, "m"), ("a.test", "l1", "sun", 0.6, "m"), ("b.test", "l1", "gas", 0.7, "m")],
        "source string, link string, label string, confidence double, model string",
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        at = F.lit("2025-01-01").cast("timestamp")
        batch = N.classify(dealt, answers, at)
        stored = spark.createDataFrame([], batch.schema).repartition(32, "source", "link")
        merged = revision_merge(stored, batch, ("source", "link"))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.split("\n") if "Exchange" in x]
        assert sum("REPARTITION_BY_NUM" in x for x in moved) == 2, plan  # the batch, and what is stored
        assert sum("ENSURE_REQUIREMENTS" in x for x in moved) == 1, plan  # the answers
        want = revision_merge(stored, N.classify(plain, answers, at), ("source", "link"))
        assert sorted((str(r.source), r.link) for r in merged.collect()) == sorted((str(r.source), r.link) for r in want.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_ingested_news_lie_in_one_file_a_slot(spark, scratch, monkeypatch):
    from gridlake import lake as L
    from gridlake.jobs.ingest import ingest_news
    from gridlake.sinks import tables as TB

    lake = L.Lake(scratch)
    docs = feeds(spark, [(f"https://s{k}.test/f", _doc(*[(f"T {k} {i}", f"l{i}") for i in range(40)])) for k in range(6)])
    docs.write.parquet(f"{scratch}/landed feeds")
    docs = spark.read.parquet(f"{scratch}/landed feeds")
    dealt = lambda *a: TB.dealt_tasks(spark, docs, lake.path(L.NEWS), L.NEWS.partition_cols, L.NEWS_SLOTS)
    assert dealt() == L.NEWS_SLOTS
    for k, keep in enumerate((False, False, True)):
        counts = ingest_news(spark, lake, docs, None, f"2025-05-0{k + 1} 00:00:00", keep_label=keep)
        assert counts["total"] == 240
        rows = spark.read.parquet(lake.path(L.NEWS))
        assert rows.count() == 240 and rows.where(F.col("fetched_at") < f"2025-05-0{k + 1}").count() == 0
        assert rows.where(F.col("key_slot") != F.pmod(F.hash("source", "link"), F.lit(L.NEWS_SLOTS))).count() == 0
        sizes = TB.file_sizes(spark, lake.path(L.NEWS), L.NEWS.partition_cols)
        assert len(sizes) == L.NEWS_SLOTS and all(len(v) == 1 for v in sizes.values())
    monkeypatch.setattr(TB, "TASK_BYTES", 10)  # larger inputs, and larger stored partitions, take more tasks
    assert dealt() > L.NEWS_SLOTS and dealt() % L.NEWS_SLOTS == 0
    monkeypatch.setattr(TB, "TASK_BYTES", 1 << 40)
    monkeypatch.setattr(TB, "TARGET_FILE_BYTES", 100)
    assert dealt() == L.NEWS_SLOTS * -(-max(sum(v) for v in sizes.values()) // 100)
    other = L.Lake(f"{scratch}/older")
    spark.range(3).withColumn("key_bucket", F.lit(1)).write.partitionBy("key_bucket").parquet(other.path(L.NEWS))
    with pytest.raises(ValueError, match="key_slot"):
        ingest_news(spark, other, docs, None, "2025-05-01 00:00:00")
