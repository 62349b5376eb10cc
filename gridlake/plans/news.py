"""News enrichment queries.

The oracles clean titles with the fixture's few entities; full entity decoding cannot be
stated in SQL and is checked in ``tests/test_news.py`` against plain Python.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions.text import clean_text, url_host
from gridlake.operators import news as N
from gridlake.plans import sql as S
from gridlake.plans import state
from gridlake.plans.registry import query
from gridlake.sources import feeds as FD
from gridlake.sources import fixtures as X

_OUT = ["source", "link", "title", "published_ts", "category", "confidence", "model", "fetched_at"]


def headlines(spark, sf_dir, titles=True):
    return FD.parse_feeds(X.feed_documents(spark, sf_dir), titles)


def runs(spark, sf_dir, titles=True):
    """Both ingest runs over one headline frame (its shuffle is reused):
    the first with every labelled headline answered, the second with the
    classifier silent for some headlines."""
    heads = headlines(spark, sf_dir, titles)
    first = N.classify(heads, X.classifier_answers(spark, sf_dir), state.previous_run())
    second = N.classify(heads, X.classifier_answers(spark, sf_dir, outage=True), state.as_of())
    return first, second


def run_two(spark, sf_dir):
    return N.classify(headlines(spark, sf_dir), X.classifier_answers(spark, sf_dir, outage=True), state.as_of())


def merged(spark, sf_dir, keep_label=False, titles=True):
    """The news table after both runs; statistics ask for it without titles."""
    first, second = runs(spark, sf_dir, titles)
    return N.merge_news(first, second, keep_label=keep_label)


# --- Oracle pieces ---------------------------------------------------------------
_BLANK = r"[\s\pZ\x{85}\x{1c}-\x{1f}]"


def _clean_sql(text: str) -> str:
    """Tags dropped, entities decoded (those the fixture has), white space collapsed."""
    bare = f"regexp_replace(coalesce({text}, ''), '<[^>]+>', '', 'g')"
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&amp", "&")):
        bare = f"replace({bare}, '{entity}', '{char}')"
    return f"trim(regexp_replace({bare}, '{_BLANK}+', ' ', 'g'))"


def _run_sql(silent: str, fetched_at: str) -> str:
    """One ingest run: headlines with answers, none where ``silent`` holds."""
    none = f"({silent}) OR l.doc_id IS NULL"
    return f"""SELECT * FROM (
    SELECT d.source, 'https://' || d.source || '/' || CAST(d.doc_id AS VARCHAR) AS link, {_clean_sql('d.text')} AS title,
           TIMESTAMP '{X.NEWS_EPOCH}' + to_hours(CAST(d.doc_id % {X.NEWS_HOURS} AS BIGINT)) AS published_ts,
           CASE WHEN {none} OR l.toxic = 1 THEN NULL
                WHEN l.quality = 1 THEN '{X.LABEL_QUALITY}' ELSE '{X.LABEL_OTHER}' END AS category,
           CAST(CASE WHEN {none} OR l.toxic = 1 THEN NULL
                WHEN l.quality = 1 THEN {X.CONFIDENCE_QUALITY} ELSE {X.CONFIDENCE_OTHER} END AS DOUBLE) AS confidence,
           CASE WHEN {none} THEN NULL ELSE '{X.MODEL}' END AS model, {fetched_at} AS fetched_at
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) r WHERE title <> ''"""


_SILENT = f"d.doc_id % {X.OUTAGE_MODULUS} = 0"
_RUN_2 = _run_sql(_SILENT, S.AS_OF_SQL)
# The second run, except that a headline without an answer keeps the first run's label.
_KEPT = f"""SELECT s.source, s.link, s.title, s.published_ts,
       CASE WHEN s.model IS NULL THEN f.category ELSE s.category END AS category,
       CASE WHEN s.model IS NULL THEN f.confidence ELSE s.confidence END AS confidence,
       coalesce(s.model, f.model) AS model, s.fetched_at
FROM ({_RUN_2}) s JOIN ({_run_sql('false', S.PREVIOUS_SQL)}) f USING (source, link)"""
_NEWS_CTE = ("news", _RUN_2)


@query("feed_items", f"SELECT source, link, title, published_ts FROM ({_RUN_2}) r")
def feed_items(spark, sf_dir):
    """RSS and Atom items -> cleaned headlines with instants."""
    return headlines(spark, sf_dir).select("source", "link", "title", "published_ts")


@query(
    "feed_rejects",
    f"""SELECT DISTINCT '{X.BROKEN_FEED_HOST}' AS source,
       'https://{X.BROKEN_FEED_HOST}/feed/' || CAST(doc_id // {X.FEED_BLOCK} AS VARCHAR) AS url,
       '{FD.INVALID_XML}' AS reason
FROM documents""",
)
def feed_rejects(spark, sf_dir):
    """Feeds that are not well-formed XML, one row each; others continue."""
    return FD.feed_rejects(X.feed_documents(spark, sf_dir))


@query("classified_headlines", _RUN_2)
def classified_headlines(spark, sf_dir):
    """Headlines with topic, confidence and model of the second run."""
    return run_two(spark, sf_dir).select(*_OUT)


@query("news_latest", _RUN_2)
def news_latest(spark, sf_dir):
    """Newest row per (source, link) over both runs."""
    first, second = runs(spark, sf_dir)
    return N.latest_news(first.unionByName(second))


@query("news_merge", _RUN_2)
def news_merge(spark, sf_dir):
    """Second run merged into the first (an outage erases labels)."""
    return merged(spark, sf_dir)


@query("news_merge_keep_label", _KEPT)
def news_merge_keep_label(spark, sf_dir):
    """J2 with ``keep_label``: an outage row keeps the stored label."""
    return merged(spark, sf_dir, keep_label=True)


@query(
    "topic_counts",
    S.with_(_NEWS_CTE) + "SELECT category, count(*) AS headlines FROM news WHERE category IS NOT NULL GROUP BY category",
)
def topic_counts(spark, sf_dir):
    """Headlines per topic, most first."""
    return N.topic_counts(merged(spark, sf_dir, titles=False))


@query(
    "ingest_counts",
    S.with_(_NEWS_CTE)
    + "SELECT count(*) AS total, count(category) AS classified, count(*) - count(category) AS other FROM news",
)
def ingest_counts(spark, sf_dir):
    """Total, classified and other headlines."""
    return N.ingest_counts(merged(spark, sf_dir, titles=False))


@query(
    "news_by_day",
    S.with_(_NEWS_CTE)
    + """SELECT date_trunc('day', published_ts) AS day, category, count(*) AS headlines
FROM news WHERE category IS NOT NULL GROUP BY 1, 2""",
)
def news_by_day(spark, sf_dir):
    """Classified headlines per day and topic."""
    return N.news_by_day(merged(spark, sf_dir, titles=False))


@query(
    "news_price_days",
    S.with_(*S.SERVING_CTES[:3], ("gold", S.gold()), _NEWS_CTE)
    + f""", per_day AS (SELECT CAST({S.local('published_ts')} AS DATE) AS local_day, category, count(*) AS headlines
                 FROM news WHERE category IS NOT NULL GROUP BY 1, 2)
SELECT g.region, g.local_day, g.avg_price, g.negative_hours, p.category, coalesce(p.headlines, 0) AS headlines
FROM gold g LEFT JOIN per_day p ON p.local_day = g.local_day""",
)
def news_price_days(spark, sf_dir):
    """Daily prices next to the local day's classified headlines by topic."""
    return N.price_days(state.gold(spark, sf_dir), merged(spark, sf_dir, titles=False))


def page_titles(spark, sf_dir):
    pages = X.pages(spark, sf_dir)
    raw = F.regexp_extract(F.col("html"), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.select("page_id", url_host(F.col("url")).alias("host"), clean_text(raw).alias("title"))


@query(
    "page_headlines",
    f"""SELECT page_id, CASE WHEN h = '' THEN url ELSE h END AS host, {_clean_sql('t')} AS title
FROM (SELECT page_id, url, regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS h,
             regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t FROM pages) p""",
)
def page_headlines(spark, sf_dir):
    """Headline cleaning and host extraction on raw web pages."""
    return page_titles(spark, sf_dir)


@query(
    "page_hosts",
    """SELECT CASE WHEN h = '' THEN url ELSE h END AS host, count(*) AS pages
FROM (SELECT url, regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS h FROM pages) p GROUP BY 1""",
)
def page_hosts(spark, sf_dir):
    """Pages per host (URL network location)."""
    return X.pages(spark, sf_dir).groupBy(url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("pages"))


@query(
    "lake_news",
    _RUN_2,
)
def lake_news(spark, sf_dir):
    """The news write path end to end: two ingest runs of the landed feeds
    (the second with the classifier silent for some headlines) merged into
    the news table, read back."""
    import uuid

    from gridlake import lake as L
    from gridlake.jobs.ingest import ingest_news
    from gridlake.session import ensure_checkpoint_dir

    lake = L.Lake(f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridlake-news-{uuid.uuid4().hex}")
    feeds = X.feed_documents(spark, sf_dir)
    ingest_news(spark, lake, feeds, X.classifier_answers(spark, sf_dir), X.PREVIOUS_RUN, batch_id="run-1")
    ingest_news(spark, lake, feeds, X.classifier_answers(spark, sf_dir, outage=True), X.AS_OF, batch_id="run-2")
    return spark.read.parquet(lake.path(L.NEWS)).select(*_OUT)
