from __future__ import annotations

import html
import re

import pyarrow.parquet as pq

from gridlake.llm import html_text as H
from gridlake.llm import queries as Q
from tests.conftest import SF_SMALL

SHOP = (
    '<html><body class="has-sidebar"><div id="top-nav"><a>Home</a></div><div class="page"><div class="line">We ship to {0}</div>'
    '<div class="body"><h2>Title {1}</h2>Text {1} of<br>a <b>page</b>&nbsp;here<p>More {1} &lt;x&gt;</div>'
    '<div class="cookie-notice">Accept</div><div class="line">All rights reserved</div></div></body></html>'
)


def test_pages_of_the_fixture(spark):
    found = {r.page_id: r.text for r in Q.op9_html_main_text(spark, SF_SMALL).collect()}
    rows = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    assert len(found) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [html.unescape(re.sub(r"<[^>]+>", " ", x)) for x in re.split(r"</?(?:p|h1)>", article)]
        want = [" ".join(x.split()) for x in parts]
        assert found[r["page_id"]] == "\n".join(x for x in want if x)


def test_constant_text_of_a_host_is_template(spark):
    rows = [(i, f"http://shop.example/{i}", SHOP.format("all", i)) for i in range(6)]
    rows += [(100 + i, f"http://tiny.example/{i}", SHOP.format("all", i)) for i in range(2)]
    rows += [(200 + i, f"http://same.example/{i}", SHOP.format("all", 0)) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS fixed", "'' AS text")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    slots = "Title {0}\nText {0} of a page here\nMore {0} <x>"
    whole = "We ship to all\n" + slots + "\nAll rights reserved"
    for i in range(6):
        assert got[i] == slots.format(i)
        assert got[200 + i] == whole.format(0)  # equal pages show no template
    assert got[100] == whole.format(0)


def test_template_main_container(spark):
    page = "<body><div>Greeting {0}</div><article><p>Story {0}</p><article class=comment>Reader</article></article><div>Bye {0}</div>"
    rows = [(i, f"http://h/{i}", page.format(i)) for i in range(5)] + [(9, "http://h/9", None)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(5)] == [f"Story {i}" for i in range(5)] and got[9] == ""


def test_markup_cases():
    text = H.main_text
    assert text(None) == text("") == text("<p></p>") == ""
    assert text("plain &amp; simple") == "plain & simple"
    assert text("a<script>var x='<p>no</p>'</script>b<style>p{}</style>") == "a b"
    assert text("<p>one<p>two</P><DIV>three") == "one\ntwo\nthree"
    assert text("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert text("<!-- <p>no</p> --><p title='a>b'>yes</p><!-- open <p>no") == "yes"
    assert text("<nav><ul><li>menu</ul></nav><p>body</p><footer>foot") == "body"
    assert text("<div class='ad'>buy<article><p>story</p></article>") == "story"
    assert text("<p>x</p><form><p>field</p></form><aside>s</aside><div role='search'>q</div><p hidden>h</p><p>y</p>") == "x\ny"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert text("<p>unclosed <b>bold</p><p>tail") == "unclosed bold\ntail"
    assert text("x<") == "x<" and text("<p>cut <a href='") == "cut"
    assert len(text("<p>" + "long word " * 100_000 + "</p>")) == 999_999


def test_odd_tables(spark):
    schema = "page_id long, url string, html string"
    assert H.extract(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, "<p>a"), (1, "no url", "<p>b"), (1, "no url", "<p>b")]
    got = sorted((r.page_id or 0, r.url or "", r.text) for r in H.extract(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, "", "a"), (1, "no url", "b"), (1, "no url", "b")]


def test_names_and_hiding_that_only_look_like_furniture():
    text = H.main_text
    for attributes in ('style="overflow:hidden"', 'class="overflow-hidden"', 'id="hidden-costs"', "title='display:none'", "data-x=hidden"):
        for element in ("div", "main", "article"):
            assert text(f"<{element} {attributes}><p>story</p></{element}>") == "story", (element, attributes)
    for attributes in ("hidden", "HIDDEN=''", "style='color:red; Display : none'", "aria-hidden=true"):
        assert text(f"<p>x</p><div {attributes}><p>unseen</p></div>") == "x", attributes
    assert text('<article class="post category-social tag-ads"><p>story</p></article>') == "story"
    assert text('<article class="share ad" id="related-to-x"><p>story</p></article>') == "story"
    assert text('<div class="content has-sidebar"><p>story</p></div>') == "story"
    assert text('<div class="box ad-slot">buy</div><div id="site-footer">foot</div><p>story</p>') == "story"


def test_named_ancestors_of_the_main_container():
    text = H.main_text
    page = '<div class="layout sidebar-left"><div class="sidebar"><p>menu</p></div><article><p>story</p></article></div>'
    assert text(page) == "story"
    assert text(page.replace("article", "main")) == "story"
    assert text(page, has_main=False) == "story"  # what stands beside the container is judged by its own name
    teasers = '<section class="related"><article>other</article></section><div class="promo"><article>third</article></div>'
    assert text(page + teasers) == "story\nthird"
    assert text("<article><p>story</p></article>" + teasers) == "story"
    assert text('<div id="comments"><article><p>reader</p></article></div><p>story</p>') == "story"


def read(spark, rows):
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_odd_pages_do_not_switch_a_template_off(spark):
    slots = "Title {0}\nText {0} of a page here\nMore {0} <x>"
    odd = {100: None, 101: "", 102: "<p", 103: "just a line", 104: "<html><body><table><tr><td>other</table>", 105: "<section><p>broken"}
    got = read(spark, [(i, f"http://shop.example/{i}", SHOP.format("all", i)) for i in range(30)] + [(k, f"http://shop.example/{k}", v) for k, v in odd.items()])
    assert [got[i] for i in range(30)] == [slots.format(i) for i in range(30)]
    assert [got[k] for k in odd] == ["", "", H.main_text("<p"), "just a line", "other", "broken"]


def test_classes_of_some_pages_and_of_several_places_a_page(spark):
    page = '<body><div class="x"><b>{n}</b></div><div class="tip"><p>Mind the gap</p></div><p>Story {i}</p><div class="tip"><p>Mind the gap</p></div></body>'
    rows = [(i, f"http://h.example/{i}", page.format(i=i, n=f"Offer of week {i % 4}")) for i in range(40)]
    rows[7] = (7, "http://h.example/7", "<body><p>Story 7</p></body>")
    got = read(spark, rows)
    assert got[7] == "Story 7"
    assert all(got[i] == f"Offer of week {i % 4}\nStory {i}" for i in range(40) if i != 7)


def test_articles_published_again_are_no_template(spark):
    page = "<body><article><h1>Head {0}</h1><p>One of {0} here</p><p>Two of {0} here</p></article><p>Seen {1} times</p></body>"
    rows = [(i, f"http://h.example/{i}", page.format("same" if i % 3 == 0 else i, i)) for i in range(30)]
    rows += [(100 + i, f"http://copies.example/{i}", page.format("same", 0)) for i in range(9)] + [(110, "http://copies.example/x", "<body><p>else</p></body>")]
    got = read(spark, rows)
    for i, _, _ in rows[:39]:
        name = "same" if i >= 100 or i % 3 == 0 else i
        assert got[i] == f"Head {name}\nOne of {name} here\nTwo of {name} here"
