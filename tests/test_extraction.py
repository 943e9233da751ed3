import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bantin.operators import extraction as X

URL = "https://site/a/some-story-12.3.html"

# One invented page per site: title, attract, author, date, body of two paragraphs, tags, image.
PAGES = {
    "baodautu": '<div class="big title-detail"> T &amp; t </div><div class="sapo_detail">S</div><a class="author">Ann</a>'
    '<span class="post-time">- 27/03/2024 14:24</span><div id="content_detail_news"><p>one</p><p></p><p>two</p>'
    '<table><tbody><tr><td><img src="/i.png"></td><td>cap</td></tr></tbody></table></div>'
    '<div class="tag_detail"><a class="tag_detail_item">#k1</a><a class="tag_detail_item"> </a><a>no</a></div>',
    "vietnamnet": '<h1 class="content-detail-title">T & t</h1><h2 class="content-detail-sapo">S</h2>'
    '<div class="bread-crumb-detail__time">Wed, 27/03/2024 - 14:24</div><div class="main-content"><p>one</p><p></p><p>two</p><p>Ann</p>'
    '<figure class="image"><img src="/i.png"><figcaption>cap</figcaption></figure></div><div class="tag-cotnent"><a>k1</a></div>',
    "vneconomy": '<h1 class="detail__title">T & t</h1><h2 class="detail__summary">S</h2><div class="detail__author">Ann -</div>'
    '<div class="detail__meta">14:24 27/03/2024</div><div class="detail__content"><p>one</p><p> </p><p>two</p>'
    '<figure><img src="/i.png"><figcaption>cap</figcaption></figure></div><div class="detail__tag"><a class="tag-item">k1</a><a class="tag-item"></a></div>',
    "saigontimes": '<h1 class="tdb-title-text">T & t</h1><a class="tdb-author-name">Ann</a><time datetime=" 2024-03-27T14:24:00+07:00 ">x</time>'
    '<div class="td-post-content"><h6>S</h6><p>one</p><p></p><p>two</p><figure><img src="http://h/i.png"><figcaption>cap</figcaption></figure></div>'
    '<ul class="tdb-tags"><li><a>k1</a></li><li><a></a></li></ul>',
    "diendandoanhnghiep": '<h1 class="title">T & t</h1><div class="summary"><strong>S</strong></div><div class="author-time"><b>Ann | Desk</b></div>'
    '<span class="published-time">27/03/2024, 14:24</span><div class="description"><p>one</p><p></p><p>two</p>'
    '<div class="image_center_wp"><img src="/i.png"></div></div><div class="tags-new"><a>k1</a></div>',
    "nhipcaudautu": '<h1 class="post-detail-title">T & t</h1><div class="des-small">S</div><span class="user-post">Ann</span>'
    '<span class="date-post">Desk | 27/03/2024 14:24</span><div class="content-detail"><p>one</p><p></p><p>two</p>'
    '<table><tbody><tr><td><img src="/i.png"></td><td>cap</td></tr></tbody></table></div><div class="post-tags"><b>k1</b></div>',
    "dantri": '<h1 class="title-page detail">T & t</h1><h2 class="singular-sapo">S</h2><div class="author-name">Ann</div>'
    '<time class="author-time" datetime="2024-03-27 14:24">x</time><div class="singular-content"><p>one</p><p></p><p>two</p>'
    '<figure class="image"><img data-src="/i.png"><figcaption>cap</figcaption></figure></div><ul class="tags-wrap"><li><a>k1</a></li></ul>',
    "phapluatdoisong": '<h1 class="title">T & t</h1><h2 class="sapo">S</h2><div class="datetime">Wed, 27/03/2024 | 14:24</div>'
    '<section class="article-content"><p>one</p><p></p><p>two</p><p>by <strong>Ann</strong></p><p>end</p>'
    '<figure class="image"><img src="/i.png"><figcaption>cap</figcaption></figure></section><ul class="tags"><li><a>k1</a></li></ul>',
    "vtc": '<h1 class="font28 bold lh-1-3">T & t</h1><h2 class="font18 bold inline-nb">S</h2><span class="time-update mr10 align-super">Wed, 27/03/2024 14:24:05 +07:00</span>'
    '<div class="edittor-content"><p>one</p><p></p><p>two</p><figure><img data-src="/i.png"><figcaption>cap</figcaption></figure></div>'
    '<div class="author-make">Ann</div><ul class="keylink font13"><li><a>k1</a></li></ul>',
    "laodong": '<article><h1 class="x title">T & t</h1><div class="chappeau">S</div><span>Ann</span><div class="time">Wed, 27/03/2024 14:24</div>'
    '<p>one</p><p></p><p>two</p></article><div class="lst-tags"><a>k1</a></div>',
    "cafef": '<h1 class="title">T & t</h1><h2 class="sapo">S</h2><p class="author">Ann</p><span class="pdate">27-03-2024</span>'
    '<div class="detail-content"><p>one</p><p></p><p>two</p><figure><img src="http://h/i.png"></figure></div><div class="tags-detail"><a>k1,</a></div>',
    "cafebiz": '<h1 class="title">T & t</h1><h2 class="sapo">S</h2><strong class="detail-author">Ann</strong>'
    '<div class="detail-content"><p>one</p><p></p><p>two</p></div><span class="tags-item"><a>k1,</a></span>',
    "vietstock": '<h1 class="article-title">T & t</h1><p class="pHead">S</p><p class="pAuthor">Ann</p><span class="date">27-03-2024</span>'
    '<div id="vst_detail"><p>one</p><p></p><p>two</p></div><div class="tags"><a>k1</a></div>',
}
DROPS_EMPTY = {"vneconomy", "saigontimes", "diendandoanhnghiep", "nhipcaudautu"}
DATES = {
    "saigontimes": "2024-03-27T14:24:00+07:00", "dantri": "2024-03-27 14:24", "vtc": " 27/03/2024 14:24:05 +07:00",
    "vietnamnet": " 27/03/2024 14:24", "phapluatdoisong": " 27/03/2024 14:24", "laodong": " 27/03/2024 14:24",
    "cafef": "27-03-2024", "vietstock": "27-03-2024", "cafebiz": None,
}
IMAGES = {
    "baodautu": ("https://media.baodautu.vn//i.png", "cap"),
    "vietnamnet": ("https://static-images.vnncdn.net/i.png", "cap"),
    "vneconomy": ("https://media.vneconomy.vn/i.png", "cap"),
    "saigontimes": ("http://h/i.png", "cap"),
    "diendandoanhnghiep": ("https://diendandoanhnghiep.vn/i.png", ""),
    "nhipcaudautu": ("https://imgst.nhipcaudautu.vn//i.png", "cap"),
    "dantri": ("https://icdn.dantri.com.vn/i.png", "cap"),
    "phapluatdoisong": ("https://media.doisongphapluat.com/i.png", "cap"),
    "vtc": ("https://cdn-i.vtcnews.vn/i.png", "cap"),
    "cafef": ("http://h/i.png", ""),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rows = [(j, URL, f"<html><body>{h}</body></html>") for j, h in PAGES.items()]
    return {r.journal: r for r in X.extract_articles(spark.createDataFrame(rows, "journal string, url string, html string")).collect()}


@pytest.mark.parametrize("journal", list(PAGES))
def test_article_page(extracted, journal):
    row = extracted[journal]
    body = ["one", "two"] if journal in DROPS_EMPTY else ["one", "", "two"]
    if journal == "vietnamnet":
        body = [*body, "Ann"]
    assert row.reject_reason is None
    assert (row.title, row.attract, row.author) == ("T & t", "S", "Ann")
    assert row.content == body
    assert row.tags == ["k1"]
    assert row.date_text == DATES.get(journal, "27/03/2024 14:24")
    assert [tuple(i) for i in row.image] == ([IMAGES[journal]] if journal in IMAGES else [])
    key = {"saigontimes": "a", "nhipcaudautu": "a"}.get(journal, "some-story-12")
    assert row.id == f"{journal}_{key}"


BROKEN = {
    "baodautu": ('class="post-time"', "missing span.post-time"),
    "vietnamnet": ("<p>", "missing div.main-content > p"),
    "vneconomy": ("14:24 27/03/2024", "no date in text"),
    "saigontimes": ("tdb-tags", "missing ul.tdb-tags"),
    "diendandoanhnghiep": ('class="summary"', "missing div.summary"),
    "nhipcaudautu": (" | ", "no date in text"),
    "dantri": ("datetime=", "no date in text"),
    "phapluatdoisong": ("<p>", "fewer than two paragraphs"),
    "vtc": ("edittor-content", "missing div.edittor-content"),
    "laodong": ("chappeau", "missing article > .chappeau"),
    "cafef": ("tags-detail", "missing div.tags-detail"),
}


def test_missing_nodes_reject_the_page(spark):
    rows = [(j, URL, PAGES[j].replace(part, "none" if part != "<p>" else "<i>")) for j, (part, _) in BROKEN.items()]
    rows.append(("nosuch", URL, "<p>x</p>"))
    out = X.extract_articles(spark.createDataFrame(rows, "journal string, url string, html string")).cache()
    reasons = {r.journal: r.reject_reason for r in X.rejected_pages(out).collect()}
    assert reasons == {**{j: why for j, (_, why) in BROKEN.items()}, "nosuch": "unknown journal"}
    assert X.require_nodes(out).count() == 0


def test_broken_markup(spark):
    html = (
        '<h1 class="title">T</h1><script>var x="</p><p>no</p>";</script><!-- <p>no</p> --><style>p{}</style>'
        '<h2 class="sapo">S</h2><div class="detail-content"><p>one<b>bold<p>inner</p></div><div class="tags-detail"><a>k</a>'
    )
    df = spark.createDataFrame([("cafef", URL, html)], "journal string, url string, html string")
    row = X.extract_articles(df).first()
    assert row.content == ["oneboldinner", "inner"] and row.tags == ["k"] and row.title == "T"


LISTINGS = {
    "baodautu": ('<div class="desc_list_news_home"><a href="https://baodautu.vn/x.html">a</a><a href="/no">b</a></div>', ["https://baodautu.vn/x.html"]),
    "vietnamnet": ('<div class="main"><div class="container"><h3><a href="/x">a</a></h3><h3><a href="https://vietnamnet.vn/y">b</a></h3></div></div>', ["https://vietnamnet.vn/x", "https://vietnamnet.vn/y"]),
    "vneconomy": ('<header class="story__header"><a href="/x.htm">a</a></header>', ["https://vneconomy.vn/x.htm"]),
    "saigontimes": ('<div class="td-module-meta-info"><h3><a href="https://s/x/">a</a></h3><h3><a href="https://s/no/">a</a></h3></div><div class="td-module-meta-info"><h3><a href="">a</a></h3></div>', ["https://s/x/"]),
    "diendandoanhnghiep": ('<div class="list-new-cat"><h2 class="heading"><a href="https://d/x.html">a</a></h2></div><h2 class="heading"><a href="/no">a</a></h2>', ["https://d/x.html"]),
    "nhipcaudautu": ('<div class="col-xs-12 col-sm-12 col-md-12 col-lg-12"><p class="entry-title"><a href="/x/">a</a></p></div>', ["https://nhipcaudautu.vn/x/"]),
    "dantri": ('<div class="article list"><h3 class="article-title"><a href="/x.htm">a</a></h3></div>', ["https://dantri.com.vn/x.htm"]),
    "phapluatdoisong": ('<section class="more-articles"><h3 class="title"><a href="/x.html">a</a></h3><h3 class="title"><a href="https://www.doisongphapluat.com/y">a</a></h3></section>', ["https://www.doisongphapluat.com/x.html"]),
    "vtc": ('<h3><a href="/x.html">a</a></h3><h3><a href="https://vtc.vn/y">a</a></h3>', ["https://vtc.vn/x.html"]),
    "laodong": ('<div class="body-content"><article><a href="https://laodong.vn/sec/x">a</a></article><article><a href="https://laodong.vn/other/y">a</a></article></div>', ["https://laodong.vn/sec/x"]),
    "cafef": ('<h3><a href="https://m.cafef.vn/x.chn">a</a></h3>', ["https://cafef.vn/x.chn"]),
}


def test_listing_links(spark):
    rows = [(j, "https://laodong.vn/sec", h) for j, (h, _) in LISTINGS.items()]
    out = X.extract_links(spark.createDataFrame(rows, "journal string, section_url string, html string"))
    got = {}
    for r in out.orderBy("journal", "pos").collect():
        got.setdefault(r.journal, []).append(r.link)
    assert got == {j: links for j, (_, links) in LISTINGS.items()}


def test_page_is_read_once_by_python(spark):
    df = spark.createDataFrame([("vtc", URL, PAGES["vtc"])], "journal string, url string, html string")
    plan = X.require_nodes(X.extract_articles(df)).select("id", F.size("content"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_unclosed_tags_take_no_longer(spark):
    import time

    from bantin.functions.dom import _Pages

    pages = _Pages()
    started = time.process_time()
    pages.read("<p>" * 20_000 + "x" + "</b>" * 20_000)
    assert time.process_time() - started < 3
    pages.read(None)
    page, missing = pages.array().to_pylist()
    assert missing is None and len(page["nodes"]) == 20_000 and page["text"] == "x"
    assert page["nodes"][0]["last"] == 19_999 and page["nodes"][5]["t1"] == 1


def test_pages_go_back_in_small_groups(spark, monkeypatch):
    """Nodes of a batch are never held all at once: the reader hands them back as they come."""
    from bantin.functions import dom

    held = []
    real = dom._Pages.array
    monkeypatch.setattr(dom._Pages, "array", lambda self: held.append(self.ends[-1]) or real(self))
    monkeypatch.setattr(dom, "GROUP_NODES", 10)
    page = "<p>a</p>" * 4
    parts = list(dom.read_pages(iter([pa.array([page, None, page, page, "", page])])))
    assert [len(p) for p in parts] == [4, 2] and held == [12, 4]
    assert [None if p is None else len(p["nodes"]) for part in parts for p in part.to_pylist()] == [4, None, 4, 4, 0, 4]


def test_node_text_is_found_by_bytes(spark):
    """Text of any script before a node does not shift it, and a place is no character count."""
    from bantin.functions import dom

    page = "<p>thị trường 😀</p>&eacute;<h1>giá <b>vàng</b>&#xD800;</h1>é<p></p>"
    parsed = X.parse_pages(spark.createDataFrame([(page,)], "html string"))
    texts = [F.expr(dom.node_text("dom.text", dom.find("dom.nodes", tag=t))) for t in ("p", "h1", "b", "i")]
    assert tuple(parsed.select(*texts).first()) == ("thị trường 😀", "giá vàng\ufffd", "vàng", None)
    h1 = parsed.select(F.expr(f"{dom.find('dom.nodes', tag='h1')}.t0")).first()[0]
    assert h1 == len("thị trường 😀é".encode())
