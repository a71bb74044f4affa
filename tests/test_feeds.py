"""News feeds: decoding, defaults and the first articles."""

import pytest

from tapeline import schemas
from tapeline.plans import news as plans
from tapeline.sources.documents import decode_feeds

DOCUMENTS = "ticker string, status int, body string"
NEWS = "ticker string, title string, publisher string, published_date string, link string, seq bigint"


def feed(*items):
    return '<rss version="2.0"><channel><title>feed</title>' + "".join(items) + "</channel></rss>"


def decode(spark, text, status=200, **options):
    return decode_feeds(spark.createDataFrame([("T", status, text)], DOCUMENTS), **options).orderBy("seq").collect()


def test_columns_and_types(spark):
    df = decode_feeds(spark.createDataFrame([("T", 200, feed("<item/>"))], DOCUMENTS))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schemas.NEWS]


def test_first_items_in_feed_order(spark):
    items = [f"<item><title>t{i}</title></item>" for i in range(5)]
    assert [r.title for r in decode(spark, feed(*items), keep_first=3)] == ["t0", "t1", "t2"]
    assert len(decode(spark, feed(*items))) == 5
    assert [r.title for r in decode(spark, feed(items[0]), keep_first=3)] == ["t0"]


def test_absent_and_empty_fields(spark):
    absent, empty = decode(
        spark, feed("<item/>", "<item><title></title><link></link><pubDate/><source url='u'></source></item>")
    )
    assert tuple(absent)[1:5] == ("N/A", "N/A", "N/A", "")
    assert tuple(empty)[1:5] == ("", "", "", "")


def test_text_is_kept_as_it_is(spark):
    texts = ["T1 &amp; x", "null", "  spaced  ", "<![CDATA[a < b]]>", "café 世", "N/A"]
    rows = decode(spark, feed(*[f"<item><title>{t}</title></item>" for t in texts]))
    assert [r.title for r in rows] == ["T1 & x", "null", "  spaced  ", "a < b", "café 世", "N/A"]


def test_publisher_with_and_without_address(spark):
    rows = decode(
        spark, feed('<item><source url="http://p">P</source></item>', "<item><source>P</source></item>")
    )
    assert [r.publisher for r in rows] == ["P", "P"]


@pytest.mark.parametrize(
    "text",
    [feed(), "<rss><channel><item><title>cut", "<html><body>error</body></html>", "", None, "not xml at all"],
)
def test_bad_feeds_give_no_rows(spark, text):
    assert decode(spark, text) == []


def test_readable_items_of_imperfect_feeds(spark):
    good = "<item><title>fine</title></item>"
    titles = lambda text: [r.title for r in decode(spark, text)]
    assert titles(feed(good, "<item><title>a & b &nbsp; c &amp; d</title></item>")) == ["fine", "a & b &nbsp; c & d"]
    assert titles("<rss><channel>" + good + "<item><title>cut") == ["fine"]
    assert titles("<rss><channel>" + good + "</channel><channel>" + good * 2 + "</channel></rss>") == ["fine"] * 3
    assert titles("<rss>" + good + "<channel><deep>" + good + "</deep></channel></rss>") == ["fine"] * 2
    assert titles(feed("<item><title>a <b>bold</b> z</title><media:x u='1'/><description>d<br></description></item>")) == ["a bold z"]
    assert titles(feed("<item><title><![CDATA[a & <b>b</b>]]></title></item>")) == ["a & <b>b</b>"]


def test_unanswered_requests_give_no_rows(spark):
    assert decode(spark, feed("<item><title>t</title></item>"), status=503) == []


def test_no_article_at_all_is_an_empty_table(spark):
    news = plans.build_news(spark.createDataFrame([("T", 404, "")], DOCUMENTS))
    assert news.columns == schemas.NEWS.names and news.isEmpty()
    assert plans.news_digest(news).collect() == []


def test_pages_of_one_feed_are_cut_together(spark):
    page = feed(*[f"<item><title>a{i}</title></item>" for i in range(2)])
    other = feed(*[f"<item><title>b{i}</title></item>" for i in range(4)])
    df = spark.createDataFrame([("T", 200, other, 1), ("T", 200, page, 0)], DOCUMENTS + ", part bigint")
    rows = plans.build_news(df).orderBy("seq").collect()
    assert [r.title for r in rows] == ["a0", "a1", "b0"]


def test_first_present_field_is_taken_per_column(spark):
    rows = [
        ("b", "only", "p", "d", None, 0),
        ("a", None, "p1", None, "l1", 0),
        ("a", "t2", "p2", "d2", "l2", 1),
        (None, "t", "p", "d", "l", 0),
    ]
    found = plans.first_article_fields(spark.createDataFrame(rows, NEWS)).orderBy("ticker").collect()
    assert [tuple(r) for r in found] == [("a", "t2", "p1", "d2", "l1"), ("b", "only", "p", "d", None)]


def test_first_article_is_one_row(spark):
    rows = [("a", None, "p1", "d1", "l1", 5), ("a", "t2", "p2", "d2", "l2", 9), (None, "t", "p", "d", "l", 0)]
    found = plans.first_articles(spark.createDataFrame(rows, NEWS)).collect()
    assert [tuple(r) for r in found] == [("a", None, "p1", "d1", "l1", 5)]


def test_digest_texts(spark):
    rows = [("b", "B news", "P", "Mon", "", 0), ("a", "A news", "Q", "Tue", "http://x", 0), ("c", None, "R", "W", None, 0)]
    digest = plans.news_digest(spark.createDataFrame(rows, NEWS)).orderBy("position").collect()
    assert [r.headline for r in digest] == ["1. [a] A news", "2. [b] B news", "3. [c] None"]
    assert [r.byline for r in digest] == ["Q - Tue", "P - Mon", "R - W"]
    assert [r.read_more for r in digest] == [' <link href="http://x">Read more</link>', "", ""]
