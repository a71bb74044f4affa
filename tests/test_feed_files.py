"""Feed files read in splits: the same articles in the same order as from whole files."""

import pytest

from pyspark.sql import functions as F

from tapeline.sources import feed_files, landing
from tapeline.sources.documents import decode_feeds
from test_feeds import DOCUMENTS, feed

ODD = [
    "<item/>",
    "<item><title>a & b &nbsp; c &amp; d</title></item >",
    "<item><title><![CDATA[a & <b>b</b>]]> & c</title></item>",
    "<item><title>two\nlines\r\n</title><link>l</link></item>",
    "<items><itemid>7</itemid></items>",
    "<item a='1'><source url='u'>p & q</source><pubDate>d</pubDate></item>",
    "<item><title>never read</title><wrong></item>",
    "<item/><item /><item></item>",
    "<item><title>café 世界</title></item>",
]


def settings(spark, names):
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def small_splits(spark):
    yield from settings(spark, {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"})


@pytest.fixture
def no_automatic_broadcast(spark):
    yield from settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})


def write(folder, name, text):
    (folder / name).write_bytes(text.encode())


def in_order(items):
    return [tuple(r)[:5] for r in items.orderBy("ticker", "seq").collect()]


def test_same_as_whole_files(spark, tmp_path, small_splits):
    for i, ending in enumerate(("</channel></rss>", "<item><title>cut</title>", "<item/><item><title>cut", "")):
        items = [*[f"<item><title>{i} {j} {'x' * (j % 90)}</title></item>" for j in range(400)], *ODD]
        write(tmp_path, f"T{i}.xml", '<?xml version="1.0"?>\n<rss><channel>' + "\n".join(ODD + items) + ending)
    for i, text in enumerate(("", "  \n<rss/>", "</item></item>", "<item>", "<item/>" * 4000, feed(*ODD))):
        write(tmp_path, f"small{i}.xml", text)
    items = feed_files.feed_file_items(spark, str(tmp_path))
    scan = spark.read.text(str(tmp_path), lineSep=feed_files.ITEM_END).where("_metadata.file_name = 'T0.xml'")
    assert scan.select(F.col("_metadata.file_block_start")).distinct().count() > 5
    expected = in_order(decode_feeds(landing.landed_files(spark, str(tmp_path))))
    assert in_order(items) == expected and len(expected) > 5600
    assert items.select("ticker", "seq").distinct().count() == len(expected)
    assert items.dtypes == decode_feeds(spark.createDataFrame([], DOCUMENTS)).dtypes


def test_long_items_over_many_splits(spark, tmp_path, small_splits):
    items = [f"<item><title>{'long ' * 3000}{j}</title></item>" + "<item/>" * (500 * (j % 2)) for j in range(12)]
    write(tmp_path, "L.xml", feed(*items))
    expected = in_order(decode_feeds(landing.landed_files(spark, str(tmp_path))))
    assert in_order(feed_files.feed_file_items(spark, str(tmp_path))) == expected and len(expected) == 3012


def test_files_that_spark_wrote(spark, tmp_path, small_splits):
    rows = spark.range(3000).select(
        F.format_string("A&+%d/ b", F.col("id") % 2).alias("ticker"),
        "id",
        F.format_string("<item><title>%05d</title></item>", "id").alias("value"),
    )
    ordered = rows.repartitionByRange(5, "ticker", "id").sortWithinPartitions("ticker", "id").drop("id")
    ordered.write.partitionBy("ticker").text(str(tmp_path / "feeds"))
    found = in_order(feed_files.feed_file_items(spark, str(tmp_path / "feeds")))
    assert [(t, title) for t, title, *_ in found] == [(f"A&+{k}/ b", f"{i:05d}") for k in (0, 1) for i in range(k, 3000, 2)]


def test_places_without_a_number_raise(spark, tmp_path):
    write(tmp_path, "E.xml", "<item/>" * 5000)
    with pytest.raises(Exception, match="no number for an item"):
        feed_files.feed_file_items(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("limit, ways", [(10, 0), (0, 1)])
def test_texts_are_shuffled_only_beside_a_long_list(spark, tmp_path, monkeypatch, no_automatic_broadcast, limit, ways):
    monkeypatch.setattr(feed_files, "BROADCAST_FILES", limit)
    write(tmp_path, "T.xml", feed(*ODD))
    for exchanges in (0, ways):
        items = feed_files.feed_file_items(spark, str(tmp_path))
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 * exchanges
        assert in_order(items) == in_order(decode_feeds(landing.landed_files(spark, str(tmp_path))))
        write(tmp_path, "U.xml", "<item><title>whole</title></item><item><title>cut</title>")


def test_many_stray_ampersands_are_read_once(spark):
    text = feed("<item><title>" + "& " * 60_000 + "<![CDATA[& &amp; ]]>" + "&amp;& &" + "</title></item>")
    (row,) = decode_feeds(spark.createDataFrame([("T", 200, text)], DOCUMENTS)).collect()
    assert row.title == "& " * 60_000 + "& &amp; " + "&& &"
