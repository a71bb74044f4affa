"""Feed files read item by item, in splits: for feeds too large to be one row.

Spark's text source cuts a file at any separator and splits it between tasks; with the end tag of an item as the separator a row is
what lies between two ends. No file is held whole, and one feed of any size is read by many tasks.

An item's place is its file's number, the start of its split and the row within it. Splits that others of their file follow begin
with the first row of their task, and a split has fewer rows than bytes, so start plus row grows along the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeline.session import hold
from tapeline.sources.documents import ITEMS, read_items

ITEM_END = "</item>"
ITEM_START = r"<item[\s>]"

#: Bits of ``seq``: items between two end tags (all but one of them empty or with blanks in the end tag), place in a file (128 GB),
#: number of the file.
ITEM_BITS, PLACE_BITS, FILE_BITS = 12, 37, 14
#: Files that break off inside an item are broadcast up to this number, matched by a shuffle beyond it.
BROADCAST_FILES = 10_000
# Rows of one task are numbered in the lower bits of Spark's increasing number.
ROW_MASK = (1 << 33) - 1


def ticker_of_file(path: Column) -> Column:
    """The value of a folder ``ticker=...`` that Spark wrote, else the name of the file without its ending."""
    folder = F.regexp_extract(path, r"/ticker=([^/]*)/[^/]*$", 1)
    name = F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)
    # Spark escapes values in names of folders, and paths are escaped once more; a plus sign stands for itself in both
    value = F.url_decode(F.replace(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))), F.lit("+"), F.lit("%2B")))
    return F.when(folder != "", value).otherwise(F.url_decode(name))


def number_of_file(path: Column) -> Column:
    """The number of a file that Spark wrote, in the order of its tasks; 0 for other files."""
    number = F.regexp_extract(path, r"/part-([0-9]+)-[^/]*$", 1)
    return F.coalesce(number.try_cast("bigint"), F.lit(0).cast("bigint"))


def split_items(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """Item elements ``(ticker, text, seq)`` of the feed files at ``path``, with ``seq`` in the order of a ticker's files and of the
    items in each. A number without room in ``seq`` raises.

    The items are those that ``decode_feeds`` finds in the whole file. What follows the last end tag is a row too, and an item that
    its file breaks off is none: such files are found by one aggregate over the places and lengths of all rows, whose result is
    stored below ``root`` or the shared folder before the items are read. Compressed files are not split; one that ends with an end tag and nothing behind it loses that item, because its length is not known.
    """
    rows = spark.read.text(path, lineSep=ITEM_END).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_MASK)).alias("row"),
        "value",
    )
    place = F.struct("block", "row", F.col("value").rlike(ITEM_START).alias("open"))
    length = F.octet_length("value") + len(ITEM_END)
    ends = rows.groupBy("file", "size").agg(F.max(place).alias("last"), F.sum(length).alias("length"))
    # the end tag counted for the row behind the last one is not in the file
    ends = ends.where("last.open and length > size")
    ends = hold(ends.select("file", "last.block", "last.row", F.lit(True).alias("unfinished")), root)
    many = ends.limit(BROADCAST_FILES + 1).count()
    text = F.concat("value", F.lit(ITEM_END))
    holding = rows.where(F.contains("value", F.lit("<item")))
    if many:
        found = ends if many > BROADCAST_FILES else F.broadcast(ends)
        holding = holding.join(found, ["file", "block", "row"], "left")
        text = F.when(F.col("unfinished"), F.col("value")).otherwise(text)
    cut = holding.select("file", "block", "row", F.posexplode(F.regexp_extract_all(text, F.lit(ITEMS), F.lit(0))).alias("pos", "text"))
    return cut.select(ticker_of_file(F.col("file")).alias("ticker"), "text", _order().alias("seq"))


def _order() -> Column:
    file, place, item = number_of_file(F.col("file")), F.col("block") + F.col("row"), F.col("pos").cast("bigint")
    fits = (file < 1 << FILE_BITS) & (place < 1 << PLACE_BITS) & (item < 1 << ITEM_BITS)
    number = F.shiftleft(file, PLACE_BITS + ITEM_BITS) + F.shiftleft(place, ITEM_BITS) + item
    wrong = F.raise_error(F.concat(F.lit("no number for an item of "), F.col("file"))).cast("bigint")
    return F.when(fits, number).otherwise(wrong)


def feed_file_items(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """Every article of the feed files at ``path``, as ``decode_feeds`` reads it."""
    return read_items(split_items(spark, path, root))
