"""A sieve for repeated keys: rows whose key is seen once are dropped where they are read, before anything is shuffled.

One map-side pass counts rows per cell, a cell being a hash of the key: a row of the count sketch is 16 bytes whatever the key, rows
of a cell are combined before they move, and sketches of batches merge by addition. Only cells with more than one row can hold a
repeated key. They are put into a bitmap of BITS_PER_CELL bits each, MOST_BITS at most, which is handed to the scan as one value. A
key that is seen once passes only where its bit is taken by another key; no repeated key is ever lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

CELLS = 1 << 40
#: 16 bits a cell let one in 16 single keys pass; beyond 4 million cells the bitmap stays at 8 MB and more of them do.
BITS_PER_CELL = 16
MOST_BITS = 1 << 26
WORD = 64


def cell_of(keys: list[str]) -> Column:
    """Missing equals missing, as in a grouping."""
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS))


def count_sketch(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (cell, n): how many rows fall into each cell that any falls into."""
    return df.groupBy(cell_of(keys).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def merged(*sketches: DataFrame) -> DataFrame:
    """The count sketch of all rows of several batches."""
    return reduce(lambda a, b: a.unionByName(b), sketches).groupBy("cell").agg(F.sum("n").alias("n"))


def size_of(cells: int, most_bits: int = MOST_BITS) -> int:
    return min(most_bits, max(1, -(-cells * BITS_PER_CELL // WORD)) * WORD)


def bitmap(cells: DataFrame, bits: int) -> DataFrame:
    """One row, ``words``: the bitmap of the cells of ``cells`` as 64-bit words."""
    place = F.pmod("cell", F.lit(bits))
    taken = cells.select(F.floor(place / WORD).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(cell, {bits}), {WORD}) as int))").alias("mask"))
    none = cells.sparkSession.range(bits // WORD).select(F.col("id").alias("word"), F.expr("0L").alias("mask"))
    words = taken.unionAll(none).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "mask")))  # most_bits / 64 at most
    return words.agg(F.transform(ordered, lambda x: x["mask"]).alias("words"))


def passing(df: DataFrame, keys: list[str], words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose cell's bit is set."""
    place = F.pmod(cell_of(keys), F.lit(bits))
    word = F.element_at(words.select("words").scalar(), (F.floor(place / WORD) + 1).cast("int"))
    return df.where(F.getbit(word, F.pmod(place, F.lit(WORD)).cast("int")) == 1)
