"""Benchmark passages in documents by greedy string tiling.

Words are runs of letters and digits, ASCII in lower case. Karp-Rabin hashes of MIN_MATCH words find seeds, the places
where an item and a document share so many words. Seeds that follow each other are one match. The longest match is marked
in both texts, what is left of the others is looked at again, and so on until no unmarked match of MIN_MATCH words is left.
The share of an item's words that are marked is its coverage; since tiles may stand in any order, passages that were
reordered are caught. A document is contaminated by an item from THRESHOLD on.

Items travel to the executors in blocks of at most BLOCK_BYTES of text; every block reads all documents.

Defined cases: null and empty documents match nothing, and neither do null items or items of fewer than MIN_MATCH words.
Repeated documents are each answered, repeated items too. An empty table on either side gives no match. Other columns of
the inputs are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.texts import Texts, Words, mixed, slabs

MIN_MATCH = 5
THRESHOLD = 0.5
#: Text of items that is sent to the executors at a time.
BLOCK_BYTES = 16 << 20
#: Seeds that are worked on at once; a document and an item with more of them, which repeat words, are compared without listing them.
SEEDS = 1 << 20
#: Bits of the table that is asked before the sorted hashes of the items.
TABLE_BITS = 22

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def words_of(texts: Texts) -> Words:
    """``texts`` must be in lower case."""
    return Words.of(texts.data, texts.offsets, _INSIDE[texts.data])


def tiles(n: int, at_item: np.ndarray, at_doc: np.ndarray, width: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of an item of ``n`` words from the seeds (at_item, at_doc): rows of (item, doc, length).

    The longest match first, of equal ones the first in the document, then in the item.
    """
    if not len(at_item):
        return []
    order = np.lexsort((at_item, at_doc - at_item))
    i, j = at_item[order], at_doc[order]
    cuts = np.flatnonzero(np.r_[True, (np.diff(j - i) != 0) | (np.diff(i) != 1), True])
    low = int(j.min())
    marked_item, marked_doc = np.zeros(n, bool), np.zeros(int(j.max()) - low + width, bool)
    heap = [(-(int(b - a) + width - 1), int(j[a]), int(i[a])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    heapq.heapify(heap)
    made = []
    while heap:
        size, q, p = heapq.heappop(heap)
        size = -size
        taken = marked_item[p : p + size] | marked_doc[q - low : q - low + size]
        if not taken.any():
            marked_item[p : p + size] = True
            marked_doc[q - low : q - low + size] = True
            made.append((p, q, size))
            if marked_item.all():
                break
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True]))
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a >= width:
                heapq.heappush(heap, (-int(b - a), q + int(a), p + int(a)))
    return made


def tiles_of_repeats(item: np.ndarray, doc: np.ndarray, width: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """The same tiling from the words themselves, in memory that grows with the texts and not with the places where they agree.

    The length of the longest unmarked match is found by halving, since a match holds matches of all smaller lengths; its
    places come from hashes of all unmarked windows of that length.
    """
    _, words = np.unique(np.r_[item, doc], return_inverse=True)
    item, doc = words[: len(item)], words[len(item) :]
    marked = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    made, longest = [], min(len(item), len(doc))
    while True:
        low, high = width - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            left, right = (_open_windows(x, m, middle) for x, m in zip((item, doc), marked, strict=True))
            low, high = (middle, high) if np.isin(left[0], right[0]).any() else (low, middle - 1)
        longest = low
        if low < width:
            return made
        (seen, at_item), (wanted, at_doc) = (_open_windows(x, m, low) for x, m in zip((item, doc), marked, strict=True))
        order = np.argsort(seen, kind="stable")
        seen, at_item = seen[order], at_item[order]
        begin, end = (np.searchsorted(seen, wanted, side=x) for x in ("left", "right"))
        shut = np.zeros(len(item), bool)  # places of the item where a window meets a mark
        upto = 0
        for k in np.flatnonzero(end > begin).tolist():
            q = int(at_doc[k])
            if q < upto:
                continue
            places = at_item[begin[k] : end[k]]
            free = places[~shut[places]]
            if len(free):
                p = int(free[0])
                marked[0][p : p + low] = True
                marked[1][q : q + low] = True
                shut[max(0, p - low + 1) : p + low] = True
                upto = q + low
                made.append((p, q, low))


def _open_windows(words: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words without a mark, and their places."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values = mixed(words.astype(np.uint64) + np.uint64(1))
    done = 1
    total, left, offset = None, size, 0  # doubling: windows of 1, 2, 4, ... words, joined to one of ``size``
    while left:
        if left & 1:
            part = values[offset : offset + n]
            total = part if total is None else mixed(total * np.uint64(3) + part)
            offset += done
        left >>= 1
        if left:
            values = mixed(values[:-done] * np.uint64(3) + values[done:])
            done *= 2
    crossed = np.r_[0, np.cumsum(marked)]
    places = np.flatnonzero(crossed[size:] == crossed[:n])
    return total[places], places


@dataclass
class Items:
    """Items of a block: for each seed hash, sorted, the item and the place; each item's number of words, and all words."""

    ids: list
    sizes: np.ndarray
    words: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None], width: int = MIN_MATCH) -> Items:
        words = words_of(Texts.of(pa.array(texts, pa.string()), lower=True))
        seeds, at = words.windows(width)
        owner = words.owner[at]
        order = np.argsort(seeds, kind="stable")
        return cls(ids, words.counts, words.hashes, seeds[order], owner[order], (at - words.bounds[owner])[order])

    def table(self) -> np.ndarray:
        held = np.zeros(1 << TABLE_BITS, bool)
        held[(self.seeds >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return held

    def matches(self, texts: Texts, held: np.ndarray, width: int = MIN_MATCH) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(text, item, tiles) of all texts and items with a seed in common."""
        words = words_of(texts)
        values, at = words.windows(width)
        maybe = np.flatnonzero(held[(values >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        left, right = (np.searchsorted(self.seeds, values[maybe], side=side) for side in ("left", "right"))
        at, n = at[maybe], right - left
        owner = words.owner[at]
        cuts = np.flatnonzero(np.r_[True, np.diff(owner) != 0, True]) if len(owner) else np.zeros(1, int)
        total = np.r_[0, np.cumsum(n)][cuts]  # seeds of the documents before
        a = 0
        while a < len(cuts) - 1:
            b = max(a + 1, int(np.searchsorted(total, total[a] + SEEDS, side="right")) - 1)
            here = slice(cuts[a], cuts[b])
            if total[b] - total[a] <= SEEDS:
                yield from self._listed(words, at[here], left[here], n[here], width)
            else:
                yield from self._counted(words, int(owner[cuts[a]]), left[here], right[here], width)
            a = b

    def _listed(self, words: Words, at: np.ndarray, left: np.ndarray, n: np.ndarray, width: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """Documents whose seeds are few: all of them at once."""
        seed = np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = np.repeat(at, n)
        owner = words.owner[at]
        order = np.lexsort((self.item[seed], owner))
        seed, at, owner = seed[order], at[order], owner[order]
        item = self.item[seed]
        cuts = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (np.diff(item) != 0), True]) if len(seed) else np.zeros(1, int)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            doc, which = int(owner[a]), int(item[a])
            yield doc, which, tiles(int(self.sizes[which]), self.place[seed[a:b]], at[a:b] - words.bounds[doc], width)

    def _counted(self, words: Words, doc: int, left: np.ndarray, right: np.ndarray, width: int) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """One document with very many seeds: item by item, from the words."""
        begins, ends = np.cumsum(self.sizes) - self.sizes, np.cumsum(self.sizes)
        asked = np.zeros(len(self.seeds) + 1, np.int64)
        np.add.at(asked, left, 1)
        np.add.at(asked, right, -1)
        mine = words.hashes[words.bounds[doc] : words.bounds[doc + 1]]
        for which in np.unique(self.item[np.cumsum(asked)[:-1] > 0]).tolist():
            yield doc, which, tiles_of_repeats(self.words[begins[which] : ends[which]], mine, width)


def blocks(items: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """All items, in blocks of about ``block_bytes``."""
    held = items.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    n = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-n // block_bytes)
    for k in range(n):
        rows = held.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).orderBy("id", "text").collect()
        if rows:
            yield Items.of([row["id"] for row in rows], [row["text"] for row in rows])


def matched(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Contaminated documents: ``key``, ``item_key``, n_tiles, matched_words, item_words, coverage."""
    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    shape = f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, n_tiles int, matched_words int, item_words int, coverage double"
    read = docs.select(key, F.col(text).alias("text"))

    def searched(block: Items) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = block.table()
            for batch in slabs(batches):
                rows = []
                for doc, item, found in block.matches(Texts.of(batch.column(1), lower=True), held):
                    covered, size = sum(x[2] for x in found), int(block.sizes[item])
                    if covered >= threshold * size:
                        rows.append((doc, block.ids[item], len(found), covered, size, covered / size))
                if rows:
                    doc, *rest = zip(*rows, strict=True)
                    ids = batch.column(0).take(pa.array(doc, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(rest[0]), *(pa.array(x, pa.int32()) for x in rest[1:4]), pa.array(rest[4], pa.float64())],
                        names=[key, item_key, "n_tiles", "matched_words", "item_words", "coverage"],
                    )

        return read.mapInArrow(search, shape)

    made = None
    for block in blocks(items, item_key, item_text, block_bytes):
        made = searched(block) if made is None else made.unionAll(searched(block))
    return docs.sparkSession.createDataFrame([], shape) if made is None else made


def cleaned(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    at = docs.columns.index(text)

    def without(docs: DataFrame, block: Items) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = block.table()
            for batch in slabs(batches, text):
                keep = np.ones(batch.num_rows, bool)
                for doc, item, found in block.matches(Texts.of(batch.column(at), lower=True), held):
                    keep[doc] &= sum(x[2] for x in found) < threshold * block.sizes[item]
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(search, docs.schema)

    for block in blocks(items, item_key, item_text, block_bytes):
        docs = without(docs, block)
    return docs
