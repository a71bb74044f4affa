"""Token sequences of fixed capacity, filled best-fit decreasing.

Texts are tokenized, closed by an end id and cut into pieces of at most ``capacity`` ids. Best-fit decreasing takes the
longest piece next and puts it where the least room is left over. What it does depends on nothing but how many pieces of
each length there are. So the pieces of a length are counted, and one plan over these counts, at most ``capacity`` of
them, is made with a segment tree over remaining capacities. Open sequences with the same room are handled as ranges. The
plan says for each length which ranks go to which sequences; pieces are ranked on Spark and placed by it.

The plan is bounded: each length adds at most two ranges, and a range loses at least half its room whenever it is used, so
there are at most 2 * capacity * log2(capacity) entries, whatever the number of pieces.

Defined cases: a null or empty text is one piece, the end id alone. Repeated rows are each packed. An empty table gives an
empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.tables import stored
from tapeline.llm.texts import LOWER, SPACE, Texts, Words, slabs

CAPACITY = 4096
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Parts of texts whose ids a task remembers at a time, and the bits of the table that finds most of them.
REMEMBERED, TABLE_BITS = 400_000, 20
#: Text whose words are looked up at once.
SLAB_BYTES = 1 << 20
#: Buckets among which the pieces of one length are ranked, at least.
BUCKETS = 32


_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN[_PLAIN] = False
_SIGN[65:91] = False


class Tree:
    """Which remaining capacities have open sequences; finds the smallest one from a given size on."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.held = [False] * (2 * self.size)

    def put(self, room: int, held: bool) -> None:
        at = room + self.size
        self.held[at] = held
        while at > 1:
            at //= 2
            self.held[at] = self.held[2 * at] or self.held[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        at = length + self.size
        while not self.held[at]:
            while at % 2:  # a right child: nothing further right below this parent
                at //= 2
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.held[2 * at] else 2 * at + 1
        return at - self.size


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, first offset), by length and rank.

    Piece ``rank`` of its length goes to sequence ``first sequence + (rank - first rank) // per``, the
    ``(rank - first rank) % per``-th of that length there.
    """
    tree, open_, rows, sequences = Tree(capacity), {}, [], 0

    def put(room: int, start: int, n: int) -> None:
        if n and room:
            open_.setdefault(room, []).append((start, n))
            tree.put(room, True)

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            room = tree.tightest(length)
            if room is None:
                room, start = capacity, sequences
                n = -(-(total - rank) // (capacity // length))
                sequences += n
            else:
                start, n = open_[room].pop()
                if not open_[room]:
                    tree.put(room, False)
            per = room // length
            rows.append((length, rank, start, per, capacity - room))
            full = min(n, (total - rank) // per)
            put(room - per * length, start, full)
            rank += full * per
            if full < n and rank < total:  # the last ones fill a part of one more
                put(room - (total - rank) * length, start + full, 1)
                rank, full = total, full + 1
            put(room, start + full, n - full)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Encoder:
    """Ids of texts. Parts that no token spans are encoded once and remembered.

    Parts end at white space, and before an ASCII sign that follows an ASCII letter or digit: the tokenizer's own pattern
    always cuts there. ASCII letters are lower-cased first, as the tokenizer would. Neither holds for its special tokens, so
    texts with their opening sign are left as they are. A part of Latin letters only is one piece to the pattern and goes
    to the merges at once.
    """

    OPENING = b"<|"

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.keys, self.rows = np.zeros(1 << TABLE_BITS, np.uint64), np.full(1 << TABLE_BITS, -1, np.int64)

    def _parts(self, texts: Texts) -> Words:
        if self.OPENING in texts.data.tobytes():
            return texts.words
        data = LOWER[texts.data]
        breaks = np.zeros(len(data), bool)
        breaks[1:] = _SIGN[data[1:]] & _PLAIN[data[:-1]]
        starts = texts.offsets[texts.offsets < len(data)]
        breaks[starts] = False
        return Words.of(data, texts.offsets, ~SPACE[data], breaks)

    def _encode(self, strings: list[str]) -> list[list[int]]:
        merge, normal = self.tokenizer.model.tokenize, self.tokenizer.normalizer.normalize_str
        made, others = [], []
        for k, x in enumerate(strings):
            if x.isalpha() and x.isascii():
                made.append([t.id for t in merge(x.lower())])
            elif x.isalpha() and max(x) < "\u0250" and (y := normal(x)).isalpha():
                made.append([t.id for t in merge("".join([self.letters[b] for b in y.encode()]))])
            else:
                made.append([])
                others.append(k)
        for k, x in zip(others, self.tokenizer.encode_batch_fast([strings[k] for k in others], add_special_tokens=False), strict=True):
            made[k] = x.ids
        return made

    def _places(self, words: Words) -> np.ndarray:
        """For each part, its row among the remembered ones."""
        if len(self.known) > REMEMBERED:
            self.forget()
        values = words.hashes
        slots = (values & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
        places = np.where(self.keys[slots] == values, self.rows[slots], -1)
        missed = np.flatnonzero(places < 0)
        found, first, inverse = np.unique(values[missed], return_index=True, return_inverse=True)
        rows = np.array([self.known.get(x, -1) for x in found.tolist()], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = missed[first[new]]
            strings = [words.data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(words.starts[at], words.ends[at], strict=True)]
            ids = self._encode(strings)
            lengths = np.array([len(x) for x in ids], np.int64)
            rows[new] = len(self.lengths) + np.arange(len(new))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum()))])
            self.known.update(zip(found[new].tolist(), rows[new].tolist(), strict=True))
        places[missed] = rows[inverse]
        self.keys[slots[missed]], self.rows[slots[missed]] = values[missed], places[missed]
        return places

    def ids(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by END_ID, and the bounds of the texts among them."""
        words = self._parts(texts)
        places = self._places(words)
        lengths = self.lengths[places] if len(places) else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = ends[words.bounds] + np.arange(len(texts) + 1)
        total = int(ends[-1])
        source = np.repeat((self.starts[places] if len(places) else lengths) - ends[:-1], lengths) + np.arange(total)
        result = np.full(total + len(texts), END_ID, np.uint32)
        inside = np.ones(len(result), bool)
        inside[bounds[1:] - 1] = False
        result[inside] = self.flat[source]
        return result, bounds


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: ``key``, piece, start, length, ids_crc32, and with ``with_ids`` the ids themselves.

    ``path`` is the vocabulary file on the executors; without it the installed one.
    """
    names = [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(path)
        for batch in slabs(batches, limit=SLAB_BYTES):
            ids, bounds = encoder.ids(Texts.of(batch.column(1)))
            each = -(-np.diff(bounds) // capacity)
            owner = np.repeat(np.arange(len(each)), each)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
            starts = bounds[owner] + piece * capacity
            ends = np.minimum(starts + capacity, bounds[owner + 1])
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(owner)), *(pa.array(x, pa.int64()) for x in (piece, piece * capacity, ends - starts, sums))]
            columns[1] = columns[1].cast(pa.int32())
            if with_ids:
                columns.append(pa.array([ids[s:e].astype(np.int32) for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(key, F.col(text).alias("text")).mapInArrow(cut, shape)


def pack(held: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``held``, a stored result of ``pieces``, with sequence_id and offset."""
    buckets = max(BUCKETS, int(held.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    cell = held.withColumn("_cell", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(buckets)))
    counts = stored(cell.groupBy("length", "_cell").count(), "lengths")
    totals = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # capacity rows
    made = plan(totals, capacity)
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_cell").orderBy(key, "piece", "ids_crc32"))
    ranked = cell.withColumn("_within", within).join(offsets, ["length", "_cell"])
    ranked = ranked.select(*held.columns, (F.col("_before") + F.col("_within") - 1).alias("_rank"))
    own = held.columns
    span = 1 + max(totals.values(), default=0)
    starts = made[:, 0] * span + made[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            length, rank = table["length"].to_numpy(), table["_rank"].to_numpy()
            row = made[np.searchsorted(starts, length * span + rank, side="right") - 1]
            beyond = rank - row[:, 1]
            sequence, offset = row[:, 2] + beyond // row[:, 3], row[:, 4] + beyond % row[:, 3] * length
            columns = [table[x].combine_chunks() for x in own] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield from pa.Table.from_arrays(columns, names=[*own, "sequence_id", "offset"]).to_batches()

    shape = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in held.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, shape)
