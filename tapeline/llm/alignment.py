"""Tokens of two tokenizers aligned by galloping intersection of their end offsets.

Both tokenizers cut the same bytes. The ends of the tokens of either are ascending lists; in each document the shorter list
drives: every one of its ends is searched in the longer list, from where it would be if all tokens were equally long, in steps
that double until it is enclosed, then by halving. Ends in both lists cut the document into groups. The ranks at which an end
and its predecessor stand in the longer list give the range of longer-list tokens that a token overlaps: its links.

How many documents hold a pair of ids linked is counted over the corpus. Links would be hundreds of rows per document, so a task
works on slabs of documents: it sends each distinct pair of a slab once, with the number of its documents, and stores which
documents hold which pairs, packed. Pairs go to ranges of A ids in which counts are added up and the highest of each A id is
marked; a frequent pair weighs one entry per slab. Answers return to the slab by its number. Texts are tokenized once and do not
travel.

The byte-level vocabulary is read from its JSON file and run by a library for such vocabularies; the other file by its own.

Defined cases: a null or empty text has no tokens, nor has one that the tokens of either tokenizer do not give back in full; it
has zeros and an empty digest. Special tokens are plain text. Rows that repeat are each answered and each counted. A null id is
as good as any. An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.tables import stored
from tapeline.llm.texts import slabs

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Text whose pairs are sent together, and text whose pairs make up one range of A ids.
SLAB_BYTES = 4 << 20
RANGE_BYTES = 64 << 20
#: Tokens that are worked on at once within a slab.
PART_BYTES = 1 << 20
#: What parts words before byte pairs are merged, for vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BITS = 17  # documents of a slab


def _bytes_of_signs() -> dict[str, int]:
    """The signs that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class ByteLevel:
    """Tokenizer A: ids of space + text, and the bytes of each id."""

    def __init__(self, vocabulary: str = VOCABULARY_A):
        import tiktoken

        with open(_path(vocabulary), encoding="utf-8") as file:
            read = json.load(file)
        signs = _bytes_of_signs()
        special = {x["id"] for x in read["added_tokens"]}
        self.entries = {i: bytes(signs[c] for c in x) for x, i in read["model"]["vocab"].items() if i not in special}
        self.encoding = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks={x: i for i, x in self.entries.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + x, disallowed_special=()).astype(np.int64) for x in texts]


class Pieces:
    """Tokenizer B: ids of the text, before which it puts a space itself."""

    def __init__(self, vocabulary: str = VOCABULARY_B):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=_path(vocabulary))
        self.entries = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.entries[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def _lengths(entries: dict[int, bytes]) -> np.ndarray:
    lengths = np.zeros(max(entries) + 1, np.int64)
    lengths[list(entries)] = [len(x) for x in entries.values()]
    return lengths


def gallop(ends: np.ndarray, wanted: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each of ``wanted``, the first place in ``ends`` that is not below it; searched from ``guess`` on, in doubling steps and
    then by halving. The last of ``ends`` must not be below any of ``wanted``."""
    top = len(ends) - 1
    guess = np.clip(guess, 0, top)
    forward = ends[guess] < wanted
    low, high = guess - 1, guess.copy()  # ends[low] < wanted <= ends[high], once found
    open_, step = np.flatnonzero(forward), 1
    while len(open_):
        low[open_] = high[open_]
        high[open_] = np.minimum(low[open_] + step, top)
        open_, step = open_[ends[high[open_]] < wanted[open_]], 2 * step
    open_, step = np.flatnonzero(~forward), 1
    open_ = open_[low[open_] >= 0]
    open_ = open_[ends[low[open_]] >= wanted[open_]]
    while len(open_):
        high[open_] = low[open_]
        low[open_] = np.maximum(high[open_] - step, -1)
        open_, step = open_[low[open_] >= 0], 2 * step
        open_ = open_[ends[low[open_]] >= wanted[open_]]
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = ends[middle] < wanted[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


@dataclass
class Aligned:
    """Tokens of some documents: which ends are common, and links as places of an A and a B token."""

    common_a: np.ndarray
    common_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray, bounds_b: np.ndarray) -> Aligned:
    """``ends``: of all documents one after the other, ascending; document i has the tokens from ``bounds[i]`` to ``bounds[i + 1]``
    and ends at the same offset in both."""
    common = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links: tuple[list, list] = ([], [])
    n = np.diff(bounds_a), np.diff(bounds_b)
    for s in (0, 1):  # the shorter list
        drives = np.flatnonzero((n[0] <= n[1]) if s == 0 else (n[0] > n[1]))
        if not len(drives):
            continue
        short, long = ((ends_a, ends_b), (ends_b, ends_a))[s]
        short_bounds, long_bounds = ((bounds_a, bounds_b), (bounds_b, bounds_a))[s]
        size = n[s][drives]
        at = np.repeat(short_bounds[drives] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        begin = np.repeat(long_bounds[drives], size)
        ratio = np.repeat(n[1 - s][drives] / np.maximum(size, 1), size)
        rank = at - np.repeat(short_bounds[drives], size)
        place = gallop(long, short[at], begin + (rank * ratio).astype(np.int64))
        equal = long[place] == short[at]
        common[s][at], common[1 - s][place[equal]] = equal, True
        first = np.r_[0, place[:-1] + equal[:-1]]
        fresh = rank == 0
        first[fresh] = begin[fresh]
        count = place - first + 1
        links[s].append(np.repeat(at, count))
        links[1 - s].append(np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum()))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in links)
    return Aligned(*common, a, b)


class Aligner:
    """Both tokenizers, and the texts of their ids with the sign that follows."""

    def __init__(self, vocabulary_a: str, vocabulary_b: str):
        self.a, self.b = ByteLevel(vocabulary_a), Pieces(vocabulary_b)
        self.lengths = _lengths(self.a.entries), _lengths(self.b.entries)
        self.n_a, self.n_b = (len(x) for x in self.lengths)
        self.written = [f"{i}{sign}" for i in range(self.n_a) for sign in ",|"] + [f"{i}{sign}" for i in range(self.n_b) for sign in (",", ";", "")]
        # A ids in an order of their own, so that frequent ones are spread over the ranges
        self.spread = np.random.default_rng(17).permutation(self.n_a)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        none = np.zeros(0, np.int64)
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        for k, text in enumerate(texts):
            data = b" " + text.encode("utf-8", "surrogatepass")
            same = all(b"".join(map(side.entries.__getitem__, ids[k].tolist())) == data for side, ids in ((self.a, ids_a), (self.b, ids_b)))
            if not text or not same:
                ids_a[k] = ids_b[k] = none
        return ids_a, ids_b

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, digest); and of each distinct pair of a document the key, and how many links it has
        there: sorted by key, which is the pair's code and the document's number."""
        each_a, each_b = self.tokens(texts)
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (each_a, each_b))
        bounds_a, bounds_b = (np.cumsum([0, *map(len, x)]) for x in (each_a, each_b))
        found = aligned(np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b]), bounds_a, bounds_b)
        # A and B tokens in the order they are written, group by group
        group_a, group_b = np.cumsum(found.common_a) - found.common_a, np.cumsum(found.common_b) - found.common_b
        upto_a, upto_b = np.r_[0, np.flatnonzero(found.common_a) + 1], np.r_[0, np.flatnonzero(found.common_b) + 1]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + upto_b[group_a]] = 2 * a + found.common_a
        sign = found.common_b.astype(np.int64)
        sign[bounds_b[1:][np.diff(bounds_b) > 0] - 1] = 2
        order[np.arange(len(b)) + upto_a[group_b + 1]] = 2 * self.n_a + 3 * b + sign
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds_a))
        doc = owner[found.link_a]
        n_links = np.bincount(doc, minlength=len(texts)).tolist()
        n_groups = np.bincount(owner[found.common_a], minlength=len(texts)).tolist()
        rows, said = [], order.tolist()
        for k in range(len(texts)):
            s, e = int(bounds_a[k] + bounds_b[k]), int(bounds_a[k + 1] + bounds_b[k + 1])
            digest = hashlib.sha256("".join(map(self.written.__getitem__, said[s:e])).encode()).hexdigest() if e > s else ""
            rows.append((len(each_a[k]), len(each_b[k]), n_groups[k], n_links[k], digest))
        keys = np.sort((self.spread[a[found.link_a]] * self.n_b + b[found.link_b] << _BITS) + doc)
        new = np.flatnonzero(np.r_[True, np.diff(keys) != 0]) if len(keys) else np.zeros(0, np.int64)
        return rows, keys[new], np.diff(np.r_[new, len(keys)])


_MADE: dict[tuple[str, str], Aligner] = {}


def _aligner(vocabulary_a: str, vocabulary_b: str) -> Aligner:
    key = vocabulary_a, vocabulary_b
    if key not in _MADE:
        _MADE[key] = Aligner(*key)
    return _MADE[key]


def _pressed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _opened(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


#: A row is a document (part -2, number: its place), a slab's pairs by document (part -1), or a question (part from 0 on).
_SHAPE = "slab long, part int, number int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, counts binary"
_REPLY = "slab long, part int, answers binary"


def measured(docs: DataFrame, ranges: int, key: str = "doc_id", text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Documents, packed pairs and questions of all slabs."""
    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(vocabulary_a, vocabulary_b)
        partition, counter = TaskContext.get().partitionId(), itertools.count()
        # batches from the scan may be much smaller than a slab
        held, size = [], 0
        for batch in itertools.chain(slabs(batches, limit=slab_bytes), [None]):
            if held and (batch is None or size + batch.nbytes > slab_bytes or sum(x.num_rows for x in held) + batch.num_rows > 1 << _BITS):
                yield from slab(aligner, (partition << 32) + next(counter), pa.Table.from_batches(held))
                held, size = [], 0
            if batch is not None:
                held.append(batch)
                size += batch.nbytes

    def slab(aligner: Aligner, number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, rows, keys, links, at = table["_key"].combine_chunks(), [], [], [], 0
        for part in slabs(table.to_batches(), limit=PART_BYTES):
            done, found, n = aligner.align([x or "" for x in part.column(1).to_pylist()])
            rows += done
            keys.append(found + at)
            links.append(n)
            at += part.num_rows
        keys, links = np.concatenate(keys), np.concatenate(links)
        order = np.argsort(keys, kind="stable")
        keys, links = keys[order], links[order]
        codes = keys >> _BITS
        new = np.flatnonzero(np.r_[True, np.diff(codes) != 0]) if len(codes) else np.zeros(0, np.int64)
        pairs, counts = codes[new], np.diff(np.r_[new, len(codes)])
        members = _pressed(keys & ((1 << _BITS) - 1)) if at > 1 << 16 else _pressed((keys & 0xFFFF).astype("<u2"))
        several = np.flatnonzero(links > 1)  # most pairs have one link in a document
        packed = len(members).to_bytes(8, "little") + members + _pressed(np.concatenate([several, links[several]]).astype("<i4"))
        parts = pairs // aligner.n_b * ranges // aligner.n_a
        cuts = np.flatnonzero(np.r_[True, np.diff(parts) != 0, True]) if len(parts) else np.zeros(1, np.int64)
        asked = [(int(parts[a]), pairs[a:b].tobytes(), counts[a:b].astype("<i4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        documents = [number, -2, 0, *[None] * 7]
        n = len(rows)
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [ids if not isinstance(ids, pa.ChunkedArray) else ids.chunk(0), pa.array([number] * n, pa.int64()), pa.array([documents[1]] * n, pa.int32()), pa.array(range(n), pa.int32())]
            + [pa.array(x, pa.int64()) for x in columns[:4]]
            + [pa.array(columns[4], pa.string()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            names=names,
        )
        asked = [(-1, packed, counts.astype("<i4").tobytes()), *asked]
        n = len(asked)
        part, data, more = zip(*asked, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, ids.type), pa.array([number] * n, pa.int64()), pa.array(part, pa.int32()), pa.nulls(n, pa.int32())]
            + [pa.nulls(n, pa.int64())] * 4
            + [pa.nulls(n, pa.string()), pa.array(data, pa.binary()), pa.array(more, pa.binary())],
            names=names,
        )

    names = ["_key", *(x.split()[0] for x in _SHAPE.split(", "))]
    return read.mapInArrow(measure, f"_key {kind}, {_SHAPE}")


def totals(asked: DataFrame, vocabulary_b_size: int) -> DataFrame:
    """Per question row, the corpus-wide counts of its pairs, negative unless they are the highest of their A id."""

    def add(group: pa.Table) -> pa.Table:
        sizes = [len(x) // 8 for x in group["pairs"].to_pylist()]
        pairs = np.frombuffer(b"".join(group["pairs"].to_pylist()), "<i8")
        counts = np.frombuffer(b"".join(group["counts"].to_pylist()), "<i4")
        found, inverse = np.unique(pairs, return_inverse=True)
        total = np.bincount(inverse, counts, len(found)).astype(np.int64)
        ids, which = np.unique(found // vocabulary_b_size, return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, which, total)
        signed = np.where(total == highest[which], total, -total)[inverse]
        ends = np.cumsum(sizes)
        made = [signed[e - s : e].tobytes() for s, e in zip(sizes, ends.tolist(), strict=True)]
        return pa.table({"slab": group["slab"], "part": group["part"], "answers": pa.array(made, pa.binary())})

    return asked.groupBy("part").applyInArrow(add, _REPLY)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Per row: ``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    if size > slab_bytes:
        ranges = max(ranges, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-size // slab_bytes)))
    ready = stored(measured(docs, ranges, key, text, vocabulary_a, vocabulary_b, slab_bytes), "aligned")
    replies = totals(ready.where("part >= 0").select("slab", "part", "pairs", "counts"), len(Pieces(vocabulary_b).entries))

    def finish(slab: pa.Table, answers: pa.Table) -> pa.Table:
        rows = slab.filter(pa.compute.equal(slab["part"], -2)).sort_by("number")
        n = rows.num_rows
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        packed = slab.filter(pa.compute.equal(slab["part"], -1))
        if packed.num_rows and answers.num_rows:
            signed = np.frombuffer(b"".join(answers.sort_by("part")["answers"].to_pylist()), "<i8")
            data, counts = packed["pairs"][0].as_py(), np.frombuffer(packed["counts"][0].as_py(), "<i4")
            split = 8 + int.from_bytes(data[:8], "little")
            members = _opened(data[8:split], "<i8" if n > 1 << 16 else "<u2")
            several = _opened(data[split:], "<i4").reshape(2, -1)
            links = np.ones(len(members), np.int64)
            links[several[0]] = several[1]
            count = np.repeat(signed, counts)
            total += np.bincount(members, links * np.abs(count), n).astype(np.int64)
            best += np.bincount(members, links * (count > 0), n).astype(np.int64)
        columns = {"n_best": pa.array(best), "count_sum": pa.array(total)}
        kept = {x: rows[x] for x in ("n_a", "n_b", "n_groups", "n_links")}
        return pa.table({key: rows["_key"], **kept, **columns, "groups_sha256": rows["groups_sha256"]})

    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return ready.where("part < 0").groupBy("slab").cogroup(replies.groupBy("slab")).applyInArrow(finish, shape)
