"""Documents in blocks, and questions about keys of a block to the whole corpus.

Many questions about strings have this form: of the keys in my part of the corpus, which ones occur elsewhere? Rows per key
would be many times the text. So documents are dealt to blocks; a block gives the sorted distinct hashes it asks about, one
binary for each of a number of key ranges; whoever owns a range sees all blocks' keys in it and answers with one small
number per key, in the same order. A block's text and the answers to it meet by the block's number. Blocks are functions of
their documents alone, so a block that is worked on again, for the next question or after a lost executor, asks the same.

Keys that are frequent in the whole corpus weigh no more than one entry per block; no group of documents meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Text of a block, about, and text whose keys make up one key range. Blocks times ranges is the number of rows of a
#: question: for much larger corpora, larger blocks (and executors) keep these rows long.
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 64 << 20

ASK = "block int, part int, size int, asked binary, extra binary"
REPLY = "block int, question int, part int, answers binary"


def dealt(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Rows (block, id, body), the text as zstandard, by block; and the number of key ranges. Null ids and texts stay null."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # small tables are spread over the cluster too, but not thinner than a MB a block and a block's text a range
    n = max(1, -(-total // block_bytes), min(least, -(-total // (1 << 20))))
    ranges = max(1, -(-total // RANGE_BYTES), min(least, -(-total // BLOCK_BYTES)))
    read = docs.select(
        F.pmod(F.xxhash64(key, F.octet_length(text)), F.lit(n)).cast("int").alias("block"), F.col(key).cast("long").alias("id"), F.col(text).alias("text")
    )

    def packed(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            body = [None if x is None else press.compress(x.encode("utf-8", "surrogatepass")) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(body, pa.binary())], names=["block", "id", "body"])

    return read.mapInArrow(packed, "block int, id long, body binary"), ranges


def bodies(block: pa.Table) -> tuple[pa.Array, pa.Array]:
    """Ids and texts of a block, by id and text so that the order of arrival does not matter."""
    press = zstandard.ZstdDecompressor()
    texts = [None if x is None else press.decompress(x) for x in block["body"].to_pylist()]
    ids = block["id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] is None, texts[i] or b""))
    return pa.array([ids[i] for i in order], pa.int64()), pa.array([texts[i] for i in order], pa.binary())


def top(values: np.ndarray, kept: int) -> np.ndarray:
    """Values with only their ``kept`` highest bytes."""
    return values & np.uint64(2**64 - 2 ** (64 - 8 * kept))


def _written(keys: np.ndarray, kept: tuple[int, ...]) -> np.ndarray:
    """The highest bytes of each column of keys, one row of bytes per key."""
    columns = np.ascontiguousarray(keys).reshape(len(keys), len(kept), 1).view(np.uint8)
    return np.concatenate([columns[:, k, 8 - size :] for k, size in enumerate(kept)], 1)


def _read(data: bytes, kept: tuple[int, ...]) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(-1, sum(kept))
    columns = np.zeros((len(rows), len(kept), 8), np.uint8)
    at = 0
    for k, size in enumerate(kept):
        columns[:, k, 8 - size :] = rows[:, at : at + size]
        at += size
    keys = columns.view("<u8").reshape(len(rows), len(kept))
    return keys[:, 0] if len(kept) == 1 else keys


def _short(extra: np.ndarray) -> np.ndarray:
    """Ids in half the room where they fit."""
    return extra.astype("u4") if extra.dtype == np.int64 and len(extra) and extra.min() >= 0 and extra.max() < 2**32 else extra


def asked(block: int, n: int, keys: np.ndarray, extra: np.ndarray, kept: tuple[int, ...]) -> pa.Table:
    """One question row for each key range. ``keys``: sorted, uint64, or several of them by rows; ``extra``: uint8 or int64,
    as many. ``kept``: how many of the highest bytes of each key are sent; the others must be 0."""
    first = keys if keys.ndim == 1 else keys[:, 0]
    parts = _parts(first, n)
    written = _written(keys, kept)
    cuts = np.flatnonzero(np.r_[True, np.diff(parts) != 0, True]) if len(parts) else np.zeros(1, int)
    rows = [(int(parts[a]), b - a, written[a:b].tobytes(), _short(extra[a:b]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    part, size, data, more = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table(
        {"block": pa.array([block] * len(rows), pa.int32()), "part": pa.array(part, pa.int32()), "size": pa.array(size, pa.int32()), "asked": pa.array(data, pa.binary()), "extra": pa.array(more, pa.binary())}
    )


def _parts(first: np.ndarray, n: int) -> np.ndarray:
    """The range of each key; ranges are of equal width, so sorted keys have sorted ranges."""
    return ((first >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def answered(questions: DataFrame, number: int, answer: Callable[[np.ndarray, np.ndarray], np.ndarray], kept: tuple[int, ...], kind: str = "u1") -> DataFrame:
    """Replies to ``questions``: ``answer(keys, extra)`` gives one number of type ``kind`` for each entry of a range."""

    def reply(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        sizes = group["size"].to_numpy().astype(np.int64)
        keys = _read(b"".join(group["asked"].to_pylist()), kept)
        types = {1: "u1", 4: "u4", 8: "i8"}
        parts = [np.frombuffer(x, types[len(x) // size]) for x, size in zip(group["extra"].to_pylist(), sizes, strict=True)]
        wide = any(x.dtype != np.uint8 for x in parts)
        result = answer(keys, np.concatenate([x.astype("i8") for x in parts] if wide else parts)).astype(kind)
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "block": group["block"],
                "question": pa.array([number] * len(sizes), pa.int32()),
                "part": group["part"],
                "answers": pa.array([result[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)], pa.binary()),
            }
        )

    return questions.groupBy("part").applyInArrow(reply, REPLY)


def answers(replies: pa.Table, number: int, kind: str = "u1") -> np.ndarray:
    """The answers to a block's question ``number``, in the order of its keys."""
    mine = replies.filter(pa.compute.equal(replies["question"], number)).sort_by("part")
    return np.frombuffer(b"".join(mine["answers"].to_pylist()), kind)


def distinct(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of a block, in how many of its documents each is (255 at most), and each entry's place there.

    ``owner`` must be sorted.
    """
    found, inverse = np.unique(keys, return_inverse=True)
    if not len(keys):
        return found, np.zeros(0, np.uint8), inverse
    order = np.argsort(inverse, kind="stable")  # owners stay sorted within a key
    new = np.r_[True, (np.diff(inverse[order]) != 0) | (np.diff(owner[order]) != 0)]
    return found, np.minimum(np.bincount(inverse[order][new], minlength=len(found)), 255).astype(np.uint8), inverse


def total_counts(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """An answer: in how many documents of all blocks each key is, 255 at most."""
    found, inverse = np.unique(keys, return_inverse=True)
    return np.minimum(np.bincount(inverse, counts, len(found)), 255).astype(np.uint8)[inverse]
