"""Repeated strings removed: every byte that lies in a string of WIDTH bytes which also starts in a document of smaller id.

Prefix-free parsing cuts texts where a rolling hash says so, so that equal strings are cut alike wherever they stand. Here
the trigger of a string of WIDTH bytes is the smallest hash of CORE bytes in it, and a phrase is a run of start positions
with the same trigger, together with all bytes of the strings that start there. Any two equal strings have the same trigger
and lie in phrases with the same trigger. The distinct phrases are the dictionary, the phrases of the texts the parse.

The suffixes of the dictionary are needed only as far as WIDTH bytes, and only those of phrases whose trigger also occurs
in another document. Three questions over all blocks find the answer (see ``blocks``):

1. which triggers occur in more than one document; phrases of other triggers are done;
2. which phrases occur in a smaller document: all their bytes go, in the parse of every later document. First occurrences
   of phrases whose trigger has other phrases too remain to be looked into;
3. which suffixes of those, cut to WIDTH bytes, start in a smaller document.

Equality is that of hashes: 64 bits of the trigger with 64 of the phrase, and 96 bits of a suffix. The first question is a
sieve, for which SIEVE bytes do: triggers that look alike only let more phrases into the second.

Defined cases: a null text is empty; texts shorter than WIDTH bytes stay as they are; a null id removes nothing from others
and is later than all. Rows of the same id are different texts of one document: neither removes bytes from the other. An
empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm import blocks as b
from tapeline.llm.texts import Texts, hashes, mixed

WIDTH = 50
CORE = 24
SIEVE = 6
#: Bytes of the keys of each question.
KEPT = {1: (SIEVE,), 2: (8, 8), 3: (8, 4)}
LAST = np.iinfo(np.int64).max

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, 0, (1,)).copy()


class Phrases:
    """Phrases of a block: start positions from ``first`` to ``last``, their document ``owner`` and ``trigger``."""

    def __init__(self, texts: Texts, width: int = WIDTH):
        data, core = texts.data, min(CORE, width // 2 // 8 * 8 or width)
        self.texts, self.width, self.eights = texts, width, _eights(data)
        n = len(data) - width + 1
        if n <= 0:
            self.first = self.last = self.owner = np.zeros(0, np.int64)
            self.trigger = np.zeros(0, np.uint64)
            return
        held = np.zeros(len(data) - core + 1, np.uint64)
        if core % 8 == 0:
            part = np.empty_like(held)
            for k in range(core // 8):
                held += np.multiply(self.eights[8 * k : 8 * k + len(held)], _ODD[k], out=part)
            del part
        else:
            for k in range(core):
                held = held * _ODD[0] + data[k : k + len(held)]
        held ^= held >> np.uint64(31)
        held *= _ODD[3]
        held ^= held >> np.uint64(32)
        window, size = width - core + 1, 1  # smallest of ``window`` hashes by doubling
        while 2 * size <= window:
            held = np.minimum(held[: len(held) - size], held[size:])
            size *= 2
        if size < window:
            held = np.minimum(held[: len(held) - (window - size)], held[window - size :])
        valid = np.zeros(n + 1, bool)
        starts, ends = texts.offsets[:-1], texts.offsets[1:] - width + 1
        long = ends > starts
        for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            valid[s:e] = True
        new = valid[:n].copy()
        new[1:] &= ~valid[: n - 1] | (held[1:] != held[:-1])
        new[starts[long]] = True
        self.first = np.flatnonzero(new)
        self.owner = np.searchsorted(texts.offsets, self.first, side="right") - 1
        limit = (texts.offsets[1:] - width)[self.owner]
        self.last = np.minimum(np.r_[self.first[1:] - 1, n - 1], limit)
        self.trigger = mixed(held[self.first])  # smallest hashes are low; key ranges need them spread evenly

    def hashes(self, chosen: np.ndarray) -> np.ndarray:
        return hashes(self.texts.data, self.first[chosen], self.last[chosen] + self.width)

    def suffixes(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start positions in the phrases ``chosen``, and two hashes of the WIDTH bytes from each on."""
        sizes = self.last[chosen] - self.first[chosen] + 1
        at = np.repeat(self.first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        for k in range(0, self.width, 8):
            part = self.eights[at + k]
            if self.width - k < 8:
                part &= np.uint64((1 << (8 * (self.width - k))) - 1)
            one = mixed(one ^ (part * _ODD[0])) + _ODD[1]
            two = mixed(two + (part ^ _ODD[2])) * _ODD[4]
        return at, np.stack([one, b.top(two, KEPT[3][1])], 1)


def _smallest(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows of ``keys``, the smallest id of each, and each entry's place among them."""
    order = np.lexsort((ids, *keys.T[::-1]))
    new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(1)] if len(keys) else np.zeros(0, bool)
    inverse = np.zeros(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return keys[order][new], ids[order][new], inverse


#: Answers to the second and third question.
REPEATED, OPEN = 1, 2


def _phrase_answers(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found, least, inverse = _smallest(keys, ids)
    if not len(found):
        return np.zeros(0, np.uint8)
    group = np.cumsum(np.r_[True, found[1:, 0] != found[:-1, 0]]) - 1  # of the same trigger
    low = np.full(group[-1] + 1, LAST)
    high = np.full(group[-1] + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, group, least)
    np.maximum.at(high, group, least)
    open_ = (low < high)[group]
    return np.where(least[inverse] < ids, REPEATED, 0) | np.where(open_[inverse], OPEN, 0)


def _suffix_answers(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    _, least, inverse = _smallest(keys, ids)
    return np.where(least[inverse] < ids, REPEATED, 0) if len(keys) else np.zeros(0, np.uint8)


class _Block:
    """A block with what is known after each question."""

    def __init__(self, table: pa.Table, width: int):
        self.number = table["block"][0].as_py() if len(table) else -1
        ids, bodies = b.bodies(table)
        self.keys = ids
        self.ids = ids.fill_null(LAST).to_numpy()
        self.phrases = Phrases(Texts.of(bodies), width)
        self.doc = self.ids[self.phrases.owner]

    def triggers(self) -> tuple[np.ndarray, np.ndarray]:
        """Question 1. Documents are counted, so rows of the same id are one."""
        same = np.cumsum(np.r_[True, np.diff(self.ids) != 0]) - 1 if len(self.ids) else self.ids
        found, counts, self.trigger_place = b.distinct(b.top(self.phrases.trigger, SIEVE), same[self.phrases.owner])
        return found, counts

    def dictionary(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Question 2: the distinct phrases of shared triggers with their smallest ids."""
        self.triggers()
        self.shared = np.flatnonzero((b.answers(replies, 1) > 1)[self.trigger_place])
        keys = np.stack([self.phrases.trigger[self.shared], self.phrases.hashes(self.shared)], 1)
        found, self.least, self.phrase_place = _smallest(keys, self.doc[self.shared])
        return found, self.least

    def suffixes(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Question 3: the suffixes of first occurrences of phrases whose trigger has others."""
        self.dictionary(replies)
        said = b.answers(replies, 2)[self.phrase_place]
        doc = self.doc[self.shared]
        repeated = ((said & REPEATED) > 0) | (doc > self.least[self.phrase_place])
        self.whole = self.shared[repeated]
        self.open_at, keys = self.phrases.suffixes(self.shared[~repeated & ((said & OPEN) > 0)])
        self.open_doc = self.ids[np.searchsorted(self.phrases.texts.offsets, self.open_at, side="right") - 1]
        found, self.open_least, self.open_place = _smallest(keys, self.open_doc)
        return found, self.open_least

    def removed(self, replies: pa.Table) -> np.ndarray:
        """Which bytes go."""
        self.suffixes(replies)
        said = b.answers(replies, 3)[self.open_place] > 0
        at = self.open_at[said | (self.open_doc > self.open_least[self.open_place])]
        size = len(self.phrases.texts.data)
        change = np.zeros(size + 1, np.int32)
        np.add.at(change, self.phrases.first[self.whole], 1)
        np.add.at(change, self.phrases.last[self.whole] + self.phrases.width, -1)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.phrases.width, -1)
        return np.cumsum(change)[:size] > 0


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, with_text: bool = False, block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """Per row: ``key``, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; with ``with_text`` also kept, the
    bytes that stay."""
    dealt, n = b.dealt(docs, key, text, block_bytes)
    by_block = dealt.groupBy("block")

    def first(table: pa.Table) -> pa.Table:
        block = _Block(table, width)
        return b.asked(block.number, n, *block.triggers(), KEPT[1])

    def later(method: str, number: int):
        def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
            block = _Block(table, width)
            return b.asked(block.number, n, *getattr(block, method)(replies), KEPT[number])

        return ask

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(table, width)
        gone = block.removed(replies)
        texts = block.phrases.texts
        starts = texts.offsets[texts.offsets < len(gone)]
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        edge[starts] = gone[starts]
        sums = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(edge)])
        kept = [texts.data[s:e][~gone[s:e]].tobytes() for s, e in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)]
        columns = {
            key: block.keys,
            "n_bytes": pa.array(texts.sizes, pa.int64()),
            "n_removed": pa.array(np.diff(sums[0][texts.offsets]), pa.int64()),
            "n_spans": pa.array(np.diff(sums[1][texts.offsets]), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    replies = b.answered(by_block.applyInArrow(first, b.ASK), 1, b.total_counts, KEPT[1])
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(later("dictionary", 2), b.ASK)
    replies = replies.unionAll(b.answered(asked, 2, _phrase_answers, KEPT[2]))
    asked = by_block.cogroup(replies.groupBy("block")).applyInArrow(later("suffixes", 3), b.ASK)
    replies = replies.unionAll(b.answered(asked, 3, _suffix_answers, KEPT[3]))
    done = by_block.cogroup(replies.groupBy("block")).applyInArrow(finish, f"`{key}` long, {RESULT}" + ", kept binary" * with_text)
    return done.withColumn(key, F.col(key).cast(docs.schema[key].dataType))
