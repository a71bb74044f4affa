"""Packing against a plain best-fit, tokens against the tokenizer itself."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import odd
from tapeline.llm import packing
from tapeline.llm.queries import op8_best_fit_packing
from tapeline.llm.tables import stored
from tapeline.llm.texts import Texts


def plain_bins(counts, capacity):
    fills = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [(capacity - f, i) for i, f in enumerate(fills) if capacity - f >= length]
            if fits:
                fills[min(fits)[1]] += length
            else:
                fills.append(length)
    return sorted(fills)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    generator = random.Random(seed)
    capacity = generator.choice([7, 16, 50, 4096])
    counts = {generator.randint(1, capacity): generator.randint(1, 12) for _ in range(generator.randint(0, 10))}
    made, places = packing.plan(counts, capacity), {}
    for length, n in counts.items():
        rows = made[made[:, 0] == length]
        for rank in range(n):
            row = rows[np.searchsorted(rows[:, 1], rank, side="right") - 1]
            beyond = rank - row[1]
            places.setdefault(row[2] + beyond // row[3], []).append((row[4] + beyond % row[3] * length, length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sum(x[1] for x in held) for held in places.values()) == plain_bins(counts, capacity)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_ids_are_the_tokenizers():
    texts = [r[1] for r in odd.texts()] + [
        "don't we'll 're's 12345 ... é z", "İstanbul ΣΑΣ ﬁ K", "<|endoftext|>x <|STARTOFTEXT|>", "a̸b ≮ é É", "wörter,und—dash… x'S's"
    ]
    plain = tokenizer()
    for group in (texts, [x for x in texts if "<|" not in (x or "")]):
        ids, bounds = packing.Encoder().ids(Texts.of(pa.array(group, pa.string())))
        for text, a, b in zip(group, bounds, bounds[1:]):
            assert ids[a:b].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def whole(rows, capacity):
    """Checks that places are gapless and that pieces of a document follow each other."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for held in by_sequence.values():
        held.sort()
        assert [o for o, _ in held] == np.concatenate([[0], np.cumsum([x for _, x in held])[:-1]]).tolist()
        assert sum(x for _, x in held) <= capacity
    return by_sequence, by_doc


def test_odd_rows_and_small_capacity(spark):
    docs = odd.documents(spark)
    held = stored(packing.pieces(docs, capacity=64, with_ids=True), "p")
    rows = packing.pack(held, capacity=64).collect()
    by_sequence, by_doc = whole(rows, 64)
    assert [r.length for r in rows if r.doc_id in (4, 5)] == [1, 1]
    plain = tokenizer()
    counts = {}
    for key, text, *_ in odd.texts():
        n = len(plain.encode(text or "", add_special_tokens=False).ids) + 1
        for length in [64] * (n // 64) + [n % 64] * (n % 64 > 0):
            counts[length] = counts.get(length, 0) + 1
    assert sorted(sum(x for _, x in h) for h in by_sequence.values()) == plain_bins(counts, 64)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert packing.pack(stored(packing.pieces(odd.nothing(spark)), "p")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = op8_best_fit_packing(spark, folder).collect()
    by_sequence, by_doc = whole(rows, packing.CAPACITY)
    plain = tokenizer()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 1]
        cuts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        assert sorted(by_doc[r.doc_id]) == [(k, 4096 * k, len(x)) for k, x in enumerate(cuts)]
    lengths = [r.length for r in rows]
    assert len(by_sequence) == len(plain_bins({x: lengths.count(x) for x in set(lengths)}, 4096))
