"""Cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import odd
from tapeline.llm import alignment
from tapeline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), alignment.ByteLevel().entries


def spans(entries):
    at, made = 0, []
    for i, data in entries:
        made.append((i, at, at + len(data)))
        at += len(data)
    return made


def plain_tokens(tokenizers, text):
    a, b, bytes_a = tokenizers
    if not text:
        return [], []
    left = [(i, bytes_a[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    data = (" " + text).encode()
    if b"".join(x for _, x in left) != data or b"".join(x for _, x in right) != data:
        return [], []
    return spans(left), spans(right)


def plain(tokenizers, rows):
    made, counts = [], Counter()
    for _, text in rows:
        left, right = plain_tokens(tokenizers, text)
        links, j = [], 0
        for i, s, e in left:
            while j < len(right) and right[j][2] <= s:
                j += 1
            k = j
            while k < len(right) and right[k][1] < e:
                links.append((i, right[k][0]))
                k += 1
        both = {e for *_, e in left} & {e for *_, e in right}
        groups, begin = [], [0, 0]
        for _ in both:
            ids = []
            for k, side in enumerate((left, right)):
                end = next(x for x in range(begin[k], len(side)) if side[x][2] in both) + 1
                ids.append(",".join(str(i) for i, *_ in side[begin[k] : end]))
                begin[k] = end
            groups.append("|".join(ids))
        counts.update(set(links))
        made.append((left, right, groups, links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    result = []
    for (key, _), (left, right, groups, links) in zip(rows, made, strict=True):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if left else ""
        best = sum(counts[x] == highest[x[0]] for x in links)
        result.append((key, len(left), len(right), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return sorted(result, key=str)


def answers(spark, rows, **options):
    docs = spark.createDataFrame([(a, b, "clash", 1, 2) for a, b in rows], "doc_id long, text string, slab string, part int, n_a int")
    return sorted(map(tuple, alignment.align(docs, **options).collect()), key=str)


def test_odd_rows(spark, tokenizers):
    strange = ["▁x", "a <s> </s> <0x41> <|endoftext|> b", "\x00 a\x01", "  two\n\n\tthree  ", "é" * 9, "漢字 かな 🙂🙂", "'s 'S it's", "  　x\u0085y", "ﬁ ＡＢ", "▁"]
    rows = [(x[0], x[1]) for x in odd.texts()] + [(100 + k, x) for k, x in enumerate(strange)] + [(None, None)]
    assert answers(spark, rows) == plain(tokenizers, rows)
    assert answers(spark, rows, slab_bytes=2_000) == plain(tokenizers, rows)
    assert answers(spark, []) == []


def test_random_texts(spark, tokenizers):
    draw = random.Random(4)
    signs = ["a", "the ", "ing", " ", "  ", "\n", "1", "23", "é", "ß", "漢", "🙂", "'s", "-", "▁", "\t", "Zu", "<s>"]
    rows = [(k % 50, "".join(draw.choices(signs, k=draw.choice((1, 5, 60, 400))))) for k in range(80)]
    assert answers(spark, rows, slab_bytes=5_000) == plain(tokenizers, rows)


def test_libraries_agree(tokenizers):
    """The byte-level vocabulary gives the same ids in the library that runs it here and in the one its file is made for."""
    made = alignment.ByteLevel()
    for low in range(0x20, 0x30000, 64):
        text = " ".join(f"a{chr(c)}b {chr(c)}{chr(c)}" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000)
        assert made.encode([text])[0].tolist() == tokenizers[0].encode(" " + text, add_special_tokens=False).ids


def test_gallop():
    draw = np.random.default_rng(3)
    for _ in range(200):
        ends = np.unique(draw.integers(0, 300, draw.integers(1, 80)))
        wanted = draw.integers(0, ends[-1] + 1, 50)
        assert (alignment.gallop(ends, wanted, draw.integers(-3, 90, 50)) == np.searchsorted(ends, wanted)).all()


def test_registered_query(spark, tokenizers):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op13_tokenizer_alignment"](spark, folder)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect()), key=str) == plain(tokenizers, [tuple(x) for x in docs])
