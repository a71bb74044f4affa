"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import odd
from tapeline.llm import periodic_runs as p
from tapeline.llm.queries import QUERIES


def plain_words(key, text, alter=True):
    words = (text or "").encode().split()
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if not alter or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]


def plain_runs(words):
    """Every period's maximal stretches; of equal ones the smallest period."""
    found, n = {}, len(words)
    numbers = np.unique(np.array(words, object), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 4 + 1):
        edges = np.flatnonzero(np.diff(np.r_[False, numbers[q:] == numbers[:-q], False]))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start + q >= max(6, 4 * q):
                found.setdefault((start, end - start + q), q)
    return sorted((s, q, length) for (s, length), q in found.items())


def plain(key, text, alter=True):
    words = plain_words(key, text, alter)
    found = plain_runs(words)
    stay = [not any(s + q <= i < s + length for s, q, length in found) for i in range(len(words))]
    best = min(((-length, s, q) for s, q, length in found), default=None)
    said = "".join(f"{s},{length},{q}\n" for s, q, length in found)
    kept = b" ".join(w for w, x in zip(words, stay) if x)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (key, len(found), *top, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def repeating(seed):
    """Texts of few different words, with stretches that repeat at many periods, one inside the other."""
    draw = random.Random(seed)
    words = []
    while len(words) < draw.choice((5, 40, 300, 900)):
        unit = [draw.choice("abcd") for _ in range(draw.choice((1, 1, 2, 3, 5, 8, 21, 70)))]
        words += unit * draw.choice((1, 3, 4, 5, 9)) + unit[: draw.randint(0, len(unit))]
    return draw.choice((" ", "\n", "\x0b ")).join(words)


def answers(spark, rows, **options):
    docs = spark.createDataFrame([(a, b, "clash", 7, "clash") for a, b in rows], "doc_id long, text string, mark string, period long, runs string")
    return sorted(map(tuple, p.collapsed(docs, texts=False, **options).collect()), key=str)


def test_runs(spark):
    rows = [(k, repeating(k)) for k in range(120)]
    assert answers(spark, rows) == sorted((plain(*x) for x in rows), key=str)


def test_multiples_of_a_period_are_not_sent(spark):
    """Of a text that its task sees whole, as many fragments leave the task as there are runs."""
    rows = [(k, repeating(k)) for k in range(60)] + [(60, "again " * 900), (61, "one two " * 300), (62, "again " * 900), (None, "b " * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sent = {r.doc_id: sorted((x.start, x.period, x.end - x.start) for x in r.found) for r in p.searched(docs).collect()}
    assert sent == {k: plain_runs(plain_words(k, t)) for k, t in rows} and len(sent) == len(rows)


def test_tiles_of_long_texts(spark):
    rows = [(k, repeating(1000 + k)) for k in range(40)] + [(77, "again " * 3000), (78, " ".join(map(str, range(500))) * 5)]
    for row_words in (1, 16, 1 << 16):
        assert answers(spark, rows, long_bytes=0, row_words=row_words) == sorted((plain(*x) for x in rows), key=str)


@pytest.mark.parametrize("long_bytes", [0, 1 << 20])
def test_odd_rows(spark, long_bytes):
    rows = [(x[0], x[1]) for x in odd.texts()] + [(1, "one one one one one one"), (None, None), (None, "b " * 9), (20, "x " * 5), (21, "X x " * 3)]
    assert answers(spark, rows, long_bytes=long_bytes) == sorted((plain(*x) for x in rows), key=str)
    assert answers(spark, rows, planting=None) == sorted((plain(*x, alter=False) for x in rows), key=str)


def test_empty_table_and_clashing_columns(spark):
    assert answers(spark, []) == []
    assert p.collapsed(odd.documents(spark)).count() == len(odd.texts())


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([(3, "see see see see see see it go  on go on go on go on now")], "doc_id long, text string")
    found = p.collapsed(docs, planting=None).first()
    assert found["collapsed"] == "see it go on now"
    assert [tuple(x) for x in found["runs"]] == [(0, 1, 6), (7, 2, 8)]


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op12_periodic_runs"](spark, folder)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect())) == sorted(plain(*x) for x in docs)
