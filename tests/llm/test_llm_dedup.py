"""Substring dedup and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

import odd
from tapeline.llm import near_duplicates, substring_dedup
from tapeline.llm.blocks import distinct, total_counts
from tapeline.llm.components import components


def plain_dedup(rows, width):
    """(n_bytes, n_removed, n_spans, sha256) of each row of (id, text), in their order."""
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    first, data = {}, [(t or "").encode() for _, t in rows]
    for i, d in enumerate(data):
        for p in range(len(d) - width + 1):
            if rows[i][0] is not None:
                first[d[p : p + width]] = min(first.get(d[p : p + width], rows[i][0]), rows[i][0])
    found = []
    for i, d in enumerate(data):
        gone = bytearray(len(d))
        for p in range(len(d) - width + 1):
            least = first.get(d[p : p + width])
            if least is not None and (key(i)[0] or least < rows[i][0]):
                gone[p : p + width] = b"\1" * width
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((rows[i][0], len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def dedup(spark, rows, width=50, **options):
    docs = spark.createDataFrame([(a, b, "clash", "clash") for a, b in rows], "doc_id long, text string, block string, n_bytes string")
    return sorted(map(tuple, substring_dedup.dedup(docs, width=width, **options).collect()), key=str)


def test_substring_dedup_of_odd_rows(spark):
    rows = [r[:2] for r in odd.texts()]
    rows += [(20, "a" * 49), (21, "a" * 50), (22, odd.prose(1, 30_000)[5_000:9_000]), (23, "é" * 60)]
    assert dedup(spark, rows, block_bytes=20_000) == plain_dedup(rows, 50)


@pytest.mark.parametrize("seed", range(2))
def test_substring_dedup_of_random_pieces(spark, seed):
    generator = random.Random(seed)
    parts = ["".join(generator.choices("ab ", k=generator.randint(3, 40))) for _ in range(12)]
    rows = [(i, "".join(generator.choices(parts, k=generator.randint(0, 9)))) for i in range(40)]
    for width in (9, 16, 50):
        assert dedup(spark, rows, width, block_bytes=200) == plain_dedup(rows, width)


def test_substring_query_against_plain_code(spark):
    from tapeline.llm.queries import op4_substring_dedup

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    found = op4_substring_dedup(spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, found), key=str) == plain_dedup(rows, 50)


def test_kept_bytes_and_empty_table(spark):
    docs = odd.documents(spark)
    kept = substring_dedup.dedup(docs, with_text=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in kept)
    assert substring_dedup.dedup(odd.nothing(spark)).collect() == []


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_join(rows, share=80):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    low = [key for key, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                linked = a and b and None not in (low[i], low[j]) and 100 * len(a & b) >= share * len(a | b)
                if linked or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                    if low[i] != low[j]:
                        low[i] = low[j] = min(low[i], low[j])
                        changed = True
    return sorted(((key, len(s), c) for (key, _), s, c in zip(rows, sets, low)), key=str)


def join(spark, rows, **options):
    docs = spark.createDataFrame([(a, b, "x", "y") for a, b in rows], "doc_id long, text string, n_shingles string, class_id string")
    return sorted(map(tuple, near_duplicates.near_duplicates(docs, **options).collect()), key=str)


def test_near_duplicates_of_odd_rows(spark):
    rows = [r[:2] for r in odd.texts()] + [(30, "X"), (31, "a b  c"), (32, "A B C"), (33, "b a c")]
    assert join(spark, rows) == plain_join(rows)
    assert near_duplicates.near_duplicates(odd.nothing(spark)).collect() == []


@pytest.mark.parametrize("task_shingles", [150, 1_000_000])
def test_near_duplicates_of_many_copies(spark, task_shingles):
    generator = random.Random(5)
    line = [f"c{k}" for k in range(30)]
    rows, bases = [], [[f"w{b}_{generator.randint(0, 60)}" for _ in range(100)] for b in range(4)]
    for i in range(90):
        text = list(generator.choice(bases))
        for _ in range(generator.choice([0, 1, 2, 4, 8])):
            text[generator.randrange(len(text))] = f"e{generator.randint(0, 9)}"
        if i % 3 == 0:
            text = line + text
        rows.append((i * 7 % 97, " ".join(text[: generator.choice([100, 95, 130])])))
    assert join(spark, rows, task_shingles=task_shingles, block_bytes=4_000) == plain_join(rows)


def test_links_at_the_very_limit(spark):
    rows = [(n, " ".join(f"{n}w{k}" for k in range(4)) + " " + " ".join(f"s{k}" for k in range(36 + n))) for n in range(1, 4)]
    rows += [(n + 10, " ".join(f"s{k}" for k in range(36 + n))) for n in range(1, 4)]
    for share in (70, 80, 90):
        assert join(spark, rows, share=share) == plain_join(rows, share)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, k) for k in range(101, 120)] + [(7, 7), (300, 200), (200, 250), (61, 60)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = {i: 10 for i in range(10, 62)} | {k: 100 for k in range(100, 120)} | {7: 7, 200: 200, 250: 200, 300: 200}
    assert found == expected


def test_answers_count_documents_not_places():
    keys, owner = np.array([5, 5, 9, 5, 9], np.uint64), np.array([0, 0, 0, 1, 3])
    found, counts, place = distinct(keys, owner)
    assert found.tolist() == [5, 9] and counts.tolist() == [2, 2] and place.tolist() == [0, 0, 1, 0, 1]
    assert total_counts(np.array([5, 9, 5], np.uint64), np.array([2, 200, 100], np.uint8)).tolist() == [102, 200, 102]
