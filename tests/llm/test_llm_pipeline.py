"""The pipeline: stages against their operators' plain rules, and rows that are odd."""

import corpus_pipeline
import odd
from tapeline.llm.tables import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages_over_odd_rows(spark):
    docs = spark.createDataFrame([(*r, "s", 0) for r in odd.texts()], odd.BASE)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stored(stage(spark, docs, FOLDER), name)
        assert new.columns == docs.columns
        assert {r.doc_id for r in new.collect()} <= {r.doc_id for r in docs.collect()}
        if name == "ngram_jaccard_join":
            kept = [r.doc_id for r in new.collect()]
            assert kept.count(9) == 1 and 1 in kept and 2 not in kept and 3 not in kept and None in kept
        docs = new
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_stages_over_nothing(spark):
    docs = odd.nothing(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 4096
    assert len({r.doc_id for r in rows}) < spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_different_texts_of_one_id_stay(spark):
    """A repeated id takes no text along: only copies go, the same ones however the rows are dealt."""
    own, other = odd.prose(21, 80), odd.prose(22, 80)
    rows = [(1, own, "aa", "s", 5), (1, other, "aa", "s", 5), (1, own, "aa", "r", 5), (1, own, "aa", "s", 5), (2, own + " x", "aa", "s", 5)]
    rows += [(3, odd.prose(23, 80), "aa", "s", 5), (None, own, "aa", "s", 5), (4, other, "aa", "t", 6), (4, odd.prose(24, 80), "bb", "t", 6)]
    right = [(1, own, "aa", "r", 5), (1, other, "aa", "s", 5), rows[5], rows[6], rows[8]]
    docs = spark.createDataFrame(rows, odd.BASE)
    for parts in (1, 3, 7):
        kept = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(parts), FOLDER)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(right, key=str)


def test_near_duplicate_stage_against_all_pairs(spark):
    """Which documents stay of the smallest table, by comparing all sets of shingles."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "").encode().split()
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    gone, ids = set(), sorted(sets)
    up = {i: i for i in ids}
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((up[a], up[b]))
                up = {i: low if v == high else v for i, v in up.items()}
    gone = {i for i, v in up.items() if v != i}
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect()}
    assert gone and kept == set(ids) - gone
