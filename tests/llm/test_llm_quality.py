"""Quality rules against plain counting, and the positive-unlabelled model on held-out labels."""

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import odd
from tapeline.llm import quality_model, quality_rules
from tapeline.llm.queries import op2_quality_rules, op3_quality_classifier
from tapeline.llm.tables import rest, stored

FOLDER = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def compare(rows):
    for r in rows:
        n_words, *_, repeated = plain(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text)
        failed = n_words < 50 or 100 * repeated > 50 * n_words
        assert r.base_failed == failed and not (r.kept and failed)


def test_counts_of_odd_rows(spark):
    docs = odd.documents(spark)
    found = quality_rules.judge(stored(quality_rules.statistics(docs), "s"))
    assert found.count() == docs.count()
    compare(found.join(docs.select("doc_id", "text").distinct(), "doc_id").collect())
    assert quality_rules.judge(stored(quality_rules.statistics(odd.nothing(spark)), "s")).collect() == []


def test_query_against_plain_counting(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = op2_quality_rules(spark, FOLDER).join(docs, "doc_id").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id", "left").collect()
    compare(found)
    judged = [r for r in found if not r.base_failed and r.quality is not None]
    assert len(judged) > 200


def test_verdicts_agree_with_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    found = op2_quality_rules(spark, FOLDER).join(labels, "doc_id").where("not base_failed")
    assert found.agg(F.avg((F.col("kept") == (F.col("label") == 1)).cast("int"))).first()[0] > 0.95


def test_posterior_is_between_the_extremes():
    good, poor, mixed = (sum(v * 3**k for k, v in enumerate(x)) for x in ([2] * 8, [0] * 8, [0, 0, 2, 2, 2, 2, 1, 1]))
    found = quality_rules.weigh({good: 900, poor: 60, mixed: 20})
    assert found[good] > 0.99 and found[poor] < 0.01 and 0 <= found[mixed] <= 1
    assert quality_rules.weigh({}) == {}


def test_one_pattern_alone_is_judged():
    assert quality_rules.weigh({3**8 - 1: 5})[3**8 - 1] > 0.5


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 1000), st.floats(0.5, 0.9))
def test_prior_is_estimated(seed, share):
    random = np.random.default_rng(seed)
    positive = random.normal(2, 1, 3000)
    n = int(3000 * share)
    unlabelled = np.concatenate([random.normal(2, 1, n), random.normal(-2, 1, 3000 - n)])
    assert abs(quality_model.estimated_prior(positive, unlabelled) - share) < 0.08


def test_model_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = op3_quality_classifier(spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    good, poor = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in poor]) > 0.97
    assert all((r.predicted == 1) == (r.score >= 0.5) and 0 <= r.score <= 1 for r in held)
    assert {r.held_out for r in found.where(rest("doc_id", 3) == 1).collect()} == {True}


def test_model_of_odd_rows(spark):
    docs = odd.documents(spark)
    model = quality_model.learn(docs, docs.where("doc_id in (1, 2, 3, 9, 11)"))
    rows = quality_model.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    untrained = quality_model.learn(docs, docs.limit(0))
    assert {r.score for r in quality_model.score(docs, untrained).collect()} == {0.5}
    assert quality_model.score(odd.nothing(spark), model).collect() == []
