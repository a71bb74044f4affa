"""URL rules, license signatures and benchmark tiling against plain code."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import odd
from tapeline.llm import decontamination, licenses, url_filter
from tapeline.llm.queries import ORACLE, op10_decontamination, op9_license_scan
from tapeline.llm.tables import stored
from tapeline.llm.texts import Texts

FOLDER = "/root/testdata/sf0.01"


def test_urls_against_sql(spark):
    from __spark_entry__ import queries
    from oracle_check import cell, duck, rows_of

    assert cell
    df = queries()["op7_url_filter"](spark, FOLDER)
    relation = duck(FOLDER).execute(ORACLE["op7_url_filter"])
    names = [c[0] for c in relation.description]
    assert rows_of(df.columns, map(tuple, df.collect())) == rows_of(names, relation.fetchall())


URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "https://A.NET"), (5, "https://a.net/x"), (6, "http://example.net/en/1?q#f"),
    (7, "http://sub.EXAMPLE.com/de/?x=://y"), (8, "http://org/fr/"), (9, "http://x.org/fr"), (10, "http://spam.x.org#://"),
    (11, "http://net:80/"), (12, "://"), (13, "http://anet/"), (14, "http://adult-x.org/fr/a"), (14, "http://adult-x.org/fr/a"), (None, "http://ads.de"),
]


def test_odd_urls(spark):
    pages = spark.createDataFrame([(a, b, "clash", "clash") for a, b in URLS], "page_id long, url string, host string, listed string")
    for most in (1, 2, 10):
        judged = url_filter.judge(pages, url_filter.listed_hosts(pages), shard_listed=most)
        found = sorted({tuple(r) for r in judged.collect()}, key=str)
        assert judged.count() == len(URLS)
        assert found == sorted(
            {
                (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.net", "", None, "allow"),
                (5, "a.net", "/x", "net/", "block"), (6, "example.net", "/en/1", "example.net/en/", "allow"),
                (7, "sub.example.com", "/de/", "example.com/de/", "block"), (8, "org", "/fr/", "org/fr/", "allow"),
                (9, "x.org", "/fr", None, "allow"), (10, "spam.x.org", "", None, "block"), (11, "net:80", "/", None, "allow"),
                (12, "", "", None, "allow"), (13, "anet", "/", None, "allow"), (14, "adult-x.org", "/fr/a", "org/fr/", "allow"),
                (None, "ads.de", "", None, "block"),
            },
            key=str,
        )
    nothing = pages.limit(0)
    assert url_filter.judge(nothing, url_filter.listed_hosts(nothing)).collect() == []


def test_shards_answer_like_the_list(spark):
    """A list of 3,000 hosts in shards of 700; a third of the pages are of one host."""
    host = F.when(F.col("id") % 3 == 0, F.lit("hot.org")).otherwise(F.concat(F.lit("h"), F.col("id") % 9_000, F.lit(".org")))
    pages = stored(spark.range(30_000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://"), host, F.lit("/a")).alias("url")), "p")
    listed = spark.range(3_000).select(F.concat(F.lit("h"), F.col("id") * 3 + 1, F.lit(".org")).alias("host"))
    judged = url_filter.judge(pages, listed, shard_listed=700)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and plan.count("Scan parquet") == 5
    wrong = judged.where((F.col("verdict") == "block") != (F.regexp_extract("host", "^h([0-9]+)", 1).try_cast("long") % 3 == 1))
    assert judged.count() == 30_000 and wrong.count() == 0
    assert judged.where("host = 'hot.org' and verdict = 'allow'").count() == 10_000


def test_cascade_is_exact(spark):
    keys = stored(spark.range(6_000).select(F.concat(F.lit("h"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed")), "k")
    levels = url_filter.cascade(keys)
    assert len(levels) > 1
    assert keys.where(F.col("listed") != url_filter.is_listed(F.col("key"), levels)).count() == 0
    assert keys.where(url_filter.is_listed(F.col("key"), [])).count() == 0


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(rows):
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(r.text)
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels) and 0 <= r.score <= 1


LICENSED = [
    "Under the MIT license, under the mit-license UNDER THE MIT\nLICENSE under the mit licenses",
    "Apache License, Version 2.0 (the license); CC-BY-NC 4.0 cc by nc cc by ncx ccby nc",
    "This work is licensed under the GNU General Public License, version 3. All rights reserved.",
    "apache license version 2 apache license version 2",
    "SPDX-License-Identifier: MIT",
    "MİT under the MİT license K",
    "é under the mit license é",
]


def test_odd_texts(spark):
    rows = odd.texts() + [(50 + i, t, "aa") for i, t in enumerate(LICENSED)]
    docs = odd.documents(spark, rows)
    result = licenses.scan(docs)
    assert result.count() == len(rows)
    found = result.join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    check(found)
    by = {r.doc_id: r for r in found}
    assert by[52].labels == "gpl-3,proprietary" and by[54].labels == "mit" and by[50].n_base == 3
    assert by[51].labels == "apache-2,cc-by-nc" and by[4].score == 0
    assert licenses.scan(odd.nothing(spark)).collect() == []


def test_contained_detections_go(spark):
    docs = spark.createDataFrame([(1, "licensed under the gpl version 3 license"), (1, "licensed under the gpl version 3 license")], "doc_id long, text string")
    assert {tuple(r) for r in licenses.detections(docs).select("label", "first_word", "n_words").collect()} == {("gpl-3", 0, 7)}


def spelled(pattern):
    """All strings that a signature's expression matches, as far as its classes and options go; the trailing lookahead left out."""
    from re import _constants as c, _parser

    def of(items):
        texts = [""]
        for kind, x in items:
            if kind is c.LITERAL:
                more = [chr(x)]
            elif kind is c.IN:
                more = [chr(k) for t, v in x for k in ([v] if t is c.LITERAL else range(v[0], v[1] + 1))]
            elif kind is c.BRANCH:
                more = [t for branch in x[1] for t in of(branch)]
            elif kind is c.SUBPATTERN:
                more = of(x[3])
            elif kind is c.MAX_REPEAT:
                assert x[:2] == (0, 1)
                more = ["", *of(x[2])]
            else:
                assert kind is c.ASSERT
                more = [""]
            texts = [t + m for t in texts for m in more]
        return texts

    return of(_parser.parse(pattern))


def plain_labels(words, rules):
    """Labels by trying every signature, without gates."""
    found = []
    for priority, label, _, pattern in rules:
        for m in re.finditer(pattern, words):
            start = words.count(" ", 0, m.start())
            found.append((start, -m.group().count(" "), priority, label))
    kept, reach = set(), 0
    for start, n, _, label in sorted(found):
        if start - n > reach:
            kept.add(label)
            reach = start - n
    return kept


def test_gates_hold_for_every_alternative(spark):
    rules = licenses.signatures()
    for _, _, keyword, pattern in rules[: len(licenses.LICENSES) - 1] + rules[-1:]:
        assert all(f" {keyword} " in t + " " for t in spelled(pattern))
    frames = [f.replace("NAME", "%s") for f in licenses.FRAMES]
    shown = [(label, spelled(frame)[-1] % name) for label, _, names in licenses.LICENSES if label != "proprietary" for name in spelled(names) for frame in frames]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(shown)], "doc_id long, text string")
    found = {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.scan(docs).collect()}
    at = {label: i for i, label in enumerate(x[0] for x in licenses.LICENSES)}
    for i, (label, text) in enumerate(shown):
        assert label in found[i] or min(at[x] for x in found[i]) < at[label], text
        if i % 7 == 0:
            base = set(filter(None, plain_base(text)[4].split(",")))
            assert found[i] == base | plain_labels(f" {text} ", rules), text


NAMED = [
    ("Licensed under the SIL Open Font License", "ofl-1.1"),
    ("FreeBSD License", "bsd-2-clause"),
    ("released under the Zero-Clause BSD license", "0bsd"),
    ("the Common Development\nand Distribution License, licensed under the Common Development and Distribution\nLicense 1.0", "cddl-1"),
    ("Licensed under the European Union Public Licence v1.2", "eupl-1.2"),
    ("licensed under MPLv2", "mpl-2"),
    ("licensed under GPL2", "gpl-2"),
    ("available under the GPL3 license", "gpl-3"),
    ("License: LGPLv3", "lgpl-3"),
    ("SPDX-License-Identifier: AGPLv3", "agpl-3"),
    ("licensed under LGPLv2.1", "lgpl-2.1"),
]


def test_names_without_the_short_word(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NAMED)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(len(NAMED))] == [label for _, label in NAMED]


WRAPPED = [
    ("All Rights\nReserved", "proprietary"),
    ("All  rights -- reserved.", "proprietary"),
    ("subject\nto the Apache 2.0", "apache-2"),
    ("covered  by the MIT", "mit"),
    ("governed\r\nby the ISC", "isc"),
    ("released\nunder\nthe\nSIL Open Font\nLicense", "ofl-1.1"),
]


def test_gate_reads_over_line_breaks(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WRAPPED)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(len(WRAPPED))] == [label for _, label in WRAPPED]


def test_license_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = op9_license_scan(spark, FOLDER)
    assert found.count() == docs.count()
    check(found.join(docs, "doc_id").collect())
    assert len(licenses.signatures()) > 200


def plain_tiles(a, b, width):
    taken_a, taken_b, made = [0] * len(a), [0] * len(b), []
    while True:
        best = (0,)
        for j in range(len(b)):
            for i in range(len(a)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not taken_a[i + k] and not taken_b[j + k]:
                    k += 1
                if k >= width and k > best[0]:
                    best = (k, j, i)
        if best[0] < width or all(taken_a):
            return sorted(made)
        k, j, i = best
        made.append((i, j, k))
        taken_a[i : i + k], taken_b[j : j + k] = [1] * k, [1] * k


@pytest.mark.parametrize("seed", range(40))
def test_tiles(seed):
    generator = random.Random(seed)
    a = generator.choices("abc", k=generator.randint(3, 14))
    b = generator.choices("abc", k=generator.randint(3, 30)) + (a[5:] + a[:5] if seed % 2 else [])
    seeds = np.array([(i, j) for i in range(len(a) - 2) for j in range(len(b) - 2) if a[i : i + 3] == b[j : j + 3]]).reshape(-1, 2)
    assert sorted(decontamination.tiles(len(a), seeds[:, 0], seeds[:, 1], 3)) == plain_tiles(a, b, 3)


def plain_matches(docs, items):
    read = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    found = []
    for item, text in items:
        a = read(text)
        grams = {tuple(a[i : i + 5]) for i in range(len(a) - 4)}
        for doc, body in docs:
            b = read(body)
            near = {j + k for j in range(len(b) - 4) if tuple(b[j : j + 5]) in grams for k in range(5)}
            if near:
                made = plain_tiles(a, [w if j in near else None for j, w in enumerate(b)], 5)
                covered = sum(x[2] for x in made)
                if 2 * covered >= len(a):
                    found.append((doc, item, len(made), covered, len(a), covered / len(a)))
    return sorted(found, key=str)


def test_matches_of_odd_rows(spark):
    item = odd.prose(77, 40)
    words = item.split()
    rows = odd.texts() + [
        (60, "before " + item + " after", "aa"), (61, " ".join(words[20:] + ["cut"] + words[:20]), "aa"), (62, " ".join(words[:12]), "aa"),
        (63, "%%% ".join(words).upper(), "aa"), (64, item + " " + item, "bb"),
    ]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "too few words here"), (5, odd.prose(2, 90)), (6, "the " * 30)]
    docs, benchmark = odd.documents(spark, rows), spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, coverage string")
    for block in (decontamination.BLOCK_BYTES, 200):
        found = decontamination.matched(docs, benchmark, block_bytes=block)
        assert sorted(map(tuple, found.collect()), key=str) == plain_matches([r[:2] for r in rows], items)
    kept = decontamination.cleaned(docs, benchmark, block_bytes=200)
    gone = {r[0] for r in plain_matches([r[:2] for r in rows], items)}
    assert {60, 61, 63, 64} <= gone and kept.count() == sum(r[0] not in gone for r in rows) and kept.columns == docs.columns
    assert decontamination.matched(odd.nothing(spark), benchmark).collect() == []
    assert decontamination.matched(docs, benchmark.limit(0)).collect() == []


def test_decontamination_query(spark):
    docs, items = ([tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(key, "text").collect()] for name, key in (("documents", "doc_id"), ("benchmark", "item_id")))
    found = sorted(map(tuple, op10_decontamination(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert found == plain_matches(docs, items) and found


@pytest.mark.parametrize("seed", range(25))
def test_tiles_of_repeats(seed):
    """The tiling from the words themselves equals that from all seeds, on texts of very few different words."""
    draw = random.Random(seed)
    a, b = ([draw.choice("ab" if seed % 2 else "a" * 30 + "bc") for _ in range(draw.randint(0, 160))] for _ in range(2))
    a[:0] = b[5:60] if seed % 3 else []
    width = draw.randint(1, 6)
    hashed = [np.array([ord(x) for x in t], np.uint64) for t in (a, b)]
    assert sorted(decontamination.tiles_of_repeats(*hashed, width)) == sorted(plain_tiles(a, b, width))


def test_one_word_over_and_over(spark):
    """A document and an item of one word: 80 million places that agree, in bounded memory."""
    texts = pa.array(["again " * 20_000, "again " * 3_000 + "now", "not at all"])
    items = decontamination.Items.of([1, 2], ["again " * 4_000, "once more " * 10])
    tracemalloc.start()
    found = list(items.matches(Texts.of(texts), items.table()))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert [(d, i, sum(x[2] for x in made)) for d, i, made in found] == [(0, 0, 4_000), (1, 0, 3_000)]


def test_many_seeds_answer_as_few(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = Texts.of(pa.array([r.text for r in docs.collect()]), lower=True)
    made = decontamination.Items.of(*zip(*[(r.item_id, r.text) for r in items.collect()], strict=True))
    plain = [(d, i, t) for d, i, t in made.matches(texts, made.table())]
    for seeds in (1, 7, 100):
        monkeypatch.setattr(decontamination, "SEEDS", seeds)
        assert [(d, i, t) for d, i, t in made.matches(texts, made.table())] == plain
