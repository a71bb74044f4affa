"""Rows that operators must bear: nulls, empty and long texts, repeats, ties, and columns with names of their own."""

import random

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, block string, length string, words string, hashed string, rejected string"
BASE = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"aa": ["ka", "lo", "mi", "ten", "sur"], "bb": ["ouw", "pf", "zick", "ä", "gret"]}


def prose(seed, n, lang="aa"):
    generator = random.Random(f"{seed}{lang}")
    words = ["".join(generator.choices(SYLLABLES[lang], k=generator.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def texts():
    long = prose(1, 30_000)
    return [
        (1, prose(2, 90), "aa"),
        (2, prose(2, 90), "aa"),
        (3, prose(2, 89) + " other", "aa"),
        (4, None, "aa"),
        (5, "", "bb"),
        (6, " \t\n ", None),
        (7, "x", "bb"),
        (8, "12 34 ###", "bb"),
        (9, long, "aa"),
        (9, long, "aa"),
        (None, prose(3, 60, "bb"), "bb"),
        (11, prose(4, 120, "bb"), "bb"),
        (12, "a" * 5_000, "bb"),
        (13, "line one two\n" * 40, "aa"),
        (14, "𝔘nicode 🙂 ́ é   z", "aa"),
        (15, prose(2, 60) + "\n" + prose(4, 60, "bb"), None),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(*r, "s", len(r[1] or ""), *["clash"] * 7) for r in rows], SHAPE)


def nothing(spark):
    return spark.createDataFrame([], BASE)
