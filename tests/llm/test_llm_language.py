"""Language by compression: held-out accuracy and odd rows."""

import pytest
from pyspark.sql import functions as F

import odd
from tapeline.llm import language
from tapeline.llm.queries import op1_language_id


@pytest.fixture(scope="module")
def dictionaries(spark):
    rows = [(i, odd.prose(i, 80, lang), lang) for i in range(40) for lang in ("aa", "bb")]
    return language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_dictionaries_are_bounded_and_repeatable(spark, dictionaries):
    assert set(dictionaries) == {"aa", "bb"}
    assert all(len(x) <= (language.EXCERPTS + language.CELLS) * (language.EXCERPT_CHARS + 1) * 4 for x in dictionaries.values())


def test_odd_rows(spark, dictionaries):
    rows = language.identify(odd.documents(spark), dictionaries).collect()
    assert len(rows) == len(odd.texts())
    by = {r.doc_id: r for r in rows}
    for key in (4, 5, 6, 8):
        assert (by[key].lang_pred, by[key].score, by[key].rejected) == ("und", 0.0, True)
    assert by[1].lang_pred == "aa" and by[11].lang_pred == "bb" and not by[11].rejected
    assert by[1].score == by[2].score and 0 <= by[7].score <= 1
    assert by[None].lang_pred == "bb"


def test_equal_sizes_are_rejected(spark):
    same = b"some words that are the same in both"
    judged = language.Encoders({"x": same, "y": same}).judge(["some words"])[0]
    assert judged[0] == "x" and judged[2]


def test_empty_tables_and_no_labels(spark, dictionaries):
    assert language.identify(odd.nothing(spark), dictionaries).collect() == []
    assert language.learn(odd.nothing(spark)) == {}
    assert {r.lang_pred for r in language.identify(odd.documents(spark), {}).collect()} == {"und"}


def test_told_keeps_columns_and_sure_texts(spark, dictionaries):
    docs = odd.documents(spark)
    kept = language.told(docs, dictionaries)
    assert kept.columns == docs.columns
    assert {4, 5, 6, 8}.isdisjoint({r.doc_id for r in kept.collect()}) and kept.where("doc_id = 9").count() == 2


def test_held_out_accuracy_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    found = op1_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.agg(F.min("score"), F.max("score")).first()[0] >= 0


def test_every_language_has_a_dictionary(spark):
    """More languages than a task's compressors at once: none is left out, and the passes answer as one."""
    import numpy as np

    letters = [f"l{k:03d}" for k in range(230)]
    texts = [(k, " ".join(f"{chr(0x4E00 + 40 * k + (7 * i) % 40)}{chr(0x4E00 + 40 * k + (3 * i) % 40)}" for i in range(200)), name) for k, name in enumerate(letters)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    made = language.learn(docs)
    assert sorted(made) == letters
    told = {r.doc_id: r.lang_pred for r in language.identify(docs, made).collect()}
    assert told == {k: name for k, _, name in texts}
    some = [x for _, x, _ in texts[::23]]
    assert np.array_equal(language.Encoders(made, at_once=17).sizes(some), language.Encoders(made, at_once=500).sizes(some))


def test_choice_is_the_smallest_sum(spark):
    """Each text against a plain compressor per language, block by block."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = language.learn(docs)
    sizes = language.Encoders(made).sizes([r.text or "" for r in docs.select("text").collect()])
    for row, each in zip(docs.select("text").collect(), sizes, strict=True):
        data = language.plain(row.text or "")
        for name, size in zip(sorted(made), each.tolist(), strict=True):
            press = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(made[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            plain = sum(len(press.compress(data[a : a + language.BLOCK_BYTES])) for a in range(0, len(data), language.BLOCK_BYTES))
            assert abs(plain - size) <= 8 * (1 + len(data) // language.BLOCK_BYTES)  # a prepared dictionary may parse otherwise


def test_a_frequent_text_is_one_row_of_the_choice(spark):
    rows = [(k, "the same text again and again " * 9, "aa") for k in range(3_000)] + [(5_000 + k, f"another text number {k} " * 9, "aa") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.learn(docs) == language.learn(docs.dropDuplicates(["text"]).repartition(7))
