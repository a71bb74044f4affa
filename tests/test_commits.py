"""Datasets that are replaced as a whole."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tapeline.sinks import commits, tables

SHAPE = "id bigint"


def rows(spark, root, name="t"):
    schema = spark.createDataFrame([], SHAPE).schema
    return sorted(r.id for r in tables.reload(spark, str(root), name, schema).collect())


def folders(root, name="t"):
    return {p.name for p in Path(root, name).iterdir() if p.name.startswith("version-")}


def failing(spark, n=50):
    """Half of the tasks store their rows, then one fails."""
    return spark.range(n).repartition(4).select(F.when(F.col("id") == 37, F.raise_error(F.lit("midway"))).otherwise(F.col("id")).cast("bigint").alias("id"))


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    tables.materialise(spark.range(5), str(tmp_path), "t")
    with pytest.raises(Exception, match="midway"):
        tables.materialise(failing(spark), str(tmp_path), "t")
    assert rows(spark, tmp_path) == [0, 1, 2, 3, 4]
    tables.materialise(spark.range(2), str(tmp_path), "t")
    assert rows(spark, tmp_path) == [0, 1]


def test_failure_between_write_and_pointer(spark, tmp_path, monkeypatch):
    tables.materialise(spark.range(5), str(tmp_path), "t")
    version = tables.prepare(spark.range(9), str(tmp_path), "t")
    assert version.df.count() == 9 and rows(spark, tmp_path) == [0, 1, 2, 3, 4]
    monkeypatch.setattr(commits, "_replace", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        commits.commit(version)
    assert rows(spark, tmp_path) == [0, 1, 2, 3, 4]
    monkeypatch.undo()
    commits.commit(version)
    assert len(rows(spark, tmp_path)) == 9


def test_first_write_fails(spark, tmp_path):
    with pytest.raises(Exception, match="midway"):
        tables.materialise(failing(spark), str(tmp_path), "t")
    assert commits.versions(spark, str(tmp_path / "t")) == []


def test_a_reader_keeps_its_version(spark, tmp_path):
    old = tables.materialise(spark.range(5), str(tmp_path), "t")
    tables.materialise(spark.range(7), str(tmp_path), "t")
    assert old.count() == 5 and len(rows(spark, tmp_path)) == 7


def test_outdated_and_abandoned_versions_go(spark, tmp_path):
    dataset = str(tmp_path / "t")
    made = [commits.write(spark.range(k), dataset) for k in range(5)]
    for version in made[:4]:
        commits.commit(version)
    assert commits.versions(spark, dataset) == [made[3].name, made[2].name]
    assert folders(tmp_path) == {made[k].name for k in (2, 3, 4)}  # the uncommitted one may be in progress
    commits.commit(commits.write(spark.range(9), dataset), kept=1, abandoned_hours=-1)
    assert len(folders(tmp_path)) == 1 and len(rows(spark, tmp_path)) == 9
    assert [p.name for p in Path(dataset).iterdir() if p.name.startswith("_current")] == ["_current"]


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert rows(spark, tmp_path) == [0, 1, 2]
    tables.materialise(spark.range(4), str(tmp_path), "t")
    assert len(rows(spark, tmp_path)) == 4


def test_replacing_a_dataset_by_what_was_read_from_it(spark, tmp_path):
    now = tables.materialise(spark.range(5), str(tmp_path), "t")
    for _ in range(3):
        now = tables.materialise(now.select((F.col("id") + 1).alias("id")), str(tmp_path), "t")
    assert rows(spark, tmp_path) == [3, 4, 5, 6, 7]
