"""Datasets that are replaced as a whole: versioned folders, and a one-file pointer that is replaced last.

A dataset is a folder with one sub-folder per version and a file that names the versions that count, the newest first. A write
makes a new version beside the others; only when all its rows are stored is the pointer replaced, by renaming a new file over it. A
write that fails in between changes nothing: readers go on with the old version, and the next commit leaves the remains alone until they
are old enough to be no write in progress. A reader that has resolved the pointer goes on reading its version while a newer one is
committed; the version before the newest is kept for that.

Two writers at a time both store whole versions; the last to commit wins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

POINTER = "_current"
#: Versions kept for readers, the newest included, and hours after which a version that was never committed is removed.
KEPT = 2
ABANDONED_HOURS = 24


@dataclass(frozen=True)
class Version:
    """A stored version of a dataset, visible to readers once it is committed. ``observed`` holds what was asked of its rows
    while they were written."""

    dataset: str
    name: str
    df: DataFrame
    observed: dict = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.dataset}/{self.name}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def versions(spark: SparkSession, dataset: str) -> list[str]:
    """Names of the committed versions, the newest first; none where nothing was committed."""
    files, pointer = _file_system(spark, dataset), _path(spark, f"{dataset}/{POINTER}")
    if not files.exists(pointer):
        return []
    stream = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def current(spark: SparkSession, dataset: str) -> str:
    """The folder that readers of ``dataset`` read. A dataset without a pointer is a plain folder of files."""
    named = versions(spark, dataset)
    return f"{dataset}/{named[0]}" if named else dataset


def read(spark: SparkSession, dataset: str, schema: T.StructType) -> DataFrame:
    """The present version. Columns that only lay out the files are not in ``schema`` and left out."""
    return spark.read.schema(schema).parquet(current(spark, dataset)).select(*schema.names)


def write(df: DataFrame, dataset: str, layout: str | None = None) -> Version:
    """Store ``df`` as a new version that nobody reads yet, in a folder per value of the column ``layout`` if there is one."""
    spark = df.sparkSession
    name = f"version-{uuid.uuid4().hex}"
    (df.write.partitionBy(layout) if layout else df.write).parquet(f"{dataset}/{name}")
    columns = [c for c in df.columns if c != layout]
    return Version(dataset, name, spark.read.schema(df.schema).parquet(f"{dataset}/{name}").select(*columns))


def commit(version: Version, kept: int = KEPT, abandoned_hours: float = ABANDONED_HOURS) -> DataFrame:
    """Make ``version`` the one that is read, and remove versions that are no longer kept. Its rows are returned."""
    spark = version.df.sparkSession
    named = [version.name, *(x for x in versions(spark, version.dataset) if x != version.name)]
    _replace(spark, version.dataset, "\n".join(named[:kept]) + "\n")
    _remove(spark, version.dataset, named[:kept], named[kept:], abandoned_hours)
    return version.df


def _replace(spark: SparkSession, dataset: str, text: str) -> None:
    """Write the pointer aside and rename it over the old one."""
    jvm = spark._jvm
    aside, pointer = _path(spark, f"{dataset}/{POINTER}.{uuid.uuid4().hex}"), _path(spark, f"{dataset}/{POINTER}")
    stream = _file_system(spark, dataset).create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    qualified = _file_system(spark, dataset)
    context.rename(qualified.makeQualified(aside), qualified.makeQualified(pointer), options)


def _remove(spark: SparkSession, dataset: str, kept: list[str], outdated: list[str], abandoned_hours: float) -> None:
    files = _file_system(spark, dataset)
    before = spark._jvm.java.lang.System.currentTimeMillis() - abandoned_hours * 3_600_000
    for status in files.listStatus(_path(spark, dataset)):
        name = status.getPath().getName()
        old = name in outdated or status.getModificationTime() < before
        if name.startswith("version-") and name not in kept and old:
            files.delete(status.getPath(), True)
