"""Session settings for tests and benchmarks, and folders for intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "tapeline", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session. On a cluster the launcher owns these settings; nothing in the library sets them."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, or where that is unset a folder in the warehouse, which all
    executors reach. A session that is one process on one machine uses its own scratch folder instead."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master == "local" or context.master.startswith("local["):
        return f"{spark.conf.get('spark.local.dir', '/tmp')}/tapeline-{context.applicationId}"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh path below ``root``, or below the shared folder."""
    return f"{(root or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hold(df: DataFrame, root: str | None = None) -> DataFrame:
    """Store ``df`` once, so that everything built on it sees the same rows even when executors are lost."""
    folder = new_folder(df.sparkSession, "held", root)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediates on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
