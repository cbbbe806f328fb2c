"""Cutting lineage at a point that several passes read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that all executors share, deleted when the session's process ends.

    The session names that folder in spark.checkpoint.dir. Only a local session without the setting
    gets a temporary one; on a cluster the executors could not share it.
    """
    root = spark.conf.get(FOLDER_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {FOLDER_CONF} to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="staylens-")
        spark.conf.set(FOLDER_CONF, root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/staylens-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return files.makeQualified(path).toString()


def pin(df: DataFrame) -> DataFrame:
    """The same rows, read from Parquet files in the shared folder.

    Every later pass sees the same rows, reads only its columns, and Spark knows the size. The order
    of the rows is not kept.
    """
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
