"""Tables written once to the folder that all executors share, and read back.

A table that several passes read is written as Parquet, so a lost executor costs only the tasks it
ran, and every pass sees the same rows. The folder is the one the session names in
`spark.checkpoint.dir`; only a local session without that setting gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new path in the shared folder, deleted when the session's process ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="staylens-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/staylens-{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return files.makeQualified(path).toString()


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read from Parquet files in the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(value: Column) -> Column:
    """The same value, computed once per row where it stands.

    The optimiser may copy an expression into each place that reads it, which inside a lambda is once
    per array element, and move filters below it. It does neither past a running id.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)
