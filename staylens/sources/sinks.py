"""Writing tables and extracts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.pin import pin


def write_table(df: DataFrame, root: str, name: str, partition_by: str | None = None) -> DataFrame:
    """Replace a table with the rows of df (snappy Parquet) and read it back.

    A table partitioned by a low-cardinality column is rebalanced on it first: small partitions become
    one file each, and a large one is split over as many tasks as its size needs.
    """
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write
    if partition_by:
        writer = df.hint("rebalance", partition_by).sortWithinPartitions(partition_by).write.partitionBy(partition_by)
    writer.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_json(df: DataFrame, root: str, name: str) -> None:
    """Write the rows as JSON lines from the tasks that hold them."""
    df.write.mode("overwrite").json(f"{root.rstrip('/')}/{name}")


def _json_value(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, (T.IntegralType, T.FractionalType, T.BooleanType, T.StringType, T.ArrayType)):
        value = value.cast("string")
    elif isinstance(field.dataType, T.DecimalType):
        value = value.cast("string")
    inside = F.to_json(F.array(value))
    return inside.substr(F.lit(2), F.length(inside) - 2)


def write_extract(df: DataFrame, root: str, name: str) -> None:
    """Write {"cols", "rows"} as text parts that, put together in order of their names, are one JSON document.

    The first part opens the document, each further line is a row in the order of df, the last part
    closes it. Rows are written by the tasks that hold them, so an extract may have any size. Values JSON
    does not know (dates, times, decimals) become text.
    """
    spark = df.sparkSession
    rows = df.select(F.concat(F.lit("["), F.concat_ws(",", *[_json_value(f) for f in df.schema]), F.lit("]")).alias("value"))
    rows = pin(rows.withColumn("_at", F.monotonically_increasing_id()))
    first = rows.agg(F.min("_at")).scalar()
    lines = rows.orderBy("_at").select(F.concat(F.when(F.col("_at") == first, "").otherwise(","), F.col("value")).alias("value"))

    def line(text: str) -> DataFrame:
        return spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))

    opening = json.dumps({"cols": df.columns}, separators=(",", ":"), ensure_ascii=False)[:-1] + ',"rows":['
    document = line(opening).union(lines).union(line("]}"))
    document.write.mode("overwrite").text(f"{root.rstrip('/')}/{name}")


def read_extract(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of an extract, typed by `schema`."""
    line = F.regexp_replace("value", "^,", "")
    rows = spark.read.text(f"{root.rstrip('/')}/{name}").filter(line.startswith("["))
    values = F.from_json(line, "array<string>")
    return rows.select(values.alias("v")).select(
        *[F.get("v", F.lit(i)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )
