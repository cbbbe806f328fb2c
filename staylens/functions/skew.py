"""Finding keys that hold too many rows for one task, and joining on them without a hot task.

The heavy keys only decide the layout of the work. Every result is exact whatever is found here.
There are at most rows / limit heavy keys. A few are a dict on the driver; more than KEYS_LISTED, as a
small limit finds them, stay a table on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.pin import pin

ROWS_PER_TASK_CONF = "spark.staylens.rowsPerTask"
ROWS_PER_TASK = 1_000_000
SKETCH_KEYS = 10_000
SKETCH_ENTRIES = 100_000
KEYS_LISTED = 20_000
# Heavy values with their row counts, or a pinned table of (value, count).
Heavy = dict | DataFrame


def rows_per_task(spark: SparkSession) -> int:
    """How many rows one ordered or joined group may put into one task."""
    return int(spark.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK)))


def ways(rows: int, limit: int) -> int:
    return max(2, math.ceil(rows / limit))


def key_table(df: DataFrame, column: str, values: list) -> DataFrame:
    """A one-column table of heavy keys, typed like the column of df."""
    schema = T.StructType([T.StructField(column, df.schema[column].dataType)])
    return df.sparkSession.createDataFrame([(v,) for v in values], schema)


def heavy_table(df: DataFrame, column: str, heavy: Heavy) -> DataFrame:
    """The heavy values of `column` and their `_rows`. A listed few are broadcast; Spark decides about a table by its size."""
    if isinstance(heavy, DataFrame):
        return heavy.withColumnRenamed("count", "_rows")
    schema = T.StructType([T.StructField(column, df.schema[column].dataType), T.StructField("_rows", T.LongType())])
    return F.broadcast(df.sparkSession.createDataFrame(list(heavy.items()), schema))


def heavy_keys(df: DataFrame, *columns: str, limit: int | None = None) -> dict[str, Heavy]:
    """Per column, the values with more than `limit` rows, with their row counts.

    A table of at most `limit` rows has none. Otherwise one pass builds a frequent-items sketch per
    column inside the tasks, so nothing is shuffled by key. Its error is below 4 rows in
    SKETCH_ENTRIES; while that is under `limit`, it names every heavy key, and a second pass counts
    those exactly. On a table beyond the sketch's reach all keys are counted, combined before the
    shuffle, and the heavy ones are listed only if they are few.
    """
    limit = limit or rows_per_task(df.sparkSession)
    rows = df.count()
    if rows <= limit:
        return {c: {} for c in columns}
    in_reach = 4 * rows <= limit * SKETCH_ENTRIES and rows <= limit * SKETCH_KEYS
    # A sketched count is never too low.
    frequent = "transform(filter(approx_top_k(`{c}`, {k}, {n}), i -> i.item IS NOT NULL AND i.count > {limit}), i -> i.item)"
    top = (
        df.agg(*[F.expr(frequent.format(c=c, k=SKETCH_KEYS, n=SKETCH_ENTRIES, limit=limit)).alias(c) for c in columns]).first()
        if in_reach
        else None
    )
    heavy: dict[str, Heavy] = {c: {} for c in columns}
    for c in columns:
        named = df.filter(F.col(c).isNotNull())
        if top is not None:
            if not top[c]:
                continue
            named = df.join(F.broadcast(key_table(df, c, top[c])), c, "left_semi")
        counted = named.groupBy(c).count().filter(F.col("count") > limit)
        if top is None:
            counted = pin(counted)
            if counted.count() > KEYS_LISTED:
                heavy[c] = counted
                continue
        heavy[c] = {r[c]: r["count"] for r in counted.collect()}
    return heavy


def salted_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: Column,
    heavy: Heavy,
    how: str = "inner",
    limit: int | None = None,
) -> DataFrame:
    """Equi-join of a large side with a side that is unique on `key`.

    Rows of a heavy key are dealt out over as many salts as its rows need at `limit` rows each, by a
    hash of `spread_by`; the single matching row of the other side is repeated once per salt. Without
    heavy keys this is the plain join and Spark chooses between broadcast and sort-merge by size.
    """
    if not heavy:
        return many.join(one, key, how)
    limit = limit or rows_per_task(many.sparkSession)
    if isinstance(heavy, DataFrame):
        salts = heavy.select(key, F.greatest(F.lit(2), F.ceil(F.col("count") / limit)).cast("bigint").alias("_salts"))
    else:
        salts = heavy_table(many, key, {k: ways(rows, limit) for k, rows in heavy.items()}).withColumnRenamed("_rows", "_salts")
    n = F.coalesce("_salts", F.lit(1).cast("bigint"))
    many = many.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), n)).drop("_salts")
    one = one.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))).drop("_salts")
    return many.join(one, [key, "_salt"], how).drop("_salt")
