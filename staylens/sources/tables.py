"""Reading the source tables and the staging layer."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.sources.schemas import SCHEMAS


class SourceTables:
    """The staged source tables. Each one is opened when it is first used."""

    NAMES = ("users", "hosts", "properties", "bookings", "conversations", "messages")

    users: DataFrame
    hosts: DataFrame
    properties: DataFrame
    bookings: DataFrame
    conversations: DataFrame
    messages: DataFrame

    def __init__(self, **opened_by: Callable[[], DataFrame]) -> None:
        self._opened_by = opened_by

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        df = self._opened_by[name]()
        setattr(self, name, df)
        return df

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.NAMES}


def read_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one source, failing before any work if the files do not carry the declared columns."""
    path = f"{root.rstrip('/')}/{name}.parquet"
    expected = SCHEMAS[name]
    found = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in expected
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{path} does not match the {name} schema: {'; '.join(wrong)}")
    return spark.read.schema(expected).parquet(path)


def stage(df: DataFrame) -> DataFrame:
    """Pass-through, except that single-precision measures become doubles of the same decimal value.

    Widening 0.2f bit by bit gives 0.200000003, which lands on the other side of a 0.2 threshold. The
    shortest decimal that names a single exactly is its text, so nothing is rounded away.
    """
    singles = {
        f.name: F.col(f.name).cast("string").cast("double")
        for f in df.schema
        if isinstance(f.dataType, T.FloatType)
    }
    return df.withColumns(singles) if singles else df


def read_sources(spark: SparkSession, root: str) -> SourceTables:
    files = {
        "users": "dim_users",
        "hosts": "dim_hosts",
        "properties": "dim_properties",
        "bookings": "fact_bookings",
        "conversations": "dim_conversations",
        "messages": "fact_chat_messages",
    }
    return SourceTables(**{name: partial(_read_staged, spark, root, file) for name, file in files.items()})


def _read_staged(spark: SparkSession, root: str, name: str) -> DataFrame:
    return stage(read_source(spark, root, name))


def register_staging_views(tables: SourceTables, prefix: str = "stg_") -> list[str]:
    """Expose the staging layer to SQL users as temporary views."""
    names = []
    for name, df in tables.named().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
