"""Data-quality checks. Each returns what violates it; an empty result is a pass.

Checks that would have to match a large table against another group it by key first, so a key that
fills a third of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


def outside_range(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside the inclusive range. Nulls pass."""
    return df.filter(outside_range(column, low, high))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows with a value outside the list. Nulls pass."""
    return df.filter(~F.col(column).isin(list(values)))


def not_constant(df: DataFrame, column: str) -> DataFrame:
    """One row when the column holds fewer than two distinct values.

    The smallest and largest value answer this without a distinct count.
    """
    low, high = F.min(column), F.max(column)
    return (
        df.agg(F.when(low.isNull(), 0).when(low == high, 1).otherwise(2).cast("bigint").alias("distinct_value_count"))
        .filter(F.col("distinct_value_count") <= 1)
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; nulls are equal to each other."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows that carry them."""
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_records"))
    )
    return keys.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def value_matches(
    df: DataFrame, column: str, upstream: DataFrame, key: str, upstream_column: str | None = None
) -> DataFrame:
    """Values that differ from the upstream row of the same key, with the number of rows that carry them.

    Keys missing upstream are not reported.
    """
    carried = df.groupBy(key, F.col(column).alias("model_value")).agg(F.count("*").alias("n_records"))
    source = upstream.select(key, F.col(upstream_column or column).alias("upstream_value"))
    return carried.join(source, key).filter(~F.col("model_value").eqNullSafe(F.col("upstream_value")))


def _aggregate(name: str, value: Column | None) -> Column:
    if name == "count":
        return F.count("*")
    return AGGREGATES[name](value)


def agg_matches(
    df: DataFrame,
    upstream: DataFrame,
    column: str | None = None,
    upstream_column: str | Column | None = None,
    agg: str = "sum",
    upstream_agg: str | None = None,
    where: Column | str | None = None,
    upstream_where: Column | str | None = None,
    tolerance: float = 1.0,
) -> DataFrame:
    """One row when an aggregate differs from the same aggregate upstream by more than the tolerance.

    The columns and filters may be SQL expressions.
    """

    def side(rows: DataFrame, name: str, value: str | Column | None, keep: Column | str | None, out: str) -> DataFrame:
        rows = rows if keep is None else rows.filter(keep)
        value = F.expr(value) if isinstance(value, str) else value
        return rows.agg(_aggregate(name, value).cast("double").alias(out))

    model = side(df, agg, column, where, "model_value")
    compare = side(upstream, upstream_agg or agg, column if upstream_column is None else upstream_column, upstream_where, "compare_value")
    difference = F.abs(F.coalesce("model_value", F.lit(0.0)) - F.coalesce("compare_value", F.lit(0.0)))
    # One row on each side.
    return model.crossJoin(compare).withColumn("diff", difference).filter(F.col("diff") > tolerance)


def freshness(df: DataFrame, loaded_at: str, now: str, warn_hours: int = 4, error_hours: int = 12) -> DataFrame:
    """Age of the newest row against a given clock time."""
    age = (F.lit(now).cast("timestamp_ntz") - F.col("max_loaded_at")).cast("bigint")
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).select(
        "max_loaded_at",
        age.alias("age_seconds"),
        F.when(age.isNull() | (age > error_hours * 3600), "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("status"),
    )


@dataclass(frozen=True)
class Check:
    """One declared check. `args` holds the keyword arguments of the function named by `kind`."""

    kind: str
    model: str
    column: str = ""
    args: dict = field(default_factory=dict)


def _row_condition(check: Check) -> Column | None:
    """The violating rows of a check that needs nothing but the row itself."""
    if check.kind == "between":
        return outside_range(check.column, check.args["low"], check.args["high"])
    if check.kind == "non_negative":
        return F.col(check.column) < 0
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(list(check.args["values"]))
    return None


def _scan_failures(check: Check) -> Column | None:
    """Failure count of a check that one scan of its table can answer, together with all others."""
    condition = _row_condition(check)
    if condition is not None:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")
    if check.kind == "not_constant":
        low, high = F.min(check.column), F.max(check.column)
        return F.when(low.isNull() | (low == high), 1).otherwise(0).cast("bigint")
    return None


def violations(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df, args = tables[check.model], check.args
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "unique_combination":
        return unique_combination(df, args["columns"])
    if check.kind == "relationships":
        return relationships(df, check.column, tables[args["parent"]], args["parent_column"])
    if check.kind == "value_matches":
        return value_matches(df, check.column, tables[args["upstream"]], args["key"])
    if check.kind == "agg_matches":
        others = {k: v for k, v in args.items() if k != "upstream"}
        return agg_matches(df, tables[args["upstream"]], check.column or None, **others)
    if check.kind == "not_constant":
        return not_constant(df, check.column)
    return df.filter(_row_condition(check))


def _failures(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    bad = violations(check, tables)
    count = F.sum("n_records") if check.kind in ("relationships", "value_matches") else F.count("*")
    return bad.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("failures"))


def run_checks(checks: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: check, model, column, failures, status.

    All row-level checks of a table share one scan. `failures` counts violating rows, duplicated
    values for the uniqueness checks.
    """

    def label(check: Check) -> list[Column]:
        column = check.column or ",".join(check.args.get("columns", []))
        return [F.lit(check.kind).alias("check"), F.lit(check.model).alias("model"), F.lit(column).alias("column")]

    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        scans = [(c, n) for c in checks if c.model == model and (n := _scan_failures(c)) is not None]
        if scans:
            row = tables[model].agg(*[n.alias(f"_{i}") for i, (_, n) in enumerate(scans)])
            each = F.array(*[F.struct(*label(c), F.col(f"_{i}").alias("failures")) for i, (c, _) in enumerate(scans)])
            parts.append(row.select(F.inline(each)))
    for check in checks:
        if _scan_failures(check) is None:
            parts.append(_failures(check, tables).select(*label(check), "failures"))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )
