"""Exact money, rate and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(price: Column | str) -> Column:
    """Price in cents-exact decimal, so that sums do not depend on the order of the rows."""
    return (F.col(price) if isinstance(price, str) else price).cast(MONEY)


def money_sum(price: Column | str, where: Column | None = None) -> Column:
    """Sum of prices to the cent. Rows outside `where` add zero, as does an empty selection."""
    value = money(price)
    if where is not None:
        value = F.when(where, value).otherwise(F.lit(0).cast(MONEY))
    return F.sum(value).cast("double")


def money_avg(price: Column | str) -> Column:
    value = money(price)
    return F.round(F.sum(value) / F.count(value).cast("decimal(20,0)"), 2).cast("double")


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where the whole is zero or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, places: int) -> Column:
    """100 * part / whole over counts, rounded half up on exact decimals; null for an empty whole."""
    whole = F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(part.cast("decimal(18,0)") * 100 / whole, places).cast("double")


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")
