"""The six source tables expressed over an order-entry star schema (orders, lineitem, ...).

Every column is a row-local expression, so each table is one scan: no window, no join on the
large tables and no dependence on row order. FIXTURES.md section 3 lists the expressions.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources.schemas import BOOKING_CHANNELS, CONVERSATION_CHANNELS, INTENTS, LANGUAGES
from staylens.sources.tables import SourceTables

# The columns read from each table; naming their types spares a look into the files per query.
STAR_COLUMNS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "nation": "n_nationkey INT, n_name STRING",
}


def _pick(values: list[str], index: str) -> str:
    return f"get(array({', '.join(repr(v) for v in values)}), CAST({index} AS INT))"


def _thread_time(key: str, slot: str, extra: str = "0") -> str:
    seconds = f"({key} * 37 % 731) * 86400 + {key} * 7919 % 80000 + {slot} * 86400 + {extra}"
    return f"timestampadd(SECOND, CAST({seconds} AS INT), TIMESTAMP_NTZ '2000-01-01 00:00:00')"


def _loaded(key: str) -> str:
    return f"timestampadd(HOUR, -CAST({key} % 24 AS INT), TIMESTAMP_NTZ '2002-01-01 06:00:00')"


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
        "c_custkey AS user_id",
        "c_name AS full_name",
        "n_name AS country",
        "date_add(DATE '1999-01-01', CAST(c_custkey % 365 AS INT)) AS signup_date",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'silver' WHEN 'BUILDING' THEN 'gold' WHEN 'MACHINERY' THEN 'platinum'"
        " WHEN 'FURNITURE' THEN 'none' END AS loyalty_tier",
    )


def hosts(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.expr("s_nationkey = n_nationkey"), "left").selectExpr(
        "s_suppkey AS host_id",
        "s_name AS host_name",
        "n_name AS country",
        "CAST(s_suppkey % 81 + 20 AS DOUBLE) / 100 AS response_rate",
        "s_suppkey % 5 = 0 AS is_superhost",
    )


def properties(part: DataFrame, host_count: Column) -> DataFrame:
    return part.withColumn("host_id", F.col("p_partkey") % host_count).selectExpr(
        "p_partkey AS property_id",
        "host_id",
        "p_name AS property_name",
        "p_type AS property_type",
        "p_brand AS city",
        "CAST(NULL AS STRING) AS country",
        "p_size % 5 + 1 AS bedrooms",
        "p_retailprice AS price_per_night",
        "CAST(p_partkey % 26 AS DOUBLE) / 10 + 2.5D AS rating",
        "p_partkey % 800 AS review_count",
    )


def _with_property(orders: DataFrame, property_count: Column, host_count: Column) -> DataFrame:
    place = F.col("o_orderkey") % property_count
    return orders.withColumns({"property_id": place, "host_id": place % host_count})


def bookings(orders: DataFrame, property_count: Column, host_count: Column) -> DataFrame:
    checkin = "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 60 + 1 AS INT))"
    nights = "CAST(o_orderkey % 13 + 1 AS INT)"
    return _with_property(orders, property_count, host_count).selectExpr(
        "o_orderkey AS booking_id",
        "property_id",
        "host_id",
        "o_custkey AS user_id",
        "CAST(o_orderdate AS DATE) AS booking_created_at",
        f"{checkin} AS checkin_date",
        f"date_add({checkin}, {nights}) AS checkout_date",
        f"{nights} AS nights",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'confirmed' ELSE 'cancelled' END AS status",
        f"{_pick(BOOKING_CHANNELS, 'o_orderkey % 3')} AS channel",
        "o_totalprice AS total_price",
    )


def conversations(orders: DataFrame, property_count: Column, host_count: Column) -> DataFrame:
    """Every order has a thread, every seventh a second one. A third of them were never booked: no booking id."""
    threads = F.expr("explode(if(o_orderkey % 7 = 0, array(0, 1), array(0)))")
    linked = orders.withColumn("slot", threads)
    return _with_property(linked, property_count, host_count).selectExpr(
        "o_orderkey * 10 + slot AS conversation_id",
        "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS booking_id",
        "o_custkey AS user_id",
        "host_id",
        "property_id",
        f"{_pick(CONVERSATION_CHANNELS, 'o_orderkey % 23 % 4')} AS channel",
        f"{_pick(INTENTS, '(o_orderkey + slot * 5) % 16')} AS intent_category",
        "CASE WHEN o_orderkey % 10 < 7 THEN 'resolved' WHEN o_orderkey % 10 < 9 THEN 'open' ELSE 'escalated' END AS status",
        f"{_thread_time('o_orderkey', 'slot')} AS opened_at",
        "CAST(CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 5 + 1 END AS INT) AS csat_score",
        "CAST(o_orderkey * 53 % 7171 + 30 AS INT) AS first_response_time_seconds",
        "CAST(o_orderkey * 53 % 7171 + 90 + o_orderkey * 97 % 86311 AS INT) AS resolution_time_seconds",
        "o_orderkey % 10 < 4 AS is_support",
        f"{_loaded('o_orderkey')} AS generated_at",
    )


def messages(lineitem: DataFrame) -> DataFrame:
    slot = "if(l_orderkey % 7 = 0 AND l_linenumber > 4, 1, 0)"
    quantity = "CAST(l_quantity AS INT)"
    # Whole hundredths: adding a half and cutting off is round() without decimal arithmetic.
    mood = "CAST(l_discount * 100 + 0.5D AS INT)"
    sender = (
        "CASE WHEN l_linenumber = 1 OR l_returnflag = 'A' THEN 'guest'"
        " WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'host'"
        " WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'bot' ELSE 'support_agent' END"
    )
    # Lines carry no key of their own: tell the lines of an order apart by what is on them.
    fingerprint = (
        "(l_partkey * 7919 + l_suppkey * 104729 + CAST(l_quantity AS BIGINT) * 1299709"
        " + CAST(l_extendedprice * 100 + 0.5D AS BIGINT) * 31"
        " + CAST(date_diff(CAST(l_shipdate AS DATE), DATE '1990-01-01') AS BIGINT) * 15485863"
        " + CAST(l_linenumber AS BIGINT) * 179424673) % 39999983"
    )
    text = f"concat({sender}, ' note ', l_linenumber, ' on part ', l_partkey)"
    return lineitem.selectExpr(
        f"l_orderkey * 40000000 + {fingerprint} AS message_id",
        f"l_orderkey * 10 + {slot} AS conversation_id",
        f"{sender} AS sender_type",
        f"if({sender} = 'guest', l_orderkey % 1000, l_suppkey) AS sender_id",
        f"{_thread_time('l_orderkey', slot, f'(l_linenumber - 1) * 450 + {quantity} * 10')} AS sent_at",
        f"{text} AS text",
        f"{_pick(INTENTS, f'(l_orderkey + {slot} * 5) % 16')} AS intent_category",
        f"CAST({mood} - 5 AS DOUBLE) / 5.5D AS sentiment_score",
        f"CASE WHEN {mood} >= 7 THEN 'positive' WHEN {mood} <= 3 THEN 'negative' ELSE 'neutral' END AS sentiment_label",
        f"{_pick(LANGUAGES, 'l_suppkey % 6')} AS language",
        f"if(l_linenumber = 1, 0, {quantity} * 20) AS response_latency_seconds",
        f"length({text}) AS message_length",
        f"{_loaded('l_orderkey')} AS generated_at",
    )


def star_sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    @cache
    def scan(name: str) -> DataFrame:
        return spark.read.schema(STAR_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    def property_count() -> Column:
        return scan("part").agg(F.count("*")).scalar()

    def host_count() -> Column:
        return scan("supplier").agg(F.count("*")).scalar()

    return SourceTables(
        users=lambda: users(scan("customer"), scan("nation")),
        hosts=lambda: hosts(scan("supplier"), scan("nation")),
        properties=lambda: properties(scan("part"), host_count()),
        bookings=lambda: bookings(scan("orders"), property_count(), host_count()),
        conversations=lambda: conversations(scan("orders"), property_count(), host_count()),
        messages=lambda: messages(scan("lineitem")),
    )
