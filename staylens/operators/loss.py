"""Why bookings are lost: the classified conversations and the tables summed from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.numeric import count_where, money, money_avg, money_sum, percent
from staylens.functions.ordering import ntile
from staylens.functions.skew import heavy_keys, salted_join
from staylens.sources.schemas import COMPLAINT_INTENTS, EVENT_PATTERNS, NO_PATTERN, PRAISE_INTENTS

NEGATIVE = -0.2
WORSENED = -0.3
LONG_CONVERSATION = 10
LOW_CSAT = 2


def pattern_flags() -> dict[str, Column]:
    """One flag per named pattern, in priority order. Flags overlap; the pattern picks the first."""
    handed_off = F.col("escalation_handoff_count") > 0
    delayed = F.col("delayed_reply_count") > 0
    rules = {
        "unanswered_opening": F.col("is_unanswered_opening"),
        "escalated_and_delayed": handed_off & delayed,
        "escalated_support": handed_off,
        "delayed_reply": delayed,
        "ends_frustrated": F.col("closing_sentiment") < NEGATIVE,
        "negative_opening": F.col("opening_sentiment") < NEGATIVE,
        "multiple_negative": F.col("negative_msg_count") >= 2,
        "sentiment_worsened": F.col("sentiment_delta") < WORSENED,
        "long_conversation": F.col("conversation_message_count") > LONG_CONVERSATION,
        "low_csat": F.col("csat_score") <= LOW_CSAT,
    }
    return {f"flag_{name}": rules[name] for name in EVENT_PATTERNS}


def event_pattern() -> Column:
    return F.coalesce(*[F.when(F.col(f"flag_{name}"), F.lit(name)) for name in EVENT_PATTERNS], F.lit(NO_PATTERN))


def journey_stage() -> Column:
    return (
        F.when(F.col("negative_msg_count") == 0, "4_closing")
        .when(F.col("opening_sentiment") < NEGATIVE, "1_opening")
        .when(F.col("sentiment_delta") < WORSENED, "3_late_mid")
        .otherwise("2_early_mid")
    )


def topic_cluster() -> Column:
    intent = F.col("conversation_primary_intent")
    return (
        F.when(intent.isin(COMPLAINT_INTENTS), "complaint").when(intent.isin(PRAISE_INTENTS), "praise").otherwise("everyday")
    )


def month_of(at: str) -> Column:
    """Calendar month as 'YYYY-MM', read off the zone-less clock time."""
    return F.substring(F.col(at).cast("string"), 1, 7)


def in_trailing_window(journeys: DataFrame, months: int = 12) -> DataFrame:
    """Journeys that started no earlier than `months` before the latest start in the data."""
    latest = journeys.agg(F.max("conversation_started_at").alias("latest"))
    cut = latest.select(F.col("latest") - F.expr(f"INTERVAL '{months}' MONTH")).scalar()
    return journeys.filter(F.col("conversation_started_at") >= cut)


def loss_events(
    journeys: DataFrame,
    bookings: DataFrame,
    users: DataFrame,
    heavy: dict[str, dict] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One classified row per journey, with the booking's outcome and price and the guest's tier.

    `journeys` is already cut to the window under study. `heavy` names the bookings and users that
    own too many conversations for one task, as found by `heavy_keys` on the conversations.
    """
    heavy = heavy or {}
    outcome = bookings.select("booking_id", F.col("status").alias("booking_status"), "total_price")
    tiers = users.select("user_id", F.coalesce("loyalty_tier", F.lit("none")).alias("loyalty_tier"))
    each = F.col("conversation_id")
    scoped = salted_join(journeys, outcome, "booking_id", each, heavy.get("booking_id", {}), limit=limit)
    scoped = salted_join(scoped, tiers, "user_id", each, heavy.get("user_id", {}), limit=limit)
    return (
        scoped.withColumns(
            {
                "activity_month": month_of("conversation_started_at"),
                "is_cancelled": F.col("booking_status") == "cancelled",
                "journey_stage": journey_stage(),
                "topic_cluster": topic_cluster(),
                **pattern_flags(),
            }
        )
        .withColumn("event_pattern", event_pattern())
        .drop("is_unanswered_opening")
    )


def heavy_parties(conversations: DataFrame, limit: int | None = None) -> dict[str, dict]:
    """Bookings and users with too many conversations for one task."""
    return heavy_keys(conversations, "booking_id", "user_id", limit=limit)


def _cohort() -> list[Column]:
    return [F.col("activity_month").alias("month"), F.col("conversation_channel").alias("channel"), F.col("loyalty_tier")]


def _counts() -> list[Column]:
    return [F.count("*").alias("bookings"), count_where(F.col("is_cancelled")).alias("cancelled_bookings")]


def _cancelled_price(name: str = "cancelled_price") -> Column:
    return money_sum("total_price", where=F.col("is_cancelled")).alias(name)


def loss_by_month_pattern(events: DataFrame) -> DataFrame:
    return events.groupBy(*_cohort(), "event_pattern").agg(*_counts(), _cancelled_price())


def loss_by_stage(events: DataFrame) -> DataFrame:
    return events.groupBy(*_cohort(), "journey_stage").agg(
        *_counts(), money_sum("total_price").alias("total_price"), _cancelled_price()
    )


def complaint_cohort(events: DataFrame) -> DataFrame:
    intent = F.col("conversation_primary_intent").alias("intent_category")
    return events.groupBy(*_cohort(), intent, "topic_cluster").agg(
        *_counts(), money_sum("total_price").alias("total_price"), _cancelled_price()
    )


def price_quintile_risk(
    events: DataFrame, max_rows: int | None = None, tiles: int = 5, limit: int | None = None
) -> DataFrame:
    """Equal-sized price groups, cheapest first, with their cancellation rate and lost value.

    Equal prices are split by conversation_id. `max_rows` bounds the number of events when the
    caller knows it; otherwise they are counted.
    """
    priced = events.select("conversation_id", "total_price", "is_cancelled")
    rows = priced.count() if max_rows is None else max_rows
    tiled = ntile(priced, tiles, ("total_price", "conversation_id"), "price_quintile", rows, limit)
    cancelled = count_where(F.col("is_cancelled"))
    price = money("total_price")
    return (
        tiled.groupBy("price_quintile")
        .agg(
            F.count("*").alias("bookings"),
            money_avg("total_price").alias("avg_price"),
            F.min(price).cast("double").alias("min_price"),
            F.max(price).cast("double").alias("max_price"),
            cancelled.alias("cancelled_bookings"),
            percent(cancelled, F.count("*"), 2).alias("cancellation_rate_pct"),
            _cancelled_price("revenue_lost_to_cancellation"),
        )
        .orderBy("price_quintile")
    )


def unanswered_opening_monthly(events: DataFrame) -> DataFrame:
    """Per month: all conversations against those whose opening message was never answered."""
    unanswered = F.col("event_pattern") == "unanswered_opening"
    total = F.count("*")
    cases = count_where(unanswered)
    lost = count_where(unanswered & F.col("is_cancelled"))
    return (
        events.groupBy(F.col("activity_month").alias("month"))
        .agg(
            total.alias("total_bookings_in_cohort"),
            percent(count_where(F.col("is_cancelled")), total, 4).alias("cohort_base_cancel_rate_pct"),
            cases.alias("unanswered_opening_bookings"),
            percent(cases, total, 4).alias("pct_unanswered_opening"),
            lost.alias("unanswered_opening_cancelled"),
            percent(lost, cases, 4).alias("unanswered_opening_cancel_rate_pct"),
        )
        .orderBy("month")
    )
