"""Message grain: the ordered event log of every conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.ordering import ordered_scan
from staylens.functions.skew import heavy_keys

DELAY_SECONDS = 900
SUPPORT = "support_agent"


def _clock_second(at: str) -> Column:
    # Counted from year 1, where cutting off the fraction always rounds down.
    return (F.col(at) - F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")).cast("bigint")


def seconds_between(start: str, end: str) -> Column:
    """Number of second boundaries crossed from start to end, in any session time zone."""
    return _clock_second(end) - _clock_second(start)


def is_delayed() -> Column:
    return ~F.col("is_first_message") & (F.col("seconds_since_prev_message") > DELAY_SECONDS)


def event_label() -> Column:
    """What happened at this turn. An unknown sender or a missing sentiment label gives null."""
    sender = F.col("sender_type")
    turn = (
        F.when(F.col("is_first_message"), F.concat(F.lit("opened_by_"), sender))
        .when(F.col("is_escalation_handoff"), F.lit("escalated_to_support"))
        .when(sender == "guest", F.concat(F.lit("guest_"), F.col("sentiment_label")))
        .when(sender == "bot", F.lit("bot_reply"))
        .when(sender == "host", F.lit("host_reply"))
        .when(sender == SUPPORT, F.lit("support_reply"))
    )
    return F.concat(turn, F.when(is_delayed(), F.lit("_delayed")).otherwise(F.lit("")))


def heavy_conversations(messages: DataFrame, limit: int | None = None) -> dict:
    """Conversations with too many messages for one task, with their number of messages."""
    return heavy_keys(messages.filter(F.col("conversation_id").isNotNull()), "conversation_id", limit=limit)["conversation_id"]


def conversation_log(
    messages: DataFrame, conversations: DataFrame, limit: int | None = None, heavy: dict | None = None
) -> DataFrame:
    """One row per message of a known conversation, numbered and labelled in sending order.

    Messages are shuffled once, by conversation; the join to the conversations and both windows use
    that one layout. A conversation with more than `limit` messages is cut along its time line.
    `heavy` names those conversations when the caller has looked already.
    """
    messages = messages.filter(F.col("conversation_id").isNotNull())
    attributes = conversations.select(
        "conversation_id",
        "booking_id",
        "user_id",
        "host_id",
        "property_id",
        F.col("channel").alias("conversation_channel"),
        F.col("status").alias("conversation_status"),
        "csat_score",
    )
    if heavy is None:
        heavy = heavy_conversations(messages, limit)
    scanned = ordered_scan(
        messages.select(
            "message_id",
            "conversation_id",
            "sender_type",
            "sender_id",
            "sent_at",
            "text",
            "intent_category",
            "sentiment_score",
            "sentiment_label",
            "response_latency_seconds",
        ),
        group="conversation_id",
        order=("sent_at", "message_id"),
        heavy=heavy,
        lags=("sent_at", "sender_type"),
        limit=limit,
        dims=attributes,
    )
    came_from = F.coalesce("prev_sender_type", F.lit(""))
    log = scanned.select(
        "message_id",
        "conversation_id",
        "booking_id",
        "user_id",
        "host_id",
        "property_id",
        "conversation_channel",
        "conversation_status",
        "csat_score",
        "sender_type",
        "sender_id",
        "sent_at",
        "text",
        "intent_category",
        "sentiment_score",
        "sentiment_label",
        "response_latency_seconds",
        F.col("position").alias("message_seq"),
        F.col("prev_sent_at").alias("prev_message_sent_at"),
        "prev_sender_type",
        F.col("group_rows").alias("conversation_message_count"),
        (F.col("position") == 1).alias("is_first_message"),
        (F.col("position") == F.col("group_rows")).alias("is_last_message"),
        seconds_between("prev_sent_at", "sent_at").alias("seconds_since_prev_message"),
        ((F.col("sender_type") == SUPPORT) & (came_from != SUPPORT)).alias("is_escalation_handoff"),
    )
    return log.withColumn("event_label", event_label())
