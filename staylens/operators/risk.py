"""Cancellation risk of confirmed bookings, and the conversations behind the riskiest ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.ordering import percent_ranks
from staylens.functions.skew import heavy_keys, salted_join
from staylens.sources.schemas import EXIT_INTENTS

# Weight of each signal in the score, in the order the terms are added.
RISK_WEIGHTS = {
    "sig_cancel_intent": 0.25,
    "sig_negative_sentiment": 0.20,
    "sig_pct_negative_msgs": 0.15,
    "sig_low_csat": 0.15,
    "sig_escalated": 0.10,
    "sig_slow_first_response": 0.05,
    "sig_slow_resolution": 0.05,
    "sig_slow_msg_latency": 0.05,
}
TOP_DECILE = 0.10
SPEED_SIGNALS = {
    "sig_slow_first_response": "avg_first_response_time_seconds",
    "sig_slow_resolution": "avg_resolution_time_seconds",
    "sig_slow_msg_latency": "avg_msg_response_latency_seconds",
}
# Averages differ in their last bits with the order of the sums. Scores are compared at this
# precision, so that equal bookings stay tied however the rows were spread.
SCORE_PLACES = 10


def message_signals(messages: DataFrame) -> DataFrame:
    """Sentiment and speed per conversation, aggregated before any join."""
    return messages.groupBy("conversation_id").agg(
        F.avg("sentiment_score").alias("avg_sentiment_score"),
        F.avg(F.when(F.col("sentiment_label") == "negative", 1.0).otherwise(0.0)).alias("pct_negative_messages"),
        F.avg("response_latency_seconds").alias("avg_msg_response_latency_seconds"),
    )


def conversation_signals(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Per booking: unweighted averages over its conversations, and whether any raised an exit or escalated."""
    linked = conversations.filter(F.col("booking_id").isNotNull())
    return (
        linked.join(message_signals(messages), "conversation_id", "left")
        .groupBy("booking_id")
        .agg(
            F.count("*").alias("conversation_count"),
            F.max(F.when(F.col("intent_category").isin(EXIT_INTENTS), 1).otherwise(0)).alias(
                "has_cancellation_or_refund_intent"
            ),
            F.max(F.when(F.col("status") == "escalated", 1).otherwise(0)).alias("has_escalated_conversation"),
            F.avg("csat_score").alias("avg_csat_score"),
            F.avg("first_response_time_seconds").alias("avg_first_response_time_seconds"),
            F.avg("resolution_time_seconds").alias("avg_resolution_time_seconds"),
            F.avg("avg_sentiment_score").alias("avg_sentiment_score"),
            F.avg("pct_negative_messages").alias("pct_negative_messages"),
            F.avg("avg_msg_response_latency_seconds").alias("avg_msg_response_latency_seconds"),
        )
    )


def booking_signals(bookings: DataFrame, conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Confirmed bookings with their signals. Counts and flags default to 0, averages stay null."""
    confirmed = bookings.filter(F.col("status") == "confirmed").select(
        "booking_id", "user_id", "property_id", "host_id", "checkin_date", "checkout_date", "total_price"
    )
    counts = ["conversation_count", "has_cancellation_or_refund_intent", "has_escalated_conversation"]
    return confirmed.join(conversation_signals(conversations, messages), "booking_id", "left").fillna(0, subset=counts)


def booking_cancellation_risk(
    bookings: DataFrame,
    conversations: DataFrame,
    messages: DataFrame,
    weights: dict[str, float] | None = None,
    null_signal: str = "last",
    limit: int | None = None,
) -> DataFrame:
    """Score every confirmed booking from 0 to 1, rank it and flag the top decile.

    `null_signal` says how a booking without a measured speed counts: "last" ranks it behind every
    measured one, "neutral" gives it 0.
    """
    if null_signal not in ("last", "neutral"):
        raise ValueError(f"null_signal must be 'last' or 'neutral', not {null_signal!r}")
    weights = weights or RISK_WEIGHTS
    total = bookings.filter(F.col("status") == "confirmed").count()
    zero = F.lit(0.0)
    signals = booking_signals(bookings, conversations, messages).withColumns(
        {
            "sig_cancel_intent": F.col("has_cancellation_or_refund_intent").cast("double"),
            "sig_escalated": F.col("has_escalated_conversation").cast("double"),
            "sig_negative_sentiment": F.coalesce(1 - (F.col("avg_sentiment_score") + 1) / 2, zero),
            "sig_pct_negative_msgs": F.coalesce("pct_negative_messages", zero),
            "sig_low_csat": F.coalesce((5 - F.col("avg_csat_score")) / 4, zero),
        }
    )
    ranked = percent_ranks(
        signals, "booking_id", {sig: (avg, False) for sig, avg in SPEED_SIGNALS.items()}, total, limit
    )
    if null_signal == "neutral":
        ranked = ranked.withColumns(
            {sig: F.when(F.col(avg).isNotNull(), F.col(sig)).otherwise(zero) for sig, avg in SPEED_SIGNALS.items()}
        )
    score = sum((F.col(sig) * weight for sig, weight in weights.items()), start=zero)
    scored = ranked.withColumn("cancellation_risk_score", F.round(score, SCORE_PLACES))
    return percent_ranks(
        scored, "booking_id", {"risk_percentile": ("cancellation_risk_score", True)}, total, limit
    ).withColumn("is_top_risk_decile", F.col("risk_percentile") <= TOP_DECILE)


def at_risk_conversations(risk: DataFrame, conversations: DataFrame, limit: int | None = None) -> DataFrame:
    """Conversations of the bookings in the top decile, with the booking's score."""
    top = risk.filter("is_top_risk_decile").select("booking_id", "cancellation_risk_score", "risk_percentile")
    heavy = heavy_keys(conversations, "booking_id", limit=limit)["booking_id"]
    return salted_join(conversations, top, "booking_id", F.col("conversation_id"), heavy, limit=limit)


def at_risk_concerns(at_risk: DataFrame, top: int = 5) -> DataFrame:
    """The intents most often raised in at-risk conversations. Ties on the last rank are all kept.

    The windows see one row per intent.
    """
    counts = at_risk.groupBy("intent_category").agg(F.count("*").alias("conversation_count"))
    everything = Window.partitionBy()
    return (
        counts.withColumns(
            {
                "pct_of_at_risk_conversations": F.col("conversation_count") / F.sum("conversation_count").over(everything),
                "concern_rank": F.rank().over(Window.orderBy(F.desc("conversation_count"))).cast("bigint"),
            }
        )
        .filter(F.col("concern_rank") <= top)
        .orderBy("concern_rank", "intent_category")
    )
