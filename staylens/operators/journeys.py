"""Conversation grain: one journey per conversation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators.messages import conversation_log, heavy_conversations, is_delayed, seconds_between
from staylens.sources.schemas import EXIT_INTENTS

CONVERSATION_KEYS = ["conversation_id", "booking_id", "user_id", "host_id", "property_id"]
# Constant within a conversation. Grouping by them, rather than picking any value, keeps text out
# of the aggregation buffers, so the counts run as a hash aggregation.
CONVERSATION_ATTRIBUTES = ["conversation_channel", "conversation_status", "csat_score"]
CHUNK_MESSAGES = 100_000
ARROW = " -> "
Fold = Callable[[str], Column]
OPENED = "opened_by_guest"


def _joined(column: str, order: str) -> Column:
    return F.expr(f"listagg({column}, '{ARROW}') WITHIN GROUP (ORDER BY {order})")


# Both texts of a journey come from one list, which is gathered and sorted once; counts tell a text without labels.
_TEXTS = {"events": "event_label", "moods": "sentiment_label"}


def _gathered() -> list[Column]:
    said = F.collect_list(F.struct("message_seq", *_TEXTS.values())).alias("_said")
    return [said, *[F.count(label).alias(f"_{text}") for text, label in _TEXTS.items()]]


def _with_texts(gathered: DataFrame) -> DataFrame:
    """The gathered labels as texts, nulls left out, null where there is no label."""
    texts = {t: F.when(F.col(f"_{t}") > 0, F.array_join(F.col(f"_said.{label}"), ARROW)) for t, label in _TEXTS.items()}
    return gathered.withColumn("_said", F.sort_array("_said")).withColumns(texts).drop("_said")


def _known(column: str) -> Column:
    return F.any_value(column, ignoreNulls=True)


def _chunk(messages: int) -> Column:
    return F.floor((F.col("message_seq") - 1) / messages)


def _journey(add: Fold, least: Fold, most: Fold, known: Fold, joined: Fold) -> list[Column]:
    """The columns of a journey from those of its chunks, folded by the functions given."""
    labels = add("_events")
    opened_only = (most("opened") == 1) & (labels == 1)
    return [
        known("intent").alias("conversation_primary_intent"),
        most("messages").alias("conversation_message_count"),
        least("started").alias("conversation_started_at"),
        most("ended").alias("conversation_ended_at"),
        joined("events").alias("event_journey"),
        joined("moods").alias("sentiment_label_journey"),
        (add("sentiment_sum") / F.nullif(add("sentiment_n"), F.lit(0))).alias("avg_sentiment_score"),
        most("opening").alias("opening_sentiment"),
        most("closing").alias("closing_sentiment"),
        add("negatives").alias("negative_msg_count"),
        add("handoffs").alias("escalation_handoff_count"),
        add("delays").alias("delayed_reply_count"),
        most("exit_raised").alias("raised_cancellation_or_refund"),
        (add("latency_sum") / F.nullif(add("latency_n"), F.lit(0))).alias("avg_response_latency_seconds"),
        # Same value as event_journey = 'opened_by_guest', without building the text.
        F.when(labels > 0, opened_only).alias("is_unanswered_opening"),
    ]


def conversation_journeys(log: DataFrame, chunk_messages: int | None = CHUNK_MESSAGES) -> DataFrame:
    """Collapse the log to one row per conversation.

    Messages are folded in chunks of consecutive positions and the chunks are then folded per
    conversation, so a conversation of any length is read by many tasks. Without `chunk_messages` each
    conversation is one chunk, which is for a log whose conversations all fit one task, as
    `fold_in_chunks` tells. Where the log is already laid out by conversation no step moves data. The
    two journey texts are whole at any length; one beyond what a cell of Spark can hold fails the task.
    `journey_parts` holds the same in bounded cells.
    """
    exit_intent = F.col("intent_category").isin(EXIT_INTENTS)
    keys = [*CONVERSATION_KEYS, *CONVERSATION_ATTRIBUTES]
    chunk = [] if chunk_messages is None else [_chunk(chunk_messages).alias("_chunk")]
    folded = log.groupBy(*keys, *chunk).agg(
        _known("intent_category").alias("intent"),
        F.max("conversation_message_count").alias("messages"),
        F.min("sent_at").alias("started"),
        F.max("sent_at").alias("ended"),
        *_gathered(),
        F.max(F.when(F.col("is_first_message") & (F.col("event_label") == OPENED), 1).otherwise(0)).alias("opened"),
        F.sum("sentiment_score").alias("sentiment_sum"),
        F.count("sentiment_score").alias("sentiment_n"),
        F.max(F.when(F.col("is_first_message"), F.col("sentiment_score"))).alias("opening"),
        F.max(F.when(F.col("is_last_message"), F.col("sentiment_score"))).alias("closing"),
        F.sum(F.when(F.col("sentiment_label") == "negative", 1).otherwise(0)).alias("negatives"),
        F.sum(F.col("is_escalation_handoff").cast("int")).alias("handoffs"),
        F.sum(F.when(is_delayed(), 1).otherwise(0)).alias("delays"),
        F.max(F.when(exit_intent, 1).otherwise(0)).alias("exit_raised"),
        F.sum("response_latency_seconds").alias("latency_sum"),
        F.count("response_latency_seconds").alias("latency_n"),
    )
    chunks = _with_texts(folded)
    if chunk_messages is None:
        journeys = chunks.select(*keys, *_journey(F.col, F.col, F.col, F.col, F.col))
    else:
        journeys = chunks.groupBy(*keys).agg(*_journey(F.sum, F.min, F.max, _known, lambda c: _joined(c, "_chunk")))
    return journeys.withColumns(
        {
            "duration_seconds": seconds_between("conversation_started_at", "conversation_ended_at"),
            "sentiment_delta": F.col("closing_sentiment") - F.col("opening_sentiment"),
        }
    )


def fold_in_chunks(heavy: dict) -> int | None:
    """How to fold a log, given the conversations with too many messages for one task."""
    return CHUNK_MESSAGES if heavy else None


def journey_parts(log: DataFrame, chunk_messages: int = CHUNK_MESSAGES) -> DataFrame:
    """The journey texts of all conversations as numbered parts of bounded size.

    Joining the parts of a conversation in order with the same arrow gives its whole text.
    """
    parts = log.groupBy("conversation_id", (_chunk(chunk_messages) + 1).alias("part")).agg(F.count("*").alias("messages"), *_gathered())
    texts = _with_texts(parts)
    return texts.select(
        "conversation_id", "part", "messages", F.col("events").alias("event_journey"), F.col("moods").alias("sentiment_label_journey")
    )


def recent_journeys(
    messages: DataFrame, conversations: DataFrame, months: int = 12, limit: int | None = None
) -> DataFrame:
    """Journeys that started within `months` of the latest start, built from the raw tables.

    A pass over two message columns finds every start. Older messages are then cut off at the scan
    and older conversations dropped before the log is built. A conversation that began before the
    cut is dropped whole, so the remaining ones are complete.
    """
    starts = messages.groupBy("conversation_id").agg(F.min("sent_at").alias("_started"))
    timed = conversations.join(starts, "conversation_id")
    bound = timed.agg((F.max("_started") - F.expr(f"INTERVAL '{months}' MONTH")).alias("cut"))
    heavy = heavy_conversations(messages, limit)
    if heavy:
        # Cutting heavy conversations reads the messages several times: settle the bound first.
        latest = bound.first()["cut"]
        cut = F.lit(None if latest is None else str(latest)).cast(messages.schema["sent_at"].dataType)
    else:
        cut = bound.scalar()
    log = conversation_log(
        messages.filter(F.col("sent_at") >= cut),
        timed.filter(F.col("_started") >= cut),
        limit=limit,
        heavy=heavy,
    )
    return conversation_journeys(log, fold_in_chunks(heavy))
