"""Dashboard extracts: reshaped marts, monthly profiles and the drill-down set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.numeric import count_where
from staylens.functions.pin import pin
from staylens.functions.skew import salted_join
from staylens.operators.messages import conversation_log

HIGH_RISK = 200
TYPICAL = 50
SEED = 42
COHORT = ["month", "channel", "loyalty_tier"]


def stage_value(by_stage: DataFrame) -> DataFrame:
    return by_stage.select(
        *COHORT,
        F.col("journey_stage").alias("stage"),
        "bookings",
        "cancelled_bookings",
        "total_price",
        "cancelled_price",
    ).orderBy(*COHORT, "stage")


def intent_value(by_intent: DataFrame) -> DataFrame:
    return by_intent.select(
        *COHORT,
        "intent_category",
        F.col("topic_cluster").alias("cluster"),
        "bookings",
        "cancelled_bookings",
        "total_price",
        "cancelled_price",
    ).orderBy(*COHORT, "intent_category")


def stage_volume(by_stage: DataFrame) -> DataFrame:
    return stage_value(by_stage).drop("total_price", "cancelled_price")


def cohort_totals(by_stage: DataFrame) -> DataFrame:
    return (
        by_stage.groupBy(*COHORT)
        .agg(
            F.sum("bookings").cast("bigint").alias("bookings"),
            F.sum("cancelled_bookings").cast("bigint").alias("cancelled_bookings"),
        )
        .orderBy(*COHORT)
    )


def pattern_impact(by_pattern: DataFrame) -> DataFrame:
    return by_pattern.select(
        *COHORT, F.col("event_pattern").alias("category"), "bookings", "cancelled_bookings", "cancelled_price"
    ).orderBy(*COHORT, "category")


def _message_band() -> Column:
    n = F.col("conversation_message_count")
    return F.when(n <= 1, "1").when(n <= 3, "2–3").when(n <= 6, "4–6").when(n <= 10, "7–10").otherwise("11+")


def profile_dimensions() -> dict[str, Column]:
    return {
        "booking_outcome": F.col("booking_status"),
        "primary_intent": F.col("conversation_primary_intent"),
        "channel": F.col("conversation_channel"),
        "loyalty_tier": F.col("loyalty_tier"),
        "csat": F.coalesce(F.concat(F.col("csat_score").cast("string"), F.lit(" / 5")), F.lit("—")),
        "messages": _message_band(),
    }


def conversation_profile(events: DataFrame) -> DataFrame:
    """Conversations per month and value of six dimensions, from one pass over all events.

    The rows are counted per full combination first; only those counts are turned to long form.
    """
    dims = profile_dimensions()
    combined = events.groupBy(F.col("activity_month").alias("month"), *[c.alias(d) for d, c in dims.items()]).agg(
        F.count("*").alias("n")
    )
    long = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dims])
    return (
        combined.select("month", "n", F.inline(long))
        .groupBy("dimension", "month", "value")
        .agg(F.sum("n").cast("bigint").alias("count"))
        .orderBy("dimension", "month", "value")
    )


def monthly_totals(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.col("activity_month").alias("month"))
        .agg(
            F.count("*").alias("conversations"),
            count_where(F.col("booking_status") == "cancelled").alias("cancelled"),
            F.sum(F.coalesce(F.col("csat_score").cast("bigint"), F.lit(0))).alias("csat_sum"),
            F.count("csat_score").alias("csat_count"),
            F.sum("conversation_message_count").cast("bigint").alias("msg_sum"),
        )
        .orderBy("month")
    )


def high_risk(events: DataFrame, risk: DataFrame, n: int = HIGH_RISK, heavy: dict | None = None) -> DataFrame:
    """The n conversations on the riskiest confirmed bookings; ties go to the lower id."""
    scores = risk.select("booking_id", "cancellation_risk_score")
    candidates = events.select("conversation_id", "booking_id")
    return (
        salted_join(candidates, scores, "booking_id", F.col("conversation_id"), heavy or {})
        .orderBy(F.desc("cancellation_risk_score"), "conversation_id")
        .limit(n)
        .select("conversation_id", "cancellation_risk_score")
    )


def sample_rank(column: str, seed: int = SEED) -> Column:
    """A sampling key that depends on the id and the seed alone, not on where the row is stored."""
    return F.md5(F.concat(F.col(column).cast("string"), F.lit(f"_{seed}")))


def typical(events: DataFrame, excluded: DataFrame, n: int = TYPICAL, seed: int = SEED) -> DataFrame:
    """A stable sample of n conversations outside `excluded`, which holds at most a few hundred ids."""
    rest = events.select("conversation_id").join(
        F.broadcast(excluded.select("conversation_id")), "conversation_id", "left_anti"
    )
    return rest.orderBy(sample_rank("conversation_id", seed), "conversation_id").limit(n)


def drill_down_selection(
    events: DataFrame, risk: DataFrame, high: int = HIGH_RISK, sample: int = TYPICAL, heavy: dict | None = None
) -> DataFrame:
    """conversation_id and tag of the drill-down set: at most high + sample rows.

    The risky half is pinned, since both the result and the exclusion read it.
    """
    risky = pin(high_risk(events, risk, high, heavy).select("conversation_id"))
    calm = typical(events, risky, sample)
    return risky.withColumn("tag", F.lit("high_risk")).unionByName(calm.withColumn("tag", F.lit("typical")))


def _chosen(selection: DataFrame) -> DataFrame:
    return F.broadcast(selection.select("conversation_id").distinct())


def drill_down_meta(events: DataFrame, selection: DataFrame) -> DataFrame:
    return (
        events.select(
            "conversation_id",
            "booking_id",
            F.col("conversation_channel").alias("channel"),
            F.col("conversation_status").alias("convo_status"),
            "csat_score",
            F.col("conversation_primary_intent").alias("primary_intent"),
            "booking_status",
            "loyalty_tier",
            F.col("activity_month").alias("month"),
        )
        .join(_chosen(selection), "conversation_id", "left_semi")
        .orderBy("conversation_id")
    )


def _message_lines(log: DataFrame) -> DataFrame:
    return log.select(
        "conversation_id",
        "message_seq",
        "sender_type",
        F.substring(F.col("sent_at").cast("string"), 1, 19).alias("sent_at"),
        "text",
        "sentiment_label",
        "event_label",
    ).orderBy("conversation_id", "message_seq")


def drill_down_messages(log: DataFrame, selection: DataFrame) -> DataFrame:
    """The log lines of the chosen conversations, from the stored log."""
    return _message_lines(log.join(_chosen(selection), "conversation_id", "left_semi"))


def drill_down_messages_from_raw(
    messages: DataFrame, conversations: DataFrame, selection: DataFrame, limit: int | None = None
) -> DataFrame:
    """The same lines without a stored log: only the chosen conversations are numbered."""
    chosen = _chosen(selection)
    return _message_lines(
        conversation_log(
            messages.join(chosen, "conversation_id", "left_semi"),
            conversations.join(chosen, "conversation_id", "left_semi"),
            limit=limit,
        )
    )


def drill_down_tags(selection: DataFrame) -> DataFrame:
    return (
        selection.groupBy(F.col("conversation_id").cast("string").alias("conversation_id"))
        .agg(F.sort_array(F.collect_set("tag")).alias("tags"))
        .orderBy("conversation_id")
    )
