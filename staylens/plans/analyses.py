"""Published analyses: where journeys turn, which patterns cost bookings, and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.numeric import count_where, money, money_sum, percent, share
from staylens.functions.ordering import tile_at
from staylens.functions.skew import salted_join
from staylens.operators.loss import month_of
from staylens.sources.schemas import EVENT_PATTERNS, EXIT_INTENTS, JOURNEY_STAGES

QUARTERS = len(JOURNEY_STAGES)


def conversation_quarters(log: DataFrame) -> DataFrame:
    """Message sums per conversation and quarter of the conversation.

    The quarter follows from the position and length already in the log, and the sums are taken per
    conversation first: at most four rows each go into any later join.
    """
    score = F.col("sentiment_score")
    negative = F.col("sentiment_label") == "negative"
    return (
        log.withColumn("quarter", tile_at(F.col("message_seq"), F.col("conversation_message_count"), QUARTERS))
        .groupBy("conversation_id", "booking_id", "quarter")
        .agg(
            F.count("*").alias("n"),
            F.count(score).alias("scored"),
            F.sum(score).alias("score_sum"),
            F.sum(score * score).alias("score_square_sum"),
            F.sum(F.when(negative, 1).otherwise(0)).alias("negatives"),
            F.sum("response_latency_seconds").alias("latency_sum"),
            F.count("response_latency_seconds").alias("latency_n"),
            F.sum(F.when(F.col("intent_category").isin(EXIT_INTENTS), 1).otherwise(0)).alias("exits"),
        )
    )


def _stage_name(quarter: str) -> Column:
    return F.get(F.array(*[F.lit(s) for s in JOURNEY_STAGES]), F.col(quarter).cast("int") - 1)


def _with_risk(quarters: DataFrame, risk: DataFrame, heavy: dict | None) -> DataFrame:
    scores = risk.select("booking_id", "cancellation_risk_score", "is_top_risk_decile")
    return salted_join(quarters, scores, "booking_id", F.col("conversation_id"), heavy or {})


def stage_impact(log: DataFrame, risk: DataFrame, heavy: dict | None = None) -> DataFrame:
    """Sentiment, speed and risk by quarter of the conversation, confirmed bookings only."""
    rows = _with_risk(conversation_quarters(log), risk, heavy)
    top = F.col("is_top_risk_decile")
    y = F.col("cancellation_risk_score")

    def total(value: str | Column, where: Column | None = None) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return F.sum(value if where is None else F.when(where, value)).cast("double")

    n, sx, sxx = total("scored"), total("score_sum"), total("score_square_sum")
    sy, syy, sxy = total(F.col("scored") * y), total(F.col("scored") * y * y), total(F.col("score_sum") * y)
    spread = F.sqrt(F.greatest(n * sxx - sx * sx, F.lit(0.0)) * F.greatest(n * syy - sy * sy, F.lit(0.0)))
    return (
        rows.groupBy(_stage_name("quarter").alias("stage_label"))
        .agg(
            F.sum("n").cast("bigint").alias("message_count"),
            F.count("*").alias("conversation_count"),
            share(sx, n).alias("avg_sentiment_score"),
            share(total("negatives"), total("n")).alias("pct_negative_messages"),
            share(total("latency_sum"), total("latency_n")).alias("avg_response_latency_seconds"),
            share(n * sxy - sx * sy, spread).alias("corr_sentiment_vs_risk"),
            share(total("score_sum", top), total("scored", top)).alias("avg_sentiment_in_top_risk_decile"),
            share(total("score_sum", ~top), total("scored", ~top)).alias("avg_sentiment_not_top_risk_decile"),
            share(total("negatives", top), total("n", top)).alias("pct_negative_in_top_risk_decile"),
            share(total("exits"), total("n")).alias("pct_cancel_refund_intent"),
        )
        .orderBy("stage_label")
    )


def first_negative_stage(log: DataFrame, risk: DataFrame, heavy: dict | None = None) -> DataFrame:
    """Conversations by the quarter of their first negative message, with the average risk."""
    first = (
        conversation_quarters(log)
        .filter(F.col("negatives") > 0)
        .groupBy("conversation_id", "booking_id")
        .agg(F.min("quarter").alias("quarter"))
    )
    return (
        _with_risk(first, risk, heavy)
        .groupBy(_stage_name("quarter").alias("stage_label"))
        .agg(
            F.count("*").alias("conversations"),
            F.avg("cancellation_risk_score").alias("avg_cancellation_risk_score"),
        )
        .orderBy("stage_label")
    )


def top_risk_bookings(
    risk: DataFrame, conversations: DataFrame, n: int = 10, heavy: dict | None = None
) -> DataFrame:
    """The riskiest bookings with each of their conversations, one line per conversation."""
    threads = conversations.select(
        "conversation_id",
        "booking_id",
        F.col("intent_category").alias("conversation_primary_intent"),
        F.col("status").alias("conversation_status"),
    )
    scored = risk.select(
        "booking_id",
        "user_id",
        "property_id",
        "host_id",
        "checkin_date",
        "checkout_date",
        "total_price",
        "conversation_count",
        "has_cancellation_or_refund_intent",
        "has_escalated_conversation",
        "avg_csat_score",
        "avg_sentiment_score",
        "pct_negative_messages",
        "avg_first_response_time_seconds",
        "avg_resolution_time_seconds",
        "cancellation_risk_score",
        "risk_percentile",
    )
    return (
        salted_join(threads, scored, "booking_id", F.col("conversation_id"), heavy or {})
        .orderBy(F.desc("cancellation_risk_score"), "booking_id", "conversation_id")
        .limit(n)
    )


def unanswered_opening_cohort(events: DataFrame) -> DataFrame:
    """Distinct bookings by the month of their first conversation in the window, rates as fractions."""
    bookings = events.groupBy("booking_id").agg(
        F.min(month_of("conversation_started_at")).alias("month"),
        F.max(F.col("is_cancelled").cast("int")).alias("cancelled"),
        F.max(F.when(F.col("event_pattern") == "unanswered_opening", 1).otherwise(0)).alias("unanswered"),
    )
    total, lost = F.count("*"), F.sum("cancelled")
    cases = F.sum("unanswered")
    case_lost = F.sum(F.col("unanswered") * F.col("cancelled"))
    return (
        bookings.groupBy("month")
        .agg(
            total.alias("total_bookings_in_cohort"),
            F.round(share(lost, total), 4).alias("cohort_base_cancel_rate"),
            cases.cast("bigint").alias("unanswered_opening_bookings"),
            F.round(share(cases, total), 4).alias("pct_unanswered_opening"),
            case_lost.cast("bigint").alias("unanswered_opening_cancelled"),
            F.round(share(case_lost, cases), 4).alias("unanswered_opening_cancel_rate"),
        )
        .withColumn("cohort_month", F.concat(F.col("month"), F.lit("-01 00:00:00")).cast("timestamp_ntz"))
        .drop("month")
        .orderBy("cohort_month")
    )


def unanswered_opening_queue(events: DataFrame) -> DataFrame:
    """Unanswered openings, most valuable booking first."""
    return (
        events.filter(F.col("event_pattern") == "unanswered_opening")
        .select(
            "booking_id",
            "conversation_id",
            "conversation_channel",
            "total_price",
            F.col("booking_status").alias("status"),
            "conversation_started_at",
        )
        .orderBy(F.desc("total_price"), "conversation_id")
    )


def pattern_lift(events: DataFrame) -> DataFrame:
    """Frequency, cancellation rate and lift over the base rate of each flag. Flags may overlap.

    All counts come from one pass that ends in one row.
    """
    cancelled = F.col("is_cancelled")
    counts = events.agg(
        F.count("*").alias("total"),
        count_where(cancelled).alias("total_lost"),
        *[count_where(F.col(f"flag_{p}")).alias(f"n_{p}") for p in EVENT_PATTERNS],
        *[count_where(F.col(f"flag_{p}") & cancelled).alias(f"lost_{p}") for p in EVENT_PATTERNS],
    )
    each = F.array(
        *[
            F.struct(F.lit(p).alias("pattern"), F.col(f"n_{p}").alias("conversations"), F.col(f"lost_{p}").alias("cancelled"))
            for p in EVENT_PATTERNS
        ]
    )
    rate = share(F.col("cancelled"), F.col("conversations"))
    return counts.select("total", "total_lost", F.inline(each)).select(
        "pattern",
        "conversations",
        "cancelled",
        share(F.col("conversations"), F.col("total")).alias("frequency"),
        rate.alias("cancel_rate"),
        share(rate, share(F.col("total_lost"), F.col("total"))).alias("lift"),
    )


def topic_cluster_rates(events: DataFrame) -> DataFrame:
    lost = count_where(F.col("is_cancelled"))
    counts = events.groupBy("topic_cluster").agg(
        F.count("*").alias("conversations"), lost.alias("cancelled"), share(lost, F.count("*")).alias("cancel_rate")
    )
    # The window sees one row per cluster.
    return counts.withColumn(
        "share_of_conversations", share(F.col("conversations"), F.sum("conversations").over(Window.partitionBy()))
    ).orderBy("topic_cluster")


def time_cuts(events: DataFrame) -> DataFrame:
    """Volume and cancellation rate by quarter, month, weekday (1 = Monday) and hour of the start."""
    at = F.col("conversation_started_at")
    cuts = {
        "quarter": F.concat(F.year(at).cast("string"), F.lit("-Q"), F.quarter(at).cast("string")),
        "month": month_of("conversation_started_at"),
        "weekday": (F.weekday(at) + 1).cast("string"),
        "hour": F.lpad(F.hour(at).cast("string"), 2, "0"),
    }
    # Counted per combination of all four before the long form.
    combined = events.groupBy(*[c.alias(name) for name, c in cuts.items()]).agg(
        F.count("*").alias("n"), count_where(F.col("is_cancelled")).alias("lost")
    )
    long = F.array(*[F.struct(F.lit(name).alias("cut"), F.col(name).alias("bucket")) for name in cuts])
    return (
        combined.select("n", "lost", F.inline(long))
        .groupBy("cut", "bucket")
        .agg(
            F.sum("n").cast("bigint").alias("conversations"),
            F.sum("lost").cast("bigint").alias("cancelled"),
            percent(F.sum("lost"), F.sum("n"), 2).alias("cancellation_rate_pct"),
        )
        .orderBy("cut", "bucket")
    )


def loss_concentration(quintiles: DataFrame) -> DataFrame:
    """Each price group's share of the value lost. The window sees one row per group."""
    lost = F.col("revenue_lost_to_cancellation")
    return quintiles.select(
        "price_quintile",
        lost,
        share(lost, F.sum(money(lost)).over(Window.partitionBy())).alias("share_of_revenue_lost"),
    ).orderBy("price_quintile")


def risk_kpis(risk: DataFrame) -> DataFrame:
    """Confirmed bookings, share flagged and average score by check-in month."""
    flagged = count_where(F.col("is_top_risk_decile"))
    return (
        risk.groupBy(month_of("checkin_date").alias("month"))
        .agg(
            F.count("*").alias("bookings"),
            flagged.alias("top_decile_bookings"),
            percent(flagged, F.count("*"), 2).alias("pct_top_decile"),
            F.avg("cancellation_risk_score").alias("avg_risk_score"),
            money_sum("total_price").alias("total_price"),
        )
        .orderBy("month")
    )


def message_volume_by_intent(messages: DataFrame) -> DataFrame:
    return (
        messages.groupBy("intent_category")
        .agg(F.count("*").alias("msgs"), F.avg("sentiment_score").alias("avg_sentiment"))
        .orderBy(F.desc("msgs"), "intent_category")
    )


def chat_experience(conversations: DataFrame) -> DataFrame:
    def rounded_avg(column: str, places: int) -> Column:
        value = F.col(column).cast("decimal(18,0)")
        return F.round(F.sum(value) / F.nullif(F.count(value).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)")), places).cast("double")

    return (
        conversations.groupBy("channel", "intent_category")
        .agg(
            F.count("*").alias("conversations"),
            rounded_avg("csat_score", 2).alias("avg_csat"),
            rounded_avg("first_response_time_seconds", 0).alias("avg_first_response_s"),
            percent(count_where(F.col("status") == "escalated"), F.count("*"), 1).alias("pct_escalated"),
        )
        .orderBy(F.desc("conversations"), "channel", "intent_category")
    )
