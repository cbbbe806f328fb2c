from datetime import datetime

import frames as f
import pytest
from pyspark.sql import functions as F

from staylens.operators import loss
from staylens.sources.schemas import EVENT_PATTERNS

JOURNEY = (
    "conversation_id int, booking_id int, user_id int, conversation_channel string, conversation_status string, csat_score int, "
    "conversation_primary_intent string, conversation_message_count bigint, conversation_started_at timestamp_ntz, "
    "opening_sentiment double, closing_sentiment double, negative_msg_count bigint, escalation_handoff_count bigint, "
    "delayed_reply_count bigint, is_unanswered_opening boolean, sentiment_delta double"
)


def journey(id, booking=1, user=1, channel="email", csat=5, intent="general_inquiry", n=3, at=f.START, opening=0.0,
            closing=0.0, negatives=0, handoffs=0, delays=0, unanswered=False, delta=None):
    delta = closing - opening if delta is None else delta
    return (id, booking, user, channel, "resolved", csat, intent, n, at, opening, closing, negatives, handoffs, delays, unanswered, delta)


def journeys(spark, *rows):
    return spark.createDataFrame(list(rows), JOURNEY)


def events_of(spark, *rows, bookings=None, users=None):
    bookings = bookings or f.bookings(spark, f.booking(1, "cancelled", 80.1), f.booking(2, "completed", 20.25))
    return loss.loss_events(journeys(spark, *rows), bookings, users or f.users(spark))


ONE_FLAG = {
    "unanswered_opening": dict(unanswered=True),
    "escalated_support": dict(handoffs=1),
    "delayed_reply": dict(delays=1),
    "ends_frustrated": dict(closing=-0.25, delta=0.0),
    "negative_opening": dict(opening=-0.25, delta=0.0),
    "multiple_negative": dict(negatives=2),
    "sentiment_worsened": dict(delta=-0.31),
    "long_conversation": dict(n=11),
    "low_csat": dict(csat=2),
}


def test_each_pattern_and_no_pattern(spark):
    cases = [*ONE_FLAG.items(), ("escalated_and_delayed", dict(handoffs=1, delays=1)), ("no_pattern", dict(csat=None))]
    rows = [journey(i, **options) for i, (_, options) in enumerate(cases)]
    got = {r.conversation_id: r.event_pattern for r in events_of(spark, *rows).collect()}
    assert got == {i: name for i, (name, _) in enumerate(cases)}


def test_first_pattern_wins(spark):
    everything = dict(unanswered=True, handoffs=1, delays=1, closing=-0.9, opening=-0.5, negatives=3, n=20, csat=1)
    switches = [dict(unanswered=False), dict(delays=0), dict(handoffs=0), dict(), dict(closing=0.0, delta=-0.4),
                dict(opening=0.0, delta=-0.4), dict(negatives=0), dict(delta=0.0), dict(n=3), dict(csat=3)]
    expected = ["unanswered_opening", "escalated_and_delayed", "escalated_support", "ends_frustrated", "ends_frustrated",
                "negative_opening", "multiple_negative", "sentiment_worsened", "long_conversation", "low_csat", "no_pattern"]
    rows, state = [journey(0, **everything)], dict(everything)
    for i, off in enumerate(switches, 1):
        state |= off
        rows.append(journey(i, **state))
    got = [r.event_pattern for r in events_of(spark, *rows).orderBy("conversation_id").collect()]
    assert got == expected


def test_thresholds_are_strict(spark):
    row = events_of(
        spark, journey(1, opening=-0.2, closing=-0.2, delta=-0.3, negatives=1, n=10, csat=3)
    ).first()
    assert row.event_pattern == "no_pattern" and row.journey_stage == "2_early_mid"


@pytest.mark.parametrize(
    "options, stage",
    [
        (dict(negatives=0, opening=-0.9), "4_closing"),
        (dict(negatives=1, opening=-0.21, delta=-0.9), "1_opening"),
        (dict(negatives=1, opening=0.1, delta=-0.31), "3_late_mid"),
        (dict(negatives=1, opening=0.1, delta=-0.3), "2_early_mid"),
    ],
)
def test_journey_stage(spark, options, stage):
    assert events_of(spark, journey(1, **options)).first().journey_stage == stage


def test_topics(spark):
    intents = ["refund_request", "positive_feedback", "cancellation_request"]
    got = events_of(spark, *[journey(i, intent=t) for i, t in enumerate(intents)]).orderBy("conversation_id")
    assert [r.topic_cluster for r in got.collect()] == ["complaint", "praise", "everyday"]


def test_missing_tier_and_missing_parties(spark):
    users = f.users(spark, (1, None), (2, "gold"))
    rows = [journey(1), journey(2, user=2), journey(3, user=9), journey(4, booking=9)]
    got = {r.conversation_id: r.loyalty_tier for r in events_of(spark, *rows, users=users).collect()}
    assert got == {1: "none", 2: "gold"}


def test_a_user_and_booking_with_most_conversations(spark):
    rows = [journey(i, booking=1 if i % 3 else 2, user=1) for i in range(60)]
    plain = events_of(spark, *rows)
    frame = journeys(spark, *rows)
    heavy = loss.heavy_parties(frame, limit=10)
    assert heavy["user_id"] == {1: 60} and set(heavy["booking_id"]) == {1, 2}
    bookings = f.bookings(spark, f.booking(1, "cancelled", 80.1), f.booking(2, "completed", 20.25))
    assert f.same(loss.loss_events(frame, bookings, f.users(spark), heavy), plain)


@pytest.fixture(scope="module")
def mart(spark):
    months = [datetime(2024, m, 3) for m in (1, 2, 3)]
    rows = [
        journey(
            i, booking=i % 40, at=months[i % 3], channel=["email", "sms"][i % 2], unanswered=i % 7 == 0 and i % 3 != 2,
            handoffs=i % 2, negatives=i % 4, opening=(i % 9 - 4) / 10, closing=(i % 5 - 2) / 5, csat=i % 5 + 1,
            intent=["refund_request", "wifi_issue", "positive_feedback"][i % 3],
        )
        for i in range(200)
    ]
    bookings = f.bookings(spark, *[f.booking(b, ["cancelled", "completed"][b % 2], 10.05 + b) for b in range(40)])
    return events_of(spark, *rows, bookings=bookings).cache()


def test_marts_add_up_to_the_events(mart):
    total = mart.agg(
        F.count("*").alias("n"), loss.money_sum("total_price").alias("p"), loss.money_sum("total_price", F.col("is_cancelled")).alias("c")
    ).first()
    for table in (loss.loss_by_stage(mart), loss.complaint_cohort(mart)):
        got = table.agg(F.sum("bookings"), F.round(F.sum("total_price"), 2), F.round(F.sum("cancelled_price"), 2)).first()
        assert tuple(got) == (total.n, total.p, total.c)
    by_pattern = loss.loss_by_month_pattern(mart).agg(F.sum("bookings"), F.round(F.sum("cancelled_price"), 2)).first()
    assert tuple(by_pattern) == (total.n, total.c)
    by_price = loss.price_quintile_risk(mart).agg(F.sum("bookings"), F.round(F.sum("revenue_lost_to_cancellation"), 2)).first()
    assert tuple(by_price) == (total.n, total.c)


def test_price_groups_differ_by_at_most_one(mart):
    for limit in (None, 30):
        table = loss.price_quintile_risk(mart, limit=limit)
        assert [r.bookings for r in table.collect()] == [40] * 5
    assert f.same(loss.price_quintile_risk(mart), loss.price_quintile_risk(mart, limit=30))


def test_month_without_unanswered_openings(mart):
    rows = {r.month: r for r in loss.unanswered_opening_monthly(mart).collect()}
    assert list(rows) == ["2024-01", "2024-02", "2024-03"]
    march = rows["2024-03"]
    assert (march.unanswered_opening_bookings, march.unanswered_opening_cancelled) == (0, 0)
    assert march.pct_unanswered_opening == 0.0 and march.unanswered_opening_cancel_rate_pct is None
    assert rows["2024-01"].unanswered_opening_bookings > 0


def test_patterns_are_exclusive_and_complete(mart):
    assert mart.filter(~F.col("event_pattern").isin([*EVENT_PATTERNS, "no_pattern"])).count() == 0
    first = [F.when(F.col(f"flag_{p}"), F.lit(p)) for p in EVENT_PATTERNS]
    assert mart.filter(F.coalesce(*first, F.lit("no_pattern")) != F.col("event_pattern")).count() == 0
