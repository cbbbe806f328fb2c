import frames as f
import pytest
from pyspark.sql import functions as F

from staylens.operators import risk


def sources(spark):
    bookings = f.bookings(
        spark,
        f.booking(1),
        f.booking(2),
        f.booking(3),  # no conversation
        f.booking(4, "cancelled"),
        f.booking(5),  # conversation without messages
        f.booking(6),  # no conversation
    )
    conversations = f.conversations(
        spark,
        f.conversation(10, 1, intent="refund_request", csat=1, status="escalated", first_response=300, resolution=9000),
        f.conversation(11, 1, csat=None, first_response=100, resolution=1000),
        f.conversation(20, 2, csat=5, first_response=50, resolution=500),
        f.conversation(40, 4),
        f.conversation(50, 5, csat=3, first_response=400, resolution=100),
        f.conversation(60, None),
    )
    messages = f.messages(
        spark,
        f.talk(10, ("guest", 0, -0.8), ("host", 60, -0.4)),
        f.talk(11, ("guest", 0, 0.5), ("host", 60, 0.0), ("guest", 90, -0.5), ("host", 95, 0.0)),
        f.talk(20, ("guest", 0, 0.9)),
    )
    return bookings, conversations, messages


def test_signals_average_conversations_not_messages(spark):
    row = risk.booking_signals(*sources(spark)).filter("booking_id = 1").first()
    assert row.conversation_count == 2
    assert (row.has_cancellation_or_refund_intent, row.has_escalated_conversation) == (1, 1)
    assert row.avg_csat_score == 1.0 and row.avg_first_response_time_seconds == 200.0
    assert abs(row.avg_sentiment_score - (-0.6 + 0.0) / 2) < 1e-12
    assert abs(row.pct_negative_messages - (1.0 + 0.25) / 2) < 1e-12


def test_bookings_without_conversations_keep_null_averages(spark):
    rows = {r.booking_id: r for r in risk.booking_signals(*sources(spark)).collect()}
    assert sorted(rows) == [1, 2, 3, 5, 6]
    assert (rows[3].conversation_count, rows[3].has_escalated_conversation, rows[3].avg_csat_score) == (0, 0, None)
    assert rows[5].conversation_count == 1 and rows[5].avg_sentiment_score is None


def test_speed_ranks_put_unmeasured_bookings_last(spark):
    rows = {r.booking_id: r for r in risk.booking_cancellation_risk(*sources(spark)).collect()}
    assert [rows[b].sig_slow_first_response for b in (2, 1, 5)] == [0.0, 0.25, 0.5]
    assert rows[3].sig_slow_first_response == rows[6].sig_slow_first_response == 0.75


def test_neutral_signal(spark):
    rows = {r.booking_id: r for r in risk.booking_cancellation_risk(*sources(spark), null_signal="neutral").collect()}
    assert rows[3].sig_slow_first_response == 0.0 and rows[3].cancellation_risk_score == 0.0
    assert rows[5].sig_slow_first_response == 0.5
    with pytest.raises(ValueError):
        risk.booking_cancellation_risk(*sources(spark), null_signal="first")


def test_score_is_the_weighted_sum(spark):
    row = risk.booking_cancellation_risk(*sources(spark)).filter("booking_id = 1").first()
    # Medians: second of four measured first responses, last of three latencies and so on.
    speed = row.sig_slow_first_response + row.sig_slow_resolution + row.sig_slow_msg_latency
    want = 0.25 + 0.20 * 0.65 + 0.15 * 0.625 + 0.15 * 1.0 + 0.10 + 0.05 * speed
    assert abs(row.cancellation_risk_score - want) < 1e-9
    assert row.risk_percentile == 0.0 and row.is_top_risk_decile


def test_own_weights(spark):
    rows = risk.booking_cancellation_risk(*sources(spark), weights={"sig_escalated": 1.0})
    assert {r.booking_id: r.cancellation_risk_score for r in rows.collect()} == {1: 1.0, 2: 0.0, 3: 0.0, 5: 0.0, 6: 0.0}


def test_splitting_does_not_change_the_scores(spark):
    whole = risk.booking_cancellation_risk(*sources(spark))
    assert f.same(risk.booking_cancellation_risk(*sources(spark), limit=2), whole)


def test_at_risk_conversations_carry_the_score(spark):
    bookings, conversations, messages = sources(spark)
    scores = risk.booking_cancellation_risk(bookings, conversations, messages)
    rows = risk.at_risk_conversations(scores, conversations).collect()
    assert sorted(r.conversation_id for r in rows) == [10, 11]
    assert {r.risk_percentile for r in rows} == {0.0}
    assert f.same(
        risk.at_risk_conversations(scores, conversations, limit=1), risk.at_risk_conversations(scores, conversations)
    )


def test_ties_on_the_last_rank_are_kept(spark):
    counts = {"a": 9, "b": 8, "c": 7, "d": 6, "e": 2, "f": 2, "g": 2, "h": 1}
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "intent_category string")
    rows = risk.at_risk_concerns(df).collect()
    assert [(r.intent_category, r.concern_rank) for r in rows] == [
        ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 5), ("g", 5),
    ]
    assert abs(rows[0].pct_of_at_risk_conversations - 9 / 37) < 1e-12


def test_tied_scores_share_the_percentile(spark):
    bookings = f.bookings(spark, *[f.booking(i) for i in range(30)])
    conversations = f.conversations(spark, *[f.conversation(i, i, status="escalated") for i in range(5)])
    messages = f.messages(spark, *[f.talk(i, ("guest", 0, 0.0)) for i in range(5)])
    flagged = risk.booking_cancellation_risk(bookings, conversations, messages).filter("is_top_risk_decile")
    # A tenth of 30 is 3, but five bookings tie for the lead.
    assert flagged.count() == 5 and flagged.agg(F.max("risk_percentile")).first()[0] == 0.0
