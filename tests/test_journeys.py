from datetime import datetime, timedelta

import frames as f
from pyspark.sql import functions as F

from staylens.operators.journeys import ARROW, CHUNK_MESSAGES, conversation_journeys, fold_in_chunks, journey_parts, recent_journeys
from staylens.operators.loss import in_trailing_window
from staylens.operators.messages import conversation_log, heavy_conversations


def journeys_of(spark, *talks, threads=None, **options):
    threads = threads or [f.conversation(1)]
    return conversation_journeys(conversation_log(f.messages(spark, *talks), f.conversations(spark, *threads)), **options)


def test_one_row_tells_the_conversation(spark):
    talk = f.talk(
        1, ("guest", 0, -0.5), ("support_agent", 1000, 0.0), ("guest", 1100, -0.3), ("support_agent", 2100, 0.6),
        intent="refund_request",
    )
    row = journeys_of(spark, talk).first()
    assert row.event_journey == (
        "opened_by_guest -> escalated_to_support_delayed -> guest_negative -> escalated_to_support_delayed"
    )
    assert row.sentiment_label_journey == "negative -> neutral -> negative -> positive"
    assert (row.negative_msg_count, row.escalation_handoff_count, row.delayed_reply_count) == (2, 2, 2)
    assert (row.opening_sentiment, row.closing_sentiment) == (-0.5, 0.6)
    assert abs(row.sentiment_delta - 1.1) < 1e-12 and abs(row.avg_sentiment_score + 0.05) < 1e-12
    assert (row.duration_seconds, row.conversation_message_count) == (2100, 4)
    assert (row.raised_cancellation_or_refund, row.conversation_primary_intent) == (1, "refund_request")
    assert row.avg_response_latency_seconds == 90.0


def test_single_message(spark):
    row = journeys_of(spark, f.talk(1, ("guest", 0, 0.4))).first()
    assert row.event_journey == "opened_by_guest" and row.is_unanswered_opening
    assert (row.opening_sentiment, row.closing_sentiment, row.sentiment_delta) == (0.4, 0.4, 0.0)
    assert (row.duration_seconds, row.delayed_reply_count) == (0, 0)


def test_null_labels_are_skipped_but_counted(spark):
    row = journeys_of(spark, f.talk(1, ("guest", 0, 0.0), ("robot", 5, 0.0), ("host", 9, 0.0))).first()
    assert row.event_journey == "opened_by_guest -> host_reply" and row.conversation_message_count == 3


def test_whole_and_chunked_folds_agree(spark):
    talks = [f.talk(c, *[(("guest", "host", "support_agent", "robot")[(c + i) % 4], 700 * i, 0.3 * ((c * i) % 5) - 0.6) for i in range(c)]) for c in range(1, 9)]
    talked = f.messages(spark, *talks)
    # Conversations whose labels are all missing.
    talked = talked.withColumn("sentiment_label", F.when(F.col("conversation_id") > 2, F.col("sentiment_label")))
    talked = talked.withColumn("sender_type", F.when(F.col("conversation_id") != 4, F.col("sender_type")))
    log = conversation_log(talked, f.conversations(spark, *[f.conversation(c) for c in range(1, 9)]))
    columns = sorted(conversation_journeys(log).columns)
    whole, *chunked = [sorted(map(str, conversation_journeys(log, n).select(*columns).collect())) for n in (None, 100, 3, 1)]
    assert len(whole) == 8 and all(c == whole for c in chunked)
    rows = {r.conversation_id: r for r in conversation_journeys(log, None).collect()}
    assert rows[1].sentiment_label_journey is None and rows[4].event_journey is None and rows[3].sentiment_label_journey


def test_chunks_only_where_a_conversation_is_heavy(spark):
    talked = f.messages(spark, f.talk(1, *[("guest", i, 0.0) for i in range(9)]), f.talk(2, ("guest", 0, 0.0)))
    assert fold_in_chunks(heavy_conversations(talked, limit=5)) == CHUNK_MESSAGES
    assert fold_in_chunks(heavy_conversations(talked, limit=10)) is None


def test_unanswered_flag_equals_the_journey_text(spark):
    talks = [
        f.talk(1, ("guest", 0, 0.0)),
        f.talk(2, ("guest", 0, 0.0), ("robot", 5, 0.0)),
        f.talk(3, ("guest", 0, 0.0), ("host", 5, 0.0)),
        f.talk(4, ("host", 0, 0.0)),
        f.talk(5, (None, 0, 0.0)),
        f.talk(6, (None, 0, 0.0), ("host", 5, 0.0)),
        f.talk(7, ("guest", 0, None)),
    ]
    rows = journeys_of(spark, *talks, threads=[f.conversation(c) for c in range(1, 8)])
    text = F.col("event_journey") == "opened_by_guest"
    assert rows.filter(~text.eqNullSafe(F.col("is_unanswered_opening"))).count() == 0
    assert rows.filter("is_unanswered_opening").count() == 3
    assert rows.filter("event_journey is null").count() == 1


def test_chunks_do_not_change_the_journey(spark):
    talk = f.talk(1, *[(["guest", "host", "support_agent"][i % 3], i * 700, (i % 9 - 4) / 4) for i in range(50)])
    other = f.talk(2, ("guest", 0, 0.1), ("robot", 3, 0.1))
    threads = [f.conversation(1), f.conversation(2, csat=None)]
    whole = journeys_of(spark, talk, other, threads=threads)
    for size in (1, 7, 50):
        got = journeys_of(spark, talk, other, threads=threads, chunk_messages=size)
        numbers = [c for c in whole.columns if c not in ("avg_sentiment_score", "avg_response_latency_seconds")]
        assert f.same(got.select(numbers), whole.select(numbers))


def test_parts_hold_the_whole_text(spark):
    talk = f.talk(1, *[(["guest", "robot", "host"][i % 3], i * 10, 0.0) for i in range(20)])
    log = conversation_log(f.messages(spark, talk, f.talk(2, ("guest", 0, 0.0))), f.conversations(spark, f.conversation(1), f.conversation(2)))
    whole = {r.conversation_id: r for r in conversation_journeys(log).collect()}
    every = journey_parts(log, chunk_messages=6).orderBy("conversation_id", "part").collect()
    assert [(r.conversation_id, r.part, r.messages) for r in every] == [(1, 1, 6), (1, 2, 6), (1, 3, 6), (1, 4, 2), (2, 1, 1)]
    parts = every[:4]
    assert ARROW.join(r.event_journey for r in parts) == whole[1].event_journey
    assert ARROW.join(r.sentiment_label_journey for r in parts) == whole[1].sentiment_label_journey


def test_recent_journeys_keep_the_bound_and_drop_straddlers(spark):
    latest = datetime(2024, 2, 29, 10, 0, 0)
    bound = datetime(2023, 2, 28, 10, 0, 0)
    starts = {1: latest, 2: bound, 3: bound - timedelta(seconds=1), 4: datetime(2020, 1, 1)}
    talks = [f.talk(c, ("guest", 0, 0.0), ("host", 30, 0.0), start=at) for c, at in starts.items()]
    orphan = f.talk(99, ("guest", 0, 0.0), start=datetime(2030, 1, 1))
    messages = f.messages(spark, *talks, orphan)
    threads = f.conversations(spark, *[f.conversation(c) for c in starts])
    stored = in_trailing_window(conversation_journeys(conversation_log(messages, threads)))
    assert sorted(r.conversation_id for r in stored.collect()) == [1, 2]
    for limit in (None, 1):
        assert f.same(recent_journeys(messages, threads, limit=limit), stored)
