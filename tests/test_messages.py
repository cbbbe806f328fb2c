import frames as f
import pytest
from pyspark.sql import functions as F

from staylens.operators.messages import conversation_log


def log_of(spark, *talks, threads=None, limit=None):
    threads = threads or [f.conversation(1)]
    return conversation_log(f.messages(spark, *talks), f.conversations(spark, *threads), limit=limit)


def labels(log):
    return [r.event_label for r in log.orderBy("conversation_id", "message_seq").collect()]


def test_turns_are_numbered_and_labelled(spark):
    talk = f.talk(1, ("guest", 0, 0.0), ("bot", 10, 0.1), ("host", 20, 0.3), ("guest", 30, -0.5), ("guest", 40, 0.9))
    log = log_of(spark, talk)
    assert labels(log) == ["opened_by_guest", "bot_reply", "host_reply", "guest_negative", "guest_positive"]
    first, last = log.filter("is_first_message").first(), log.filter("is_last_message").first()
    assert (first.message_seq, first.prev_sender_type, first.seconds_since_prev_message) == (1, None, None)
    assert (last.message_seq, last.conversation_message_count, last.seconds_since_prev_message) == (5, 5, 10)


def test_every_entry_into_support_is_a_handoff(spark):
    talk = f.talk(1, ("guest", 0, 0.0), ("support_agent", 5, 0.0), ("support_agent", 9, 0.0), ("guest", 12, 0.0), ("support_agent", 15, 0.0))
    log = log_of(spark, talk)
    assert labels(log) == ["opened_by_guest", "escalated_to_support", "support_reply", "guest_neutral", "escalated_to_support"]
    assert log.filter("is_escalation_handoff").count() == 2


def test_opening_by_support_is_a_handoff_but_labelled_as_opening(spark):
    row = log_of(spark, f.talk(1, ("support_agent", 0, 0.0))).first()
    assert row.is_escalation_handoff and row.event_label == "opened_by_support_agent"


def test_delay_starts_after_900_seconds(spark):
    log = log_of(spark, f.talk(1, ("guest", 0, 0.0), ("host", 900, 0.0), ("host", 1801, 0.0)))
    assert labels(log) == ["opened_by_guest", "host_reply", "host_reply_delayed"]


def test_unknown_sender_and_missing_mood_have_no_label(spark):
    log = log_of(spark, f.talk(1, ("guest", 0, 0.0), ("robot", 5, 0.0), ("guest", 9, None), (None, 12, 0.0)))
    assert labels(log) == ["opened_by_guest", None, None, None]


def test_tied_times_follow_the_message_id(spark):
    talk = f.talk(1, ("guest", 0, 0.0), ("host", 5, 0.0), ("bot", 5, 0.0))
    assert labels(log_of(spark, talk[::-1])) == ["opened_by_guest", "host_reply", "bot_reply"]


def test_messages_without_a_conversation_are_dropped(spark):
    log = log_of(spark, f.talk(1, ("guest", 0, 0.0)), f.talk(2, ("guest", 0, 0.0)))
    assert [r.conversation_id for r in log.collect()] == [1]


def test_seconds_count_boundaries_in_any_time_zone(spark):
    talk = f.talk(1, ("guest", 0.9, 0.0), ("host", 1.1, 0.0))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert log_of(spark, talk).filter("message_seq = 2").first().seconds_since_prev_message == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("limit", [2, 10, 60])
def test_a_conversation_with_a_third_of_all_messages(spark, limit):
    senders = ["guest", "host", "bot", "support_agent"]
    hot = f.talk(1, *[(senders[i * 7 % 4], i // 3 * 400, (i % 11 - 5) / 5.5) for i in range(300)])
    rest = [f.talk(c, *[(senders[(c + i) % 4], i * 500, 0.1 * i) for i in range(c % 5 + 1)]) for c in range(2, 202)]
    threads = [f.conversation(c) for c in range(1, 202)]
    plain = log_of(spark, hot, *rest, threads=threads)
    split = log_of(spark, hot, *rest, threads=threads, limit=limit)
    assert "_seg" in split._jdf.queryExecution().toString()
    assert f.same(split, plain)
    assert plain.filter("conversation_id = 1").agg(F.max("message_seq")).first()[0] == 300


@pytest.mark.parametrize("limit", [2, 4])
def test_many_heavy_conversations_stay_off_the_driver(spark, monkeypatch, limit):
    from pyspark.sql import DataFrame

    from staylens.functions import ordering, skew
    from staylens.operators.messages import heavy_conversations

    # At 1 GB millions of conversations have more than four messages; a list of them all failed the driver.
    monkeypatch.setattr(skew, "KEYS_LISTED", 10, raising=False)
    monkeypatch.setattr(skew, "SKETCH_KEYS", 10)
    senders = ["guest", "host", "bot", "support_agent"]
    talks = [f.talk(c, *[(senders[(c + i) % 4], i // 3 * 500, 0.1 * i) for i in range(c % 9 + 1)]) for c in range(1, 202)]
    hot = f.talk(300, *[(senders[i * 7 % 4], i // 3 * 400, 0.0) for i in range(300)])
    threads = [f.conversation(c) for c in range(1, 301) if c % 10]
    for said in (talks, [*talks, hot]):
        heavy = heavy_conversations(f.messages(spark, *said), limit)
        assert isinstance(heavy, DataFrame) and heavy.count() > 80
        plain = log_of(spark, *said, threads=[*threads, f.conversation(300)])
        for most in (100, 20):
            monkeypatch.setattr(ordering, "LIMITS_CUT_BY_POINTS", most)
            assert f.same(log_of(spark, *said, threads=[*threads, f.conversation(300)], limit=limit), plain)
