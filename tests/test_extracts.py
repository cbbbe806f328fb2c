import json

import frames as f
import pytest
from pyspark.sql import functions as F
from test_loss import events_of, journey

from staylens.plans import analyses, extracts
from staylens.sources import sinks


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        journey(i, booking=i % 50, csat=[None, 1, 5][i % 3], n=i % 13 + 1, unanswered=i % 11 == 0, channel="sms" if i % 2 else "email")
        for i in range(400)
    ]
    bookings = f.bookings(spark, *[f.booking(b, ["cancelled", "confirmed"][b % 2], 10.0 * b) for b in range(50)])
    return events_of(spark, *rows, bookings=bookings).cache()


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(b, round((b % 7) / 10, 2), b % 7 == 6) for b in range(50)]
    return spark.createDataFrame(rows, "booking_id int, cancellation_risk_score double, is_top_risk_decile boolean")


def test_high_risk_takes_the_lower_id_on_ties(events, scores):
    got = [(r.cancellation_risk_score, r.conversation_id) for r in extracts.high_risk(events, scores, 30).collect()]
    everything = [(s, c) for c, s in events.join(scores, "booking_id").select("conversation_id", "cancellation_risk_score").collect()]
    assert got == sorted(everything, key=lambda p: (-p[0], p[1]))[:30]


def test_sample_does_not_depend_on_storage(events, scores):
    chosen = extracts.high_risk(events, scores, 30)
    first = [r.conversation_id for r in extracts.typical(events, chosen, 20).collect()]
    again = [r.conversation_id for r in extracts.typical(events.repartition(7, "total_price"), chosen, 20).collect()]
    other = [r.conversation_id for r in extracts.typical(events, chosen, 20, seed=43).collect()]
    assert first == again and first != other
    assert not set(first) & {r.conversation_id for r in chosen.collect()} and len(set(first)) == 20


def test_selection_meta_and_tags(events, scores):
    selection = extracts.drill_down_selection(events, scores, 30, 20)
    meta = extracts.drill_down_meta(events, selection).collect()
    assert len(meta) == 50 and [r.conversation_id for r in meta] == sorted(r.conversation_id for r in meta)
    tags = {r.conversation_id: r.tags for r in extracts.drill_down_tags(selection).collect()}
    assert sorted(map(tuple, tags.values())) == [("high_risk",)] * 30 + [("typical",)] * 20


def test_messages_of_the_selection(spark):
    talks = [f.talk(c, ("guest", 0, 0.0), ("host", 5, 0.0)) for c in range(5)]
    messages = f.messages(spark, *talks)
    conversations = f.conversations(spark, *[f.conversation(c) for c in range(5)])
    selection = spark.createDataFrame([(2, "high_risk"), (4, "typical")], "conversation_id int, tag string")
    from staylens.operators.messages import conversation_log

    stored = extracts.drill_down_messages(conversation_log(messages, conversations), selection)
    raw = extracts.drill_down_messages_from_raw(messages, conversations, selection)
    assert [tuple(r) for r in raw.collect()] == [tuple(r) for r in stored.collect()]
    assert [(r.conversation_id, r.message_seq, r.sent_at) for r in raw.collect()] == [
        (2, 1, "2024-01-01 12:00:00"), (2, 2, "2024-01-01 12:00:05"), (4, 1, "2024-01-01 12:00:00"), (4, 2, "2024-01-01 12:00:05"),
    ]


def test_profile_bands_and_totals(events):
    profile = {}
    for r in extracts.conversation_profile(events).collect():
        profile.setdefault(r.dimension, {})[r.value] = r["count"]
    assert set(profile) == {"booking_outcome", "primary_intent", "channel", "loyalty_tier", "csat", "messages"}
    assert all(sum(values.values()) == 400 for values in profile.values())
    assert set(profile["csat"]) == {"—", "1 / 5", "5 / 5"}
    assert set(profile["messages"]) == {"1", "2–3", "4–6", "7–10", "11+"}
    total = extracts.monthly_totals(events).first()
    assert (total.conversations, total.csat_count) == (400, 266)
    assert total.csat_sum == 133 * 6


def test_lift_of_overlapping_flags(events):
    rows = {r.pattern: r for r in analyses.pattern_lift(events).collect()}
    base = events.agg(F.avg(F.col("is_cancelled").cast("int"))).first()[0]
    low = events.filter("flag_low_csat").agg(F.count("*"), F.avg(F.col("is_cancelled").cast("int"))).first()
    assert rows["low_csat"].conversations == low[0] and abs(rows["low_csat"].lift - low[1] / base) < 1e-12
    assert rows["escalated_support"].conversations == 0 and rows["escalated_support"].lift is None


def test_queue_is_sorted_by_value(events):
    prices = [r.total_price for r in analyses.unanswered_opening_queue(events).collect()]
    assert prices == sorted(prices, reverse=True) and len(prices) == 37


def test_cohort_counts_each_booking_once(events):
    row = analyses.unanswered_opening_cohort(events).first()
    assert row.total_bookings_in_cohort == 50 and str(row.cohort_month) == "2024-01-01 00:00:00"


def test_stage_impact_equals_a_message_level_computation(spark):
    from staylens.operators.messages import conversation_log

    talks = [f.talk(c, *[("guest", 60 * i, ((c * 7 + i * 3) % 11 - 5) / 5.5) for i in range(c % 9 + 1)]) for c in range(60)]
    log = conversation_log(f.messages(spark, *talks), f.conversations(spark, *[f.conversation(c, c % 20) for c in range(60)]))
    risk = spark.createDataFrame([(b, b * 0.04, b > 16) for b in range(15)] + [(17, 0.9, True)], "booking_id int, cancellation_risk_score double, is_top_risk_decile boolean")
    got = {r.stage_label: r for r in analyses.stage_impact(log, risk).collect()}
    salted = {r.stage_label: r for r in analyses.stage_impact(log, risk, heavy={3: 10}).collect()}
    from pyspark.sql import Window

    w = Window.partitionBy("conversation_id").orderBy("message_seq")
    rows = log.join(risk, "booking_id").withColumn("q", F.ntile(4).over(w))
    want = rows.groupBy("q").agg(
        F.count("*").alias("n"),
        F.countDistinct("conversation_id").alias("c"),
        F.avg("sentiment_score").alias("s"),
        F.corr("sentiment_score", "cancellation_risk_score").alias("r"),
    )
    for r in want.collect():
        for table in (got, salted):
            row = table[["1_opening", "2_early_mid", "3_late_mid", "4_closing"][r.q - 1]]
            assert (row.message_count, row.conversation_count) == (r.n, r.c)
            assert abs(row.avg_sentiment_score - r.s) < 1e-9 and abs(row.corr_sentiment_vs_risk - r.r) < 1e-9


def document(folder):
    """The parts of an extract put together."""
    return json.loads("".join(p.read_text(encoding="utf-8") for p in sorted(folder.glob("part-*"))))


def test_extract_file(spark, tmp_path, events):
    sinks.write_extract(extracts.monthly_totals(events), str(tmp_path), "totals")
    got = document(tmp_path / "totals")
    assert got["cols"][0] == "month" and got["rows"][0][:2] == ["2024-01", 400]


def test_extract_is_one_document_at_any_size(spark, tmp_path):
    df = spark.range(0, 210_000, 1, 7).selectExpr("id", "'\u2013\"' || id AS t", "IF(id % 2 = 0, NULL, id / 4) AS x", "DATE '2024-01-05' AS d")
    sinks.write_extract(df, str(tmp_path), "large")
    got = document(tmp_path / "large")
    assert got["cols"] == ["id", "t", "x", "d"] and len(got["rows"]) == 210_000
    assert got["rows"][:2] == [[0, '\u2013"0', None, "2024-01-05"], [1, '\u2013"1', 0.25, "2024-01-05"]]
    assert [r[0] for r in got["rows"]] == list(range(210_000))
    assert sinks.read_extract(spark, str(tmp_path), "large", df.schema).exceptAll(df).count() == 0
    sinks.write_extract(df.limit(0), str(tmp_path), "empty")
    assert document(tmp_path / "empty") == {"cols": ["id", "t", "x", "d"], "rows": []}
