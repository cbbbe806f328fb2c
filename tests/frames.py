"""Small hand-made source tables."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1, 12, 0, 0)
MESSAGE = (
    "message_id bigint, conversation_id int, sender_type string, sender_id int, sent_at timestamp_ntz, text string, "
    "intent_category string, sentiment_score double, sentiment_label string, response_latency_seconds int"
)
CONVERSATION = (
    "conversation_id int, booking_id int, user_id int, host_id int, property_id int, channel string, "
    "intent_category string, status string, csat_score int, first_response_time_seconds int, resolution_time_seconds int"
)
BOOKING = (
    "booking_id int, property_id int, host_id int, user_id int, checkin_date date, checkout_date date, status string, "
    "total_price double"
)


def label_of(score):
    if score is None:
        return None
    return "positive" if score > 0.2 else "negative" if score < -0.2 else "neutral"


def talk(conversation_id, *turns, start=START, intent="general_inquiry", first_id=None):
    """Message rows from (sender, seconds after start, score) turns; a fourth item overrides the label."""
    first_id = conversation_id * 1000 if first_id is None else first_id
    rows = []
    for i, (sender, after, score, *label) in enumerate(turns):
        mood = label[0] if label else label_of(score)
        rows.append(
            (first_id + i, conversation_id, sender, 1, start + timedelta(seconds=after), f"text {i}", intent, score, mood, 60 * i)
        )
    return rows


def messages(spark, *talks):
    return spark.createDataFrame([r for t in talks for r in t], MESSAGE)


def conversation(
    conversation_id, booking_id=1, user_id=1, channel="email", intent="general_inquiry", status="resolved", csat=4,
    first_response=100, resolution=1000,
):
    return (conversation_id, booking_id, user_id, 1, 1, channel, intent, status, csat, first_response, resolution)


def conversations(spark, *rows):
    return spark.createDataFrame(list(rows), CONVERSATION)


def booking(booking_id, status="confirmed", price=100.0, user_id=1):
    return (booking_id, 1, 1, user_id, START.date(), (START + timedelta(days=2)).date(), status, price)


def bookings(spark, *rows):
    return spark.createDataFrame(list(rows), BOOKING)


def users(spark, *rows):
    return spark.createDataFrame(list(rows) or [(1, "gold")], "user_id int, loyalty_tier string")


def same(left, right):
    """Equal as multisets of rows, columns matched by name."""
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
