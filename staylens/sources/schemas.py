"""Schemas and value domains of the six source tables."""

from pyspark.sql import types as T


_TYPES = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """StructType from "name TYPE, ...". Unlike fromDDL it needs no running session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in spec.split(","))])


SCHEMAS: dict[str, T.StructType] = {
    "dim_users": _struct(
        "user_id INT, full_name STRING, country STRING, signup_date DATE, loyalty_tier STRING"
    ),
    "dim_hosts": _struct(
        "host_id INT, host_name STRING, country STRING, response_rate FLOAT, is_superhost BOOLEAN"
    ),
    "dim_properties": _struct(
        "property_id INT, host_id INT, property_name STRING, property_type STRING, city STRING, "
        "country STRING, bedrooms TINYINT, price_per_night FLOAT, rating FLOAT, review_count INT"
    ),
    "fact_bookings": _struct(
        "booking_id INT, property_id INT, host_id INT, user_id INT, booking_created_at DATE, "
        "checkin_date DATE, checkout_date DATE, nights SMALLINT, status STRING, channel STRING, "
        "total_price FLOAT"
    ),
    "dim_conversations": _struct(
        "conversation_id INT, booking_id INT, user_id INT, host_id INT, property_id INT, "
        "channel STRING, intent_category STRING, status STRING, opened_at TIMESTAMP_NTZ, "
        "csat_score TINYINT, first_response_time_seconds INT, resolution_time_seconds INT, "
        "is_support BOOLEAN, generated_at TIMESTAMP_NTZ"
    ),
    "fact_chat_messages": _struct(
        "message_id BIGINT, conversation_id INT, sender_type STRING, sender_id INT, "
        "sent_at TIMESTAMP_NTZ, text STRING, intent_category STRING, sentiment_score FLOAT, "
        "sentiment_label STRING, language STRING, response_latency_seconds INT, "
        "message_length SMALLINT, generated_at TIMESTAMP_NTZ"
    ),
}

# Domains of the source columns and of the derived classifications.
BOOKING_STATUSES = ["confirmed", "completed", "cancelled"]
CONVERSATION_STATUSES = ["resolved", "open", "escalated"]
SENDER_TYPES = ["guest", "host", "support_agent", "bot"]
SENTIMENT_LABELS = ["negative", "neutral", "positive"]
BOOKING_CHANNELS = ["web", "ios", "android"]
CONVERSATION_CHANNELS = ["in_app", "email", "whatsapp", "sms"]
LANGUAGES = ["en", "es", "fr", "de", "pt", "it"]
INTENTS = [
    "pre_booking_question",
    "checkin_instructions",
    "checkin_issue",
    "amenity_complaint",
    "cleanliness_complaint",
    "noise_complaint",
    "cancellation_request",
    "refund_request",
    "payment_issue",
    "extend_stay_request",
    "early_checkout",
    "lost_item",
    "host_unresponsive",
    "wifi_issue",
    "general_inquiry",
    "positive_feedback",
]
EXIT_INTENTS = ["cancellation_request", "refund_request"]
COMPLAINT_INTENTS = [
    "noise_complaint",
    "checkin_issue",
    "amenity_complaint",
    "refund_request",
    "payment_issue",
    "cleanliness_complaint",
    "host_unresponsive",
]
PRAISE_INTENTS = ["positive_feedback"]
JOURNEY_STAGES = ["1_opening", "2_early_mid", "3_late_mid", "4_closing"]
EVENT_PATTERNS = [
    "unanswered_opening",
    "escalated_and_delayed",
    "escalated_support",
    "delayed_reply",
    "ends_frustrated",
    "negative_opening",
    "multiple_negative",
    "sentiment_worsened",
    "long_conversation",
    "low_csat",
]
NO_PATTERN = "no_pattern"
