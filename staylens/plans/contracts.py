"""The checks declared on every table of the three layers."""

from __future__ import annotations

from staylens.operators.quality import Check
from staylens.sources.schemas import (
    BOOKING_STATUSES,
    CONVERSATION_STATUSES,
    EVENT_PATTERNS,
    JOURNEY_STAGES,
    NO_PATTERN,
    SENDER_TYPES,
    SENTIMENT_LABELS,
)

COHORT_GRAIN = ["month", "channel", "loyalty_tier"]
LOST = "if(is_cancelled, total_price, 0)"
FRESHNESS = {"conversations": "generated_at", "messages": "generated_at"}


def _key(model: str, column: str) -> list[Check]:
    return [Check("unique", model, column), Check("not_null", model, column)]


def _ranges(model: str, low: float, high: float, *columns: str) -> list[Check]:
    return [Check("between", model, c, {"low": low, "high": high}) for c in columns]


def _non_negative(model: str, *columns: str) -> list[Check]:
    return [Check("non_negative", model, c) for c in columns]


def _refers(model: str, column: str, parent: str) -> Check:
    return Check("relationships", model, column, {"parent": parent, "parent_column": column})


def _one_of(model: str, column: str, values: list[str]) -> Check:
    return Check("accepted_values", model, column, {"values": values})


def _grain(model: str, *columns: str) -> Check:
    return Check("unique_combination", model, args={"columns": [*COHORT_GRAIN, *columns]})


def _adds_up(model: str, column: str, **others: object) -> Check:
    return Check("agg_matches", model, column, {"upstream": "loss_events", **others})


def columns_read(checks: list[Check], model: str) -> list[str]:
    """The columns of a model that simple checks read, in it or as the parent of others."""
    read = [c for check in checks if check.model == model for c in (check.column, *check.args.get("columns", [])) if c]
    read += [check.args["parent_column"] for check in checks if check.args.get("parent") == model]
    return list(dict.fromkeys(read))


def staging_checks() -> list[Check]:
    return [
        *_key("users", "user_id"),
        *_key("hosts", "host_id"),
        *_ranges("hosts", 0, 1, "response_rate"),
        *_key("properties", "property_id"),
        _refers("properties", "host_id", "hosts"),
        *_non_negative("properties", "bedrooms", "price_per_night"),
        *_ranges("properties", 0, 5, "rating"),
        *_key("bookings", "booking_id"),
        _refers("bookings", "property_id", "properties"),
        _refers("bookings", "host_id", "hosts"),
        _refers("bookings", "user_id", "users"),
        *_non_negative("bookings", "nights", "total_price"),
        _one_of("bookings", "status", BOOKING_STATUSES),
        *_key("conversations", "conversation_id"),
        _refers("conversations", "booking_id", "bookings"),
        _refers("conversations", "user_id", "users"),
        _refers("conversations", "host_id", "hosts"),
        _refers("conversations", "property_id", "properties"),
        _one_of("conversations", "status", CONVERSATION_STATUSES),
        *_ranges("conversations", 1, 5, "csat_score"),
        *_key("messages", "message_id"),
        _refers("messages", "conversation_id", "conversations"),
        _one_of("messages", "sender_type", SENDER_TYPES),
        *_ranges("messages", -1, 1, "sentiment_score"),
        _one_of("messages", "sentiment_label", SENTIMENT_LABELS),
        *_non_negative("messages", "response_latency_seconds"),
    ]


def intermediate_checks() -> list[Check]:
    return [
        *_key("booking_cancellation_risk", "booking_id"),
        *_ranges("booking_cancellation_risk", 0, 1, "cancellation_risk_score", "risk_percentile"),
        Check("not_constant", "booking_cancellation_risk", "cancellation_risk_score"),
        *_key("conversation_log", "message_id"),
        *_non_negative("conversation_log", "message_seq", "seconds_since_prev_message"),
        *_key("conversation_journeys", "conversation_id"),
        *_ranges("conversation_journeys", -1, 1, "opening_sentiment", "closing_sentiment"),
        *_non_negative(
            "conversation_journeys", "escalation_handoff_count", "delayed_reply_count", "duration_seconds"
        ),
        *_key("at_risk_conversations", "conversation_id"),
        _refers("at_risk_conversations", "booking_id", "booking_cancellation_risk"),
        Check("not_null", "at_risk_concerns", "intent_category"),
        *_ranges("at_risk_concerns", 1, 5, "concern_rank"),
    ]


def mart_checks() -> list[Check]:
    return [
        Check("value_matches", "loss_events", "total_price", {"upstream": "bookings", "key": "booking_id"}),
        *_key("loss_events", "conversation_id"),
        _one_of("loss_events", "journey_stage", JOURNEY_STAGES),
        Check("not_null", "loss_events", "event_pattern"),
        _one_of("loss_events", "event_pattern", [*EVENT_PATTERNS, NO_PATTERN]),
        *_non_negative("loss_events", "total_price"),
        _grain("loss_by_month_pattern", "event_pattern"),
        _adds_up("loss_by_month_pattern", "cancelled_price", upstream_column=LOST),
        Check("not_null", "loss_by_month_pattern", "month"),
        Check("not_null", "loss_by_month_pattern", "event_pattern"),
        *_non_negative("loss_by_month_pattern", "cancelled_price"),
        _grain("loss_by_stage", "journey_stage"),
        _adds_up("loss_by_stage", "total_price"),
        _adds_up("loss_by_stage", "cancelled_price", upstream_column=LOST),
        Check("not_null", "loss_by_stage", "journey_stage"),
        *_non_negative("loss_by_stage", "total_price", "cancelled_price"),
        _grain("complaint_cohort", "intent_category"),
        _adds_up("complaint_cohort", "total_price"),
        _adds_up("complaint_cohort", "cancelled_price", upstream_column=LOST),
        Check("not_null", "complaint_cohort", "intent_category"),
        *_non_negative("complaint_cohort", "cancelled_price"),
        _adds_up("price_quintile_risk", "revenue_lost_to_cancellation", upstream_column=LOST),
        *_key("price_quintile_risk", "price_quintile"),
        *_ranges("price_quintile_risk", 1, 5, "price_quintile"),
        *_ranges("price_quintile_risk", 0, 100, "cancellation_rate_pct"),
        *_non_negative("price_quintile_risk", "revenue_lost_to_cancellation"),
        _adds_up("unanswered_opening_monthly", "total_bookings_in_cohort", upstream_agg="count"),
        _adds_up(
            "unanswered_opening_monthly",
            "unanswered_opening_bookings",
            upstream_agg="count",
            upstream_where="event_pattern = 'unanswered_opening'",
        ),
        *_key("unanswered_opening_monthly", "month"),
        *_ranges(
            "unanswered_opening_monthly",
            0,
            100,
            "cohort_base_cancel_rate_pct",
            "pct_unanswered_opening",
            "unanswered_opening_cancel_rate_pct",
        ),
    ]
