"""Registered queries and their SQL counterparts.

Every query reads the whole tables. Doubles are rounded to six places, because averages differ in
their last bits with the order in which rows are added.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property, reduce
from importlib import import_module
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_queries
from staylens.functions.ordering import percent_ranks
from staylens.functions.pin import pin, shared_folder
from staylens.operators import journeys, loss, messages, quality, risk
from staylens.plans import analyses, contracts, extracts
from staylens.sources.schemas import SCHEMAS
from staylens.sources.sinks import read_extract, write_extract, write_json, write_table
from staylens.sources.tables import SourceTables, read_sources, register_staging_views
from staylens.sources.tpch import star_sources

SMOKE_DIR = "/root/testdata/sf0.001"


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema if isinstance(f.dataType, T.DoubleType)})


class Session:
    """The source tables of one run and the tables derived from them, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.src: SourceTables = star_sources(spark, sf_dir)
        # One plan per table and run, so that heavy keys and counts are looked up once.
        self.risk, self.log, self.events = cache(self.risk), cache(self.log), cache(self.events)
        self.heavy_bookings, self.heavy_conversations = cache(self.heavy_bookings), cache(self.heavy_conversations)

    @cached_property
    def declared(self) -> SourceTables:
        """The sources written in their declared types, one file set each, and staged from there."""
        root = shared_folder(self.spark)
        for (file, schema), df in zip(SCHEMAS.items(), self.src.named().values(), strict=True):
            typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
            write_table(typed, root, f"{file}.parquet")
        return read_sources(self.spark, root)

    def risk(self, **options: object) -> DataFrame:
        s = self.src
        return risk.booking_cancellation_risk(s.bookings, s.conversations, s.messages, **options)

    def heavy_conversations(self, limit: int | None = None) -> dict:
        return messages.heavy_conversations(self.src.messages, limit)

    def log(self, limit: int | None = None) -> DataFrame:
        return messages.conversation_log(self.src.messages, self.src.conversations, limit, self.heavy_conversations(limit))

    def journeys(self, log: DataFrame | None = None) -> DataFrame:
        folded = journeys.fold_in_chunks(self.heavy_conversations())
        return journeys.conversation_journeys(self.log() if log is None else log, folded)

    def events(self, limit: int | None = None) -> DataFrame:
        s = self.src
        recent = journeys.recent_journeys(s.messages, s.conversations, limit=limit)
        return loss.loss_events(recent, s.bookings, s.users, loss.heavy_parties(s.conversations, limit=limit), limit)

    def events_from_stored_journeys(self) -> DataFrame:
        s = self.src
        stored = pin(self.journeys())
        return loss.loss_events(loss.in_trailing_window(stored), s.bookings, s.users)

    def at_risk(self) -> DataFrame:
        return risk.at_risk_conversations(self.risk(), self.src.conversations)

    def heavy_bookings(self) -> dict:
        return loss.heavy_parties(self.src.conversations)["booking_id"]

    def quintiles(self, limit: int | None = None) -> DataFrame:
        # There are no more events than conversations.
        bound = self.src.conversations.count()
        return loss.price_quintile_risk(self.events(), max_rows=bound, limit=limit)

    def high_risk(self, events: DataFrame) -> DataFrame:
        return extracts.high_risk(events, self.risk(), heavy=self.heavy_bookings())

    def selection(self, events: DataFrame) -> DataFrame:
        # Both halves of the selection read the events, but only their keys.
        keys = pin(events.select("conversation_id", "booking_id"))
        return pin(extracts.drill_down_selection(keys, self.risk(), heavy=self.heavy_bookings()))

    def stored_intermediate(self) -> dict[str, DataFrame]:
        """The columns that the checks read. Journeys are folded where the log is laid out, not from a stored log."""
        checks = contracts.intermediate_checks()

        def stored(model: str, df: DataFrame, *more: str) -> DataFrame:
            return pin(df.select(*dict.fromkeys([*contracts.columns_read(checks, model), *more])))

        scores = stored("booking_cancellation_risk", self.risk(), "is_top_risk_decile")
        at_risk = stored("at_risk_conversations", risk.at_risk_conversations(scores, self.src.conversations), "intent_category")
        return {
            "booking_cancellation_risk": scores,
            "conversation_log": stored("conversation_log", self.log()),
            "conversation_journeys": stored("conversation_journeys", self.journeys()),
            "at_risk_conversations": at_risk,
            "at_risk_concerns": risk.at_risk_concerns(at_risk),
        }

    def stored_marts(self) -> dict[str, DataFrame]:
        events = pin(self.events())
        return {
            "loss_events": events,
            "loss_by_month_pattern": pin(loss.loss_by_month_pattern(events)),
            "loss_by_stage": pin(loss.loss_by_stage(events)),
            "complaint_cohort": pin(loss.complaint_cohort(events)),
            "price_quintile_risk": pin(loss.price_quintile_risk(events)),
            "unanswered_opening_monthly": pin(loss.unanswered_opening_monthly(events)),
        }


def _check_freshness(s: Session) -> DataFrame:
    sources = s.src.named()
    parts = [
        quality.freshness(sources[m], column, oracle_queries.NOW).withColumn("model", F.lit(m))
        for m, column in contracts.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _check_relationships(s: Session) -> DataFrame:
    confirmed = s.src.bookings.filter(F.col("status") == "confirmed")
    return quality.relationships(s.src.conversations, "booking_id", confirmed, "booking_id")


def _check_agg_matches(s: Session) -> DataFrame:
    cancelled = F.col("status") == "cancelled"
    found = quality.agg_matches(
        loss.loss_by_stage(s.events()), s.src.bookings, "cancelled_price", "total_price", upstream_where=cancelled
    )
    return found.select(*[F.round(c, 2).alias(c) for c in found.columns])


def _checks_marts(s: Session) -> DataFrame:
    return quality.run_checks(contracts.mart_checks(), {**s.src.named(), **s.stored_marts()})


def _checks_intermediate(s: Session) -> DataFrame:
    return quality.run_checks(contracts.intermediate_checks(), {**s.src.named(), **s.stored_intermediate()})


def _typical(s: Session) -> DataFrame:
    events = pin(s.events().select("conversation_id", "booking_id"))
    return extracts.typical(events, s.high_risk(events))


def _drill_down_meta(s: Session) -> DataFrame:
    events = s.events()
    return extracts.drill_down_meta(events, s.selection(events))


def _drill_down_messages(s: Session) -> DataFrame:
    return extracts.drill_down_messages_from_raw(s.src.messages, s.src.conversations, s.selection(s.events()))


def _drill_down_tags(s: Session) -> DataFrame:
    return extracts.drill_down_tags(s.selection(s.events())).withColumn("tags", F.concat_ws(",", "tags"))


def _read_back(staged: DataFrame) -> DataFrame:
    """A staged table for comparison: small integers as INT."""
    small = [f.name for f in staged.schema if isinstance(f.dataType, (T.ByteType, T.ShortType))]
    return staged.withColumns({c: F.col(c).cast("int") for c in small})


def _declared_bookings(s: Session) -> DataFrame:
    """Prices back as the singles they were stored in, which shows that staging lost nothing."""
    return _read_back(s.declared.bookings).withColumn("total_price", F.col("total_price").cast("float").cast("double"))


def _staging_views(s: Session) -> DataFrame:
    """The staged files as SQL users see them."""
    register_staging_views(s.declared, "declared_")
    return s.spark.sql(
        "SELECT m.sender_type, c.channel, count(*) AS messages, count(c.booking_id) AS with_booking"
        " FROM declared_messages m JOIN declared_conversations c USING (conversation_id) GROUP BY ALL"
    )


def _written_events(s: Session) -> DataFrame:
    return write_table(s.events(), shared_folder(s.spark), "loss_events", partition_by="activity_month")


def _written_json(s: Session) -> DataFrame:
    lines, root = journeys.journey_parts(s.log(), chunk_messages=3), shared_folder(s.spark)
    write_json(lines, root, "journey_parts")
    return s.spark.read.schema(lines.schema).json(f"{root}/journey_parts")


def _written_extract(s: Session) -> DataFrame:
    profile, root = extracts.conversation_profile(s.events()), shared_folder(s.spark)
    write_extract(profile, root, "conversation_profile")
    return read_extract(s.spark, root, "conversation_profile", profile.schema)


def _odd_ranks(s: Session, limit: int | None) -> DataFrame:
    """Ranks of a measure with NaN, both zeros, nulls and large ties."""
    odd = s.src.bookings.selectExpr(
        "booking_id",
        "CASE booking_id % 9 WHEN 0 THEN double('NaN') WHEN 1 THEN -0.0D WHEN 2 THEN 0.0D WHEN 3 THEN NULL"
        " WHEN 4 THEN -total_price ELSE total_price END AS measure",
    )
    ranks = {"rank_up": ("measure", False), "rank_down": ("measure", True)}
    return percent_ranks(odd, "booking_id", ranks, odd.count(), limit).select("booking_id", *ranks)


# Small task limits force the paths that split large groups, over the same whole tables.
PLANS: dict[str, Callable[[Session], DataFrame]] = {
    # Staging
    "stg_users": lambda s: s.src.users,
    "stg_hosts": lambda s: s.src.hosts,
    "stg_properties": lambda s: s.src.properties,
    "stg_bookings": lambda s: s.src.bookings,
    "stg_conversations": lambda s: s.src.conversations,
    "stg_messages": lambda s: s.src.messages,
    # Files in the declared types, staged; tables and extracts written and read back
    "declared_users": lambda s: _read_back(s.declared.users),
    "declared_hosts": lambda s: _read_back(s.declared.hosts),
    "declared_properties": lambda s: _read_back(s.declared.properties),
    "declared_bookings": _declared_bookings,
    "declared_conversations": lambda s: _read_back(s.declared.conversations),
    "declared_messages": lambda s: _read_back(s.declared.messages),
    "staging_views": _staging_views,
    "written_loss_events": _written_events,
    "written_journey_parts": _written_json,
    "written_conversation_profile": _written_extract,
    # Ranks of odd values, plain and split
    "percent_ranks": lambda s: _odd_ranks(s, None),
    "percent_ranks_split": lambda s: _odd_ranks(s, 50),
    # Intermediate
    "message_signals": lambda s: risk.message_signals(s.src.messages),
    "conversation_signals": lambda s: risk.conversation_signals(s.src.conversations, s.src.messages),
    "booking_signals": lambda s: risk.booking_signals(s.src.bookings, s.src.conversations, s.src.messages),
    "booking_cancellation_risk": lambda s: s.risk(),
    "booking_cancellation_risk_neutral": lambda s: s.risk(null_signal="neutral"),
    "booking_cancellation_risk_split": lambda s: s.risk(limit=250),
    "conversation_log": lambda s: s.log(),
    "conversation_log_split": lambda s: s.log(limit=4),
    "conversation_journeys": lambda s: s.journeys(),
    "conversation_journeys_chunked": lambda s: journeys.conversation_journeys(s.log(), chunk_messages=2),
    "journey_parts": lambda s: journeys.journey_parts(s.log(), chunk_messages=3),
    "at_risk_conversations": lambda s: s.at_risk(),
    "at_risk_concerns": lambda s: risk.at_risk_concerns(s.at_risk()),
    # Marts
    "loss_events": lambda s: s.events(),
    "loss_events_stored_journeys": lambda s: s.events_from_stored_journeys(),
    "loss_events_salted": lambda s: s.events(limit=5),
    "loss_by_month_pattern": lambda s: loss.loss_by_month_pattern(s.events()),
    "loss_by_stage": lambda s: loss.loss_by_stage(s.events()),
    "complaint_cohort": lambda s: loss.complaint_cohort(s.events()),
    "price_quintile_risk": lambda s: s.quintiles(),
    "price_quintile_risk_split": lambda s: s.quintiles(limit=250),
    "unanswered_opening_monthly": lambda s: loss.unanswered_opening_monthly(s.events()),
    # Data quality
    "check_between": lambda s: quality.between(s.src.messages, "sentiment_score", -0.5, 0.5).select("message_id", "sentiment_score"),
    "check_non_negative": lambda s: quality.non_negative(s.journeys(), "sentiment_delta").select("conversation_id", "sentiment_delta"),
    "check_not_null": lambda s: quality.not_null(s.src.conversations, "csat_score").select("conversation_id", "booking_id", "csat_score"),
    "check_accepted_values": lambda s: quality.accepted_values(s.src.messages, "sender_type", ["guest", "host"]).select("message_id", "sender_type"),
    "check_not_constant": lambda s: quality.not_constant(s.src.properties, "country"),
    "check_unique": lambda s: quality.unique(s.src.bookings, "user_id"),
    "check_unique_combination": lambda s: quality.unique_combination(s.src.bookings, ["user_id", "channel"]),
    "check_relationships": _check_relationships,
    "check_value_matches": lambda s: quality.value_matches(s.src.conversations, "channel", s.src.bookings, "booking_id"),
    "check_agg_matches": _check_agg_matches,
    "check_freshness": _check_freshness,
    "checks_staging": lambda s: quality.run_checks(contracts.staging_checks(), s.src.named()),
    "checks_intermediate": _checks_intermediate,
    "checks_marts": _checks_marts,
    # Extracts
    "extract_stage_value": lambda s: extracts.stage_value(loss.loss_by_stage(s.events())),
    "extract_intent_value": lambda s: extracts.intent_value(loss.complaint_cohort(s.events())),
    "extract_stage_volume": lambda s: extracts.stage_volume(loss.loss_by_stage(s.events())),
    "extract_cohort_totals": lambda s: extracts.cohort_totals(loss.loss_by_stage(s.events())),
    "extract_pattern_impact": lambda s: extracts.pattern_impact(loss.loss_by_month_pattern(s.events())),
    "extract_conversation_profile": lambda s: extracts.conversation_profile(s.events()),
    "extract_monthly_totals": lambda s: extracts.monthly_totals(s.events()),
    "extract_high_risk": lambda s: s.high_risk(s.events()),
    "extract_typical": _typical,
    "extract_drill_down_meta": _drill_down_meta,
    "extract_drill_down_messages": _drill_down_messages,
    "extract_drill_down_tags": _drill_down_tags,
    # Analyses
    "analysis_stage_impact": lambda s: analyses.stage_impact(s.log(), s.risk(), s.heavy_bookings()),
    "analysis_first_negative_stage": lambda s: analyses.first_negative_stage(s.log(), s.risk(), s.heavy_bookings()),
    "analysis_top_risk_bookings": lambda s: analyses.top_risk_bookings(s.risk(), s.src.conversations, heavy=s.heavy_bookings()),
    "analysis_unanswered_cohort": lambda s: analyses.unanswered_opening_cohort(s.events()),
    "analysis_unanswered_queue": lambda s: analyses.unanswered_opening_queue(s.events()),
    "analysis_pattern_lift": lambda s: analyses.pattern_lift(s.events()),
    "analysis_topic_cluster_rates": lambda s: analyses.topic_cluster_rates(s.events()),
    "analysis_time_cuts": lambda s: analyses.time_cuts(s.events()),
    "analysis_price_quintiles": lambda s: s.quintiles(),
    "analysis_loss_concentration": lambda s: analyses.loss_concentration(s.quintiles()),
    "analysis_risk_kpis": lambda s: analyses.risk_kpis(s.risk()),
    "analysis_message_volume": lambda s: analyses.message_volume_by_intent(s.src.messages),
    "analysis_chat_experience": lambda s: analyses.chat_experience(s.src.conversations),
}


def entry(spark: SparkSession) -> DataFrame:
    """Value lost by month, channel, loyalty tier and journey stage."""
    return loss.loss_by_stage(Session(spark, SMOKE_DIR).events())


def _corpus_parts() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data subpackage and its pipeline, as far as they are installed."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    sql: dict[str, str] = {}
    if find_spec("staylens.llm") and find_spec("staylens.llm.queries"):
        corpus = import_module("staylens.llm.queries")
        found |= corpus.QUERIES
        sql |= corpus.ORACLE_SQL
        if find_spec("corpus_pipeline"):
            pipeline = import_module("corpus_pipeline")
            found["pipeline"] = pipeline.run
            if pipeline.ORACLE_SQL:
                sql["pipeline"] = pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Callable[[Session], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: rounded(plan(Session(spark, sf_dir)))

    return {name: runner(plan) for name, plan in PLANS.items()} | _corpus_parts()[0]


def oracle_sql() -> dict[str, str]:
    return oracle_queries.statements() | _corpus_parts()[1]
