"""Full rebuild: staging views, intermediate and mart tables, checks and extracts.

Every table is recomputed on each run. Percentiles, price groups and the trailing window depend on
the whole population, so rows written earlier would go stale.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TypeVar

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators import journeys, loss, messages, risk
from staylens.operators.quality import freshness, run_checks
from staylens.plans import analyses, contracts, extracts
from staylens.sources.sinks import write_extract, write_json, write_table
from staylens.sources.tables import SourceTables, read_sources, register_staging_views

T = TypeVar("T")

INTERMEDIATE = (
    "booking_cancellation_risk",
    "at_risk_conversations",
    "at_risk_concerns",
    "conversation_log",
    "conversation_journeys",
    "journey_parts",
)


def together(spark: SparkSession, jobs: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent writes at the same time, so one fills the executors while another ends."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: done.result() for name, done in running.items()}


def build_risk(src: SourceTables, root: str, limit: int | None = None) -> dict[str, DataFrame]:
    root = f"{root.rstrip('/')}/intermediate"
    scored = risk.booking_cancellation_risk(src.bookings, src.conversations, src.messages, limit=limit)
    scored = write_table(scored, root, "booking_cancellation_risk")
    at_risk = risk.at_risk_conversations(scored, src.conversations, limit=limit)
    at_risk = write_table(at_risk, root, "at_risk_conversations")
    return {
        "booking_cancellation_risk": scored,
        "at_risk_conversations": at_risk,
        "at_risk_concerns": write_table(risk.at_risk_concerns(at_risk), root, "at_risk_concerns"),
    }


def build_journeys(src: SourceTables, root: str, limit: int | None = None) -> dict[str, DataFrame]:
    """The log and what is folded from it.

    The laid-out log is kept on the executors' disks while it is folded, so the messages are shuffled
    and sorted once for all three tables. Parts that go with a lost executor are computed again.
    """
    root = f"{root.rstrip('/')}/intermediate"
    heavy = messages.heavy_conversations(src.messages, limit)
    log = messages.conversation_log(src.messages, src.conversations, limit=limit, heavy=heavy)
    log = log.persist(StorageLevel.DISK_ONLY)
    folds = {
        "conversation_journeys": partial(journeys.conversation_journeys, chunk_messages=journeys.fold_in_chunks(heavy)),
        "journey_parts": journeys.journey_parts,
    }

    def write(name: str) -> DataFrame:
        return write_table(folds[name](log), root, name)

    try:
        written = write_table(log, root, "conversation_log")
        return {"conversation_log": written} | together(log.sparkSession, {name: partial(write, name) for name in folds})
    finally:
        log.unpersist()


def build_marts(
    src: SourceTables, stored_journeys: DataFrame, root: str, heavy: dict[str, dict], limit: int | None = None
) -> dict[str, DataFrame]:
    """`heavy` is what heavy_parties found in the conversations."""
    root = f"{root.rstrip('/')}/marts"
    events = loss.loss_events(loss.in_trailing_window(stored_journeys), src.bookings, src.users, heavy, limit)
    events = write_table(events, root, "loss_events", partition_by="activity_month")
    marts = {
        "loss_by_month_pattern": loss.loss_by_month_pattern,
        "loss_by_stage": loss.loss_by_stage,
        "complaint_cohort": loss.complaint_cohort,
        "price_quintile_risk": partial(loss.price_quintile_risk, limit=limit),
        "unanswered_opening_monthly": loss.unanswered_opening_monthly,
    }

    def write(name: str) -> DataFrame:
        return write_table(marts[name](events), root, name)

    return {"loss_events": events} | together(events.sparkSession, {name: partial(write, name) for name in marts})


def build_tables(src: SourceTables, root: str, limit: int | None = None) -> dict[str, DataFrame]:
    """Write all intermediate and mart tables. The marts wait for the journeys, and nothing for the risk."""

    src.named()  # open the sources once, before the threads share them
    chains = {
        "risk": partial(build_risk, src, root, limit),
        "journeys": partial(build_journeys, src, root, limit),
        "heavy": partial(loss.heavy_parties, src.conversations, limit),
    }
    with ThreadPoolExecutor(max_workers=len(chains)) as pool:
        thread = inheritable_thread_target(src.bookings.sparkSession)
        running = {name: pool.submit(thread(job)) for name, job in chains.items()}
        folded, heavy = running["journeys"].result(), running["heavy"].result()
        marts = build_marts(src, folded["conversation_journeys"], root, heavy, limit)
        return running["risk"].result() | folded | marts


def register_layer_views(built: dict[str, DataFrame]) -> list[str]:
    """Expose the stored tables to SQL users as temporary views, `int_...` and `mart_...` by layer."""
    names = []
    for name, df in built.items():
        names.append(("int_" if name in INTERMEDIATE else "mart_") + name)
        df.createOrReplaceTempView(names[-1])
    return names


def check_all(src: SourceTables, built: dict[str, DataFrame], root: str) -> DataFrame:
    """Run every declared check and store the results, one table per layer."""
    root = f"{root.rstrip('/')}/check_results"
    tables = {**src.named(), **built}
    layers = {
        "staging": contracts.staging_checks(),
        "intermediate": contracts.intermediate_checks(),
        "marts": contracts.mart_checks(),
    }

    def write(layer: str) -> DataFrame:
        return write_table(run_checks(layers[layer], tables), root, layer)

    results = together(src.bookings.sparkSession, {layer: partial(write, layer) for layer in layers})
    return reduce(DataFrame.unionByName, results.values())


def source_freshness(src: SourceTables, now: str) -> DataFrame:
    tables = src.named()
    parts = [
        freshness(tables[model], column, now).withColumn("model", F.lit(model))
        for model, column in contracts.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_extracts(built: dict[str, DataFrame], root: str) -> None:
    root = f"{root.rstrip('/')}/extracts"
    events, stages, scores = built["loss_events"], built["loss_by_stage"], built["booking_cancellation_risk"]
    heavy = loss.heavy_parties(events)["booking_id"]
    selection = write_table(extracts.drill_down_selection(events, scores, heavy=heavy), root, "drill_down_selection")
    tables = {
        "stage_value": extracts.stage_value(stages),
        "intent_value": extracts.intent_value(built["complaint_cohort"]),
        "stage_volume": extracts.stage_volume(stages),
        "cohort_totals": extracts.cohort_totals(stages),
        "pattern_impact": extracts.pattern_impact(built["loss_by_month_pattern"]),
        "conversation_profile": extracts.conversation_profile(events),
        "monthly_totals": extracts.monthly_totals(events),
        "drill_down_meta": extracts.drill_down_meta(events, selection),
        "drill_down_tags": extracts.drill_down_tags(selection),
    }
    writes: dict[str, Callable[[], None]] = {n: partial(write_extract, df, root, n) for n, df in tables.items()}
    # The chosen conversations are few, their messages need not be.
    lines = extracts.drill_down_messages(built["conversation_log"], selection)
    writes["drill_down_messages"] = partial(write_json, lines, root, "drill_down_messages")
    together(events.sparkSession, writes)


def write_analyses(src: SourceTables, built: dict[str, DataFrame], root: str, limit: int | None = None) -> None:
    root = f"{root.rstrip('/')}/analyses"
    events, log, scores = built["loss_events"], built["conversation_log"], built["booking_cancellation_risk"]
    heavy = loss.heavy_parties(src.conversations, limit=limit)["booking_id"]
    tables = {
        "stage_impact": analyses.stage_impact(log, scores, heavy),
        "first_negative_stage": analyses.first_negative_stage(log, scores, heavy),
        "top_risk_bookings": analyses.top_risk_bookings(scores, src.conversations, heavy=heavy),
        "unanswered_opening_cohort": analyses.unanswered_opening_cohort(events),
        "unanswered_opening_queue": analyses.unanswered_opening_queue(events),
        "pattern_lift": analyses.pattern_lift(events),
        "topic_cluster_rates": analyses.topic_cluster_rates(events),
        "time_cuts": analyses.time_cuts(events),
        "loss_concentration": analyses.loss_concentration(built["price_quintile_risk"]),
        "risk_kpis": analyses.risk_kpis(scores),
        "message_volume_by_intent": analyses.message_volume_by_intent(src.messages),
        "chat_experience": analyses.chat_experience(src.conversations),
    }
    together(events.sparkSession, {name: partial(write_table, df, root, name) for name, df in tables.items()})


def rebuild(
    spark: SparkSession, source_root: str, out_root: str, now: str, src: SourceTables | None = None
) -> tuple[DataFrame, DataFrame]:
    """Build every layer under `out_root`; return the check results and the source freshness."""
    src = src or read_sources(spark, source_root)
    register_staging_views(src)
    built = build_tables(src, out_root)
    register_layer_views(built)
    checks = check_all(src, built, out_root)
    write_extracts(built, out_root)
    write_analyses(src, built, out_root)
    return checks, source_freshness(src, now)
