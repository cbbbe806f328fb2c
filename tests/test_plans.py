"""Shape of the physical plans with broadcasts off, as on tables too large for them."""

import os
import re

import pytest
from pyspark import StorageLevel

from staylens.operators import journeys, loss, messages, risk
from staylens.sources.tpch import star_sources

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture()
def src(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield star_sources(spark, SF)
    for key in settings:
        spark.conf.unset(key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return [line for line in plan.splitlines() if "Exchange " in line and "Reused" not in line]


def test_one_shuffle_of_messages_from_log_to_journeys(src):
    plan = plan_of(journeys.conversation_journeys(messages.conversation_log(src.messages, src.conversations)))
    found = [e for e in exchanges(plan) if "SinglePartition" not in e]  # the table counts of the source
    assert len(found) == 2 and all("hashpartitioning(conversation_id" in e for e in found), plan
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("chunk_messages", [None, 100])
def test_folding_a_kept_log_moves_nothing(src, chunk_messages):
    log = messages.conversation_log(src.messages, src.conversations, heavy={}).persist(StorageLevel.DISK_ONLY)
    try:
        plan = plan_of(journeys.conversation_journeys(log, chunk_messages))
        above = plan[: plan.index("InMemoryRelation")]
        assert exchanges(above) == [] and above.count("ObjectHashAggregate(") == (2 if chunk_messages is None else 4), plan
    finally:
        log.unpersist()


def test_marts_read_only_what_they_need(src):
    recent = journeys.recent_journeys(src.messages, src.conversations)
    plan = plan_of(loss.loss_by_stage(loss.loss_events(recent, src.bookings, src.users)))
    assert "listagg" not in plan and "collect_list" not in plan and "text" not in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and not any("l_tax" in s or "c_name" in s or "l_returnflag" in s for s in scans)


def test_no_single_task_sort_in_the_split_ranks(src):
    scored = risk.booking_cancellation_risk(src.bookings, src.conversations, src.messages, limit=100)
    plan = plan_of(scored)
    for line in plan.splitlines():
        if "Window" in line and "specifiedwindowframe" in line.lower():
            assert "_slot" in line, line


def test_message_signals_are_combined_before_the_shuffle(src):
    plan = plan_of(risk.conversation_signals(src.conversations, src.messages))
    assert plan.count("partial_avg(sentiment_score") == 1


def test_month_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "activity_month string, n int").write.partitionBy("activity_month").parquet(path)
    plan = plan_of(spark.read.parquet(path).filter("activity_month = '2024-02'"))
    assert "PartitionFilters: [isnotnull(activity_month" in plan
