import json
import os

import pytest
from pyspark.sql import functions as F

from staylens.plans.build import rebuild
from staylens.sources.schemas import SCHEMAS
from staylens.sources.tables import read_source, read_sources, register_staging_views, stage
from staylens.sources.tpch import star_sources

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The six source files in their declared types."""
    root = str(tmp_path_factory.mktemp("raw"))
    names = dict(zip(SCHEMAS, ["users", "hosts", "properties", "bookings", "conversations", "messages"]))
    src = star_sources(spark, SF)
    for file, name in names.items():
        df = getattr(src, name)
        df = df if name != "messages" else df.withColumn("sentiment_score", F.round("sentiment_score", 3))
        df.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in SCHEMAS[file]]).write.parquet(f"{root}/{file}.parquet")
    return root


def test_wrong_columns_are_refused(spark, tmp_path):
    spark.range(3).selectExpr("id AS user_id", "'x' AS full_name").write.parquet(str(tmp_path / "dim_users.parquet"))
    with pytest.raises(ValueError, match="user_id: expected int, found bigint.*country: expected string, found nothing"):
        read_source(spark, str(tmp_path), "dim_users")


def test_staging_keeps_the_decimal_value_of_floats(spark):
    df = spark.createDataFrame([(-0.2, 1234.56)], "sentiment_score float, total_price float")
    assert tuple(stage(df).first()) == (-0.2, 1234.56)


def test_staging_views(spark, raw):
    names = register_staging_views(read_sources(spark, raw))
    assert names == ["stg_users", "stg_hosts", "stg_properties", "stg_bookings", "stg_conversations", "stg_messages"]
    assert spark.sql("SELECT count(*) FROM stg_bookings").first()[0] == 1500


def test_rebuild_from_declared_files(spark, raw, tmp_path):
    out = str(tmp_path)
    checks, fresh = rebuild(spark, raw, out, now="2002-01-01 09:00:00")
    assert checks.count() == 91
    failed = [(r["check"], r.model, r.column, r.failures) for r in checks.filter("status = 'fail'").collect()]
    assert failed == []
    assert {r.model: r.status for r in fresh.collect()} == {"conversations": "pass", "messages": "pass"}
    events = spark.read.parquet(f"{out}/marts/loss_events")
    stages = spark.read.parquet(f"{out}/marts/loss_by_stage")
    assert stages.agg(F.sum("bookings")).first()[0] == events.count() > 0
    months = [d for d in os.listdir(f"{out}/marts/loss_events") if d.startswith("activity_month=")]
    assert len(months) == events.select("activity_month").distinct().count() > 6
    assert all(len(os.listdir(f"{out}/marts/loss_events/{m}")) <= 4 for m in months)  # two files and their sums
    parts = sorted((tmp_path / "extracts" / "stage_value").glob("part-*"))
    assert len(json.loads("".join(p.read_text() for p in parts))["rows"]) == stages.count()
    assert spark.sql("SELECT count(*) FROM mart_loss_by_stage").first()[0] == stages.count()
    assert spark.sql("SELECT count(*) FROM int_conversation_log").first()[0] == spark.table("stg_messages").count()
    chosen = spark.read.parquet(f"{out}/extracts/drill_down_selection").select("conversation_id").distinct().count()
    lines = spark.read.json(f"{out}/extracts/drill_down_messages")
    assert lines.select("conversation_id").distinct().count() == chosen
    first = {t: spark.read.parquet(f"{out}/marts/{t}").collect() for t in ("loss_by_stage", "price_quintile_risk")}
    rebuild(spark, raw, out, now="2002-01-01 09:00:00")
    for t, rows in first.items():
        assert sorted(map(str, spark.read.parquet(f"{out}/marts/{t}").collect())) == sorted(map(str, rows))
