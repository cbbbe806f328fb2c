import pytest
from pyspark.sql import functions as F

from staylens.operators import quality as q
from staylens.operators.quality import Check


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 0.5, "a", 10), (2, -0.5, "b", 10), (2, 3.0, "z", 10), (None, None, None, 10)]
    return spark.createDataFrame(rows, "id int, x double, tag string, same int")


def test_between(table):
    assert [r.x for r in q.between(table, "x", 0, 1).orderBy("x").collect()] == [-0.5, 3.0]
    assert q.between(table, "x", -0.5, 3).count() == 0


def test_non_negative(table):
    assert [r.x for r in q.non_negative(table, "x").collect()] == [-0.5]
    assert q.non_negative(table, "same").count() == 0


def test_not_null(table):
    assert q.not_null(table, "id").count() == 1 and q.not_null(table, "same").count() == 0


def test_accepted_values(table):
    assert [r.tag for r in q.accepted_values(table, "tag", ["a", "b"]).collect()] == ["z"]
    assert q.accepted_values(table, "tag", ["a", "b", "z"]).count() == 0


def test_not_constant(spark, table):
    assert [r.distinct_value_count for r in q.not_constant(table, "same").collect()] == [1]
    assert q.not_constant(table, "x").count() == 0
    nulls = spark.createDataFrame([(None,), (None,)], "v int")
    assert [r.distinct_value_count for r in q.not_constant(nulls, "v").collect()] == [0]


def test_unique(table):
    assert [tuple(r) for r in q.unique(table, "id").collect()] == [(2, 2)]
    assert q.unique(table, "x").count() == 0


def test_unique_combination(spark, table):
    assert q.unique_combination(table, ["id", "tag"]).count() == 0
    twice = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert [tuple(r) for r in q.unique_combination(twice, ["k", "v"]).collect()] == [(1, None, 2)]


def test_relationships(spark, table):
    parent = spark.createDataFrame([(1,), (None,)], "key int")
    assert [tuple(r) for r in q.relationships(table, "id", parent, "key").collect()] == [(2, 2)]
    assert q.relationships(table, "id", table, "id").count() == 0


def test_value_matches(spark):
    left = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, None), (3, None), (4, 1.0), (9, 7.0)], "k int, v double")
    right = spark.createDataFrame([(1, 6.0), (2, 1.0), (3, None), (4, 1.0)], "k int, w double")
    got = sorted(tuple(r) for r in q.value_matches(left, "v", right, "k", "w").select("k", "model_value", "upstream_value", "n_records").collect())
    assert got == [(1, 5.0, 6.0, 2), (2, None, 1.0, 1)]
    assert q.value_matches(left, "v", left, "k").count() == 0


def test_agg_matches(spark):
    a = spark.createDataFrame([(1.0,), (2.0,), (3.5,)], "v double")
    b = spark.createDataFrame([(6.0, True), (4.0, False)], "w double, keep boolean")
    assert q.agg_matches(a, b, "v", "w", upstream_where="keep").count() == 0  # 0.5 apart
    assert q.agg_matches(a, b, "v", "w", upstream_where="keep", tolerance=0.1).first().diff == 0.5
    assert q.agg_matches(a, b, "v", F.when(F.col("keep"), F.col("w")).otherwise(0.5)).count() == 0
    assert q.agg_matches(a, b, "v", "w").first().compare_value == 10.0
    assert q.agg_matches(a, b, agg="count", tolerance=0).first().diff == 1.0
    assert q.agg_matches(a, b, "v", agg="sum", upstream_agg="count", tolerance=4.4).first().diff == 4.5
    assert q.agg_matches(a.filter("v > 9"), b.filter("w > 9"), "v", "w").count() == 0  # null counts as 0
    assert q.agg_matches(a, b, "v", "w", agg="max", where="v < 3").first().diff == 4.0


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01 12:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )
    for now, status, age in [
        ("2024-01-01 16:00:00", "pass", 14400),
        ("2024-01-01 16:00:01", "warn", 14401),
        ("2024-01-02 00:00:01", "error", 43201),
    ]:
        row = q.freshness(df, "t", now).first()
        assert (row.status, row.age_seconds) == (status, age)
    assert q.freshness(df.filter("t is null"), "t", "2024-01-01 16:00:00").first().status == "error"


def test_suite_counts_every_check(spark, table):
    parent = spark.createDataFrame([(1,)], "id int")
    checks = [
        Check("between", "t", "x", {"low": 0, "high": 1}),
        Check("non_negative", "t", "x"),
        Check("not_null", "t", "id"),
        Check("accepted_values", "t", "tag", {"values": ["a"]}),
        Check("not_constant", "t", "same"),
        Check("not_constant", "t", "x"),
        Check("unique", "t", "id"),
        Check("unique_combination", "t", args={"columns": ["id", "tag"]}),
        Check("relationships", "t", "id", {"parent": "p", "parent_column": "id"}),
        Check("value_matches", "t", "id", {"upstream": "p", "key": "id"}),
        Check("agg_matches", "t", "same", {"upstream": "p", "upstream_column": "id"}),
    ]
    got = {(r["check"], r["column"]): (r.failures, r.status) for r in q.run_checks(checks, {"t": table, "p": parent}).collect()}
    assert got == {
        ("between", "x"): (2, "fail"),
        ("non_negative", "x"): (1, "fail"),
        ("not_null", "id"): (1, "fail"),
        ("accepted_values", "tag"): (2, "fail"),
        ("not_constant", "same"): (1, "fail"),
        ("not_constant", "x"): (0, "pass"),
        ("unique", "id"): (1, "fail"),
        ("unique_combination", "id,tag"): (0, "pass"),
        ("relationships", "id"): (2, "fail"),
        ("value_matches", "id"): (0, "pass"),
        ("agg_matches", "same"): (1, "fail"),
    }


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 1.5D AS x", "'a' AS tag").write.parquet(path)
    checks = [
        Check("between", "t", "x", {"low": 0, "high": 500}),
        Check("non_negative", "t", "x"),
        Check("not_null", "t", "id"),
        Check("accepted_values", "t", "tag", {"values": ["a"]}),
        Check("not_constant", "t", "x"),
    ]
    plan = q.run_checks(checks, {"t": spark.read.parquet(path)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_intermediate_checks_store_only_what_they_read(spark):
    import __spark_entry__ as registry
    from staylens.plans import contracts

    session = registry.Session(spark, registry.SMOKE_DIR)
    stored = session.stored_intermediate()
    assert set(stored["conversation_log"].columns) == {"message_id", "message_seq", "seconds_since_prev_message"}
    assert "event_journey" not in stored["conversation_journeys"].columns
    whole = {**stored, "conversation_log": session.log(), "conversation_journeys": session.journeys(), "booking_cancellation_risk": session.risk()}
    checks = contracts.intermediate_checks()
    found = q.run_checks(checks, stored)
    assert found.count() == len(checks) and sorted(found.collect()) == sorted(q.run_checks(checks, whole).collect())
