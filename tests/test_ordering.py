import random

import pytest
from frames import same
from pyspark.sql import Window
from pyspark.sql import functions as F

from staylens.functions.ordering import ntile, ordered_scan, percent_ranks, tile_at
from staylens.functions.skew import heavy_keys, salted_join


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows; group 7 holds a third of them, and a third of its values are one tie."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        group = 7 if i % 3 == 0 else rng.randrange(100, 400)
        value = None if i % 31 == 0 else 50.0 if i % 9 == 0 else float(rng.randrange(0, 300))
        rows.append((group, value, i, rng.choice(["a", "b", None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g int, x double, id bigint, tag string").repartition(6).cache()


def plain_scan(df):
    w = Window.partitionBy("g").orderBy(F.col("x").asc_nulls_last(), "id")
    return df.withColumns(
        {
            "position": F.row_number().over(w).cast("bigint"),
            "prev_x": F.lag("x").over(w),
            "prev_tag": F.lag("tag").over(w),
            "group_rows": F.count("*").over(Window.partitionBy("g")),
        }
    )


def test_heavy_keys_are_counted_exactly(skewed):
    assert heavy_keys(skewed, "g", limit=200)["g"] == {7: 1000}
    assert heavy_keys(skewed, "g", limit=5000)["g"] == {}


def test_thousands_of_heavy_keys_are_all_found(spark):
    df = spark.range(90_000).selectExpr("if(id < 60000, id % 15000, id) AS k")
    assert heavy_keys(df, "k", limit=3)["k"] == {k: 4 for k in range(15_000)}


def test_heavy_keys_ignore_nulls(spark):
    df = spark.createDataFrame([(None,)] * 50 + [(1,)] * 30 + [(2,)], "k int")
    assert heavy_keys(df, "k", limit=10)["k"] == {1: 30}


@pytest.mark.parametrize("limit", [20, 100, 400])
def test_split_scan_equals_plain_window(skewed, limit):
    heavy = heavy_keys(skewed, "g", limit=limit)["g"]
    assert heavy
    got = ordered_scan(skewed, "g", ("x", "id"), heavy, lags=("x", "tag"), limit=limit)
    assert same(got, plain_scan(skewed))


def test_split_scan_joins_dimensions_on_the_same_layout(spark, skewed):
    dims = spark.createDataFrame([(7, "hot"), (120, "cold"), (9999, "unused")], "g int, name string")
    heavy = heavy_keys(skewed, "g", limit=100)["g"]
    got = ordered_scan(skewed, "g", ("x", "id"), heavy, lags=("x", "tag"), limit=100, dims=dims)
    assert same(got, plain_scan(skewed).join(dims, "g"))


def test_split_scan_has_no_heavy_window_partition(skewed):
    heavy = heavy_keys(skewed, "g", limit=50)["g"]
    from staylens.functions.ordering import _with_segments

    sizes = _with_segments(skewed, "g", ("x", "id"), heavy, 50).groupBy("g", "_seg").count()
    # Cut points are drawn, two per limit on average.
    assert sizes.agg(F.max("count")).first()[0] <= 6 * 50
    assert sizes.filter("g = 7").count() > 20


@pytest.mark.parametrize("limit", [10_000, 150])
def test_ntile_equals_plain_window(skewed, limit):
    w = Window.orderBy(F.col("x").asc_nulls_last(), "id")
    want = skewed.withColumn("t", F.ntile(5).over(w).cast("bigint"))
    got = ntile(skewed, 5, ("x", "id"), "t", rows=3000, limit=limit)
    assert same(got, want)


@pytest.mark.parametrize("limit", [100, 3])
def test_ntile_with_a_remainder(spark, limit):
    df = spark.createDataFrame([(i, 10.0) for i in range(12)], "id bigint, x double")
    got = ntile(df, 5, ("x", "id"), "t", rows=12, limit=limit).orderBy("id")
    assert [r.t for r in got.collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]


def test_ntile_of_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(3)], "id bigint, x double")
    got = ntile(df, 5, ("x", "id"), "t", rows=3, limit=2).orderBy("id")
    assert [r.t for r in got.collect()] == [1, 2, 3]


def test_tile_at_equals_ntile(spark):
    df = spark.range(1, 24).crossJoin(spark.range(1, 24).withColumnRenamed("id", "n")).filter("id <= n")
    w = Window.partitionBy("n").orderBy("id")
    for tiles in (4, 5):
        both = df.select(F.ntile(tiles).over(w).alias("a"), tile_at(F.col("id"), F.col("n"), tiles).alias("b"))
        assert both.filter("a <> b").count() == 0


@pytest.mark.parametrize("limit", [50, 400])
def test_split_percent_ranks_equal_plain_windows(skewed, limit):
    df = skewed.withColumn("y", F.col("id") % 17 * 1.5)
    want = df.withColumns(
        {
            "up": F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_last())),
            "down": F.percent_rank().over(Window.orderBy(F.col("y").desc_nulls_last())),
        }
    )
    got = percent_ranks(df, "id", {"up": ("x", False), "down": ("y", True)}, rows=3000, limit=limit)
    assert same(got, want)


@pytest.mark.parametrize("limit", [3, 60])
def test_split_percent_ranks_of_nan_zeros_and_nulls(spark, limit):
    odd = [float("nan"), 0.0, -0.0, None, float("inf"), -float("inf"), 1.5, -2.5]
    rows = [(i, odd[i * 7 % 8] if i % 3 else float(i * 31 % 97)) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, x double").repartition(3)
    ranks = {"up": ("x", False), "down": ("x", True), "again": ("id", True)}
    want = percent_ranks(df, "id", ranks, rows=400, limit=1000).drop("x")
    assert same(percent_ranks(df, "id", ranks, rows=400, limit=limit).drop("x"), want)


def test_split_percent_ranks_of_ties_over_many_ranges(spark, monkeypatch):
    from staylens.functions import ordering, skew

    # Each row once carried all cut points, so the work grew with the square of the rows.
    monkeypatch.setattr(ordering, "_cut_points", None)
    rows = [(i, 7.0 if i % 2 else float("nan") if i % 12 == 0 else float(i % 40), None if i % 5 else i * 1.0) for i in range(1200)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double").repartition(3)
    ranks = {"up": ("x", False), "down": ("x", True), "other": ("y", False)}
    want = percent_ranks(df, "id", ranks, rows=1200, limit=2000)
    spark.conf.set(skew.ROWS_PER_TASK_CONF, "60")
    try:
        assert same(percent_ranks(df, "id", ranks, rows=1200, limit=20), want)
    finally:
        spark.conf.unset(skew.ROWS_PER_TASK_CONF)


def test_percent_rank_of_one_row(spark):
    df = spark.createDataFrame([(1, 5.0)], "id int, x double")
    assert percent_ranks(df, "id", {"r": ("x", False)}, rows=1, limit=0).first()["r"] == 0.0


def test_percent_rank_nulls_last(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (4, None)], "id int, x double")
    for limit in (10, 1):
        got = percent_ranks(df, "id", {"r": ("x", False)}, rows=4, limit=limit).orderBy("id")
        assert [round(r.r, 4) for r in got.collect()] == [0.0, 0.3333, 0.6667, 0.6667]


def test_salted_join_equals_plain_join(spark, skewed):
    one = spark.range(0, 300).select(F.col("id").cast("int").alias("g"), (F.col("id") * 2).alias("v"))
    heavy = {7: 1000}
    for how in ("inner", "left"):
        got = salted_join(skewed, one, "g", F.col("id"), heavy, how)
        assert same(got, skewed.join(one, "g", how))


def test_salted_join_on_a_table_of_heavy_keys(spark, skewed):
    one = spark.range(0, 300).select(F.col("id").cast("int").alias("g"), (F.col("id") * 2).alias("v"))
    heavy = skewed.groupBy("g").count().filter("count > 5")
    assert same(salted_join(skewed, one, "g", F.col("id"), heavy, limit=5), skewed.join(one, "g"))


def test_salts_follow_the_limit_of_the_caller(spark, skewed, monkeypatch):
    from staylens.functions import skew

    asked = []
    monkeypatch.setattr(skew, "ways", lambda rows, limit: asked.append((rows, limit)) or 10)
    one = spark.range(0, 300).select(F.col("id").cast("int").alias("g"))
    assert salted_join(skewed, one, "g", F.col("id"), {7: 1000}, limit=100).filter("g = 7").count() == 1000
    assert asked == [(1000, 100)]


def test_pin_writes_parquet_to_the_folder_of_the_session(spark):
    from staylens.functions.pin import pin

    df = pin(spark.range(3))
    assert df.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in df.inputFiles()[0]
    assert "ExistingRDD" not in df._jdf.queryExecution().toString()
