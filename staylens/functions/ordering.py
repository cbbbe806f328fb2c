"""Positions and ranks over groups that may be far too large for one task.

A group with more rows than one task should sort is cut into segments along its sort order. The
window then runs per segment, and a small summary of the segments (count, last row) supplies what a
row needs from the segments before it. Cut points are a sample of the values, chosen by a hash of the
row's key: their number grows with the group, and they decide only how even the segments are, never
the result. A group of so many segments that its cut points would weigh on every row is sorted into
ranges over the tasks and cut by the place of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions.pin import pin
from staylens.functions.skew import Heavy, heavy_table, rows_per_task, ways

# Expected cut points per `limit` rows.
CUTS_PER_TASK = 2
# A group of more limits than this is cut by ranges.
LIMITS_CUT_BY_POINTS = 100
SEGMENT_STRIDE = 2**31
# The bits that monotonically_increasing_id has for the rows of one partition.
RANGE_BITS = 33


def _cut_points(rows: DataFrame, groups: list[str], value: str, drawn_by: Column, limit: int) -> DataFrame:
    """One row per group with its sorted cut points in blocks: `blocks` and their last values `ends`.

    About CUTS_PER_TASK values per `limit` rows, so all cut points together are about as many as the
    tasks that the rows need. That bounds what is broadcast. Nulls are no cut points.
    """
    drawn = rows.filter(F.col(value).isNotNull() & (F.pmod(F.xxhash64(drawn_by), F.lit(limit)) < CUTS_PER_TASK))
    cuts = drawn.groupBy(*groups).agg(F.sort_array(F.collect_set(value)).alias("_cuts"))
    size = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / size).cast("int")),
        lambda i: F.slice(F.col("_cuts"), i * size + 1, size),
    )
    ends = F.transform("blocks", lambda b: F.element_at(b, -1))
    return cuts.withColumn("blocks", blocks).withColumn("ends", ends).drop("_cuts")


def _cuts_below(x: Column) -> tuple[Column, Column]:
    """Number of cut points below x, and whether x is itself a cut point; 0 in a group without cut points."""
    block = F.size(F.filter("ends", lambda e: e < x))
    inside = F.get(F.col("blocks"), block)
    below = block * F.size(F.get(F.col("blocks"), F.lit(0))) + F.coalesce(F.size(F.filter(inside, lambda e: e < x)), F.lit(0))
    none = F.col("ends").isNull()
    return F.when(none, 0).otherwise(below), F.when(none, False).otherwise(F.coalesce(F.array_contains(inside, x), F.lit(False)))


def _slot(x: Column) -> Column:
    """Even slots lie between two cut points, odd slots hold the rows equal to a cut point. Null for null.

    A value that fills much of the group is almost surely a cut point, so no even slot is heavy. NaN is
    an ordinary value that is larger than all others.
    """
    below, hit = _cuts_below(x)
    return F.when(x.isNotNull(), below.cast("bigint") * 2 + hit.cast("int"))


def _with_segments(df: DataFrame, group: str, order: Sequence[str], heavy: Heavy, limit: int) -> DataFrame:
    """Add `_seg`: 0 for light groups, else a positive number that rises along the sort order of the group."""
    most = limit * LIMITS_CUT_BY_POINTS
    if isinstance(heavy, DataFrame):
        large: Heavy = heavy.filter(F.col("count") > most)
        rows = large.agg(F.sum("count")).first()[0]
        cut: Heavy = heavy.filter(F.col("count") <= most)
    else:
        large = {k: n for k, n in heavy.items() if n > most}
        rows = sum(large.values())
        cut = {k: n for k, n in heavy.items() if n <= most}
    if not rows:
        return _cut_by_points(df, group, order, cut, limit)
    keys = heavy_table(df, group, large)
    ranged = _cut_by_ranges(df.join(keys, group, "left_semi"), group, order, rows, limit)
    return ranged.unionByName(_cut_by_points(df.join(keys, group, "left_anti"), group, order, cut, limit))


def _cut_by_ranges(df: DataFrame, group: str, order: Sequence[str], rows: int, limit: int) -> DataFrame:
    """Rows sorted over the tasks by group and order; a segment is a run of `limit` / CUTS_PER_TASK of them."""
    along = [F.col(group), F.col(order[0]).asc_nulls_last(), F.col(order[1])]
    segment = max(1, limit // CUTS_PER_TASK)
    # Ids rise with the range and inside it.
    place = F.expr(f"monotonically_increasing_id() div {segment} + 1")
    ranged = df.repartitionByRange(_ranges(df, rows, limit), *along).sortWithinPartitions(*along)
    return pin(ranged.withColumn("_seg", place))


def _ranges(df: DataFrame, rows: int, limit: int) -> int:
    """How many ranges to sort: by the limit, but no more tasks than the session deals in or the rows need."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ways(rows, rows_per_task(spark)))
    return min(CUTS_PER_TASK * ways(rows, limit), tasks)


def _cut_by_points(df: DataFrame, group: str, order: Sequence[str], heavy: Heavy, limit: int) -> DataFrame:
    if not heavy:
        return df.withColumn("_seg", F.lit(0).cast("bigint"))
    value, tiebreak = order
    keys = heavy_table(df, group, heavy).select(group, F.lit(True).alias("_heavy"))
    # Layouts of a few groups go to every task. Those of many are joined by group, which is no hot key here.
    small = F.broadcast if isinstance(heavy, dict) else lambda layout: layout
    # Only the heavy rows, and of them two columns, are read again for the layout.
    hot = pin(df.select(group, value, tiebreak).join(small(keys), group, "left_semi"))
    cuts = pin(_cut_points(hot, [group], value, F.struct(F.col(group), F.col(tiebreak)), limit))
    last = F.lit(2**30 + 1)

    def add_slot(rows: DataFrame) -> DataFrame:
        slot = F.when(F.col("_heavy"), F.coalesce(_slot(F.col(value)), last) + 2).otherwise(F.lit(0))
        return (
            rows.join(small(keys), group, "left")
            .join(small(cuts), group, "left")
            .withColumn("_slot", slot.cast("bigint"))
            .drop("ends", "blocks", "_heavy")
        )

    # A slot of equal values can still be heavy: cut it again along the tie-break column.
    placed = add_slot(hot)
    tied = placed.groupBy(group, "_slot").count().filter((F.col("count") > limit) & (F.col("_slot") % 2 == 1)).drop("count")
    tied_rows = placed.join(small(tied), [group, "_slot"], "left_semi")
    again = F.struct(F.col(group), F.col(tiebreak), F.lit("again"))
    tie_cuts = pin(_cut_points(tied_rows, [group, "_slot"], tiebreak, again, limit))
    below, _ = _cuts_below(F.col(tiebreak))
    out = add_slot(df).join(small(tie_cuts), [group, "_slot"], "left").withColumn("_part", below).drop("ends", "blocks")
    return out.withColumn("_seg", F.col("_slot") * SEGMENT_STRIDE + F.col("_part")).drop("_slot", "_part")


def ordered_scan(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    heavy: Heavy,
    lags: Sequence[str] = (),
    limit: int | None = None,
    dims: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of every group along `order` = (value, unique tie-break).

    Adds `position` (1-based), `group_rows` and `prev_<c>` for each column in `lags`. Nulls of the
    value sort last. `dims`, unique on `group`, is inner-joined on the same layout, so the window
    and the join share one shuffle of the rows. `heavy` is what `heavy_keys` found of the groups.
    """
    sort = [F.col(order[0]).asc_nulls_last(), F.col(order[1])]
    if not heavy:
        w = Window.partitionBy(group).orderBy(*sort)
        out = df.withColumns(
            {
                "position": F.row_number().over(w).cast("bigint"),
                **{f"prev_{c}": F.lag(c).over(w) for c in lags},
                "group_rows": F.count("*").over(Window.partitionBy(group)),
            }
        )
        return out if dims is None else out.join(dims, group)

    limit = limit or rows_per_task(df.sparkSession)
    # Many heavy groups, none of which is a hot key: a group stays together, and all its segments with it.
    together = isinstance(heavy, DataFrame) and heavy.filter(F.col("count") > limit * LIMITS_CUT_BY_POINTS).isEmpty()
    df = _with_segments(df, group, order, heavy, limit)
    keys = [group, "_seg"]
    nulls_last = F.struct(F.col(order[0]).isNull(), F.col(order[0]), F.col(order[1]))
    segments = (
        df.filter(F.col("_seg") > 0)
        .groupBy(*keys)
        .agg(F.count("*").alias("_rows"), *[F.max_by(c, nulls_last).alias(f"_last_{c}") for c in lags])
    )
    # One row per segment of a heavy group. Segments are light, so Spark may join them either way.
    along = Window.partitionBy(group).orderBy("_seg")
    seams = segments.select(
        *keys,
        (F.sum("_rows").over(along) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("_total"),
        *[F.lag(f"_last_{c}").over(along).alias(f"_seam_{c}") for c in lags],
    )
    if dims is not None and together:
        df = df.join(dims, group)
    elif dims is not None:
        copies = dims.join(seams.select(*keys), group, "left")
        copies = copies.withColumn("_seg", F.coalesce("_seg", F.lit(0).cast("bigint")))
        df = df.join(copies, keys)
    w = Window.partitionBy(*keys).orderBy(*sort)
    local = df.withColumns(
        {
            "position": F.row_number().over(w).cast("bigint"),
            **{f"prev_{c}": F.lag(c).over(w) for c in lags},
            "group_rows": F.count("*").over(Window.partitionBy(*keys)),
        }
    )
    if together:
        found = F.struct(*[c for c in seams.columns if c not in keys])
        listed = seams.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("_seg", found))).alias("_seams"))
        local = local.join(listed, group, "left").withColumn("_seam", F.col("_seams")[F.col("_seg")]).select("*", "_seam.*")
        local = local.drop("_seams", "_seam")
    else:
        local = local.join(seams, keys, "left")
    return local.withColumns(
        {
            **{f"prev_{c}": F.when(F.col("position") == 1, F.col(f"_seam_{c}")).otherwise(F.col(f"prev_{c}")) for c in lags},
            "position": F.col("position") + F.coalesce("_before", F.lit(0).cast("bigint")),
            "group_rows": F.coalesce("_total", "group_rows"),
        }
    ).drop("_seg", "_before", "_total", *[f"_seam_{c}" for c in lags])


def tile_at(position: Column, rows: Column, tiles: int) -> Column:
    """NTILE of a row whose position and group size are known: the first tiles take the remainder."""
    small, extra = F.floor(rows / tiles), rows % tiles
    wide = extra * (small + 1)
    tile = F.when(position <= wide, F.ceil(position / (small + 1))).otherwise(
        extra + F.ceil((position - wide) / F.greatest(small, F.lit(1)))
    )
    return tile.cast("bigint")


def ntile(df: DataFrame, tiles: int, order: Sequence[str], out: str, rows: int, limit: int | None = None) -> DataFrame:
    """Exact NTILE over the whole table along `order` = (value, unique tie-break).

    `rows` is an upper bound of the row count. When it fits one task this is the plain window;
    beyond that the table is pinned and numbered by segments.
    """
    limit = limit or rows_per_task(df.sparkSession)
    if rows <= limit:
        w = Window.orderBy(F.col(order[0]).asc_nulls_last(), F.col(order[1]))
        return df.withColumn(out, F.ntile(tiles).over(w).cast("bigint"))
    table = pin(df.withColumn("_all", F.lit(0)))
    total = table.count()
    if total == 0:
        return table.drop("_all").withColumn(out, F.lit(None).cast("bigint"))
    placed = ordered_scan(table, "_all", order, heavy={0: total}, limit=limit)
    tile = tile_at(F.col("position"), F.col("group_rows"), tiles)
    return placed.withColumn(out, tile).drop("_all", "position", "group_rows")


def percent_ranks(
    df: DataFrame, key: str, ranks: dict[str, tuple[str, bool]], rows: int, limit: int | None = None
) -> DataFrame:
    """Exact PERCENT_RANK over the whole table, nulls last, for several numeric columns at once.

    `ranks` maps each output column to (input column, descending). `key` is unique and not null, and
    `rows` is the exact row count. When it fits one task these are plain windows. Beyond that all
    columns are ranked as one thin table of (column, value, key), sorted into ranges; a row adds the
    place of its value inside the range to the count of the ranges before it. A value that fills
    several ranges takes its place from the first, so ties of any size stay spread; null rows need no
    sort at all. Both ways give the same ranks, also for NaN (larger than all numbers) and for both
    zeros (equal).
    """
    limit = limit or rows_per_task(df.sparkSession)
    if rows <= limit:
        return df.withColumns(
            {
                out: F.percent_rank().over(
                    Window.orderBy(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last())
                )
                for out, (c, descending) in ranks.items()
            }
        )

    wide = pin(df)
    ranked = wide
    for descending in (False, True):
        columns = {out: c for out, (c, down) in ranks.items() if down == descending}
        if columns:
            ranked = ranked.join(_slot_ranks(wide, key, columns, descending, rows, limit), key)
    return ranked


def _slot_ranks(wide: DataFrame, key: str, columns: dict[str, str], descending: bool, rows: int, limit: int) -> DataFrame:
    """`key` and the percent rank of every column in one direction."""
    values = F.array(*[F.struct(F.lit(out).alias("_out"), F.col(c).cast("double").alias("_value")) for out, c in columns.items()])
    thin = wide.select(key, F.inline(values)).filter(F.col("_value").isNotNull())
    # Equal values are told apart by the key, so that ties of any size spread over ranges.
    along = [F.col("_out"), F.desc("_value") if descending else F.asc("_value"), F.col(key)]
    cut = thin.repartitionByRange(_ranges(wide, rows * len(columns), limit), *along).sortWithinPartitions(*along)
    # Ids rise with the range and inside it: the upper bits count ranges, the lower ones rows.
    placed = pin(cut.withColumn("_at", F.monotonically_increasing_id()))
    sliced = placed.withColumn("_slot", F.shiftright("_at", RANGE_BITS))
    # One row per range and column.
    ends = sliced.groupBy("_out", "_slot").agg(
        F.count("*").alias("_rows"),
        F.min("_at").alias("_from"),
        F.min_by("_value", "_at").alias("_first"),
        F.max_by("_value", "_at").alias("_last"),
    )
    before = F.sum("_rows").over(Window.partitionBy("_out").orderBy("_slot")) - F.col("_rows")
    slots = pin(ends.withColumn("_before", before))
    # Where a value that stands at the end of a range begins there: only such values go on in the next one.
    open_ended = sliced.join(F.broadcast(slots.select("_out", "_slot", "_from", "_before", "_last")), ["_out", "_slot"])
    begun = (
        open_ended.filter(F.col("_value") == F.col("_last"))
        .groupBy("_out", "_value")
        .agg(F.min(F.col("_before") + F.col("_at") - F.col("_from")).alias("_begun"))
    )
    carried = (
        slots.select("_out", "_slot", "_from", "_before", F.col("_first").alias("_value"))
        .join(begun, ["_out", "_value"], "left")
        .withColumnRenamed("_value", "_first")
    )
    carried = pin(carried)
    same = Window.partitionBy("_out", "_slot", "_value")
    inside = F.min("_at").over(same) - F.col("_from") + F.col("_before")
    ranked = (
        sliced.join(F.broadcast(carried), ["_out", "_slot"])
        .withColumn("_rank", F.when(F.col("_value") == F.col("_first"), F.least("_begun", inside)).otherwise(inside))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("_out") == out, F.col("_rank"))).alias(out) for out in columns])
    )
    # Nulls rank behind all values, so at their number.
    counts = wide.agg(*[F.count(c).alias(out) for out, c in columns.items()]).first()
    steps = max(rows - 1, 1)
    found = wide.select(key).join(ranked, key, "left")
    return found.select(key, *[(F.coalesce(out, F.lit(counts[out])).cast("double") / steps).alias(out) for out in columns])
