"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows go from each input partition to each shard is drawn first, from the multivariate
hypergeometric distribution: that is the law of a uniform shuffle, so the rest can be done row by row.
A partition permutes its rows and gives the first of them to shard 0, the next to shard 1 and so on.
As the matrix tells how many rows arrive from the partitions before it, each row knows its place among
the arrivals of its shard, and a second permutation of those places is its slot. Rows are then
exchanged once, and sorted by slot.

The driver draws only for groups of partitions (at most GROUPS x shards numbers); a task draws for the
partitions of one group. Permutations are keyed four-round Feistel networks, so no task holds a shard.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.store import stored

SHARDS = 40
SEED = 23
GROUPS = 1024
BLOCK_ROWS = 1 << 14
ROW_BITS = 33
ROUNDS = 6


def draw(rng: np.random.Generator, sent: list[int], room: np.ndarray) -> np.ndarray:
    """Rows from each sender to each shard; every row sum is `sent`, and the column sums are at most `room`."""
    matrix = np.zeros((len(sent), len(room)), dtype=np.int64)
    for i, n in enumerate(sent):
        left, rest = int(room.sum()), n
        for s, places in enumerate(room):
            if not rest:
                break
            left -= int(places)
            # The generator takes populations below 10 ** 9; for larger ones the normal law of the same
            # mean and variance, rounded into the possible range, cannot be told from it.
            if left == 0:
                got = rest
            elif left + places < 10**9:
                got = int(rng.hypergeometric(int(places), left, rest)) if places else 0
            else:
                share, all_ = places / (places + left), float(places + left)
                deviation = (rest * share * (1 - share) * (all_ - rest) / (all_ - 1)) ** 0.5
                got = min(int(places), rest, max(rest - left, 0, round(rng.normal(rest * share, deviation))))
            matrix[i, s], rest = got, rest - got
        room = room - matrix[i]
    return matrix


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(place: np.ndarray, key: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each place below its size, mapped to another one by the permutation that key and size name."""
    size = size.astype(np.uint64)
    half = ((np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 2) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, open_ = place.astype(np.uint64), np.arange(len(place))
    while len(open_):
        x, h, m, k = out[open_], half[open_], mask[open_], key[open_].astype(np.uint64)
        left, right = x >> h, x & m
        for r in range(ROUNDS):
            salt = _mixed(k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1))
            left, right = right, left ^ (_mixed(right + salt) & m)
        out[open_] = (left << h) | right
        # Values past the size walk on until they fall below it.
        open_ = open_[out[open_] >= size[open_]]
    return out.astype(np.int64)


@F.arrow_udf(T.LongType())
def _permuted(place: pa.Array, key: pa.Array, size: pa.Array) -> pa.Array:
    return pa.array(permuted(*(np.asarray(c.to_numpy(zero_copy_only=False)) for c in (place, key, size))), pa.int64())


def _members(seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def members(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("_part")
        room, base = np.array(parts["room"].iloc[0], dtype=np.int64), np.array(parts["base"].iloc[0], dtype=np.int64)
        rng = np.random.default_rng([seed, int(parts["_group"].iloc[0])])
        matrix = draw(rng, parts["n"].tolist(), room)
        before = base + np.cumsum(matrix, axis=0) - matrix
        return pd.DataFrame({"_part": parts["_part"], "_n": parts["n"], "_cum": list(np.cumsum(matrix, axis=1)), "_base": list(before - np.cumsum(matrix, axis=1) + matrix)})

    return members


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`docs` with `shard` (0 to shards - 1) and `slot` (from 0, without gaps), exchanged and sorted by them.

    Shard sizes differ by one at most. The input is written to the shared folder first, so each row has
    one place, whatever its columns hold: nulls, empty or long texts and repeated rows are rows like any
    other. Columns named shard or slot are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    own = docs.select(F.struct(*[docs[c] for c in names]).alias("row"))
    row = F.monotonically_increasing_id()
    staged = stored(own.select("row", F.shiftright(row, ROW_BITS).alias("_part"), row.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row")))
    counts = staged.groupBy("_part").agg(F.count("*").alias("n")).withColumn("_group", F.col("_part") % GROUPS)
    groups = sorted((r["_group"], r["n"]) for r in counts.groupBy("_group").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in groups)
    sizes = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    room = draw(np.random.default_rng(seed), [n for _, n in groups], sizes)
    base = np.cumsum(room, axis=0) - room
    drawn = spark.createDataFrame(
        [(g, room[i].tolist(), base[i].tolist()) for i, (g, _) in enumerate(groups)], "_group bigint, room array<bigint>, base array<bigint>"
    )
    members = counts.join(drawn, "_group").groupBy("_group").applyInPandas(_members(seed), "_part bigint, _n bigint, _cum array<bigint>, _base array<bigint>")
    # Written first, so that Spark knows its size: a small matrix is broadcast and the rows stay where they are.
    matrix = stored(members)
    local = staged.join(matrix, "_part").withColumn("_place", _permuted("_row", F.col("_part") * 2 + seed * 1_000_003, "_n"))
    sent = local.withColumn("shard", F.size(F.filter("_cum", lambda c: c <= F.col("_place"))))
    # _base already has the partition's rows for earlier shards taken off.
    arrival = sent.select("row", "shard", (F.get("_base", F.col("shard")) + F.col("_place")).alias("_arrival"))
    size = F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    key = F.col("shard") * 2 + 1 + seed * 1_000_003
    placed = arrival.withColumn("slot", _permuted("_arrival", key.cast("bigint"), size.cast("bigint")))
    exchanged = placed.select("row", "shard", "slot").repartition("shard", F.floor(F.col("slot") / BLOCK_ROWS)).sortWithinPartitions("shard", "slot")
    return exchanged.select("row.*", "shard", "slot")
