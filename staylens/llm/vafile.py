"""Exact top-k by inner product with a vector-approximation file.

Vectors of whole numbers are quantised: each dimension's range over the table is cut into 256 cells of
one width, and the approximation of a vector is one byte per dimension. A query's score with the centre
of a vector's cells is off by at most half a cell per dimension, weighted by the query, and that slack is
the same for all vectors. So one pass over the approximations bounds every score from both sides:

1. blocks of approximations meet blocks of queries; a block drops what its own bounds rule out;
2. over all blocks, the k-th best lower bound rules out more;
3. what is left is read in order of its bound, best first, in waves that double: exact vectors are
   fetched and scored, and a query is done when its k-th exact score beats the bound of all unread ones.

Equal vectors are one entry with its k + 1 smallest ids, as no query can return more of them (one may be
its own), so a vector that comes very often is scored once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.store import stored

SCALE = 1024
CELLS = 256
BLOCK_VECTORS = 1 << 14
BLOCK_QUERIES = 1 << 10
EXACT = 2**53
LONG_MAX = 2**63 - 1


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component. Rows without an id, or with a null vector, or null or non-finite components go."""
    found = vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("x")).filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    fine = ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return found.filter(fine).select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _entries(numbers: DataFrame, k: int) -> DataFrame:
    """(entry, dims, v, ids): one row per different vector, with its k + 1 smallest different ids.

    `entry` is a number of its own, as one id may stand in several rows; it holds once the rows are stored.
    """
    ordered = Window.partitionBy("v").orderBy("vec_id")
    ranked = numbers.withColumn("rank", F.dense_rank().over(ordered)).filter(F.col("rank") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("entry"), F.size("v").alias("dims"), "v", "ids"
    )


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: by doubles where no sum can round, else by Python's numbers."""
    if not a.size or not b.size or np.abs(a.astype(float)).max() * np.abs(b.astype(float)).max() * max(1, a.shape[-1]) < EXACT:
        return np.einsum("ij,ij->i", a.astype(np.float64), b.astype(np.float64)).astype(np.int64).astype(object)
    return (a.astype(object) * b.astype(object)).sum(axis=1)


def _blocks(rows: DataFrame, number: str, columns: list[str]) -> DataFrame:
    """Rows with the same dims and block number as one row of arrays, in the order of their entries."""
    packed = rows.groupBy("dims", number).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
    return packed.select("dims", number, *[F.col("rows")[c].alias(c) for c in columns])


def _matrix(column: pa.Array, i: int, dims: int) -> np.ndarray:
    rows = column[i].as_py()
    return np.array(rows, dtype=np.int64).reshape(len(rows), dims)


def _bounds(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidates (query_id, entry, most, least): bounds of the score of pairs that a block can't rule out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                dims = b.column("dims")[i].as_py()
                low, width = (np.array(b.column(c)[i].as_py(), dtype=np.float64) for c in ("low", "width"))
                entries, ids = np.array(b.column("entry")[i].as_py()), np.array(b.column("query_id")[i].as_py())
                cells = np.stack([np.frombuffer(x, dtype=np.uint8) for x in b.column("cells")[i].as_py()])
                queries = _matrix(b.column("q"), i, dims).astype(np.float64)
                middle = queries @ (low + (cells + 0.5) * width).T
                # An entry of the query's id alone gives no row, and there may be any number of them.
                sole = b.column("sole")[i].values
                single, sole = sole.is_valid().to_numpy(zero_copy_only=False), sole.fill_null(0).to_numpy()
                at = np.minimum(np.searchsorted(ids, sole), len(ids) - 1)
                own = np.flatnonzero(single & (ids[at] == sole))
                middle[at[own], own] = -np.inf
                # Half a cell per dimension, and room for the rounding of the sums.
                slack = np.abs(queries) @ (width / 2)
                slack += 1e-9 * (np.abs(queries) @ (np.abs(low) + CELLS * width)) + 1
                if middle.shape[1] > k + 1:
                    kth = np.partition(middle, -(k + 1), axis=1)[:, -(k + 1)]
                    keep = (middle >= (kth - 2 * slack)[:, None]) & (middle > -np.inf)
                else:
                    keep = middle > -np.inf
                q, e = np.nonzero(keep)
                yield pa.record_batch(
                    [pa.array(ids[q]), pa.array(entries[e]), pa.array(middle[q, e] + slack[q]), pa.array(middle[q, e] - slack[q])],
                    ["query_id", "entry", "most", "least"],
                )

    return scan


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        dims = np.array(b.column("dims").to_pylist())
        order = np.argsort(dims, kind="stable")
        values: list[tuple[int, int]] = []
        for d in np.unique(dims):
            rows = order[dims[order] == d]
            part = b.take(pa.array(rows))
            left, right = (np.array(part.column(c).to_pylist(), dtype=np.int64).reshape(len(rows), d) for c in ("q", "v"))
            values += zip(rows.tolist(), _product(left, right).tolist(), strict=True)
        scores = [max(-LONG_MAX - 1, min(LONG_MAX, int(s))) for _, s in sorted(values)]
        yield pa.record_batch([b.column("query_id"), b.column("entry"), b.column("ids"), pa.array(scores, pa.int64())], ["query_id", "entry", "ids", "score"])


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, vec_id, score) per query, ties to the smaller id."""
    rows = scored.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for each of `queries` over all of `vectors` (both vec_id, embedding).

    The score is the inner product of floor(scale * component). A row with the query's own id is never its
    result; ties go to the smaller id; fewer than k candidates give fewer rows. Vectors that are null or
    hold null or non-finite components, or whose id is null, take no part. Vectors are only compared with
    those of the same length. Rows that repeat an id and vector count once; an id with several vectors is a
    candidate with each, and as a query stands for its smallest vector. Scores beyond 64 bits are
    returned as the nearest 64-bit number. An empty table or no queries give no rows.
    """
    entries = stored(_entries(whole_numbers(vectors, scale), k))
    asked = stored(
        whole_numbers(queries, scale).groupBy("vec_id").agg(F.min("v").alias("q")).select(F.col("vec_id").alias("query_id"), F.size("q").alias("dims"), "q")
    )
    size, n_asked = entries.count(), asked.count()
    # The grid: per length of vector, the least value and the cell width of each dimension.
    ends = entries.select("dims", F.posexplode("v").alias("d", "x")).groupBy("dims", "d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    grid = ends.groupBy("dims").agg(F.sort_array(F.collect_list(F.struct("d", "low", "high"))).alias("g"))
    grid = grid.select(
        "dims",
        F.transform("g", lambda g: g["low"].cast("double")).alias("low"),
        F.transform("g", lambda g: F.greatest((g["high"].cast("double") - g["low"].cast("double") + 1) / CELLS, F.lit(1 / CELLS))).alias("width"),
    )
    cell = F.transform(
        F.arrays_zip("v", "low", "width"), lambda z: F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor((z["v"].cast("double") - z["low"]) / z["width"]))).cast("int")
    )
    # One byte per dimension, as the two hex digits of the cell.
    cells = F.unhex(F.array_join(F.transform(cell, lambda c: F.lpad(F.hex(c.cast("bigint")), 2, "0")), ""))
    n_blocks, n_query_blocks = -(-size // block_vectors), -(-n_asked // block_queries)
    approximate = entries.join(grid, "dims").select("dims", "entry", F.when(F.size("ids") == 1, F.col("ids")[0]).alias("sole"), cells.alias("cells"), F.pmod(F.xxhash64("entry"), F.lit(max(1, n_blocks))).alias("block"))
    asked_blocks = _blocks(asked.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(max(1, n_query_blocks)))), "query_block", ["query_id", "q"])
    spread = asked_blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(0, n_blocks - 1)).cast("bigint"))))
    pairs = _blocks(approximate, "block", ["entry", "sole", "cells"]).join(spread, ["dims", "block"]).join(grid, "dims")
    dealt = pairs.repartition("block", "query_block")
    bounded = dealt.mapInArrow(_bounds(k), "query_id bigint, entry bigint, most double, least double")
    by_query = Window.partitionBy("query_id")
    kth = F.max(F.when(F.col("r") == k + 1, F.col("least"))).over(by_query)
    ranked = bounded.withColumn("r", F.row_number().over(by_query.orderBy(F.desc("least"), "entry"))).withColumn("kth", kth)
    open_ = ranked.filter("kth is null or most >= kth").withColumn("place", F.row_number().over(by_query.orderBy(F.desc("most"), "entry")))
    candidates = stored(open_.select("query_id", "entry", "most", "place"))
    exact = entries.select("entry", "dims", "v", "ids")
    best, read, wave = None, 0, 2 * (k + 1)
    while True:
        todo = candidates.filter((F.col("place") > read) & (F.col("place") <= read + wave))
        if best is not None:
            # A query is certain when its k-th score is above the bound of what is next.
            kth_score = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
            todo = todo.join(kth_score, "query_id", "left").filter("kth is null or most >= kth").drop("kth")
        scored = todo.join(exact, "entry").join(asked.select("query_id", "q"), "query_id").select("query_id", "entry", "dims", "q", "v", "ids")
        fresh = _best(scored.mapInArrow(_exact, "query_id bigint, entry bigint, ids array<bigint>, score bigint"), k).select("query_id", "vec_id", "score")
        if best is not None:
            fresh = best.select("query_id", "vec_id", "score").union(fresh)
        best = stored(_best(fresh.select("query_id", F.array("vec_id").alias("ids"), "score"), k))
        read, wave = read + wave, 2 * wave
        kth_score = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        left = candidates.filter(F.col("place") > read).join(kth_score, "query_id", "left").filter("kth is null or most >= kth")
        if left.isEmpty():
            return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
