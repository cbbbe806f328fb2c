"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is the share it should have, times the size of all sources, over its own
size. Each document draws its number of copies from the Poisson distribution of that mean, by inverting
the distribution at a uniform number that is a hash of the document and a seed, so the draw does not
depend on partitions or retries. Copies are then dealt out by a hash of document and copy number, and
sorted by it, which is a global shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.store import settled, stored

SEED = 17
EXPONENT = 0.5
HEX_DIGITS = 13


def _draw_bits(*parts: Column) -> Column:
    """A whole number below 2 ** 52, from a hash of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def _size(docs: DataFrame) -> Column:
    """UTF-8 bytes of the text and one for its end, so that no source has size 0."""
    return F.octet_length(F.coalesce(docs["text"].cast("string"), F.lit(""))) + 1


def source_sizes(docs: DataFrame) -> DataFrame:
    return docs.groupBy(docs["source"].alias("mix_source")).agg(F.sum(_size(docs)).alias("size"))


def tempered_weights(sizes: DataFrame, exponent: float = EXPONENT) -> DataFrame:
    """(mix_source, size, weight): shares in proportion to size ** exponent; 1 leaves the mix as it is, 0 makes all alike."""
    return sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(exponent)))


def poisson_table(rate: float) -> tuple[int, list[float]]:
    """(k, [P(X <= k), P(X <= k + 1), ...]) as far as the values differ from 0 and 1 in a double."""
    if rate <= 0:
        return 0, []
    spread = 12 * math.sqrt(rate) + 40
    low, total, table = max(0, int(rate - spread)), 0.0, []
    for k in range(low, int(rate + spread) + 1):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        table.append(min(total, 1.0))
        if k > rate and total >= 1.0 - 1e-16:
            break
    return low, table


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [poisson_table(r) for r in b.column("rate").to_pylist()]
        lows, tables = [f[0] for f in found], [f[1] for f in found]
        yield pa.record_batch(
            [b.column("mix_source"), b.column("rate"), pa.array(lows, pa.int64()), pa.array(tables, pa.list_(pa.float64()))],
            ["mix_source", "rate", "least", "below"],
        )


def rates(weighted: DataFrame) -> DataFrame:
    """(mix_source, rate, least, below) per source from (mix_source, size, weight); the totals are one row."""
    total = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size")
    kind = weighted.schema["mix_source"].dataType.simpleString()
    # One row beside the few rows of the sources.
    return (
        weighted.join(F.broadcast(total))
        .select("mix_source", rate.alias("rate"))
        .mapInArrow(_tables, f"mix_source {kind}, rate double, least bigint, below array<double>")
    )


def mixed(docs: DataFrame, weighted: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """`docs` (doc_id, text, source and any others) repeated to the target shares and shuffled.

    `weighted` holds (mix_source, size, weight) per source; by default shares go with the root of the
    size. Sources missing there leave the mix, null is a source like any other. New columns: `copy`
    (from 1), `copies` and `shuffle_key`, by which the rows are dealt out and sorted; columns of these
    names are replaced. A document with no copies leaves the mix: that is the operator's purpose. Null
    text counts as empty; rows that repeat id and text draw the same number. An empty table gives no
    rows.
    """
    # Written first, so that Spark knows its size: few sources are broadcast and the texts stay where they are.
    table = stored(rates(weighted if weighted is not None else tempered_weights(source_sizes(docs))))
    # The input travels as one column, so that its names never meet those made here.
    own = [docs[c] for c in docs.columns if c.lower() not in ("copy", "copies", "shuffle_key")]
    rows = docs.select(F.struct(*own).alias("_row"))
    digest = F.md5(F.coalesce(F.col("_row.text").cast("string"), F.lit("")))
    drawn = rows.join(table, F.col("_row.source").eqNullSafe(table["mix_source"])).select(
        "_row", "least", "below", digest.alias("_digest"), settled((_draw_bits(F.lit(seed), F.col("_row.doc_id"), digest) + 0.5) / float(1 << 52)).alias("_u")
    )
    counted = drawn.withColumn("copies", F.col("least") + F.size(F.filter("below", lambda p: p <= F.col("_u"))))
    copies = counted.filter("copies > 0").select("_row", "copies", "_digest", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
    keyed = copies.withColumn("shuffle_key", _draw_bits(F.lit(seed + 1), F.col("_row.doc_id"), F.col("_digest"), F.col("copy")))
    return keyed.select("_row", "copy", "copies", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key").select("_row.*", "copy", "copies", "shuffle_key")
