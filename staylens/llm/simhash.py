"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where over half of the hashes of its word shingles have it
set. Two fingerprints link at `max_bits` or fewer differing bits. The fingerprint is cut into
segments. If two fingerprints differ in at most r bits, then over m segments at least one segment
differs in at most r // m bits (and in the segments past r % m + 1 in one less, else the sum would
exceed r), so every fingerprint looks up the small Hamming ball of each of its segments in the table
of segments, and each match is verified on all 64 bits.

Only distinct fingerprints are compared, so copies cost nothing. A segment value shared by more than
`crowd` fingerprints would give pairs by the square of its size; those fingerprints, and those that
look such a value up, are linked by balls of half the radius around whole fingerprints instead. Two
fingerprints within r bits meet in such a ball, and all that meet there are linked to one of them.
That gives the same classes with rows in proportion to the fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.components import components
from staylens.llm.store import stored

BITS = 64
SEED = 42
BLOCK_BYTES = 1 << 20
WHITE = b" \t\n\r\x0b\x0c"


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of about a megabyte, so a very long text never has all its words in memory."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        while end < len(data) and data[end] not in WHITE:
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number. A text without words has fingerprint 0."""
    ones, n, tail = np.zeros(BITS, dtype=np.int64), 0, []
    hashed = xxhash.xxh64_intdigest
    for words in word_blocks(data.lower()):
        words = tail + words
        if len(words) >= shingle:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
            hashes = np.array([hashed(g, SEED) for g in grams], dtype=">u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(hashes)
            words = words[len(words) - shingle + 1 :]
        tail = words
    if not n and tail:
        ones += np.unpackbits(np.array([hashed(b" ".join(tail), SEED)], dtype=">u8").view(np.uint8))
        n = 1
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def row_key(docs: DataFrame) -> F.Column:
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(row_key, doc_id, fp) per row. row_key tells apart rows without an id, or that repeat one with another text."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column("row_key"), b.column("doc_id"), pa.array(fps, pa.int64())], ["row_key", "doc_id", "fp"])

    keyed = docs.select(row_key(docs).alias("row_key"), docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return keyed.mapInArrow(of_batches, "row_key bigint, doc_id bigint, fp bigint")


def ball(width: int, radius: int) -> list[int]:
    """All masks of `width` bits with at most `radius` set."""
    return [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _masks(masks: list[int]) -> F.Column:
    return F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks])


def _probe(seg: int, value: F.Column) -> Callable[[F.Column], F.Column]:
    return lambda mask: F.struct(F.lit(seg).alias("seg"), value.bitwiseXOR(mask).alias("key"))


def _segment_rows(fps: DataFrame, segments: int, radii: list[int]) -> DataFrame:
    """(fp, seg, key) for every value in the ball of each segment, nearest included."""
    parts = []
    for s, radius in enumerate(radii):
        if radius >= 0:
            low, high = BITS * s // segments, BITS * (s + 1) // segments
            value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(_signed((1 << (high - low)) - 1)))
            parts.append(F.transform(_masks(ball(high - low, radius)), _probe(s, value)))
    return fps.select("fp", F.explode(F.concat(*parts)).alias("x")).select("fp", "x.seg", "x.key")


def radii(max_bits: int, segments: int) -> list[int]:
    """The radius to search in each segment; -1: none is needed there."""
    a, rest = divmod(max_bits, segments)
    return [a if s <= rest else a - 1 for s in range(segments)]


def _meeting_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) that join up all of fps that are within max_bits, by balls of half that radius."""
    core = max_bits // 2
    masks = ball(BITS, max_bits - core)
    near = fps.select("fp", F.explode(_masks(masks)).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("z"), (F.bit_count("mask") <= core).alias("core")
    )
    centre = near.groupBy("z").agg(F.count("*").alias("n"), F.min(F.when(F.col("core"), F.col("fp"))).alias("v")).filter("n > 1 and v is not null")
    return near.join(centre.select("z", "v"), "z").filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def links(fps: DataFrame, max_bits: int, segments: int, crowd: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints (fp) that give the classes of `max_bits` or fewer differing bits."""
    searched = radii(max_bits, segments)
    table = _segment_rows(fps, segments, [min(r, 0) for r in searched])
    probes = _segment_rows(fps, segments, searched)
    crowded = stored(table.groupBy("seg", "key").count().filter(F.col("count") > crowd).select("seg", "key"))
    extra = None
    if not crowded.isEmpty():
        extra = _meeting_links(probes.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct(), max_bits)
        table = table.join(crowded, ["seg", "key"], "left_anti")
    found = (
        probes.withColumnRenamed("fp", "u")
        .join(table.withColumnRenamed("fp", "v"), ["seg", "key"])
        .filter((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
        .select("u", "v")
    )
    return found if extra is None else found.union(extra)


def near_classes(docs: DataFrame, shingle: int = 3, max_bits: int = 2, segments: int = 2, crowd: int = 1000) -> DataFrame:
    """(row_key, doc_id, fp, component_id, kept) per row of `docs` (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id of the class. `kept` marks one row key per class: the smallest
    (doc_id, row_key); rows that repeat both id and text share it. Null text counts as empty; texts
    without words have fingerprint 0 and link like any other. Null ids are never the smallest unless
    all of the class are null, which gives a null component_id. An empty table gives no rows.
    """
    fps = stored(fingerprints(docs, shingle))
    distinct = stored(fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("least")))
    roots = components(links(distinct.select("fp"), max_bits, segments, crowd))
    labelled = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    heads = labelled.groupBy("root").agg(F.min("least").alias("least"))
    classes = labelled.select("fp", "root").join(heads, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.row_key").alias("_head"))
    return fps.join(classes, "fp").select("row_key", "doc_id", "fp", "component_id", (F.col("row_key") == F.col("_head")).alias("kept"))


def hex_digits(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, **options: int) -> DataFrame:
    """`docs` with one row per class, all its columns kept. Of rows that repeat id and text one stays."""
    heads = near_classes(docs, **options).filter("kept").select(F.col("row_key").alias("_head")).distinct()
    # The input travels as one column, so that its names never meet those made here.
    rows = docs.select(row_key(docs).alias("_own_key"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    kept = rows.join(heads, rows["_own_key"] == heads["_head"])
    return kept.groupBy("_head").agg(F.min("_row").alias("_row")).select("_row.*")
