"""Repeated byte strings by bucket-pointer refinement, spread over tasks.

Every position of the corpus that starts a string of `width` bytes belongs to the bucket of its first
q bytes. A bucket is named by an identifier computed from the bytes, so that all tasks agree on the
names without a table, and the identifier for a longer gram is made from two identifiers that are
there already: the position's own and the one at a later offset. Grams grow in such steps from 64 to
`width` bytes, and each step sorts what is left by those identifiers.

To sort fewer rows, neighbouring positions stand together: of the grams inside a string, the one with
the least identifier is its anchor, and a run of strings with the same anchor is one row. Equal strings
have equal anchors, so they always meet in one bucket. Inside a bucket the rows are sorted by an
identifier of all the bytes of the run:

* rows with the same identifier are copies: every string in them is repeated;
* a bucket with one row holds no repeat;
* different runs in one bucket may share some of their strings. One row of each goes to the next
  step, where longer grams split it. At the last step every string is a bucket of its own.

Only the text of such runs is moved. Rows that are copies inside one batch are combined before the
shuffle, so a passage in a third of all documents sends a row per batch. A bucket is sorted, not
collected: Spark streams it and spills.

Identifiers have 64 bits, and equality is decided by two independent ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.simhash import row_key
from staylens.llm.store import stored

WIDTH = 200
FIRST_GRAM = 64
CHUNK_BYTES = 1 << 21
PLACE_BITS = 22
BATCH_ROWS = 200_000
ROW = "g bigint, r bigint, row_key bigint, start bigint, n int, witness boolean, covered boolean, data binary"


def gram_steps(width: int) -> list[int]:
    """Gram lengths 64, ..., width: each step halves how many grams a string holds. Short widths start lower."""
    first = min(FIRST_GRAM, 1 << max(3, width.bit_length() - 2))
    steps = [first]
    while steps[-1] < width:
        steps.append(min(2 * steps[-1], max(steps[-1] + 1, (steps[-1] + width + 1) // 2)))
        if width - steps[-1] <= width // 20:
            steps[-1] = width
    return steps


def _paired(ids: np.ndarray, offset: int) -> np.ndarray:
    """Identifiers of the grams made of the gram at each position and the one `offset` later."""
    x = ids[:-offset] * np.uint64(0x9E3779B97F4A7C15)
    x += ids[offset:] * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def bucket_ids(data: bytes, steps: list[int]) -> np.ndarray:
    """Identifier of the gram of steps[-1] bytes at each position, by way of all shorter grams."""
    ids = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,)).astype(np.uint64)
    length = 8
    while length < steps[0]:
        ids, length = _paired(ids, length), 2 * length
    for longer in steps[1:]:
        ids, length = _paired(ids, longer - length), longer
    return ids


def _least_in_window(keys: np.ndarray, size: int) -> np.ndarray:
    span, least = 1, keys
    while 2 * span <= size:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    return least if span == size else np.minimum(least[: span - size], least[size - span :])


def runs(pieces: list[bytes], steps: list[int], width: int) -> tuple[np.ndarray, ...]:
    """(piece, first start in it, number of starts, bucket, run identifier) for each run of strings with one anchor."""
    buffer = b"".join(pieces)
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    ends = np.cumsum(lengths)
    ids = bucket_ids(buffer, steps)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (ids & ~mask) | np.arange(len(ids), dtype=np.uint64)
    anchors = (_least_in_window(keys, width - steps[-1] + 1) & mask).astype(np.int64)
    for end in ends[:-1]:
        anchors[end - width + 1 : end] = -1
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    count = np.diff(np.append(first, len(anchors)))
    inside = anchors[first] >= 0
    first, count = first[inside], count[inside]
    piece = np.searchsorted(ends, first, side="right")
    view = memoryview(buffer)
    whole = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (first + count + width - 1).tolist(), strict=True)], dtype=np.uint64)
    return piece, first - (ends - lengths)[piece], count, ids[anchors[first]].view(np.int64), whole.view(np.int64)


def _chunks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[list[int], list[int], list[bool], list[bytes]]]:
    """Pieces of at most CHUNK_BYTES together; a longer text is cut so that each string lies in one piece."""
    found, size = ([], [], [], []), 0
    columns = [batch.column(c).to_pylist() for c in ("row_key", "base", "witness", "data")]
    for key, base, witness, data in zip(*columns, strict=True):
        for at in range(0, len(data) - width + 1, CHUNK_BYTES):
            piece = data[at : at + CHUNK_BYTES + width - 1]
            if size and size + len(piece) > CHUNK_BYTES + width:
                yield found
                found, size = ([], [], [], []), 0
            for column, value in zip(found, (key, base + at, witness, piece), strict=True):
                column.append(value)
            size += len(piece)
    if size:
        yield found


def _marker(steps: list[int], width: int, keep_bytes: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ROW: one per different run of a batch, and one `covered` row per run with a copy in the batch."""

    def combined(parts: list[tuple], texts: list[bytes] | None) -> pa.RecordBatch:
        key, start, n, witness, g, r = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((r, g))
        new = np.concatenate(([True], (g[order][1:] != g[order][:-1]) | (r[order][1:] != r[order][:-1])))
        group = np.cumsum(new) - 1
        size, seen = np.bincount(group), np.bincount(group, weights=witness[order]) > 0
        repeated = (size[group] > 1) | seen[group]
        heads, copies = order[new], order[repeated & ~witness[order]]
        rows = np.concatenate((heads, copies))
        covered = np.concatenate((np.zeros(len(heads), bool), np.ones(len(copies), bool)))
        known = np.concatenate((repeated[new], np.ones(len(copies), bool)))
        data = [None if texts is None or c else texts[i] for i, c in zip(rows.tolist(), covered.tolist(), strict=True)]
        # Rows that are decided only pass through the shuffle; a key of their own spreads them.
        spread = np.where(covered, key[rows] ^ start[rows], g[rows])
        arrays = [spread, r[rows], key[rows], start[rows], n[rows].astype(np.int32), known, covered]
        return pa.record_batch([*map(pa.array, arrays), pa.array(data, pa.binary())], ["g", "r", "row_key", "start", "n", "witness", "covered", "data"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, texts, held = [], [] if keep_bytes else None, 0
        for batch in batches:
            for keys, bases, witnesses, pieces in _chunks(batch, width):
                piece, at, n, g, r = runs(pieces, steps, width)
                parts.append((np.array(keys, dtype=np.int64)[piece], np.array(bases, dtype=np.int64)[piece] + at, n, np.array(witnesses, dtype=bool)[piece], g, r))
                if keep_bytes:
                    texts += [pieces[p][a : a + c + width - 1] for p, a, c in zip(piece.tolist(), at.tolist(), n.tolist(), strict=True)]
                held += len(n)
                if held >= BATCH_ROWS:
                    yield combined(parts, texts)
                    parts, texts, held = [], [] if keep_bytes else None, 0
        if held:
            yield combined(parts, texts)

    return mark


def refined(rows: DataFrame, steps: list[int], width: int, keep_bytes: bool) -> DataFrame:
    """One step over rows (row_key, base, witness, data): runs that are `covered`, and one of each run that is `open`."""
    marked = rows.mapInArrow(_marker(steps, width, keep_bytes), ROW)
    bucket = Window.partitionBy("g", "covered")
    ordered = bucket.orderBy("r")
    beside = marked.withColumns(
        {
            "_new": ~F.lag("r").over(ordered).eqNullSafe(F.col("r")),
            "_last": ~F.lead("r").over(ordered).eqNullSafe(F.col("r")),
            "_mixed": F.min("r").over(bucket) != F.max("r").over(bucket),
        }
    )
    copies = ~(F.col("_new") & F.col("_last"))
    known = F.col("witness") | copies
    return beside.select(
        "row_key",
        "start",
        "n",
        "data",
        known.alias("witness"),
        (F.col("covered") | (copies & ~F.col("witness"))).alias("covered"),
        (~F.col("covered") & F.col("_mixed") & F.col("_new")).alias("open"),
    ).filter("covered or open")


def covered_runs(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row_key, start, n): strings of `width` bytes at start, ..., start + n - 1 of a text come more than once."""
    texts = docs.select(row_key(docs).alias("row_key"), docs["text"].cast("string").cast("binary").alias("data")).filter(F.octet_length("data") >= width)
    rows = texts.select("row_key", F.lit(0).cast("bigint").alias("base"), F.lit(False).alias("witness"), "data")
    steps, found = gram_steps(width), []
    for k in range(len(steps)):
        step = stored(refined(rows, steps[: k + 1], width, keep_bytes=0 < k < len(steps) - 1))
        found.append(step.filter("covered").select("row_key", "start", "n"))
        left = step.filter("open").select("row_key", F.col("start").alias("base"), "n", "witness", "data")
        if k == len(steps) - 1 or left.isEmpty():
            break
        rows = left.drop("n") if k else _with_bytes(left, texts, width)
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    return spans


def _with_bytes(left: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    wanted = left.groupBy("row_key").agg(F.collect_set(F.struct("base", "n", "witness")).alias("wanted"))
    cut = F.transform(
        "wanted",
        lambda x: F.struct(x["base"].alias("base"), x["witness"].alias("witness"), F.substring("data", x["base"].cast("int") + 1, x["n"] + width - 1).alias("data")),
    )
    return texts.join(wanted, "row_key").select("row_key", F.explode(cut).alias("x")).select("row_key", "x.*")


def _merged(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                one: list[dict] = []
                for p in sorted(parts, key=lambda p: p["start"]):
                    end = p["start"] + p["n"] + width - 1
                    if one and p["start"] <= one[-1]["end"]:
                        one[-1]["end"] = max(one[-1]["end"], end)
                    else:
                        one.append({"start": p["start"], "end": end})
                out.append(one)
            yield pa.record_batch([batch.column("row_key"), pa.array(out, spans)], ["_key", "repeat_spans"])

    return merge


def _left(text: bytes, cuts: list[dict]) -> list[bytes]:
    edges = [0, *(e for c in cuts for e in (c["start"], c["end"])), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]


@F.arrow_udf(T.BinaryType())
def _kept(data: pa.Array, spans: pa.Array) -> pa.Array:
    rows = zip(data.to_pylist(), spans.to_pylist(), strict=True)
    return pa.array([b"".join(_left(text, cuts)) if cuts else text for text, cuts in rows], pa.binary())


@F.arrow_udf(T.StringType())
def _kept_text(data: pa.Array, spans: pa.Array) -> pa.Array:
    rows = zip(data.to_pylist(), spans.to_pylist(), strict=True)
    return pa.array(["".join(part.decode("utf-8", "ignore") for part in _left(text or b"", cuts)) for text, cuts in rows], pa.string())


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` with `repeat_spans` (byte ranges of the UTF-8 text) and `kept` (the remaining bytes).

    A byte goes if a string of `width` bytes that covers it starts anywhere else too, in the same or
    another text; overlaps count, every copy goes, and all is judged on the texts as they came. Null
    text counts as empty; texts shorter than `width` are left whole. Rows that repeat an id and a text
    count as copies of each other. An empty table gives no rows. Cuts may fall inside a character, so
    `kept` is binary.
    """
    merged = (
        covered_runs(docs, width)
        .groupBy("row_key")
        .agg(F.collect_set(F.struct("start", "n")).alias("parts"))
        .mapInArrow(_merged(width), "_key bigint, repeat_spans array<struct<start: bigint, end: bigint>>")
    )
    # The input travels as one column, so that its names never meet those made here.
    own = [docs[c] for c in docs.columns if c.lower() not in ("repeat_spans", "kept")]
    rows = docs.select(row_key(docs).alias("_own_key"), F.struct(*own).alias("_row"))
    data = F.coalesce(F.col("_row.text").cast("string"), F.lit("")).cast("binary")
    spans = F.coalesce(merged["repeat_spans"], F.array().cast("array<struct<start: bigint, end: bigint>>"))
    joined = rows.join(merged, rows["_own_key"] == merged["_key"], "left").select("_row", spans.alias("repeat_spans"), data.alias("_data"))
    return joined.select("_row.*", "repeat_spans", _kept("_data", "repeat_spans").alias("kept"))


def kept_text(text: Column, repeat_spans: Column) -> Column:
    """The remaining text. Where a cut falls into a character, its broken half goes too."""
    return F.when(F.size(repeat_spans) == 0, text).otherwise(_kept_text(text.cast("binary"), repeat_spans))
