"""Line dedup: of a line that several documents hold, only the document with the smallest id keeps it.

A line's key is the line without the white space at both ends, A-Z in lower case. Rows of (128-bit hash
of the key, document, position) are dealt out by ranges of that whole order and sorted, so the rows of
one hash stand together, its first document first, and one pass over a partition tells the lines that
go. Ranges are cut by document and position too: a line that a third of all rows hold spans many
partitions. A partition then does not know how its first hash began, so it leaves that hash's first
document open and names the document that its own last hash began with; these few rows are compared
afterwards. Texts take no part in any of this. The result is one compressed bitmap per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.store import stored

MIN_CHARS = 10
SORTED = "high bigint, low bigint, doc_id bigint, row_key bigint, place int"
MARKED = f"kind int, {SORTED}"
GOES, OPEN, BEGAN = range(3)


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _doc_id(docs: DataFrame) -> Column:
    return docs["doc_id"].cast("bigint")


def _row_key(docs: DataFrame) -> Column:
    """Tells apart rows without an id, or that repeat one with another text."""
    return F.xxhash64(_doc_id(docs), _text(docs))


def line_key(line: bytes) -> bytes:
    return line.strip().lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough to be looked for."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows that repeat id and text say the same; a task says it once.
        seen: set[tuple[int | None, int]] = set()
        for b in batches:
            digests, ids, keys, places = [], [], [], []
            for doc_id, row_key, text in zip(b.column("doc_id").to_pylist(), b.column("row_key").to_pylist(), b.column("text").to_pylist(), strict=True):
                if (doc_id, row_key) in seen:
                    continue
                seen.add((doc_id, row_key))
                before = len(digests)
                for place, line in enumerate(text.split(b"\n")):
                    if _long_enough(key := line_key(line), min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        places.append(place)
                ids += [doc_id] * (len(digests) - before)
                keys += [row_key] * (len(digests) - before)
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            columns = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(places, pa.int32())]
            yield pa.record_batch(columns, ["high", "low", "doc_id", "row_key", "place"])

    thin = docs.select(_doc_id(docs).alias("doc_id"), _row_key(docs).alias("row_key"), _text(docs).cast("binary").alias("text"))
    return thin.mapInArrow(of_batches, SORTED)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sorted rows: GOES for lines of any but the first document of their hash, OPEN for those of the
    first document of the partition's first hash, BEGAN with the first document of its last hash."""
    hash_now: tuple[int, int] | None = None
    owner: tuple[bool, int] = (False, 0)
    in_first_run = True
    began: pa.RecordBatch | None = None
    for b in batches:
        if not b.num_rows:
            continue
        high, low = (b.column(c).to_numpy() for c in ("high", "low"))
        missing = b.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        doc = b.column("doc_id").fill_null(0).to_numpy()
        new = np.empty(len(high), dtype=bool)
        new[0] = (int(high[0]), int(low[0])) != hash_now
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        # Of the run that goes on from the batch before, the owner is known.
        own_doc = np.where(run >= 0, doc[starts[run]] if len(starts) else 0, owner[1])
        own_missing = np.where(run >= 0, missing[starts[run]] if len(starts) else False, owner[0])
        first = (run < (1 if hash_now is None else 0)) & in_first_run
        goes = (doc != own_doc) | (missing != own_missing)
        kind = np.where(goes, GOES, np.where(first, OPEN, -1)).astype(np.int32)
        picked = np.flatnonzero(kind >= 0)
        yield _marked(kind[picked], b.take(pa.array(picked)))
        if len(starts):
            in_first_run = in_first_run and hash_now is None and len(starts) == 1
            began = b.slice(int(starts[-1]), 1)
        hash_now, owner = (int(high[-1]), int(low[-1])), (bool(own_missing[-1]), int(own_doc[-1]))
    if began is not None:
        yield _marked(np.array([BEGAN], np.int32), began)


def _marked(kind: np.ndarray, rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.record_batch([pa.array(kind), *rows.columns], ["kind", *rows.schema.names])


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row_key, place) of the lines that go."""
    order = [F.col("high"), F.col("low"), F.col("doc_id").asc_nulls_last(), F.col("row_key"), F.col("place")]
    marked = stored(line_hashes(docs, min_chars).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream, MARKED))
    # One row per partition: the first document of a hash that goes on is the least that any partition names for it.
    owners = marked.filter(F.col("kind") == BEGAN).groupBy("high", "low").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("owner"))
    late = marked.filter(F.col("kind") == OPEN).join(owners, ["high", "low"]).filter(~F.col("doc_id").eqNullSafe(F.col("owner.doc_id")))
    later = F.col("doc_id").isNull() | (F.col("doc_id") > F.col("owner.doc_id"))
    place = ["doc_id", "row_key", "place"]
    return marked.filter(F.col("kind") == GOES).select(*place).union(late.filter(later).select(*place))


@F.arrow_udf(T.BinaryType())
def _bitmap(n_lines: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for n, places in zip(n_lines.to_pylist(), gone.to_pylist(), strict=True):
        bits = np.ones(n, dtype=np.uint8)
        bits[places or []] = 0
        out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
    return pa.array(out, pa.binary())


@F.arrow_udf(T.BinaryType())
def _kept(data: pa.Array, n_lines: pa.Array, keep: pa.Array) -> pa.Array:
    out = []
    for text, n, packed in zip(data.to_pylist(), n_lines.to_pylist(), keep.to_pylist(), strict=True):
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n, bitorder="little")
        out.append(text if bits.all() else b"\n".join(line for line, stays in zip(text.split(b"\n"), bits.tolist(), strict=True) if stays))
    return pa.array(out, pa.binary())


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` (doc_id, text and any others) with `n_lines`, `n_dropped` and `keep`, a bitmap of the lines that stay.

    `keep` is a zlib stream of one bit per line, the first line in the lowest bit of the first byte.
    Columns of these names are replaced. Null and empty texts are one empty line. Keys of under
    `min_chars` code points stay wherever they are, and so do repeats inside the document that keeps
    the line. Rows with one doc_id are one document; rows without an id are one document whose id is
    larger than any other. Rows that repeat id and text get the same bitmap. An empty table gives no
    rows.
    """
    # A copy of a row may say the same in another task, so places are a set; there are no more than lines in the text.
    gone = repeated_lines(docs, min_chars).groupBy(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key")).agg(F.collect_set("place").alias("_gone"))
    own = [docs[c] for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "keep")]
    # Lines are counted below the join, so that a text goes through it once.
    n_lines = (F.octet_length(_text(docs)) - F.octet_length(F.replace(_text(docs), F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    rows = docs.select(_doc_id(docs).alias("_own_doc"), _row_key(docs).alias("_own_key"), n_lines.alias("n_lines"), F.struct(*own).alias("_row"))
    joined = rows.join(gone, (F.col("_own_key") == F.col("_key")) & F.col("_own_doc").eqNullSafe(F.col("_doc")), "left")
    counted = joined.select("_row", "n_lines", F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"), "_gone")
    return counted.select("_row.*", "n_lines", "n_dropped", _bitmap("n_lines", "_gone").alias("keep"))


def kept_lines(text: Column, n_lines: Column, keep: Column) -> Column:
    """The lines that stay, joined by line feeds, as UTF-8 bytes."""
    return _kept(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), n_lines, keep)
