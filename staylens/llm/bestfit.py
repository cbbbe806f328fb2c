"""Best-fit-decreasing packing of token ids into binary matrices.

Documents are split into pieces of at most one row, nothing is lost, and pieces go by falling length
to the row with the least room that still holds them. The rows of a pool stand in a segment tree over
room sizes, so each search takes a few steps whatever the number of rows. Tasks pack their own
partition a pool at a time; nothing is shuffled.

A matrix holds `rows` x `width` ids, little-endian unsigned 16 or 32 bit, padded with PAD_ID. Beside it
stand the cumulative segment lengths over the whole matrix, padding being segments of their own, and the
places where positions restart: a piece that continues a document restarts too, and `piece_starts` tells
where in its document it begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from staylens.llm.tokens import chunk_tokenizer

WIDTH = 2048
MATRIX_ROWS = 64
END_ID = 1
PAD_ID = 0
POOL_TOKENS = 1 << 22
MATRICES = (
    "matrix_id bigint, rows int, width int, id_bytes int, ids binary, doc_ids array<bigint>, piece_starts array<bigint>, "
    "piece_lengths array<int>, cu_seqlens array<int>, position_resets array<int>"
)


class RoomTree:
    """Open rows by room left; `best` finds the row with the least room that is enough."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def best(self, need: int) -> tuple[int, int] | None:
        """(room, row), taken out of the tree."""
        node, filled = self.leaves + need, self.filled
        while not filled[node]:
            # Up to the first ancestor with anything to the right, then down to its least leaf.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if filled[2 * node] else 2 * node + 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            filled[node] = 0
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = 0
                node >>= 1
        return room, row


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Numbers of the pieces in each row, placed by falling length."""
    tree, rows = RoomTree(width), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.best(lengths[piece])
        room, row = found or (width, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            tree.add(room - lengths[piece], row)
    return rows


def _packer(path: str, width: int, matrix_rows: int, pool_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = END_ID.to_bytes(4, "little")
    names = [c.split()[0] for c in MATRICES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())] + [pa.list_(pa.int32())] * 3

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, number = chunk_tokenizer(path), TaskContext.get().partitionId() << 40
        kind = np.dtype("<u2" if len(tokenizer.ends_word) <= 1 << 16 else "<u4")
        pool: list[tuple] = []

        def matrices() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = best_fit([len(p[2]) // 4 for p in pool], width)
            for first in range(0, len(rows), matrix_rows):
                part = rows[first : first + matrix_rows]
                matrix = np.full((len(part), width), PAD_ID, dtype=kind)
                docs, starts, lengths, ends, resets = [], [], [], [0], []
                for r, members in enumerate(part):
                    at = 0
                    for p in members:
                        doc_id, start, ids = pool[p]
                        n = len(ids) // 4
                        matrix[r, at : at + n] = np.frombuffer(ids, dtype="<u4")
                        docs.append(doc_id)
                        starts.append(start)
                        lengths.append(n)
                        resets.append(r * width + at)
                        at += n
                        ends.append(r * width + at)
                    if at < width:
                        ends.append((r + 1) * width)
                row = [number, len(part), width, kind.itemsize, matrix.tobytes(), docs, starts, lengths, ends, resets]
                number += 1
                yield pa.record_batch([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        tokens = 0
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokenizer.ids(texts), strict=True):
                ids = found + end
                pool += [(doc_id, at // 4, ids[at : at + 4 * width]) for at in range(0, len(ids), 4 * width)]
                tokens += len(ids) // 4
                if tokens >= pool_tokens:
                    yield from matrices()
                    pool.clear()
                    tokens = 0
        yield from matrices()

    return pack


def matrices(docs: DataFrame, tokenizer: str, width: int = WIDTH, matrix_rows: int = MATRIX_ROWS, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row per matrix of packed ids of `docs` (doc_id, text; other columns are ignored).

    Null and empty texts are the end id alone; rows that repeat are packed as often as they come; null
    ids stay null in `doc_ids`. A very long document fills rows of its own and its rest is packed like
    any piece. An empty table gives no rows.
    """
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.mapInArrow(_packer(tokenizer, width, matrix_rows, pool_tokens), MATRICES)
