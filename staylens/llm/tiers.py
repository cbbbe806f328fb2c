"""Hierarchical multi-length packing: context tiers, windows filled from shorter tiers, balanced steps.

Each task packs the documents of its own partition, a pool of bounded size at a time, so nothing is
shuffled and memory does not grow with the input. In a pool

* a document's whole windows of the longest context stand alone, and what remains (or all of a shorter
  document) goes to the smallest tier that holds it;
* every tier, longest first, packs its own pieces best-fit by falling length, and fills the gap of a
  window with the longest pieces of shorter tiers that fit;
* when only longer pieces are left for a gap, the shortest of those is cut, so a window is full;
* what fills no window of the shortest tier waits for the next pool.

The last remainder of a partition is cut into windows of falling powers of two, so no window needs
padding: a batch takes windows of one length. Windows of one tier are dealt to step groups of equal
token count, heaviest attention cost first, always to the lightest group with room.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from staylens.llm.tokens import chunk_tokenizer

TIERS = (2048, 1024, 512, 256)
END_ID = 1
POOL_TOKENS = 1 << 20
STEP_WINDOWS = 16
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint, tier int, step_group bigint"
)

# A piece is (length, document number in the pool, first id in it).
Piece = tuple[int, int, int]


class _Shelf:
    """Pieces of the pool in order of length, in one list per tier."""

    def __init__(self, tiers: tuple[int, ...]) -> None:
        self.tiers = tiers[::-1]
        self.shelves: list[list[Piece]] = [[] for _ in tiers]

    def tier_of(self, length: int) -> int:
        return bisect_left(self.tiers, length)

    def put(self, piece: Piece) -> None:
        insort(self.shelves[self.tier_of(piece[0])], piece)

    def take_fitting(self, gap: int, below: int) -> Piece | None:
        """The longest piece of at most `gap` ids from the tiers up to number `below`."""
        for k in range(min(below, self.tier_of(gap)), -1, -1):
            at = bisect_right(self.shelves[k], (gap, 1 << 62, 0)) - 1
            if at >= 0:
                return self.shelves[k].pop(at)
        return None

    def take_longer(self, gap: int) -> Piece | None:
        """The shortest piece of more than `gap` ids."""
        for k in range(self.tier_of(gap), len(self.shelves)):
            at = bisect_right(self.shelves[k], (gap, 1 << 62, 0))
            if at < len(self.shelves[k]):
                return self.shelves[k].pop(at)
        return None

    def tokens(self) -> int:
        return sum(p[0] for shelf in self.shelves for p in shelf)


def _fill(shelf: _Shelf, size: int, tier: int) -> list[Piece]:
    """One window of `size` ids; a piece that is cut leaves its rest on the shelf."""
    window, gap = [], size
    while gap:
        piece = shelf.take_fitting(gap, tier)
        if piece is None:
            length, doc, start = shelf.take_longer(gap)
            piece = (gap, doc, start)
            shelf.put((length - gap, doc, start + gap))
        window.append(piece)
        gap -= piece[0]
    return window


def pack_pool(lengths: list[int], tiers: tuple[int, ...], last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces that fill none. With `last` nothing is left over."""
    longest, shelf, windows = tiers[0], _Shelf(tiers), []
    for doc, n in enumerate(lengths):
        whole = n - n % longest
        windows += [[(longest, doc, at)] for at in range(0, whole, longest)]
        if n > whole:
            shelf.put((n - whole, doc, whole))
    left = shelf.tokens()
    for tier in range(len(tiers) - 1, -1, -1):
        size = shelf.tiers[tier]
        while shelf.shelves[tier] and left >= size:
            windows.append(_fill(shelf, size, tier))
            left -= size
    while left >= shelf.tiers[0]:
        size = max(t for t in shelf.tiers if t <= left)
        windows.append(_fill(shelf, size, shelf.tiers.index(size)))
        left -= size
    if last:
        while left:
            size = 1 << (left.bit_length() - 1)
            windows.append(_fill(shelf, size, len(tiers) - 1))
            left -= size
    return windows, sorted(p for s in shelf.shelves for p in s)


def balanced(windows: list[list[Piece]], step_windows: int, longest: int) -> list[int]:
    """A group number per window: groups hold windows of one size, as many ids each, with like attention cost."""
    groups = [0] * len(windows)
    by_size: dict[int, list[int]] = {}
    for i, w in enumerate(windows):
        by_size.setdefault(sum(p[0] for p in w), []).append(i)
    first = 0
    for size in sorted(by_size, reverse=True):
        members = by_size[size]
        room = step_windows * max(1, longest // size)
        n = -(-len(members) // room)
        members.sort(key=lambda i: (-sum(p[0] * p[0] for p in windows[i]), i))
        heap, held = [(0, g) for g in range(n)], [0] * n
        for i in members:
            cost, g = heapq.heappop(heap)
            groups[i], held[g] = first + g, held[g] + 1
            if held[g] < room:
                heapq.heappush(heap, (cost + sum(p[0] * p[0] for p in windows[i]), g))
        first += n
    return groups


def _packer(path: str, tiers: tuple[int, ...], step_windows: int, pool_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    end = END_ID.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Numbers are unique over the table: the partition's number above a running one.
        base = TaskContext.get().partitionId() << 40
        sequences = steps = 0
        # Per piece of the pool: document id, ids, place of the first of them, ids of the document.
        pool: list[tuple] = []

        def closed(last: bool) -> tuple[pa.RecordBatch, list[tuple]]:
            nonlocal sequences, steps
            windows, rest = pack_pool([len(p[1]) // 4 for p in pool], tiers, last)
            group = balanced(windows, step_windows, tiers[0])
            out: list[list] = [[] for _ in names]
            for number, window in enumerate(windows):
                at, size = 0, sum(p[0] for p in window)
                for length, doc, start in window:
                    doc_id, ids, before, total = pool[doc]
                    row = (doc_id, before + start, length, ids[4 * start : 4 * (start + length)], total, base + sequences + number, at, size, base + steps + group[number])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    at += length
            sequences, steps = sequences + len(windows), steps + max(group, default=-1) + 1
            types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
            kept = [(pool[d][0], pool[d][1][4 * s : 4 * (s + n)], pool[d][2] + s, pool[d][3]) for n, d, s in rest]
            return pa.record_batch([pa.array(c, t) for c, t in zip(out, types, strict=True)], names), kept

        tokens, tokenizer = 0, chunk_tokenizer(path)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), tokenizer.ids(texts), strict=True):
                ids = found + end
                pool.append((doc_id, ids, 0, len(ids) // 4))
                tokens += len(ids) // 4
                if tokens >= pool_tokens:
                    rows, pool = closed(last=False)
                    tokens = sum(len(p[1]) // 4 for p in pool)
                    yield rows
        yield closed(last=True)[0]

    return pack


def packed(
    docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, step_windows: int = STEP_WINDOWS, pool_tokens: int = POOL_TOKENS
) -> DataFrame:
    """One row per piece of a document (doc_id, text; other columns are ignored) in a packed window.

    Rows: the piece's place in its document (`start`, `length`), its `ids` (little-endian unsigned 32
    bit), the ids of the document (`doc_tokens`, end id included), its window (`sequence_id`), place there
    (`offset`), the window's size (`tier`) and `step_group`. `tiers` are powers of two, longest first.
    Every window is full. Null and empty texts are the end id alone; rows that repeat are packed as
    often as they come; null ids stay null. An empty table gives no rows.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be falling powers of two")
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return texts.mapInArrow(_packer(tokenizer, tiers, step_windows, pool_tokens), PIECES)
