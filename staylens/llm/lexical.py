"""Ranked lexical search by bag deduplication: documents that no item can tell apart are scored once.

A document is restricted to the terms that the items use. What is left, the counts of those terms (its
bag) and its length measure m, decides every score, so documents with the same bag and m are one class.
Classes are met by hash and verified by the bag itself. Each is scored once against all items; the
classes in front are expanded to their members by ascending doc_id.

A term is a run of letters, digits and characters beyond ASCII, with A-Z in lower case. With N documents
of at least one term, L terms in all, and df documents that hold a term, its weight is
floor(1000 * ln((2 N + 2) / (2 df + 1))). A document of n terms has m = 10 + (90 n N) div L, and an item's
term that it holds tf times adds weight * ((10^9 tf) div (1000 tf + 8 m)).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.simhash import word_blocks
from staylens.llm.store import stored

TOP_K = 10
# What is sent to every task at once: bytes of the items' terms, with so many more for each term and item. More items
# are searched block by block.
BLOCK_BYTES = 16 << 20
PAIR_BYTES = 16
ITEM_BYTES = 2048
# Numbers that a task holds at once while it scores.
CELLS = 1 << 20
LAST_ID = (1 << 63) - 1
# ASCII letters and digits stay, capitals become small, every other ASCII character parts terms.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def term_blocks(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, about a megabyte of text at a time."""
    return word_blocks((text or b"").translate(TERM_BYTES))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each pair once; an item that stands in several rows has the terms of all of them."""
    kind = items.schema["item_id"].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [set().union(*term_blocks(t)) for t in b.column("text").to_pylist()]
            rows = pa.array([i for i, terms in enumerate(found) for _ in terms], pa.int64())
            yield pa.record_batch([b.column("item_id").take(rows), pa.array([t for terms in found for t in terms], pa.binary())], ["item_id", "term"])

    texts = items.select(items["item_id"], items["text"].cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(of_batches, f"item_id {kind}, term binary").distinct()


def _in_blocks(pairs: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items dealt into blocks of at most `block_bytes`, and one item of any size beside them."""
    sizes = stored(pairs.groupBy("item_id").agg((F.sum(F.octet_length("term") + PAIR_BYTES) + ITEM_BYTES).alias("bytes")))
    total, largest = sizes.agg(F.sum("bytes"), F.max("bytes")).first()
    if not total:
        return []
    n = 1 if total <= block_bytes else math.ceil(2 * total / block_bytes)
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(n))
        filled = sizes.groupBy(block.alias("block")).agg(F.sum("bytes").alias("bytes"))
        if filled.filter(F.col("bytes") > block_bytes + largest).isEmpty():
            return [pairs.filter(block == i) for i in range(n)] if n > 1 else [pairs]
        n *= 2


def bags(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, bag) per row with at least one term; a bag is the sorted numbers of known terms, then their
    counts, as little-endian unsigned 32-bit numbers."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.get
        for b in batches:
            totals, packed = [], []
            for text in b.column("text").to_pylist():
                n, counts = 0, Counter()
                for terms in term_blocks(text):
                    n += len(terms)
                    counts.update(map(number, terms))
                counts.pop(None, None)
                totals.append(n)
                packed.append(np.array([*(order := sorted(counts)), *(counts[t] for t in order)], "<u4").tobytes())
            yield pa.record_batch([b.column("doc_id"), pa.array(totals, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "n", "bag"])

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(of_batches, "doc_id bigint, n bigint, bag binary").filter("n > 0")


def _parts(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(bag, "<u4").astype(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def document_frequencies(bagged: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term. A task counts its own rows first; there are as many sums as terms."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for b in batches:
            terms = [_parts(x)[0] for x in b.column("bag").to_pylist()]
            if terms:
                held += np.bincount(np.concatenate(terms), minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(at), pa.array(held[at])], ["term", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in bagged.select("bag").mapInArrow(of_batches, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


class Postings:
    """The items of each term, and the terms' weights."""

    def __init__(self, terms: list[int], items: list[int], weights: list[int], n_items: int) -> None:
        order = np.argsort(np.array(terms, np.int64), kind="stable")
        self.items = np.array(items, np.int64)[order]
        self.lengths = np.bincount(np.array(terms, np.int64), minlength=len(weights))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.weights = np.array(weights, np.int64)
        self.n_items = n_items

    def scores(self, held: list[tuple[np.ndarray, np.ndarray]], m: np.ndarray) -> np.ndarray:
        """The score of every class (row) for every item (column)."""
        out = np.zeros((len(held), self.n_items), np.int64)
        row = np.repeat(np.arange(len(held)), [len(t) for t, _ in held])
        term, tf = (np.concatenate([x[i] for x in held]) for i in range(2))
        worth = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        lengths = self.lengths[term]
        # Terms are taken in portions, so that no more than about CELLS pairs of class and item are laid out at once.
        ends = np.cumsum(lengths)
        at = 0
        while at < len(term):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, side="right")))
            n = lengths[at:to]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.items[np.repeat(self.starts[term[at:to]], n) + inner]
            np.add.at(out, (np.repeat(row[at:to], n), item), np.repeat(worth[at:to], n))
            at = to
        return out


class Front:
    """The best `k` classes of each item so far: higher scores first, then smaller first members."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.best: list[list[tuple]] = [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, keys: list[tuple]) -> None:
        rows, items = np.nonzero(scores >= self.least)
        for row, item in zip(rows.tolist(), items.tolist(), strict=True):
            self.best[item].append((-int(scores[row, item]), int(first[row]), *keys[row]))
        for item in np.unique(items).tolist():
            self.best[item] = sorted(self.best[item])[: self.k]
            if len(self.best[item]) == self.k:
                self.least[item] = -self.best[item][-1][0]


def leading_classes(classes: DataFrame, postings: Postings, k: int) -> DataFrame:
    """(item, class_hash, m, first_id, score): of every task its `k` best classes per item, no class with score 0."""
    n_items = postings.n_items
    height = max(1, min(1024, CELLS // max(1, n_items)))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        front = Front(n_items, k)
        for whole in batches:
            for at in range(0, whole.num_rows, height):
                b = whole.slice(at, height)
                m, first, hashes = (b.column(c).to_numpy() for c in ("m", "first_id", "class_hash"))
                scores = postings.scores([_parts(x) for x in b.column("bag").to_pylist()], m)
                front.add(scores, first, list(zip(hashes.tolist(), m.tolist(), strict=True)))
        rows = [(i, h, m, first, -score) for i, best in enumerate(front.best) for score, first, h, m in best]
        names = ["item", "class_hash", "m", "first_id", "score"]
        yield pa.record_batch([pa.array([r[j] for r in rows], pa.int64()) for j in range(5)], names)

    return classes.select("class_hash", "m", "first_id", "bag").mapInArrow(of_batches, "item bigint, class_hash bigint, m bigint, first_id bigint, score bigint")


def _keep_first(df: DataFrame, k: int, group: list[str], *order: Column) -> DataFrame:
    """The first `k` rows of each group. Every task cuts its own rows first, so a large group costs no more than a small one."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("_place") <= k)


def _search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    kind = pairs.schema["item_id"].dataType.simpleString()
    listed = [(r["item_id"], bytes(r["term"])) for r in pairs.collect()]
    ids = sorted({i for i, _ in listed}, key=lambda i: (i is None, i))
    item_number, numbers = {i: n for n, i in enumerate(ids)}, {t: n for n, t in enumerate(sorted({t for _, t in listed}))}

    bagged = stored(bags(docs, numbers))
    n_docs, n_all = bagged.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(bagged, len(numbers)).tolist()
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]
    postings = Postings([numbers[t] for _, t in listed], [item_number[i] for i, _ in listed], weights, len(ids))

    measure = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(n_all, 1)}L").cast("bigint")
    members = bagged.filter(F.octet_length("bag") > 0).select("doc_id", measure.alias("m"), "bag")
    members = members.withColumn("class_hash", F.xxhash64("m", "bag"))
    # Equal hashes are one class only if m and the bag are equal too. Copies meet inside the tasks first.
    classes = stored(members.groupBy("class_hash", "m", "bag").agg(F.coalesce(F.min("doc_id"), F.lit(LAST_ID)).alias("first_id")))
    leading = leading_classes(classes, postings, k)
    # Of an item's k best documents, each is in one of its k best classes.
    chosen = stored(_keep_first(leading, k, ["item"], F.col("score").desc(), F.col("first_id"), F.col("class_hash"), F.col("m")).drop("_place"))
    key = ["class_hash", "m", "first_id"]
    # Keys of at most k classes per item of the block, so they may go to every task.
    keys = F.broadcast(chosen.select(*key).distinct())
    wanted = classes.join(keys, key)
    near = members.join(F.broadcast(chosen.select("class_hash", "m").distinct()), ["class_hash", "m"])
    front = _keep_first(near, k, ["class_hash", "m", "bag"], F.col("doc_id").asc_nulls_last()).drop("_place")
    expanded = front.join(wanted, ["class_hash", "m", "bag"]).drop("bag")
    ranked = _keep_first(expanded.join(chosen, key), k, ["item"], F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    names = docs.sparkSession.createDataFrame([(n, i) for n, i in enumerate(ids)], f"item bigint, item_id {kind}")
    return ranked.join(names, "item").select("item_id", F.col("_place").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents (doc_id, text) of each item (item_id, text), scores above 0.

    Equal scores rank by ascending doc_id, a null doc_id last; other columns are ignored. Null and empty
    texts have no terms and count for nothing. Every row is a document, so a row that stands twice ranks
    twice. Rows of one item_id, null included, are one item with the terms of all its texts. An item
    without terms, or whose terms no document holds, gives no rows, and neither does an empty table.
    """
    pairs = stored(item_terms(items))
    kind = items.schema["item_id"].dataType.simpleString()
    found = [_search_block(docs, block, k) for block in _in_blocks(pairs, block_bytes)]
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in found:
        out = block if block is found[0] else out.union(block)
    return out
