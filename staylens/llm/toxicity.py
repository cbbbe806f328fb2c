"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels say which documents are toxic, not which words. A feature of a word (the word, its beginning, its
end) is taken as toxic where a G-test over labelled documents finds it in far more toxic ones than
chance would put there, beyond all doubt for the number of features tried; words with such a feature in
toxic documents are the labelled tokens. The field learns from windows of those tokens: weights of
features and of the four transitions. Forward and backward passes give each word's probability; a
document's score is a logistic function of the chance that any of its words is toxic and of how many are.

Fitting takes at most TRAIN_DOCUMENTS labelled documents and WINDOWS windows, the ones with the least
hash of their id; scoring covers all documents with all their words. Windows of a toxic document are
those that hold a toxic feature; a clean one gives two per block of BLOCK_CHARS characters, at the block's
first word and at its middle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.store import stored

TRAIN_DOCUMENTS = 20_000
WINDOWS = 4_000
WINDOW = 64
LEAST_WEIGHT = 1e-3
BLOCK_CHARS = 1 << 20
WORDS_KEPT = 300_000
TOXIC_SHARE = 0.5
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """One that all words share, the word, its first three to five letters and its last three."""
    word = word.lower()
    return ["", "w" + word, *("p" + word[:n] for n in (3, 4, 5) if len(word) > n), *(["s" + word[-3:]] if len(word) > 3 else [])]


def words(text: str) -> Iterator[tuple[int, list[str]]]:
    """(offset, words) of successive blocks of a text, so a very long text never has all its words in memory."""
    at = 0
    while at < len(text):
        end = at + BLOCK_CHARS
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield at, WORD.findall(text, at, end)
        at = end


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


@dataclass
class Field:
    """Weights for the tag "toxic" against "clean": features, start, transitions [from, to], and the score's logistic."""

    weights: dict[str, float]
    start: float
    moves: np.ndarray
    logistic: tuple[float, float, float]

    def emission(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))

    def log_odds(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log odds of the marginals of many documents' words, laid end to end in falling order of length."""
        (t00, t01), (t10, t11) = self.moves
        offsets = np.cumsum(lengths) - lengths
        forward, backward = emissions.copy(), np.zeros_like(emissions)
        longest = int(lengths[0]) if len(lengths) else 0
        alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
        first = offsets[: alive[0]] if longest else offsets
        forward[first] += self.start
        for t in range(1, longest):
            here = offsets[: alive[t]] + t
            x = forward[here - 1]
            forward[here] += np.logaddexp(x + t11, t01) - np.logaddexp(x + t10, t00)
        for t in range(longest - 1, 0, -1):
            here = offsets[: alive[t]] + t
            y = emissions[here] + backward[here]
            backward[here - 1] = np.logaddexp(y + t11, t10) - np.logaddexp(y + t01, t00)
        return forward + backward


def _gradient(field: Field, learned: np.ndarray, slots: np.ndarray, tags: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Of the log likelihood of windows (rows) of words (columns) with feature slots, tags and a mask of real words."""
    emission = np.zeros((*tags.shape, 2))
    emission[..., 1] = np.append(learned, 0.0)[slots].sum(axis=-1)
    rows, steps = tags.shape
    alpha, beta = np.zeros((steps, rows, 2)), np.zeros((steps, rows, 2))
    alpha[0] = emission[:, 0] + np.array([0.0, field.start])
    for t in range(1, steps):
        moved = np.logaddexp.reduce(alpha[t - 1][:, :, None] + field.moves[None], axis=1) + emission[:, t]
        alpha[t] = np.where(real[:, t, None], moved, alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        moved = np.logaddexp.reduce(field.moves[None] + (emission[:, t + 1] + beta[t + 1])[:, None, :], axis=2)
        beta[t] = np.where(real[:, t + 1, None], moved, beta[t + 1])
    total = np.logaddexp.reduce(alpha[-1], axis=1)
    marginal = np.exp(alpha + beta - total[None, :, None])[..., 1].T * real
    error = (tags - marginal) * real
    flat, each = slots.reshape(-1), np.repeat(error.reshape(-1), slots.shape[-1])
    weights = np.bincount(flat, weights=each, minlength=len(learned) + 1)[:-1]
    moves = np.zeros((2, 2))
    for t in range(1, steps):
        on = real[:, t]
        pair = np.exp(alpha[t - 1][on][:, :, None] + field.moves[None] + (emission[on, t] + beta[t][on])[:, None, :] - total[on][:, None, None])
        moves -= pair.sum(axis=0)
        np.add.at(moves, (tags[on, t - 1], tags[on, t]), 1.0)
    return weights, float(error[:, 0].sum()), moves


def train(windows: list[tuple[list[str], list[int]]], rounds: int = 100, rate: float = 0.4, decay: float = 1e-5) -> Field:
    """AdaGrad on the penalised log likelihood of all windows."""
    field = Field({}, 0.0, np.zeros((2, 2)), (0.0, 1.0, 0.0))
    if not windows:
        return field
    number: dict[str, int] = {}
    known = {w: [number.setdefault(f, len(number)) for f in features(w)] for words_, _ in windows for w in words_}
    learned = np.zeros(len(number))
    steps, widest = max(len(t) for _, t in windows), max(map(len, known.values()))
    slots = np.full((len(windows), steps, widest), len(number), dtype=np.int64)
    tags, real = np.zeros((len(windows), steps), dtype=np.int64), np.zeros((len(windows), steps), dtype=bool)
    for i, (words_, marks) in enumerate(windows):
        for j, (w, tag) in enumerate(zip(words_, marks, strict=True)):
            slots[i, j, : len(known[w])], tags[i, j], real[i, j] = known[w], tag, True
    seen = [np.full_like(learned, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        found = _gradient(field, learned, slots, tags, real)
        found = (found[0] - decay * len(windows) * learned, found[1], found[2] - decay * field.moves)
        seen = [s + g * g for s, g in zip(seen, found, strict=True)]
        learned += rate * found[0] / np.sqrt(seen[0])
        field.start += rate * found[1] / math.sqrt(seen[1])
        field.moves += rate * found[2] / np.sqrt(seen[2])
    field.weights = {f: float(learned[i]) for f, i in number.items() if abs(learned[i]) > LEAST_WEIGHT}
    return field


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Penalised logistic regression on two columns, by Newton's method."""
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    penalty = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
    return tuple(beta.tolist())


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A min-hash over three-word windows: near copies mostly share it, other texts hardly ever do.

    A text of fewer words has no window; it has the hash of all its words.
    """
    for b in batches:
        found = []
        for text in b.column("text").to_pylist():
            least, tail = None, []
            for _, block in words(text or ""):
                block = tail + block
                for gram in zip(block, block[1:], block[2:], strict=False):
                    hashed = xxhash.xxh64_intdigest(" ".join(gram)) >> 1
                    least = hashed if least is None else min(least, hashed)
                tail = block[-2:]
            found.append(xxhash.xxh64_intdigest(" ".join(tail)) >> 1 if least is None else least)
        yield b.append_column("signature", pa.array(found, pa.int64()))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[str] = []
        marks: list[int] = []
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            found = {f for w in {w for _, block in words(text or "") for w in block} for f in features(w)}
            out += found
            marks += [toxic] * len(found)
        yield pa.record_batch([pa.array(out, pa.string()), pa.array(marks, pa.int64())], ["feature", "toxic"])


def _toxic_features(sample: DataFrame) -> set[str]:
    """Features that toxic documents of the sample hold beyond chance."""
    sizes = sample.agg(F.sum("toxic"), F.count("*")).first()
    toxic, all_ = sizes[0] or 0, sizes[1]
    if not toxic or toxic == all_:
        return set()
    counts = sample.mapInArrow(_count_features, "feature string, toxic bigint").groupBy("feature").agg(F.sum("toxic").alias("k"), F.count("*").alias("n"))
    counts = stored(counts.filter("k >= 3"))
    tried = max(2, counts.count())
    share = toxic / all_
    clean = F.col("n") - F.col("k")
    test = 2 * (F.col("k") * F.log(F.col("k") / (F.col("n") * share)) + F.when(clean > 0, clean * F.log(clean / (F.col("n") * (1 - share)))).otherwise(0.0))
    often = F.col("k") > TOXIC_SHARE * F.col("n")
    return {r["feature"] for r in counts.filter(often & (test > 2 * math.log(tried) + 6)).select("feature").collect()}


def _windows(toxic_features: set[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for at, block in words(text or ""):
                    hits = [i for i, w in enumerate(block) if toxic and not toxic_features.isdisjoint(features(w))]
                    chosen = dict.fromkeys(i - i % WINDOW for i in hits) if toxic else {0: None, len(block) // 2: None}
                    marked = set(hits)
                    for i in chosen:
                        part = block[i : i + WINDOW]
                        if part:
                            rows.append((xxhash.xxh64_intdigest(f"{at}:{i}:{' '.join(part)}") >> 1, part, [int(i + j in marked) for j in range(len(part))]))
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            types = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["place", "words", "tags"])

    return cut


SCORED = "any_toxic double, many_toxic double, spans array<struct<start: bigint, end: bigint, probability: double>>"


def _scorer(field: Field, carried: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def spans(text: str, odds: np.ndarray) -> list[dict]:
        """Runs of words that are more likely toxic than not, as character offsets."""
        hot, out, last, n = set(np.flatnonzero(odds > 0).tolist()), [], -2, 0
        for at, block in words(text):
            if hot.isdisjoint(range(n, n + len(block))):
                n += len(block)
                continue
            for i, m in enumerate(WORD.finditer(text, at, at + BLOCK_CHARS + len(block[-1])), n):
                if i >= n + len(block):
                    break
                if i in hot:
                    p = 1 / (1 + math.exp(-min(700.0, float(odds[i]))))
                    if last == i - 1:
                        out[-1]["end"], out[-1]["probability"] = m.end(), max(p, out[-1]["probability"])
                    else:
                        out.append({"start": m.start(), "end": m.end(), "probability": p})
                    last = i
            n += len(block)
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            parts = []
            for text in texts:
                found = []
                for _, block in words(text):
                    if len(known) > WORDS_KEPT:
                        known.clear()
                    for w in set(block).difference(known):
                        known[w] = field.emission(w)
                    found.append(np.array(list(map(known.__getitem__, block)), dtype=np.float64))
                parts.append(np.concatenate(found) if found else np.zeros(0))
            lengths = np.array([len(p) for p in parts], dtype=np.int64)
            order = np.argsort(-lengths, kind="stable")
            odds = field.log_odds(np.concatenate([parts[i] for i in order]) if len(order) else np.zeros(0), lengths[order])
            any_, many, found_spans = np.zeros(len(texts)), np.zeros(len(texts)), [[] for _ in texts]
            at = 0
            for i in order.tolist():
                own = odds[at : at + int(lengths[i])]
                at += int(lengths[i])
                # log of the odds that some word is toxic, and of the expected number.
                none = -np.logaddexp(0, own).sum()
                any_[i] = min(20.0, max(-20.0, math.log(max(-math.expm1(none), 1e-9)) - none)) if len(own) else -20.0
                many[i] = math.log1p(float((1 / (1 + np.exp(-np.clip(own, -50, 50)))).sum()))
                if len(own) and own.max() > 0:
                    found_spans[i] = spans(texts[i], own)
            yield pa.record_batch([b.column(carried), pa.array(any_), pa.array(many), pa.array(found_spans, spans_type)], [carried, "any_toxic", "many_toxic", "spans"])

    return score


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS, windows: int = WINDOWS) -> Field:
    """Learn from the rows of `labels` (doc_id, toxic) that are not held out. Only ids and the toxic mark are read.

    Null labels and ids count for nothing; a document labelled twice is toxic if either label says so. Of
    rows that share an id the smallest text is learned from.
    Without labels, or with labels of one kind, the field knows nothing and scores all documents alike.
    """
    known = labels.filter("doc_id is not null and toxic is not null").select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["toxic"].cast("bigint").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_documents)
    # At most train_documents pairs of numbers.
    # One text of each id, counted down inside the tasks: no id brings more rows than another.
    named = _texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    named = named.mapInArrow(_signatures, "doc_id bigint, text string, toxic bigint, signature bigint")
    # Copies would make any of their words look toxic; one text of each group of at most train_documents rows stays.
    first = F.row_number().over(Window.partitionBy("signature").orderBy(F.desc("toxic"), "doc_id", "text"))
    sample = stored(named.withColumn("place", first).filter("place = 1").select("doc_id", "text", "toxic"))
    toxic_features = _toxic_features(sample)
    cut = sample.mapInArrow(_windows(toxic_features), "place bigint, words array<string>, tags array<bigint>")
    tagged = [(r["words"], r["tags"]) for r in cut.orderBy("place", "words").limit(windows).collect()]
    field = train(tagged)
    rows = sample.mapInArrow(_scorer(field, "toxic"), f"toxic bigint, {SCORED}").select("any_toxic", "many_toxic", "toxic").collect()
    if rows:
        x = np.array([(r[0], r[1]) for r in rows], dtype=np.float64)
        field.logistic = _fit_logistic(x, np.array([float(r[2]) for r in rows]))
    return field


def scored(docs: DataFrame, field: Field, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) per row of `docs` (doc_id, text; other columns are ignored).

    `spans` are character ranges of words more likely toxic than not, neighbours joined, with their
    highest probability. Null and empty texts get the score of a text without words; rows that repeat a
    text get the same score; null ids stay and are not held out. An empty table gives no rows.
    """
    found = _texts(docs).mapInArrow(_scorer(field, "doc_id"), f"doc_id bigint, {SCORED}")
    a, b, c = field.logistic
    score = 1 / (1 + F.exp(-(a + b * F.col("any_toxic") + c * F.col("many_toxic"))))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score.alias("score"), "spans").select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans"
    )
