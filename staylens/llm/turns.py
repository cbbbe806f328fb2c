"""Conversation structure repair: the cheapest edits that turn a conversation's roles into (s?(ua)+)?.

Rows are kept, given another role, deleted, and empty turns are inserted. Four states are enough: nothing
yet, after the system turn, after a user turn, after an assistant turn. Hirschberg's divide and conquer
finds the edits in linear space: the costs of reaching every state at the middle of the conversation from
its start, and of going on from there to its end, meet; of the cheapest crossings the one whose edits so
far spell the least in ASCII is taken, and both halves are solved alike. To compare spellings without
writing them down, the forward vector carries the rank of each state's spelling beside its cost: edits up
to a row end with that row's own letter, so no spelling is the beginning of another one.

A conversation may be any length. Rows are dealt out by ranges of (conversation, turn), so a long one
spans partitions; it is cut into chunks, each summed up by the costs and ranks between all states. A
chunk is then to its conversation what a row is to a chunk: the same method finds the states where chunks
meet, and every chunk is solved by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import pack
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.store import stored

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The state after one more turn that is inserted or given its role, and the state after a row that is kept, by its initial.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
# What is inserted after the last row, by the state it leaves.
ENDING = ("", INSERT * 2, INSERT, "")
LEGAL = {"su", "ua", "au"}
MUST_GO = 0
INITIALS = "sua"
NEVER = 1 << 50
# Any state can take the way of any other one for two insertions and a deletion at most, counting what ends the
# conversation. One that costs more than that above the cheapest is on no cheapest way.
DOMINATED = 2 * COST[INSERT] + COST[DELETE] + 1
CHUNK_ROWS = 1 << 16
BATCH_ROWS = 10_000
WHITE = " \t\n\x0b\x0c\r"


def row_code(initial: str, must_go: bool, truncated: bool) -> int:
    """All that the edits of a row depend on, as one byte."""
    if must_go:
        return MUST_GO
    return 1 + 2 * (INITIALS.index(initial) if initial in KEPT else len(INITIALS)) + truncated


class Step:
    """From each state to each other: the cost, and the rank of the spelling among those from the same state.

    Vectors are carried relative to their least cost. Few of them occur, so each step keeps what it made of those it met.
    """

    def __init__(self, costs: Sequence[Sequence[int]], ranks: Sequence[Sequence[int]]) -> None:
        self.costs, self.ranks = costs, ranks
        # Cost, rank before and rank here in one number, which is least for the cheapest and then least-spelled way.
        self.into = [[(p, (costs[p][q] << 4) + ranks[p][q]) for p in STATES if costs[p][q] < NEVER] for q in STATES]
        self.onward_known: dict[tuple, tuple] = {}
        self.back_known: dict[tuple, tuple] = {}

    def onward(self, vector: tuple) -> tuple:
        """What the least cost grows by, and costs and ranks after this step for those before it."""
        costs, ranks = vector
        before = [(c << 4) + (r << 2) for c, r in zip(costs, ranks, strict=True)]
        best = [min([before[p] + way for p, way in into if costs[p] < NEVER], default=None) for into in self.into]
        least = min(b >> 4 for b in best if b is not None)
        best = [b if b is not None and (b >> 4) - least <= DOMINATED else None for b in best]
        after = tuple(NEVER if b is None else (b >> 4) - least for b in best)
        return least, (after, tuple(_ranked([None if b is None else b & 15 for b in best])))

    def back(self, costs: tuple) -> tuple:
        """What the least cost grows by, and the costs of going on from before this step for those after it."""
        before = [min(NEVER, *(a + b for a, b in zip(ways, costs, strict=True))) for ways in self.costs]
        least = min(before)
        return least, tuple(c - least if c < NEVER else NEVER for c in before)


def row_ways(code: int) -> list[dict[int, tuple[int, str]]]:
    """By the state before a row and the one after it, cost and spelling of the best edits: inserted turns, then the row's own."""
    kind, truncated = divmod(code - 1, 2)
    ways: list[dict[int, tuple[int, str]]] = [{} for _ in STATES]
    for p in STATES:
        state = p
        for n in range(3):  # with two inserted turns every state that can be inserted has been passed
            edits = [(state, COST[DELETE], DELETE)]
            if code != MUST_GO:
                edits.append((NEXT[state], COST[REROLE] + truncated * TRUNCATED_COST, REROLE))
                if kind < len(INITIALS) and state in KEPT[INITIALS[kind]]:
                    edits.append((KEPT[INITIALS[kind]][state], COST[KEEP] + truncated * TRUNCATED_COST, KEEP))
            for q, cost, letter in edits:
                way = (n * COST[INSERT] + cost, n * INSERT + letter)
                ways[p][q] = min(ways[p].get(q, way), way)
            state = NEXT[state]
    return ways


def _ranked(values: Sequence[Any]) -> list[int]:
    """The place of each value that is not None in ascending order."""
    order = {v: n for n, v in enumerate(sorted(v for v in values if v is not None))}
    return [order.get(v, 0) for v in values]


WAYS = [row_ways(code) for code in range(9)]
ROWS = [
    Step(
        [[WAYS[code][p][q][0] if q in WAYS[code][p] else NEVER for q in STATES] for p in STATES],
        [_ranked([WAYS[code][p][q][1] if q in WAYS[code][p] else None for q in STATES]) for p in STATES],
    )
    for code in range(9)
]


def forward(steps: Sequence[Step], low: int, high: int, start: int) -> tuple[list[int], tuple[int, ...]]:
    """After steps low to high - 1: for each state the least cost from `start`, and the rank of the least spelling of that cost."""
    total, vector = 0, (_only(start), (0,) * 4)
    for i in range(low, high):
        step = steps[i]
        found = step.onward_known.get(vector)
        if found is None:
            found = step.onward_known[vector] = step.onward(vector)
        total, vector = total + found[0], found[1]
    return [min(NEVER, total + c) for c in vector[0]], vector[1]


def backward(steps: Sequence[Step], low: int, high: int, end: int) -> list[int]:
    """For each state the least cost from there, before step `low`, to `end` after step high - 1."""
    total, costs = 0, _only(end)
    for i in range(high - 1, low - 1, -1):
        step = steps[i]
        found = step.back_known.get(costs)
        if found is None:
            found = step.back_known[costs] = step.back(costs)
        total, costs = total + found[0], found[1]
    return [min(NEVER, total + c) for c in costs]


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else NEVER for s in STATES)


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The state before the first step and after each one, on the least-spelled of the cheapest ways from `start` to `end`."""
    states = [start] * (len(steps) + 1)
    states[-1] = end

    def solve(low: int, high: int) -> None:
        if high - low < 2:
            return
        middle = (low + high) // 2
        reached, ranks = forward(steps, low, middle, states[low])
        left = backward(steps, middle, high, states[high])
        states[middle] = min(STATES, key=lambda s: (reached[s] + left[s], ranks[s]))
        solve(low, middle)
        solve(middle, high)

    solve(0, len(steps))
    return states


def last_state(steps: Sequence[Step]) -> int:
    """The state in which the rows of a conversation end best, counting what is inserted after them."""
    costs, ranks = forward(steps, 0, len(steps), NOTHING)
    return min(STATES, key=lambda s: (costs[s] + COST[INSERT] * len(ENDING[s]), ranks[s]))


def summed_up(codes: bytes) -> Step:
    """The rows of a chunk as one step."""
    ways = [forward([ROWS[c] for c in codes], 0, len(codes), p) for p in STATES]
    return Step([w[0] for w in ways], [w[1] for w in ways])


def spelled(codes: bytes, start: int, end: int) -> tuple[bytes, list[str]]:
    """The state before the first row and after each one, and the edits at each row: inserted turns, then its own letter."""
    states = crossings([ROWS[c] for c in codes], start, end)
    return bytes(states), [WAYS[c][p][q][1] for c, p, q in zip(codes, states[:-1], states[1:], strict=True)]


# Most conversations are short and many of them alike.
SHORT = 32
_summed_up_before = lru_cache(1 << 16)(summed_up)
_spelled_before = lru_cache(1 << 16)(spelled)


def summed_up_once(codes: bytes) -> Step:
    return _summed_up_before(codes) if len(codes) <= SHORT else summed_up(codes)


def spelled_once(codes: bytes, start: int, end: int) -> tuple[bytes, list[str]]:
    return _spelled_before(codes, start, end) if len(codes) <= SHORT else spelled(codes, start, end)


CHUNK = (
    "head bigint, codes binary, marks binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " first_initial string, last_initial string, min_turn bigint, max_turn bigint, turns bigint, costs array<bigint>, ranks array<bigint>"
)


class Chunk:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv_id: Any, head: int) -> None:
        self.conv_id, self.head = conv_id, head
        self.codes, self.marks = bytearray(), bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first: str | None = None
        self.last: str | None = None
        self.min_turn: int | None = None
        self.max_turn: int | None = None

    def add(self, turn: int | None, mark: bytes, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        duplicate, truncated = duplicate and not blank, truncated and not (blank or duplicate)
        self.codes.append(row_code(initial, blank or duplicate, truncated))
        self.marks += mark
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if turn is not None:
            self.turns += turn != self.max_turn
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn

    def row(self) -> tuple:
        codes = bytes(self.codes)
        step = summed_up_once(codes)
        flat = [[x for line in table for x in line] for table in (step.costs, step.ranks)]
        return (
            *(self.conv_id, self.head, codes, bytes(self.marks), self.blank, self.duplicate, self.truncated, self.illegal),
            *(self.first, self.last, self.min_turn, self.max_turn, self.turns, *flat),
        )


def _kind(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _arrow(df: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    """The schema (conv_id, columns) for Spark and for Arrow."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"conv_id {_kind(df)}, {columns}"
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def _with_mark(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, mark); nulls in role and text are one space. The mark is a digest of conversation, role and text."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in ("role", "text"))
    conv = F.coalesce(rows["conv_id"].cast("string"), F.lit(""))
    named = rows.select(rows["conv_id"], rows["turn"].cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), conv.alias("_conv"))
    whole = F.concat_ws(":", F.octet_length("_conv"), F.octet_length("role"), F.col("conv_id").isNull().cast("int"), "_conv", "role", "text")
    return named.select("conv_id", "turn", "role", "text", F.unhex(F.md5(whole)).alias("mark"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows without their texts, with `seq`, a number that rises along each conversation."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    thin = _with_mark(rows).select(
        "conv_id",
        "turn",
        "mark",
        F.substring("role", 1, 1).alias("initial"),
        (F.octet_length(end) == 0).alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        # Rows that are alike in everything can be told apart here, so any number of them can be dealt out.
        F.monotonically_increasing_id().alias("_salt"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("mark"), F.col("_salt")]
    return stored(thin.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt").withColumn("seq", F.monotonically_increasing_id()))


def _part(seq: str) -> Column:
    return F.shiftright(seq, 33)


def chunks(ordered: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The rows of every conversation in chunks, each summed up. `head` is the first row's number."""
    ddl, schema = _arrow(ordered, CHUNK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Chunk | None = None
        for b in batches:
            done = []
            for conv_id, seq, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.conv_id != conv_id or now.head >> 33 != seq >> 33 or len(now.codes) == chunk_rows:
                    if now is not None:
                        done.append(now.row())
                    now = Chunk(conv_id, seq)
                now.add(*row)
            yield _batch(done, schema)
        if now is not None:
            yield _batch([now.row()], schema)

    firsts = ordered.groupBy("mark").agg(F.min("seq").alias("first"), F.count("*").alias("n")).filter("n > 1").select("mark", "first")
    judged = ordered.join(firsts, "mark", "left").select(
        "conv_id", "seq", "turn", "mark", "initial", "blank", F.coalesce(F.col("seq") > F.col("first"), F.lit(False)).alias("duplicate"), "truncated"
    )
    return stored(judged.repartition(_part("seq")).sortWithinPartitions("seq").mapInArrow(cut, ddl))


def _meeting_states(cut: DataFrame) -> DataFrame:
    """(head, start, end, is_last) per chunk: the states in which its conversation enters and leaves it."""
    ddl, schema = _arrow(cut, "head bigint, start int, end int, is_last boolean")

    def solved(conv_id: Any, heads: list[int], steps: list[Step]) -> list[tuple]:
        states = crossings(steps, NOTHING, last_state(steps))
        return [(conv_id, h, states[i], states[i + 1], i == len(heads) - 1) for i, h in enumerate(heads)]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads, steps = None, [], []
        for b in batches:
            done = []
            for conv_id, head, costs, ranks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if heads and conv_id != now:
                    done += solved(now, heads, steps)
                    heads, steps = [], []
                now = conv_id
                heads.append(head)
                steps.append(Step(*([table[i : i + 4] for i in range(0, 16, 4)] for table in (costs, ranks))))
            yield _batch(done, schema)
        if heads:
            yield _batch(solved(now, heads, steps), schema)

    thin = cut.select("conv_id", "head", "costs", "ranks").repartition("conv_id").sortWithinPartitions("conv_id", "head")
    return thin.mapInArrow(of_batches, ddl).drop("conv_id")


def edited(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of the conversations of `rows` (conv_id, turn, role, text; others are ignored), with their edits.

    A conversation's chunks follow each other by `head`. `words` holds the edits of each row of a chunk
    (inserted turns I, then K, R or D), `states` the state before the first row and after each one,
    `ending` what is inserted after the last row, `cost` the price of all. A row is blank, else a
    duplicate of an earlier row's role and text, else truncated; each chunk counts those, and adjacent
    rows whose initials are not su, ua or au. Rows are taken by turn, nulls first, rows of one turn in
    the order of a digest of role and text. Nulls in role and text are one space; null is a conversation
    like any other. An empty table gives no rows.
    """
    cut = chunks(in_order(rows), chunk_rows)
    ddl, schema = _arrow(cut, "head bigint, states binary, words array<string>, ending string, cost bigint")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = []
            for conv_id, head, codes, start, end, is_last, cost in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ending = ENDING[end] if is_last else ""
                done.append((conv_id, head, *spelled_once(codes, start, end), ending, cost + COST[INSERT] * len(ending)))
            yield _batch(done, schema)

    cost = F.element_at("costs", 4 * F.col("start") + F.col("end") + 1)
    states = cut.select("conv_id", "head", "codes", "costs").join(_meeting_states(cut), "head")
    solved = states.select("conv_id", "head", "codes", "start", "end", "is_last", cost.alias("cost")).mapInArrow(of_batches, ddl).drop("conv_id")
    return stored(cut.drop("codes", "costs", "ranks").join(solved, "head"))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: (conv_id, head, place, edit, role, text), in order of head and place.

    `edits` comes from edited(rows). Inserted turns have an empty text. Of rows that repeat role and text
    at most the first is kept, so a text meets its row by their digest, and copies meet inside the tasks first.
    Inserted turns go through the same join with marks of their own, which are shorter than any digest.
    """
    ddl, schema = _arrow(edits, "head bigint, place int, edit string, new_role string, mark binary")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list[tuple] = []
            for conv_id, head, states, words, ending, marks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                place = 0
                for i, (state, word) in enumerate(zip(states, [*words, ending], strict=True)):
                    for edit in word.replace(DELETE, ""):
                        state = NEXT[state]
                        role = None if edit == KEEP else ROLES[state]
                        mark = pack(">qi", head, place) if edit == INSERT else marks[16 * i : 16 * i + 16]
                        made.append((conv_id, head, place, edit, role, mark))
                        place += 1
                if len(made) >= BATCH_ROWS:
                    yield _batch(made, schema)
                    made = []
            yield _batch(made, schema)

    turns = edits.select("conv_id", "head", "states", "words", "ending", "marks").mapInArrow(of_batches, ddl)
    texts = _with_mark(rows).select("mark", "role", "text").dropDuplicates(["mark"])
    role, text = F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    return turns.join(texts, "mark", "left").select("conv_id", "head", "place", "edit", role, text)


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost", "turns")


class Report:
    """Figures of one conversation, from its chunks and its repaired rows in order."""

    def __init__(self, conv_id: Any) -> None:
        self.conv_id = conv_id
        self.totals = dict.fromkeys(COUNTS, 0)
        self.audit: list[str] = []
        self.last: str | None = None
        self.min_turn: int | None = None
        self.max_turn: int | None = None
        self.digest, self.has_lines = hashlib.sha256(), False

    def add_chunk(self, chunk: dict) -> None:
        for c in COUNTS:
            self.totals[c] += chunk[c]
        if self.last is not None:
            self.totals["illegal"] += self.last + chunk["first_initial"] not in LEGAL
        self.last = chunk["last_initial"]
        if chunk["min_turn"] is not None:
            self.totals["turns"] -= chunk["min_turn"] == self.max_turn
            self.min_turn = chunk["min_turn"] if self.min_turn is None else self.min_turn
            self.max_turn = chunk["max_turn"]
        self.audit.append(chunk["audit"])

    def add_line(self, line: bytes) -> None:
        self.digest.update(b"\n" + line if self.has_lines else line)
        self.has_lines = True

    def row(self) -> tuple:
        t = self.totals
        gaps = 0 if self.min_turn is None else self.max_turn - self.min_turn + 1 - t["turns"]
        return (self.conv_id, gaps, t["blank"], t["duplicate"], t["truncated"], t["illegal"], t["cost"], "".join(self.audit), self.digest.hexdigest())


def reports(conversations: DataFrame, edits: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conv_id of `conversations`: faults, price and spelling of the edits, digest of the repaired rows.

    `edits` and `turns` come from edited and repaired. A conversation without rows there has zeros and the
    digest of nothing. A digest reads a conversation from its first row to its last: it is the one thing
    here that runs along all of a conversation in one task, which streams the rows and holds none of them.
    """
    ddl, schema = _arrow(conversations, REPORT)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Report | None = None
        for b in batches:
            done = []
            for conv_id, kind, line, chunk in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "line", "chunk")), strict=True):
                if kind == 0:
                    if now is not None:
                        done.append(now.row())
                    now = Report(conv_id)
                elif kind == 1:
                    now.add_chunk(chunk)
                else:
                    now.add_line(line)
            yield _batch(done, schema)
        if now is not None:
            yield _batch([now.row()], schema)

    ids = conversations.select("conv_id").distinct().withColumn("kind", F.lit(0))
    audit = F.concat(F.array_join("words", ""), "ending").alias("audit")
    chunk = F.struct(*COUNTS, "first_initial", "last_initial", "min_turn", "max_turn", audit).alias("chunk")
    parts = edits.select("conv_id", F.lit(1).alias("kind"), "head", chunk)
    lines = turns.select("conv_id", F.lit(2).alias("kind"), "head", "place", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    whole = ids.unionByName(parts, allowMissingColumns=True).unionByName(lines, allowMissingColumns=True)
    return whole.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "head", "place").mapInArrow(of_batches, ddl)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by a checksum of `conv_id:turn`: of twenty rows one is dropped, one
    emptied, one robbed of its marks .!?, one repeated, one given to the user. Nulls are one space."""
    conv_id, turn, role, text = (F.coalesce(conversations[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    rule = (F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20).alias("rule")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), rule).filter("rule <> 0")
    role = F.when(F.col("rule") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("rule") == 1, F.lit("")).when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("rule") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")
