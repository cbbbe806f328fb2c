"""Conversation repair against a plain version that writes out the spelling of every state."""

import hashlib
import random
import re
import zlib

import pytest

from staylens.llm import turns

RND = random.Random(5)
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NAMES = {"u": "user", "a": "assistant"}
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def best_edits(rows):
    """(cost, audit, lines) of rows (role, text, must_go, truncated): the least of all ways, state by state."""
    state_of = {"": (0, "", ())}

    def all_ways(ways):
        """Every state with every number of insertions, as (state, way)."""
        found = [(s, w) for s, w in ways.items()]
        for _ in range(3):
            found += [(after, (w[0] + 2, w[1] + "I", (*w[2], NAMES[turn] + ":"))) for s, w in found for (before, turn), after in AFTER.items() if turn != "s" and before == s]
            found = list(dict.fromkeys(found))
        return found

    for role, text, must_go, truncated in rows:
        after = {}
        for s, (cost, audit, lines) in all_ways(state_of):
            options = [(s, 3, "D", ())]
            if not must_go:
                options += [(q, 2 + truncated, "R", (NAMES[t] + ":" + text,)) for (p, t), q in AFTER.items() if p == s and t != "s"]
                options += [(AFTER[s, role[:1]], truncated, "K", (role + ":" + text,))] if (s, role[:1]) in AFTER else []
            for q, price, letter, line in options:
                way = (cost + price, audit + letter, lines + line)
                after[q] = min(after.get(q, way), way, key=lambda w: w[:2])
        state_of = after
    return min((w for s, w in all_ways(state_of) if s in ("", "a")), key=lambda w: w[:2])


def plain(conversations, damage=True):
    out = {}
    for conv in {r[0] for r in conversations}:
        rows = []
        for conv_id, turn, role, text in (r for r in conversations if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            rule = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
            rows += [(turn, "user" if rule == 4 else role, text)] * (0 if rule == 0 else 2 if rule == 3 else 1)
        name = "" if conv is None else str(conv)

        def mark(role, text, name=name, missing=int(conv is None)):
            return hashlib.md5(f"{len(name.encode())}:{len(role.encode())}:{missing}:{name}:{role}:{text}".encode()).digest()

        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, mark(*r[1:])))
        seen, judged, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            end = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        known = [t for t, *_ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = best_edits(judged)
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def reported(conversations, table, damage=True, chunk_rows=turns.CHUNK_ROWS):
    rows = turns.damaged(table) if damage else table
    edits = turns.edited(rows, chunk_rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in turns.reports(table, edits, turns.repaired(rows, edits)).collect()}


def made():
    said = ["Yes.", "no", "What?", "", " \n", "Sure!\t", "cut of", "été.", "\u0085", "...", "ok"]
    rows = [(c, t, RND.choice(["user", "assistant", "user", "assistant", "system", "tool", "System", "", None]), RND.choice([*said, None, "own %d." % RND.randint(0, 99)])) for c in range(40) for t in range(RND.randint(1, 9))]
    rows += [(None, t, "user", "Hm %d." % t) for t in range(4)] + [(50, None, "user", "A."), (50, None, "assistant", "B."), (50, 7, "user", "A."), (50, 3, "assistant", None)]
    rows += [(51, 1, "user", "x " * 30_000 + "."), (51, 1, "user", "x " * 30_000 + "."), (51, 1, "assistant", "Same turn.")] * 2
    return rows + [(60, t, RND.choice(["user", "assistant"]), "turn %d%s" % (t % 37, RND.choice([".", ""]))) for t in range(150)]


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.mark.parametrize("damage", [True, False])
def test_reports(spark, damage):
    rows = made()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain(rows, damage)
    for chunk_rows in (turns.CHUNK_ROWS, 3):
        assert reported(rows, table, damage, chunk_rows) == want


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds nearly all rows, and one row of it stands many times."""
    rows = [(1, t, "user" if t % 2 else "assistant", "turn %d." % (t % 90)) for t in range(200)] + [(1, 300, "user", "again")] * 60 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert turns.edited(table).filter("conv_id = 1").count() > 8
        assert reported(rows, table, damage=False) == plain(rows, damage=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_dropped_and_empty(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "Hi.") for c in gone]
    got = reported(rows, spark.createDataFrame(rows, SCHEMA))
    assert got == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone}
    assert reported([], spark.createDataFrame([], SCHEMA)) == {}


def test_clashing_columns(spark):
    rows = made()[:60]
    table = spark.createDataFrame([(*r, 1, "m", 2, "w") for r in rows], SCHEMA + ", head int, mark string, seq int, kind string")
    assert reported(rows, table) == plain(rows)


def test_repaired_rows_are_legal(spark):
    rows = [(c, t, r or "tool", x or "") for c, t, r, x in made() if c is not None]
    table = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for r in sorted(turns.repaired(table, turns.edited(table, 4)).collect(), key=lambda r: (r.conv_id, r.head, r.place)):
        out.setdefault(r.conv_id, []).append(r.role[:1])
    assert out and all(re.fullmatch("s?(ua)+", "".join(x)) for x in out.values())


def test_divide_and_conquer_in_any_division():
    """Chunks of any length give the edits that the whole conversation gives."""
    for _ in range(300):
        codes = bytes(RND.randrange(9) for _ in range(RND.randint(1, 14)))
        rows = [("sua"[(c - 1) // 2] if c and (c - 1) // 2 < 3 else "x", "", c == 0, bool(c) and (c - 1) % 2 == 1) for c in codes]
        cost, audit, _ = best_edits(rows)
        steps = [turns.ROWS[c] for c in codes]
        end = turns.last_state(steps)
        assert "".join(turns.spelled(codes, 0, end)[1]) + turns.ENDING[end] == audit
        size = RND.randint(1, 5)
        cuts = [codes[i : i + size] for i in range(0, len(codes), size)]
        summed = [turns.summed_up(c) for c in cuts]
        end = turns.last_state(summed)
        states = turns.crossings(summed, 0, end)
        parts = [turns.spelled(c, p, q)[1] for c, p, q in zip(cuts, states, states[1:])]
        assert "".join(w for part in parts for w in part) + turns.ENDING[end] == audit
        assert sum(s.costs[p][q] for s, p, q in zip(summed, states, states[1:])) + 2 * len(turns.ENDING[end]) == cost
