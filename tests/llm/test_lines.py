"""Line dedup against a plain Python version, in few and in many partitions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import lines

WHITE = " \t\n\v\f\r"
UPPER = {c: c + 32 for c in range(65, 91)}
RND = random.Random(3)
COMMON = ["A line that many hold", "  a LINE that many hold\t", "another frequent line é", "\x0bÀ propos de tout ça", "short", "nine char", "ten chars!", "ééééééééé", "éééééééééé", "", " "]


def key_of(line):
    return line.strip(WHITE).translate(UPPER)


def plain(rows, min_chars=10):
    """(doc_id, lines, dropped, digest) per row."""
    owner, holders = {}, {}
    rank = lambda i: (i is None, i or 0)
    for doc_id, text in rows:
        for k in map(key_of, (text or "").split("\n")):
            holders.setdefault(k, set()).add(doc_id)
            owner[k] = min(owner.get(k, doc_id), doc_id, key=rank)
    out = []
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if len(k := key_of(x)) < min_chars or len(holders[k]) < 2 or owner[k] == doc_id]
        out.append((doc_id, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def made(n):
    texts = ["\n".join(RND.choice(COMMON) if RND.random() < 0.7 else "a line of its own %d %d" % (i, j) for j in range(RND.randint(1, 9))) for i in range(n)]
    rows = list(enumerate(texts, 100))
    odd = [(1, None), (2, ""), (3, "\n"), (4, "A line that many hold\n" * 3), (5, "x" * 50_000 + "\n" + "x" * 50_000), (6, "x" * 50_000), (None, COMMON[0]), (None, COMMON[2] + "\nonly without an id")]
    return rows + odd + [rows[3], rows[3], (rows[4][0], COMMON[0] + "\nthe same id with other lines"), (None, COMMON[0])]


def digests(table, **options):
    judged = lines.keep_bitmaps(table, **options)
    kept = F.sha2(lines.kept_lines(F.col("text"), F.col("n_lines"), F.col("keep")), 256)
    return sorted([tuple(r) for r in judged.select("doc_id", "n_lines", "n_dropped", kept).collect()], key=str)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_line_dedup(spark, parts):
    rows = made(60)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert digests(table) == plain(rows)
        assert digests(table, min_chars=3) == plain(rows, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_one_line_in_every_partition(spark):
    """A line that all documents hold spans the partitions; only the smallest id keeps it."""
    rows = [(i, "the one line that all of them hold") for i in range(500, 0, -1)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert digests(table) == plain(rows)


def test_clashing_columns_and_bitmaps(spark):
    rows = [(i, t, "a", i, b"k", 1, "p", "h") for i, t in made(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_dropped long, keep binary, row_key int, place string, high string")
    got = lines.keep_bitmaps(table).collect()
    assert set(got[0].asDict()) == set(table.columns)
    for r in got:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), bitorder="little")
        assert len(bits) - 8 < r.n_lines <= len(bits) and r.n_lines - bits[: r.n_lines].sum() == r.n_dropped
        assert r.row_key == 1 and r.place == "p" and r.high == "h"
    assert lines.keep_bitmaps(table.limit(0)).count() == 0
