"""Ranked search against a plain Python version that scores every document for every item."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from staylens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RND = random.Random(11)
WORDS = ["the", "The", "été", "ÉTÉ", "x9", "Über", "naïve", "日本", "a_b", "c-d", "e.f", "rare", "\u0085q", "k k"] + ["w%d" % i for i in range(30)]


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def plain(docs, items, k=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_all = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = defaultdict(set)
    for item_id, text in items:
        asked[item_id] |= set(terms(text))
    out = []
    for item_id, wanted in asked.items():
        scored = []
        for doc_id, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // n_all
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def made_docs():
    bases = [" ".join(RND.choice(WORDS) for _ in range(RND.randint(1, 40))) for _ in range(25)]
    rows = [(i, RND.choice(bases) if i % 3 else " ".join(RND.choice(WORDS) for _ in range(12))) for i in range(120, 0, -1)]
    # A class of many members, with words that no item has.
    rows += [(i, "rare w1 w2 only%d" % i) for i in range(900, 600, -1)]
    rows += [(200, None), (201, ""), (202, "--- !!"), (203, "W3 " * 4000), (None, "rare w1"), (None, "w5 w6"), (3, "w5 été"), (204, "nothing known")]
    return rows + [rows[4], rows[4]]


ITEMS = [(i, " ".join(RND.choice(WORDS) for _ in range(6))) for i in range(12)] + [(20, None), (21, ""), (22, "unheard of"), (23, "w1 W1 w1 rare"), (0, "more w7"), (None, "w5"), (23, "w1 W1 w1 rare")]


@pytest.mark.parametrize("block_bytes", [16 << 20, 5000])
def test_search(spark, block_bytes):
    docs = made_docs()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for k in (10, 3):
        got = lexical.search(table, items, k=k, block_bytes=block_bytes)
        assert sorted([tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()], key=str) == plain(docs, ITEMS, k)


def test_search_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in made_docs()], "doc_id long, text string, item_id string, score int, m int, bag int, n int")
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, doc_id string, term int")
    got = lexical.search(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == len(plain(made_docs(), ITEMS))
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_scores_in_portions(monkeypatch):
    rng = np.random.default_rng(1)
    pairs = sorted({(int(t), int(i)) for t, i in zip(rng.integers(0, 20, 90), rng.integers(0, 9, 90))})
    weights = rng.integers(0, 5000, 20).tolist()
    postings = lexical.Postings([t for t, _ in pairs], [i for _, i in pairs], weights, 9)
    held = [(np.sort(rng.choice(20, n, replace=False)), rng.integers(1, 5, n)) for n in (1, 20, 7, 0)]
    m = np.array([11, 12, 500, 10])
    want = [[sum(weights[t] * (10**9 * int(f) // (1000 * int(f) + 8 * int(x))) for t, f in zip(*h) if (int(t), i) in pairs) for i in range(9)] for h, x in zip(held, m)]
    for cells in (1, 7, 1 << 20):
        monkeypatch.setattr(lexical, "CELLS", cells)
        assert postings.scores(held, m).tolist() == want
