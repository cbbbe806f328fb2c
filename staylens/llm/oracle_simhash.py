"""SimHash classes as SQL for DuckDB, which has no XXH64: it is spelled out over lists of UHUGEINT.

Every product of two 64-bit numbers fits 128 bits, so it is exact before it is cut to 64.
"""

from __future__ import annotations

# Fixed values of XXH64: its five primes, and how far its four sums are rotated when they are merged.
PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
MERGE_TURNS = (1, 7, 12, 18)

P1, P2, P3, P4, P5 = PRIMES
WORD = 1 << 64


def _number(n: int) -> str:
    return f"{n % WORD}::UHUGEINT"


def _cut(x: str) -> str:
    return f"(({x}) % {WORD}::UHUGEINT)"


def _times(x: str, factor: int) -> str:
    return _cut(f"({x}) * {_number(factor)}")


def _turned(x: str, bits: int) -> str:
    return f"(({x}) * {_number(1 << bits)} % {WORD}::UHUGEINT + ({x}) // {_number(1 << (64 - bits))})"


def _step(sum_: str, product: str) -> str:
    """One round; `product` is the lane times the second prime."""
    return _times(_turned(_cut(f"{sum_} + {product}"), 31), P1)


def _folded(x: str, bits: int) -> str:
    return f"xor({x}, {x} // {_number(1 << bits)})"


def _numbers(size: int, at: str, n: str, factor: int) -> str:
    """`n` little-endian numbers of `size` bytes from byte `at` of the hex string `digits`, times `factor`."""
    pairs = " || ".join(f"substr(digits, CAST(2 * ({at} + {size} * k) + {2 * b + 1} AS BIGINT), 2)" for b in reversed(range(size)))
    value = f"CAST(CAST('0x' || {pairs} AS UBIGINT) AS UHUGEINT)"
    return f"list_transform(range({n}), lambda k: {_times(value, factor)})"


def _four_sums(seed: int) -> str:
    starts = (seed + P1 + P2, seed + P2, seed, seed - P1)
    lanes = "list_transform(range(n_bytes // 32), lambda s: lanes[4 * s + {}])"
    return ", ".join(f"list_reduce({lanes.format(k)}, lambda a, x: {_step('a', 'x')}, {_number(v)}) AS v{k}" for k, v in enumerate(starts, 1))


def _merged_sums() -> str:
    out = _cut(" + ".join(_turned(f"v{k}", bits) for k, bits in enumerate(MERGE_TURNS, 1)))
    for k in range(1, 5):
        out = _cut(f"{_times(f'xor({out}, {_step(_number(0), _times(f"v{k}", P2))})', P1)} + {_number(P4)}")
    return out


def simhash_sql(seed: int, shingle: int, max_bits: int) -> str:
    """(doc_id, fingerprint, component_id) of `documents`."""
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
grams AS (
  SELECT doc_id, array_to_string(words[i:i + {shingle - 1}], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {shingle - 2}, 2))) AS i FROM texts WHERE len(words) > 0)
),
spelled AS (SELECT gram, hex(encode(gram)) AS digits, octet_length(encode(gram)) AS n_bytes FROM (SELECT DISTINCT gram FROM grams)),
cut AS (
  SELECT gram, n_bytes, {_numbers(8, "0", "n_bytes // 8", P2)} AS lanes,
    {_numbers(4, "n_bytes // 8 * 8", "n_bytes % 8 // 4", P1)} AS halves, {_numbers(1, "n_bytes // 4 * 4", "n_bytes % 4", P5)} AS rest
  FROM spelled
),
summed AS (SELECT *, {_four_sums(seed)} FROM cut),
opened AS (
  SELECT *, {_cut(f"CASE WHEN n_bytes < 32 THEN {_number(seed + P5)} ELSE {_merged_sums()} END + CAST(n_bytes AS UHUGEINT)")} AS h FROM summed
),
by_lanes AS (
  SELECT gram, halves, rest, list_reduce(list_transform(lanes[n_bytes // 32 * 4 + 1:], lambda p: {_step(_number(0), "p")}),
    lambda a, x: {_cut(f"{_times(_turned('xor(a, x)', 27), P1)} + {_number(P4)}")}, h) AS h
  FROM opened
),
by_halves AS (
  SELECT gram, rest, list_reduce(halves, lambda a, x: {_cut(f"{_times(_turned('xor(a, x)', 23), P2)} + {_number(P3)}")}, h) AS h FROM by_lanes
),
by_bytes AS (SELECT gram, list_reduce(rest, lambda a, x: {_times(_turned("xor(a, x)", 11), P1)}, h) AS h FROM by_halves),
stirred AS (SELECT gram, {_times(_folded("h", 33), P2)} AS h FROM by_bytes),
twice AS (SELECT gram, {_times(_folded("h", 29), P3)} AS h FROM stirred),
hashed AS (SELECT gram, CAST({_folded("h", 32)} AS UBIGINT) AS h FROM twice),
bits AS (
  SELECT doc_id, bit, 2 * sum(CAST((h >> bit) & 1 AS BIGINT)) > count(*) AS is_set
  FROM grams JOIN hashed USING (gram), (SELECT CAST(unnest(range(64)) AS UBIGINT) AS bit) GROUP BY doc_id, bit
),
prints AS (
  SELECT doc_id, CAST(coalesce(sum(CAST(1::UBIGINT << bit AS HUGEINT)) FILTER (is_set), 0) AS UBIGINT) AS fp
  FROM texts LEFT JOIN bits USING (doc_id) GROUP BY doc_id
),
nodes AS (SELECT fp, min(doc_id) AS doc_id FROM prints GROUP BY fp),
links AS (SELECT a.fp, b.fp AS other FROM nodes a JOIN nodes b ON bit_count(xor(a.fp, b.fp)) <= {max_bits}),
reached(fp, other) AS (SELECT fp, other FROM links UNION SELECT r.fp, l.other FROM reached r JOIN links l ON l.fp = r.other),
found AS (SELECT reached.fp, min(nodes.doc_id) AS component_id FROM reached JOIN nodes ON nodes.fp = reached.other GROUP BY reached.fp)
SELECT doc_id, lpad(lower(hex(fp)), 16, '0') AS fingerprint, component_id FROM prints JOIN found USING (fp)
"""
