"""Each operator against a brute-force version, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from staylens.llm import bestfit, components, mixing, repeats, rules, shards, simhash, tiers, tokens, toxicity, vafile, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, kept string, copies int"
RND = random.Random(7)
BASE = [" ".join("".join(RND.choice("abcdeé") for _ in range(5)) for _ in range(120)) for _ in range(6)]


def texts():
    near = BASE[0].split()
    near[60] = "zzz"
    made = [None, "", " \n\t", "one", "two words", "x" * 5000, BASE[0], BASE[0], BASE[0] + "\nend", " ".join(near), BASE[1][:300] + BASE[2], BASE[1], BASE[3] + " " + BASE[4]]
    return made + [RND.choice(BASE)[RND.randint(0, 90) :] for _ in range(12)]


@pytest.fixture(scope="module")
def rows():
    made = [(i, t, "en", "src%d" % (i % 3) if i % 5 else None, 1, "s", "k", 9) for i, t in enumerate(texts(), 1)]
    return made + [made[7], (None, BASE[5], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_vector_search(spark):
    rng = np.random.default_rng(3)
    plain = [(i, rng.normal(size=5).tolist()) for i in range(60)] + [(i, [0.5] * 5) for i in range(60, 90)]
    odd = [(None, [1.0] * 5), (200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (204, [1.0, 2.0]), (3, plain[3][1])]
    table = spark.createDataFrame(plain + odd, "vec_id long, embedding array<double>")
    asked = table.filter("vec_id % 10 = 0")
    got = defaultdict(list)
    for r in vafile.top_k(table, asked, k=4, block_vectors=16, block_queries=4).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    v = {i: [int(np.floor(1024 * x)) for x in e] for i, e in plain}
    for q in range(0, 90, 10):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[i])), i) for i in v if i != q)[:4]
        assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert vafile.top_k(table.limit(0), asked.limit(0)).count() == 0


def test_vector_search_with_repeated_ids(spark):
    """Ids with two vectors, with vectors of two lengths, and one with more vectors of its own than neighbours asked for."""
    rng = np.random.default_rng(4)
    made = [(i, rng.integers(-9, 9, 4).tolist()) for i in range(40)]
    made += [(i, rng.integers(-9, 9, 4).tolist()) for i in range(0, 40, 2)]
    made += [(i, rng.integers(-9, 9, 3).tolist()) for i in range(0, 40, 3)]
    made += [(10, [90 + j, 90, 90, 90]) for j in range(12)] + [(11, made[12][1]), made[13]]
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in made], "vec_id long, embedding array<double>")
    asked = table.filter("vec_id % 5 = 0 or vec_id = 11")
    entries = {(i, tuple(v)) for i, v in made}
    for block in (8, 1 << 14):
        got = defaultdict(list)
        for r in vafile.top_k(table, asked, k=4, scale=1, block_vectors=block, block_queries=4).collect():
            got[r.query_id].append((r["rank"], r.vec_id, r.score))
        assert set(got) == {*range(0, 40, 5), 11}
        for q in got:
            own = min(v for i, v in entries if i == q)
            best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in entries if i != q and len(v) == len(own))[:4]
            assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_tier_packing(docs, none, rows):
    path = tokens.word_vocabulary()
    pieces = tiers.packed(docs, path, tiers=(64, 32, 16), pool_tokens=300).collect()
    assert Counter((r[0], tiers.END_ID) for r in rows) == Counter((p.doc_id, tiers.END_ID) for p in pieces if p.start + p.length == p.doc_tokens)
    by_sequence = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_sequence[p.sequence_id].append(p)
    for window in by_sequence.values():
        at = 0
        for p in sorted(window, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window[0].tier <= 64 and at & (at - 1) == 0
    whole = {p.doc_id: b"" for p in pieces}
    for p in sorted((p for p in pieces if p.doc_id not in (None, 8)), key=lambda p: p.start):
        whole[p.doc_id] += p.ids
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    for i, text, *_ in rows:
        if i not in (None, 8):
            want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
            assert np.frombuffer(whole[i], "<u4").tolist() == want
    assert tiers.packed(none, path).count() == 0


def test_best_fit(docs, none, rows):
    for width in (7, 16):
        lengths = [RND.randint(1, width) for _ in range(200)]
        room = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in room if r >= n]
            if fits:
                room.remove(min(fits))
            room.append((min(fits) if fits else width) - n)
        packed = bestfit.best_fit(lengths, width)
        assert sorted(width - sum(lengths[i] for i in row) for row in packed) == sorted(room)
    found = bestfit.matrices(docs, tokens.word_vocabulary(), width=32, matrix_rows=4).collect()
    total = 0
    for m in found:
        ids = np.frombuffer(m.ids, "<u2")
        assert len(ids) == m.rows * 32 and m.cu_seqlens[0] == 0 and m.cu_seqlens[-1] == len(ids)
        assert set(m.position_resets) <= set(m.cu_seqlens)
        total += sum(m.piece_lengths)
    assert total == sum(p.length for p in tiers.packed(docs, tokens.word_vocabulary()).collect())
    assert bestfit.matrices(none, tokens.word_vocabulary()).count() == 0


def test_shards(docs, none, rows):
    placed = shards.shuffled(docs, shards=4).collect()
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(4)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r.text for r in placed) == Counter(r[1] for r in rows)
    assert shards.shuffled(none, shards=4).count() == 0
    for n in (1, 2, 5, 1000):
        assert sorted(shards.permuted(np.arange(n), np.full(n, 5), np.full(n, n)).tolist()) == list(range(n))
    matrix = shards.draw(np.random.default_rng(1), [5, 0, 7], np.array([4, 4, 4]))
    assert matrix.sum(axis=0).tolist() == [4, 4, 4] and matrix.sum(axis=1).tolist() == [5, 0, 7]


def test_mixing(spark, docs, none, rows):
    low, table = mixing.poisson_table(2.5)
    assert low == 0 and abs(table[0] - np.exp(-2.5)) < 1e-12 and abs(table[-1] - 1) < 1e-9
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.when(F.col("id") < 2000, "a").alias("source"))
    shares = mixing.mixed(many).groupBy("source").count().collect()
    want = np.sqrt([2000, 1000]) / np.sqrt([2000, 1000]).sum() * 3000
    assert all(abs(r["count"] - want[0 if r.source else 1]) < 150 for r in shares)
    out = mixing.mixed(docs)
    assert out.columns == [*[c for c in docs.columns if c != "copies"], "copy", "copies", "shuffle_key"]
    assert all(1 <= r["copy"] <= r.copies for r in out.collect())
    assert mixing.mixed(none).count() == 0


CLASHES = ["least", "below", "_u", "_digest", "_data", "_head", "_key", "_own_key", "_row", "rate", "mix_source", "row_key", "root", "fp"]


def test_clashing_columns(docs):
    """Extra columns with names that the operators use inside come out as they went in."""
    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})

    def right(out, names):
        return out.columns == names and all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in out.collect() for c in CLASHES)

    def without(*new):
        return [c for c in wide.columns if c not in new]

    mix, cut, heads = mixing.mixed(wide), repeats.without_repeats(wide), simhash.one_of_each(wide)
    assert right(mix, [*without("copies"), "copy", "copies", "shuffle_key"])
    assert right(cut, [*without("kept"), "repeat_spans", "kept"]) and right(heads, wide.columns)
    assert Counter((r.doc_id, r.copy, r.shuffle_key) for r in mix.collect()) == Counter((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mixed(docs).collect())
    assert Counter((r.doc_id, bytes(r.kept)) for r in cut.collect()) == Counter((r.doc_id, bytes(r.kept)) for r in repeats.without_repeats(docs).collect())


@pytest.mark.parametrize("width", [200, 40])
def test_repeats(docs, none, rows, width):
    data = [(r[1] or "").encode() for r in rows]
    starts = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    want = Counter()
    for r, b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if starts[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        want[(r[0], sum(gone), bytes(x for x, y in zip(b, gone) if not y))] += 1
    got = repeats.without_repeats(docs, width)
    assert Counter((r.doc_id, sum(s.end - s.start for s in r.repeat_spans), bytes(r.kept)) for r in got.collect()) == want
    assert "slot" in got.columns and repeats.without_repeats(none, width).count() == 0


def test_warc(spark, tmp_path):
    pages = [(1, "http://a", "x"), (2, None, "x"), (None, "u", "x"), (4, "a\r\nb", None), (5, "q", ""), (5, "q", ""), (6, "l", "é" * 30000), (7, "m", "é" * 30000)]
    folder = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"))
    read = spark.read.format("warc").load(folder)
    got = {(r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in read.collect()}
    assert ("<urn:page:7>", "revisit", "<urn:page:6>", 60000) in got and ("<urn:page:5>", "revisit", "<urn:page:4>", 0) in got
    assert ("<urn:page:null>", "response", None, 1) in got and read.count() == 8
    whole = read.filter("record_id = '<urn:page:6>'").first()
    assert bytes(whole.payload).decode() == "é" * 30000
    assert whole.payload_digest == base64.b32encode(hashlib.sha1(whole.payload).digest()).decode()
    assert read.filter("record_type = 'revisit'").count() == 4
    assert spark.read.format("warc").option("payload", "verify").load(folder).count() == 8
    empty = warc.archived(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "e"))
    assert spark.read.format("warc").load(empty).count() == 0


def test_plain_warc(spark, tmp_path):
    data = b"".join(warc.record("response", f"<urn:page:{i}>", None, b"p" * i, None, warc.DATE) for i in (1, 9000, 3))
    (tmp_path / "x.warc").write_bytes(data)
    warc.register(spark)
    read = spark.read.format("warc").load(str(tmp_path))
    assert sorted(r.payload_bytes for r in read.collect()) == [1, 3, 9000]
    assert read.filter("record_id = '<urn:page:3>'").first().payload_bytes == 3


@pytest.mark.parametrize("kind", ["sl", "gzip", "stored", "plain"])
def test_warc_header_cut_by_a_step(tmp_path, kind):
    """HTTP headers that begin or end anywhere about a multiple of the step in which headers are read."""
    noise = RND.randbytes(3 * warc.HEAD_BYTES)
    data, want = b"", []
    pack = {"sl": warc.gzip_member, "gzip": gzip.compress, "stored": lambda r: gzip.compress(r, 0), "plain": bytes}[kind]
    for n in range(3600, 3801):
        for record_type, refers_to in (("response", None), ("revisit", "<urn:page:1>")):
            payload = noise[: 9000 + n]
            data += pack(warc.record(record_type, f"<urn:page:{len(want)}>", "u" * n, payload, refers_to, warc.DATE))
            want.append((f"<urn:page:{len(want)}>", len(payload), payload if refers_to is None else None))
    path = tmp_path / ("x.warc" if kind == "plain" else "x.warc.gz")
    path.write_bytes(data)
    for mode in ("read", "skip", "verify"):
        got = list(warc.WarcReader({"path": str(tmp_path), "payload": mode})._records(str(path)))
        assert [(r[3], r[-2], r[-1]) for r in got] == [(i, size, payload if mode == "read" else None) for i, size, payload in want]


def test_warc_long_urls(spark, tmp_path):
    pages = [(2 * n + i, "u" * n, f"page {n}") for n in range(3600, 3801) for i in (0, 1)]
    folder = warc.archived(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"))
    for mode in ("read", "skip", "verify"):
        read = spark.read.format("warc").option("payload", mode).load(folder)
        assert Counter((r.record_type, r.payload_bytes) for r in read.collect()) == Counter({("response", 9): 201, ("revisit", 9): 201})


def test_toxicity(spark, docs, none):
    rnd = random.Random(2)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    made = []
    for i in range(600):
        body = [rnd.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(3):
                body[rnd.randrange(60)] = rnd.choice(["moron", "scum", "trash"])
        made.append((i, " ".join(body), int(i % 4 == 0)))
    train = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    field = toxicity.fit(train, train.select("doc_id", "toxic", F.lit("x").alias("lang")))
    got = toxicity.scored(train, field).join(train, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == r.toxic for r in held)
    hit = next(r for r in held if r.toxic)
    assert all(hit.text[s.start : s.end].split()[0] in ("moron", "scum", "trash") for s in hit.spans)
    assert all(0 <= r.score <= 1 for r in toxicity.scored(docs, field).collect())
    assert toxicity.scored(none, toxicity.fit(none, train.limit(0).select("doc_id", "toxic"))).count() == 0


def test_toxicity_tells_short_texts_apart():
    texts = ["one", "two words", "words two", "moron", "", None, "one, two, three", "One two three", "one two three"]
    (batch,) = toxicity._signatures(iter([pa.record_batch([pa.array(texts, pa.string())], ["text"])]))
    found = batch.column("signature").to_pylist()
    assert len(set(found[:5])) == 5 and found[4] == found[5] and found[6] == found[8] != found[7]


def test_toxicity_learns_one_text_per_id(spark, monkeypatch):
    """An id with many texts brings one of them to the fit, and no square of its rows to the driver."""
    made = [(1 + 1000 * (i > 200), f"text number {i} of many words, {RND.choice(BASE)[:60]}") for i in range(260)] + [(2 * i, BASE[i] + " scum") for i in range(1, 6)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in {i for i, _ in made}], "doc_id long, toxic int")
    want = {i: min(t for j, t in made if j == i) for i, _ in made}
    seen, fitted, features_of = [], [], toxicity._toxic_features
    monkeypatch.setattr(toxicity, "held_out", lambda doc_id: F.lit(False))
    monkeypatch.setattr(toxicity, "_toxic_features", lambda sample: seen.extend(sample.collect()) or features_of(sample))
    monkeypatch.setattr(toxicity, "_fit_logistic", lambda x, y: fitted.append(len(x)) or (0.0, 0.0, 0.0))
    toxicity.fit(spark.createDataFrame(made, "doc_id long, text string"), labels, train_documents=20)
    assert {r.doc_id: r.text for r in seen} == want and len(seen) == len(want) and fitted == [len(want)]


def test_rules(docs, none, rows):
    judged = rules.judged(docs).collect()
    assert len(judged) == len(rows)
    for r in judged:
        words = [w for w in (r.text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert not r.kept or len(words) >= 50
    assert rules.passing(docs).columns == docs.columns and rules.passing(none).count() == 0


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("crowd", [1000, 0])
def test_simhash(docs, none, rows, crowd):
    prints = [slow_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[top(i)] = top(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[top(i)].append(r[0])
    want = Counter((r[0], prints[i] - (1 << 64) if prints[i] >> 63 else prints[i], min((x for x in groups[top(i)] if x is not None), default=None)) for i, r in enumerate(rows))
    got = simhash.near_classes(docs, crowd=crowd)
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got.collect()) == want
    if crowd:
        assert simhash.one_of_each(docs).count() == len(groups) and simhash.one_of_each(none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 99), (7, 7)]
    got = components.components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {**{i: 0 for i in range(31)}, 99: 99, 100: 99}


def test_pipeline_stages_keep_clashing_columns(spark, docs):
    import corpus_pipeline

    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("kept", "repeat_spans", "copy", "copies", "shuffle_key", "_rest", "_row")})
    narrow = docs.select("text", "source", "doc_id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in out.collect() for c in wide.columns[9:] + ["kept", "copies"])
        assert stage(spark, narrow, "").columns == narrow.columns and stage(spark, narrow.limit(0), "").count() == 0


def slow_passing(text):
    words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}

    def share(count, base, low=None, high=None):
        return (low is None or 100 * count >= low * base) and (high is None or 100 * count <= high * base)

    return (
        len(words) >= 50
        and share(len(covered), len(words), high=50)
        and share(sum(map(len, words)), len(words), 200, 1200)
        and share(sum(text.count(c) for c in "#*$%&|<>"), len(words), high=10)
        and share(text.count("!"), len(words), high=20)
        and share(sum(w.lower() in rules.STOP_WORDS for w in words), len(words), low=3)
        and share(len(lines) - len(set(lines)), len(lines), high=50)
        and share(sum(bool(re.match(r"[ \t-\r]*[-*•]", x)) for x in lines), len(lines), high=90)
        and share(sum(bool(re.search(r"(\.\.\.|…)[ \t-\r]*$", x)) for x in lines), len(lines), high=30)
    )


def slow_one_of_each(rows):
    """The smallest id of each class; ids are not null and come with one text each."""
    left, heads = dict(rows), []
    prints = {i: slow_fingerprint(r[1]) for i, r in left.items()}
    while left:
        near, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            near.add(i)
            todo += [j for j in left if j not in near and j not in todo and (prints[i] ^ prints[j]).bit_count() <= 2]
        heads.append(left[min(near)])
        left = {i: r for i, r in left.items() if i not in near}
    return heads


def slow_kept_texts(rows, width=200):
    data = [r[1].encode() for r in rows]
    starts = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for r, b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if starts[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs, last = [b""], 0
        for x, g in zip(b, gone):
            if g and not last:
                runs.append(b"")
            elif not g:
                runs[-1] += bytes([x])
            last = g
        out.append((r[0], "".join(x.decode("utf-8", "ignore") for x in runs), r[2]))
    return out


def slow_copies(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.encode()) + 1
    roots = sum(s**0.5 for s in sizes.values())
    copies = []
    for i, text, source in rows:
        rate = sizes[source] ** 0.5 / roots * sum(sizes.values()) / sizes[source]
        u = (int(hashlib.md5(f"{mixing.SEED}:{i}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        n, chance = 0, math.exp(-rate)
        below = chance
        while below <= u:
            n += 1
            chance *= rate / n
            below += chance
        copies += [(i, text)] * n
    return copies


def test_pipeline_against_plain_python(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    rnd = random.Random(11)

    def prose(n):
        return " ".join("the" if rnd.random() < 0.2 else "".join(rnd.choice("abcdefghé") for _ in range(6)) for _ in range(n))

    passage = prose(60)
    made = [prose(rnd.randint(55, 160)) for _ in range(40)]
    made += [made[3], made[4] + " x", prose(60) + " é" + passage + "é " + prose(60), prose(60) + " è" + passage + "è " + prose(60)]
    made += [None, "", "too short", prose(60) + " !" * 40, prose(60) + " #" * 30, "zzz yyy xxx " * 60, prose(10) + ("\n" + prose(9)) * 9, " ".join(prose(80).replace("the", "qqq").split())]
    rows = [(i, t, None if i % 7 == 0 else "abc"[i % 5 % 3]) for i, t in enumerate(made, 1)]
    rows.append(rows[7])
    made_docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    made_docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))

    passed = [r for r in rows if slow_passing(r[1])]
    heads = slow_one_of_each((r[0], r) for r in passed)
    cut = slow_kept_texts(heads)
    mix = slow_copies(cut)
    # Each stage has something to do here.
    assert len(rows) > len(passed) > len(heads) and any(a[1] != b[1] for a, b in zip(heads, cut)) and len(set(mix)) < len(cut) and len(mix) > len(set(mix))
    library = Tokenizer.from_file(tokens.word_vocabulary())
    want = Counter()
    for i, text in mix:
        want.update((i, at, x) for at, x in enumerate([*library.encode(text, add_special_tokens=False).ids, tiers.END_ID]))
    got = Counter()
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.update((p.doc_id, p.start + at, x) for at, x in enumerate(np.frombuffer(p.ids, "<u4").tolist()))
    assert got == want
    short = corpus_pipeline.suffix_dedup(spark, made_docs.filter("text is not null").dropDuplicates(["doc_id"]), "").collect()
    brute = slow_kept_texts([r for r in dict((r[0], r) for r in rows).values() if r[1] is not None])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in short) == sorted((i, t, len(t)) for i, t, _ in brute)


def test_pipeline(spark):
    import corpus_pipeline

    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sizes and all(r.n & (r.n - 1) == 0 for r in sizes)
