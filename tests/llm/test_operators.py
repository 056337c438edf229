"""Every operator against a brute-force version, on small tables with nulls, empty texts, ties and repeats."""

import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrears.llm import (
    automaton,
    channel,
    decontaminate,
    licenses,
    neighbours,
    packing,
    passages,
    pii,
    simhash,
    token_counts,
    tokens,
    toxicity,
    training_order,
)

LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
TEXTS = [
    (1, f"{LINE} and a tail of its own"), (2, f"head {LINE}"), (3, f"head {LINE}"), (4, None), (5, ""),
    (6, "\t odd white \n\n space <|endoftext|> here  "), (7, "word " * 3000), (8, "A" * 5000), (None, f"x {LINE}"),
    (9, "mail ann@example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (555) 010-9999 today"),
    (1, f"{LINE} and a tail of its own"), (10, "Licensed under the Apache License, Version 2.0.\nCC BY NC"),
]
SCHEMA = "doc_id long, text string, rid string, fp string, n_words string, spans string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, "a", "b", "c", "d") for t in TEXTS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return tokens.library(tokens.vocabulary())


def counted(rows):
    return sorted(map(repr, rows))


def test_token_counts(docs, empty, library):
    got = [tuple(r) for r in token_counts.token_counts(docs).collect()]
    want = []
    for i, t in TEXTS:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    assert counted(got) == counted(want)
    assert token_counts.token_counts(empty).count() == 0


def test_encoder_gives_the_ids_of_the_library(library):
    path, rng = tokens.vocabulary(), np.random.default_rng(7)
    assert tokens.by_rank(path)
    encoder, units = tokens.Encoder(path, True), tokens.Units(path, True)
    signs = list("ab'stlredvm ''  \n\n.,!?0129éñßÿŁʻ½²ª_-\x00\x7f\t\xa0漢") + ["<|endoftext|>"]
    texts = ["".join(rng.choice(signs, rng.integers(0, 25))) for _ in range(4000)]
    for t in [*texts, "a" * 5000, " " * 3000 + "x", "\n" * 1500, *(t or "" for _, t in TEXTS)]:
        want = library.encode(t, add_special_tokens=False).ids
        assert encoder.ids(t) == want and units.count(t) == len(want)


def test_packing(docs, empty, library):
    rows = packing.pack(docs, size=64).collect()
    ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in TEXTS}
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    at = 0
    for sequence, offset, length in places:
        assert sequence * 64 + offset == at and offset + length <= 64
        at += length
    assert at == sum(len(ids[i]) for i, _ in TEXTS)
    assert packing.pack(empty).count() == 0
    assert [packing.pad_to(n) for n in (1, 3, 1024, 2047)] == [1, 2048, 1024, 2048]


def test_texts_left_to_the_library():
    path = tokens.vocabulary()
    encoder = tokens.Encoder(path, tokens.by_rank(path))
    gaps = [" " * 1000, "\n" * 1000, " \n" * 500, "a" + "  \n" * 334]
    for text in ["a\tb", "\u0250", "\U0001f600", "a<|endoftext|>", *gaps]:
        assert encoder.slow(text)
    for text in ["", "a b\nc", "\u00e9", "<|endoftext|", " " * 999, "\n \n", (" \n" * 499 + "a") * 3]:
        assert not encoder.slow(text)


def test_training_order_reads_a_shard_once(spark, tmp_path):
    """A shard's bytes are not copied for each of its slots, here 8192 times 32 MB."""
    size, n = 2048, 8192
    ids = np.arange(size * n, dtype="<u4").astype("<u2").tobytes()
    row = (0, 0, n, bytearray(ids))
    spark.createDataFrame([row], "shard long, first_slot long, n long, data binary").write.parquet(f"{tmp_path}/one")
    shards = spark.read.parquet(f"{tmp_path}/one")
    start = time.monotonic()
    got = training_order.read_from(shards, 0, size, n).select("slot", F.crc32("ids").alias("crc")).collect()
    assert time.monotonic() - start < 20
    stride = 2 * size
    assert [(r.slot, r.crc) for r in got] == [(k, zlib.crc32(ids[k * stride:(k + 1) * stride])) for k in range(n)]


def test_training_order(docs, empty, library):
    for n in (1, 2, 7, 100, 4097):
        slots = training_order.permute(np.arange(n), n, 5)
        assert sorted(slots) == list(range(n))
        assert (training_order.sequence_of(slots, n, 5) == np.arange(n)).all()
    shards = training_order.materialise(docs, size=64, per_shard=8)
    rows = training_order.read_from(shards, 0, 64, 8).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    assert all(r.shard == r.slot // 8 and r.byte_offset == r.slot % 8 * 128 for r in rows)
    back = training_order.sequence_of(np.arange(len(rows)), len(rows), 20_240_501)
    stream = b"".join(bytes(rows[k].ids) for k in np.argsort(back))
    for _, t in TEXTS:
        assert np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u2").tobytes() in stream
    later = training_order.read_from(shards, 10, 64, 8).orderBy("slot").collect()
    assert [bytes(r.ids) for r in later] == [bytes(r.ids) for r in rows[10:]]
    assert training_order.read_from(training_order.materialise(empty)).count() == 0


def test_repeated_passages(docs, empty):
    least = {}
    words = [(passages.LAST if i is None else i, passages.WORDS.findall(t or "")) for i, t in TEXTS]
    for i, w in words:
        for k in range(len(w) - 12):
            least[tuple(w[k:k + 13])] = min(i, least.get(tuple(w[k:k + 13]), i))
    want = []
    for (own, _), (i, w) in zip(TEXTS, words, strict=True):
        gone = {x for k in range(len(w) - 12) if least[tuple(w[k:k + 13])] < i for x in range(k, k + 13)}
        want.append((own, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = [tuple(r) for r in passages.remove_repeats(docs, shard_segments=2).collect()]
    assert counted(got) == counted(want) and sum(r[2] for r in got) > 20
    assert passages.remove_repeats(empty).count() == 0


def test_passages_around_one_frequent_anchor(spark, monkeypatch):
    rng = np.random.default_rng(8)
    hashes, pool = passages.WordHashes(), [f"w{k}" for k in range(200)]
    phrases = [rng.choice(pool, 5).tolist() for _ in range(4000)]
    phrase = min(phrases, key=lambda p: passages.anchors(hashes.of(p), 5)[0][0] & (2 ** 64 - 1))
    texts = [(k, " ".join([*rng.choice(pool[:3], 6), f"l{k % 2}", "left", *phrase, "right", f"r{k % 3}",
                           *rng.choice(pool[:3], 6)])) for k in rng.permutation(400).tolist()]
    texts += [(None, texts[0][1]), (500, f"other start {texts[1][1]}")]
    least = {}
    rows = [(passages.LAST if i is None else i, t.split()) for i, t in texts]
    for i, w in rows:
        for k in range(len(w) - 12):
            least[tuple(w[k:k + 13])] = min(i, least.get(tuple(w[k:k + 13]), i))
    want = []
    for (own, _), (i, w) in zip(texts, rows, strict=True):
        gone = {x for k in range(len(w) - 12) if least[tuple(w[k:k + 13])] < i for x in range(k, k + 13)}
        want.append((own, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    scan, whole = passages.scan_shard, getattr(passages, "scan_split_shard", None)

    def bounded(window):
        def run(frame):
            assert len(frame) <= 150
            return scan(frame, window)
        return run

    def bounded_split(window):
        def run(frame, owned):
            assert len(frame) <= 150 and len(owned) <= 150
            return whole(frame, owned, window)
        return run

    monkeypatch.setattr(passages, "shard_scan", bounded)
    monkeypatch.setattr(passages, "split_shard_scan", bounded_split, raising=False)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in passages.remove_repeats(df, shard_segments=50).collect()]
    assert counted(got) == counted(want) and sum(r[2] > 0 for r in got) > 100


def test_simhash(spark, empty):
    base = "".join(f"w{k} " for k in range(200))
    texts = [*TEXTS, *((20 + k, base.replace(f"w{k * 7} ", "new ")) for k in range(12)), (40, "a b"), (41, "A  B")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    prints = [simhash.fingerprint(t) & (2 ** 64 - 1) for _, t in texts]
    root = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a in range(len(texts)):
            for b in range(len(texts)):
                if bin(prints[a] ^ prints[b]).count("1") <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    least = {}
    for (i, _), r in zip(texts, root, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(texts, prints, root, strict=True)]
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    assert counted(map(tuple, got)) == counted(want)
    assert simhash.near_duplicates(empty.select("doc_id", "text")).count() == 0


def test_links_of_many_close_fingerprints(spark):
    rng = np.random.default_rng(3)
    values = {0, -1, 1, 2, 3, 1 << 62, -(1 << 63)}
    for v in rng.integers(-2 ** 63, 2 ** 63 - 1, 60).tolist():
        values |= {v, v ^ 1, v ^ (1 << 40), v ^ (1 << 40) ^ (1 << 7), v ^ 7}
    values = sorted(values)
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "fp long, node long")
    want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values))
            if bin((values[a] ^ values[b]) & (2 ** 64 - 1)).count("1") <= 2}
    assert {tuple(r) for r in simhash.links(df).collect()} == want


def test_allocation_covers_every_pair():
    for n in (1, 10 ** 4, 10 ** 9, 10 ** 12):
        groups = simhash.allocate(n, np.full(64, 0.5))
        assert sum(t + 1 for _, _, t in groups) == 3 and all(a < b for a, b, _ in groups)


@pytest.mark.parametrize("shard_words", [100_000, 16])
def test_decontamination(spark, docs, empty, shard_words):
    items = [(1, LINE), (2, "cc by nc"), (3, None), (4, "..."), (2, "CC by-NC"), (None, "word " * 14), (11, "tail of")]
    table = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        w = decontaminate.words_of(t)
        for k in range(len(w) - min(13, len(w)) + 1):
            if w:
                windows.setdefault(tuple(w[k:k + min(13, len(w))]), set()).add("" if i is None else str(i))
    want = []
    for i, t in TEXTS:
        w, hit, found = decontaminate.words_of(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                     len(hit) > 0 and 20 * len(hit) >= len(w)))
    got = decontaminate.contamination(docs, table, shard_words=shard_words).drop("spans").collect()
    assert counted(map(tuple, got)) == counted(want)
    assert decontaminate.contamination(empty, table).count() == 0
    clean = decontaminate.contamination(docs, table.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert clean == 0


def test_automaton_on_random_words():
    rng = np.random.default_rng(1)
    items = [(str(k), [str(x) for x in rng.integers(0, 3, rng.integers(1, 12))]) for k in range(12)]
    matcher = automaton.WindowMatcher(items, 5)
    for _ in range(60):
        w = [str(x) for x in rng.integers(0, 4, 40)]
        hit, found = set(), set()
        for i, words in items:
            n = min(5, len(words))
            for a in range(len(words) - n + 1):
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == words[a:a + n]:
                        hit |= set(range(k, k + n))
                        found.add(i)
        spans, ids = matcher.match([w])[0]
        assert {x for a, b in spans for x in range(a, b)} == hit and set(ids) == found


def test_pii(docs, empty):
    rows = pii.report(pii.extract(docs)).collect()
    assert len(rows) == len(TEXTS)
    row = next(r for r in rows if r.doc_id == 9)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    text = dict(TEXTS)[9]
    assert [text[int(a):int(b)] for _, a, b in (s.split(":") for s in row.spans.split(","))] == [
        "ann@example.com", "10.0.0.1", "4111 1111 1111 1111", "+1 (555) 010-9999"]
    assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
    assert pii.report(pii.extract(empty)).count() == 0
    for t in ["a@b@c.de x", "a@b.c@d.e", "@x.y", "..@a.b-c.d.", "q@w..e r@t.y.", "é@a.b"]:
        assert pii.emails(t) == [m.span() for m in pii.PATTERNS["email"].finditer(t)]


def test_pii_patterns_find_identifiers_of_their_own(spark):
    rows = [(k, f"number: 41111111111111{k:02d}x and address: u{k}@host{k}.example") for k in range(30)]
    rows += [(100, "address: someone@intranet9")]
    found = {r.doc_id: r.added for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shapes = {pii.shape(f"u{k}@host{k}.example") for k in range(30)}
    assert shapes == {"a9@a9.a"} and all(not found[k] or found[k][0].kind in pii.KINDS for k in found)
    edges = spark.createDataFrame(
        [("mail a@a", str(k), "email") for k in range(20)] + [("mail a@a", "new", None), ("the a9", "z", None)],
        "pattern string, instance string, kind string")
    assert [tuple(r) for r in pii.trusted_patterns(edges).collect()] == [("mail a@a", "email")]


def test_pii_second_generation(spark):
    texts = [f"mail: u{k}@host{k}.example" for k in range(400)]
    texts += [f"mail: AB-{1000 + k} or" for k in range(30)] + [f"handle: AB-{1000 + k} or" for k in range(30)]
    texts += ["handle: QX99/7777#z or", "price: 1000/7777#z or", "call: (555) 010-9999 or 4111 1111 1111 1112 now"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.added] for r in pii.extract(df).collect()}
    assert found[400] == ["AB-1000"] and found[430] == ["AB-1000"]
    assert found[460] == ["QX99/7777#z"] and found[461] == [] and found[462] == []
    assert [texts[462][a:b] for a, b in pii.candidates(texts[462])] == [
        "(555) 010-9999", "010-9999", "4111 1111 1111 1112"]
    phones = [f"call: +1 (555) 010-{k:04d} or" for k in range(100)] + ["call: +1 (555) 010 or", "call: (555) 010-9999 or"]
    df = spark.createDataFrame(list(enumerate(phones)), "doc_id long, text string")
    found = {r.doc_id: [phones[r.doc_id][s.start:s.end] for s in r.added] for r in pii.extract(df).collect()}
    assert found[100] == ["+1 (555) 010"] and "(555) 010-9999" in found[101]


def test_toxicity(spark, docs, empty):
    insults, plain = ["stupid", "moron", "loser"], ["house", "tree", "river", "stone"]
    rng = np.random.default_rng(2)
    rows = [(k, " ".join([*rng.choice(plain, 12), *(rng.choice(insults, 2) if k % 2 else [])])) for k in range(400)]
    rows += [(1000, "river st00pid m0r0n tree"), (1001, "river l o s e r tree"), (1002, "river tree"), (1003, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, labels).collect()}
    assert len(got) == 404
    for k in range(400):
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and got[k].predicted == k % 2
    assert [got[k].predicted for k in (1000, 1001, 1002, 1003)] == [1, 1, 0, 0]
    assert toxicity.toxicity(empty, labels).count() == 0
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == len(TEXTS) and all(r.score == 0 or r.score < 1e-9 for r in none)


def test_restoring():
    model = channel.log_model(channel.trigram_counts(["worthless idiot moron pathetic loser trash"] * 9))
    restorer = channel.Restorer(model)
    for disguised, word in [("1d10t", "idiot"), ("w0rthl3ss", "worthless"), ("l.o.s.e.r", "loser"), ("tr4$h", "trash"),
                            ("m o r o n", "moron"), ("paaathetic!", "pathetic")]:
        assert word in restorer.words(f"so {disguised} now")
    assert not restorer.words(None)
    assert channel.Restorer(model, {"idiot": 2.0}.get).words("so 1d10t now") == {"idiot": 2.0}


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((600, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [
        (600, None), (700, [0.0] * 16), (800, [float("nan")] * 16), (900, [None] * 16), (None, vectors[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 100 = 0"), block_rows=150).collect()
    assert {r.query_id for r in got} == {0, 100, 200, 300, 400, 500}
    hits = 0
    for q in {r.query_id for r in got}:
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.argsort(d)[:10].tolist()))
    assert hits >= 54
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_among_copies(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((2000, 64))
    for low, high in ((100, 140), (300, 400), (500, 1500)):
        vectors[low:high] = vectors[low]
    ids = rng.permutation(len(vectors))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)],
                               "vec_id long, embedding array<double>")
    asked = [int(ids[k]) for k in (100, 120, 139, 300, 350, 399, 500, 900, 1499)]
    for block_rows in (4096, 600):
        got = neighbours.nearest(df, df.where(F.col("vec_id").isin(asked)), block_rows=block_rows).collect()
        for q in asked:
            d = ((vectors - vectors[ids == q][0]) ** 2).sum(1)
            want = [i for _, i in sorted(zip(d.tolist(), ids.tolist(), strict=True)) if i != q][:10]
            assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want


def test_licenses(docs, empty):
    rows = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert (rows[10].n_base, rows[10].first_word, rows[10].last_word) == (2, 3, 8)
    assert rows[10].base_labels == "apache-2,cc-by-nc" and rows[10].score == 1.0
    assert rows[4].n_words == 0 and rows[4].first_word is None and rows[4].labels == ""
    assert licenses.license_scan(empty).count() == 0
    join = licenses.TemplateJoin(licenses.TEMPLATES, {}, 0.8)
    rng = np.random.default_rng(5)
    pool = sorted({w for texts in licenses.TEMPLATES.values() for t in texts for w in licenses.words_of(t)})
    for _ in range(300):
        block = set(rng.choice(pool, rng.integers(1, len(pool))).tolist())
        want = {label for label, texts in licenses.TEMPLATES.items() for t in texts for s in [set(licenses.words_of(t))]
                if len(s & block) >= 0.8 * len(s) - 1e-9}
        assert set(join.best(block)) == want


def test_license_notices_as_they_are_written(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    gpl = "This work is licensed under the GNU General Public License, version {}."
    far = " filler" * 40
    texts = ["Copyright 2020 Ann.\nAll rights reserved.", "All rights reserved.", bsd, gpl.format(3), gpl.format(2),
             f"{gpl.format(3)}{far} {gpl.format(2)}", gpl.format(3).replace("General", "\n * General"),
             " ".join(f"{w}{far}" for w in licenses.words_of(gpl.format(3))), "all the rights are not reserved"]
    want = ["all-rights-reserved", "all-rights-reserved", "bsd", "gpl-3", "gpl-2", "gpl-2,gpl-3", "gpl-3", "", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_scan(df).collect()}
    assert [got[k] for k in range(len(texts))] == want
    join = licenses.TemplateJoin(licenses.TEMPLATES, {}, 0.8)
    rng = np.random.default_rng(9)
    pool = sorted({w for _, words, _ in join.sets for w in words})
    for _ in range(200):
        words = rng.choice(["x", "y", *pool], 150).tolist()
        for k, (_, wanted, need) in enumerate(join.sets):
            held = [len(wanted & set(words[a:a + join.width[k]])) for a in range(len(words))]
            blocks = join.blocks(k, words, 0, len(words))
            assert max([b[2] for b in blocks], default=0) == (max(held) if max(held) >= need else 0)


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    kept = docs.select("text").collect()
    assert not any(re.search(r"[a-z]+@[a-z0-9]+\.", r.text or "") for r in kept)
    pieces = pipeline.pack_sequences(spark, docs, folder)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pii_refused_numbers_speak_against_their_pattern(spark):
    good = ["4539578763621486", "4556737586899855", "4716461583322103", "4024007103939509", "4485275742308327"]
    assert all(pii.luhn(n) for n in good) and not pii.luhn("4539578763621487")
    texts = [f"see the {n} there" for n in good] + [f"see the {int(n) + 1} there" for n in good]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.extract(df).collect()}
    assert all(len(found[k].base) == 1 for k in range(5))
    assert not any(r.added for r in found.values())
    edges = spark.createDataFrame([("p", f"s{k}", "card") for k in range(8)] + [("p", f"w{k}", "wrong") for k in range(4)],
                                  "pattern string, instance string, kind string")
    assert pii.trusted_patterns(edges).collect() == []
    assert len(pii.trusted_patterns(edges.where("kind = 'card'")).collect()) == 1


def test_pii_candidates_are_outermost():
    for text in ("ring +1 (555) 010-9999 now", "call 020 7946 0000-12 or AB-123456", "id 12-34/56-78 x" * 50):
        spans = pii.outermost(pii.candidates(text))
        assert spans and all(b <= c or not (c >= a and d <= b) for (a, b), (c, d) in zip(spans, spans[1:]))


def test_passage_anchors_of_a_batch_hold_nothing_back(spark):
    words = [["a", "b" * 300, "é" * 9, "12345678", "123456789"] * 5, [], ["x"] * 12, [f"w{k % 7}" for k in range(60)]]
    hashes = passages.WordHashes()
    flat = hashes.of([w for text in words for w in text])
    assert flat.tolist() == [hashes.of([w])[0] for text in words for w in text] and not vars(hashes)
    assert len(set(flat.tolist())) == 13
    sizes = np.array([len(text) for text in words])
    want, at = [], 0
    for text in words:
        want += [(a, first + at, last + at) for a, first, last in passages.anchors(hashes.of(text))]
        at += len(text)
    assert list(zip(*(x.tolist() for x in passages.runs(flat, sizes, 13)), strict=True)) == want
    df = spark.createDataFrame([(1, " \t" + "\x0b ".join(words[0])), (2, "\xa0 " + "  ".join(words[0]))], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in passages.remove_repeats(df).collect()}
    assert got == {1: (25, 0, " ".join(words[0])), 2: (26, 25, "\xa0")}


def test_a_shard_is_scanned_in_parts_of_whole_anchors(monkeypatch):
    import pandas as pd

    sizes, scan = [], passages.scan_part
    monkeypatch.setattr(passages, "PART_SEGMENTS", 3)
    monkeypatch.setattr(passages, "scan_part", lambda s, o, w: sizes.append(len(s)) or scan(s, o, w))
    rows = [(k // 4, k, f"p{k // 4} a b c d{k % 2}", 9 - k) for k in range(10)]
    frame = pd.DataFrame(rows, columns=["anchor", "segment_key", "segment", "least"]).sample(frac=1, random_state=1)
    got = passages.scan_shard(frame, 4).sort_values("segment_key")["owners"].tolist()
    assert sizes == [4, 4, 2]
    groups = [[k for k in range(10) if k // 4 == g] for g in range(3)]
    want = [[min(9 - j for j in groups[k // 4]), min(9 - j for j in groups[k // 4] if j % 2 == k % 2)] for k in range(10)]
    assert got == want


def test_passages_leave_no_shuffle_files(spark):
    from arrears.llm import common

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return set(re.findall(r"shuffle_(\d+)_", files))

    before = shuffled()
    rows = passages.written(spark.range(0, 1000, 1, 8).groupBy((F.col("id") % 7).alias("k")).count(), "test")
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 7
    assert spark.conf.get(common.FREE_SHUFFLES) == "false"
