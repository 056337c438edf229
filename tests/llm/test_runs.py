"""Runs against brute force over all starts and periods."""

import hashlib
import random
import zlib

import pytest

from arrears.llm import runs


def brute(words):
    """Every maximal repetition, by its definition: each period, each stretch, smallest period only."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            first = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - first >= max(24, 3 * p):
                found.setdefault((first, i + p), p)
    return sorted(((a, e - a, p) for (a, e), p in found.items()), key=lambda r: (r[0], r[2]))


def sample(r):
    words = [r.choice("abcdefgh"[:r.randint(1, 8)]) for _ in range(r.randint(0, 60))]
    for _ in range(r.randint(0, 4)):
        p = r.choice([1, 2, 3, 5, 8, 9, 10, 11, 13, 17, 18, 24, 35, 36, 50, 71, 72, 100])
        base = [r.choice("abcdefghijklmnop"[:r.choice([1, 2, 4, 16])]) for _ in range(p)]
        words += (base * 9)[:r.randint(p, 6 * p)]
        if r.random() < 0.3 and words:
            words[r.randrange(len(words))] = "z"
        words += [r.choice("abc") for _ in range(r.randint(0, 9))]
    return words


def test_random_texts_agree_with_brute_force():
    r = random.Random(13)
    texts = [sample(r) for _ in range(400)]
    assert runs.runs_of(texts) == [brute(t) for t in texts]


def test_words_of_structure():
    fibonacci = ["a", "b"]
    while len(fibonacci[1]) < 700:
        fibonacci = [fibonacci[1], fibonacci[1] + fibonacci[0]]
    morse = "a"
    while len(morse) < 700:
        morse += morse.translate(str.maketrans("ab", "ba"))
    nested = (("x y " * 30 + "w ") * 8).split()
    texts = [list(fibonacci[1]), list(morse), nested, ["same"] * 2000, [str(i) for i in range(500)] * 3]
    assert runs.runs_of(texts) == [brute(t) for t in texts]


def test_long_text_beside_short_ones():
    r = random.Random(5)
    base = [str(r.randrange(3000)) for _ in range(6000)]
    long = base[:2000] + base * 3 + ["end"]
    got = runs.runs_of([["a"] * 24, long, [], ["b"] * 23])
    assert got[0] == [(0, 24, 1)] and got[2] == [] and got[3] == []
    assert (2000, 18000, 6000) in [(s, n, p) for s, n, p in got[1]]


def digest(doc_id, text):
    words = runs.split_words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_on_odd_rows(spark, tmp_path):
    r = random.Random(2)
    rows = [(i, " ".join(sample(r)), "x", 1) for i in range(300)]
    rows += [(None, "ha " * 40, "x", 1), (7, None, None, None), (8, "", "y", 2), (8, "", "y", 2),
             (9, " \t\x0b\n ", "y", 2), (10, " wide  " * 30, "y", 2), (11, "one two " * 1500, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed int")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op13_synchronising_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(digest(i, t)) for i, t, *_ in rows)
    empty = docs.limit(0)
    assert runs.periodic_runs(empty, "text", ["doc_id"]).collect() == []


@pytest.mark.parametrize("words", [["a"] * 24, list("ab") * 12, list("abcdefgh") * 3])
def test_shortest_runs(words):
    assert runs.runs_of([words]) == [brute(words)] != [[]]
    assert runs.runs_of([words[:-1]]) == [[]]
