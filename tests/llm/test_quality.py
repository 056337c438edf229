"""Quality scores: the learner against its textbook form, odd rows, held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest

from arrears.llm import quality as q


class Textbook:
    """The same updates bucket by bucket, in dictionaries."""

    def __init__(self):
        self.z, self.n = {}, {}

    def weight(self, i):
        z, bar = self.z.get(i, 0.0), 0.0 if i == 0 else q.SPARSE
        if abs(z) <= bar:
            return 0.0
        return -(z - math.copysign(bar, z)) / ((q.DAMPING + math.sqrt(self.n.get(i, 0.0))) / q.RATE + q.SMOOTH)

    def score(self, found):
        x = 1 / math.sqrt(max(1, len(found)))
        return 1 / (1 + math.exp(-(self.weight(0) + sum(self.weight(i) * x for i in found))))

    def learn(self, found, label):
        x = 1 / math.sqrt(max(1, len(found)))
        w = {i: self.weight(i) for i in (0, *found)}
        wrong = self.score(found) - label
        for i in w:
            g, n = wrong * (1.0 if i == 0 else x), self.n.get(i, 0.0)
            self.n[i] = n + g * g
            self.z[i] = self.z.get(i, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / q.RATE * w[i]


def texts(r, n):
    """Good prose, and bad rows whose words all end in signs."""
    out = []
    for _ in range(n):
        good = r.random() < 0.7
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(r.randint(3, 40))]
        out.append((int(good), " ".join(w if good else w + r.choice(["###", "%%%"]) for w in words)))
    return out


def test_learner_is_the_textbook_one():
    r, fast, slow = random.Random(1), q.Learner(), Textbook()
    for y, text in texts(r, 150) + [(1, ""), (0, None)]:
        found = q.buckets(text)
        fast.learn(found, y)
        slow.learn(found.tolist(), y)
    w = fast.weights()
    assert w[0] == pytest.approx(slow.weight(0))
    touched = sorted(slow.z)
    assert np.allclose(w[touched], [slow.weight(i) for i in touched])
    assert not w[np.setdiff1d(np.arange(q.BUCKETS), touched)].any()


def test_buckets():
    found = q.buckets("One, two. One, two.")
    # Words One two , . and pairs: One-, ,-two two-. .-One
    assert len(found) == 8 and (np.diff(found) > 0).all() and found[0] >= 1
    assert found.tolist() == q.buckets("One, two. One, two. One, two.").tolist()
    assert len(q.buckets(None)) == len(q.buckets("")) == len(q.buckets(" \n")) == 0
    assert len(q.buckets("word " * 20000)) == 2


def fixture(spark, n=600):
    rows = [(i, text, "x", 1.0, y) for i, (y, text) in enumerate(texts(random.Random(4), n))]
    extra = [(n, None, "x", 1.0, 1), (n + 1, "", "y", 1.0, 0), (None, "no id ###", "y", 1.0, 0),
             (5, rows[5][1], "x", 1.0, rows[5][4]), (6, "another text of six", "x", 1.0, 1), (n + 2, "long " * 20000, "z", 1.0, 1)]
    docs = spark.createDataFrame([r[:4] for r in rows + extra], "doc_id long, text string, _score string, score double")
    labels = spark.createDataFrame([(r[0], r[4], 0) for r in rows + extra] + [(7, None, 0), (8, 5, 1)],
                                   "doc_id long, quality int, text int")
    return docs, labels, rows


def test_query_form_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(q, "SHARD_ROWS", 100)
    docs, labels, rows = fixture(spark)
    got = q.quality(docs.repartition(5), labels).collect()
    assert len(got) == docs.count() and got[0].__fields__ == ["doc_id", "held_out", "score", "predicted"]
    again = {(r.doc_id, r.score) for r in q.quality(docs.repartition(3), labels.repartition(2)).collect()}
    assert again == {(r.doc_id, r.score) for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    truth = {r[0]: r[4] for r in rows if r[0] not in (5, 6)}
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(held) / len(held) > 0.95


def test_held_out_labels_are_not_read(spark):
    docs, labels, _ = fixture(spark, 200)
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) AS quality")
    a, b = ({(r.doc_id, r.score) for r in q.quality(docs, which).collect()} for which in (labels, turned))
    assert a == b


def test_empty_tables(spark):
    docs, labels, _ = fixture(spark, 20)
    assert q.quality(docs.limit(0), labels).collect() == []
    assert {(r.score, r.predicted) for r in q.quality(docs, labels.limit(0)).collect()} == {(0.5, 0)}


def test_query_on_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = q.op12_leader_quality(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").selectExpr("predicted = quality AS right").collect()
    assert len(held) > 50 and sum(r.right for r in held) / len(held) > 0.85


def test_one_state_a_pass_comes_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(q, "SHARD_ROWS", 5)
    data = [(i, i, i % 2, q.buckets(f"word {i % 7} of {i % 2}").tobytes()) for i in range(23)]
    rows = spark.createDataFrame(data, "id long, place long, y int, found binary")
    dealt = rows.selectExpr("pmod(xxhash64(place, id), 5) AS shard", "place", "y", "found").orderBy(
        "shard", "place", "y", "found").collect()
    state = q.Learner()
    for _ in range(2):
        shards = {}
        for r in dealt:
            shards.setdefault(r.shard, q.Learner(state.leader, state.squares)).learn(np.frombuffer(r.found, np.int32), r.y)
        state = q.Learner(*(sum(getattr(s, name) for s in shards.values()) / len(shards) for name in ("leader", "squares")))
    kind, sizes = type(rows), []
    collect = kind.collect

    def measured(df):
        found = collect(df)
        sizes.append(sum(len(v) for r in found for v in r if isinstance(v, (bytes, bytearray))))
        return found

    monkeypatch.setattr(kind, "collect", measured)
    assert (q.learn(rows, passes=2) == state.weights()).all() and len(shards) > 1
    assert sizes and max(sizes) == 2 * 8 * q.BUCKETS
