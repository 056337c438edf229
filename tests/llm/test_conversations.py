"""Repair of conversations against an exhaustive search over edits."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from arrears.llm import conversations as conv

BLANK = " \t\n\x0b\x0c\r"


def best_edits(rows):
    """Least (cost, audit, repaired lines) by trying every edit; rows are (role, text, must go, truncated)."""

    def step(state, role):
        if state == 0 and role == "s":
            return 1
        if role == {0: "u", 1: "u", 2: "a", 3: "u"}[state]:
            return 2 if role == "u" else 3
        return None

    @cache
    def search(i, state, inserts):
        found = []
        if i == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        if inserts < 4:
            for name in ("user", "assistant"):
                to = step(state, name[0])
                if to is not None and (rest := search(i, to, inserts + 1)):
                    found.append((rest[0] + 2, "I" + rest[1], (f"{name}:", *rest[2])))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            if rest := search(i + 1, state, 0):
                found.append((rest[0] + 3, "D" + rest[1], rest[2]))
            if not must_go:
                for letter, name, cost in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    to = step(state, name[:1])
                    if to is not None and (rest := search(i + 1, to, 0)):
                        found.append((rest[0] + cost + cut, letter + rest[1], (f"{name}:{text}", *rest[2])))
        return min(found, default=None)

    return search(0, 0, 0)


def expected(rows):
    """The contract's row for the original rows (conv, turn, role, text) of one conversation."""
    def filled(x):
        return " " if x is None else str(x)

    after = []
    for c, turn, role, text in rows:
        role, text = filled(role), filled(text)
        mark = zlib.crc32(f"{filled(c)}:{filled(turn)}".encode()) % 20
        if mark == 0:
            continue
        text = "" if mark == 1 else re.sub("[.!?]", "", text) if mark == 2 else text
        role = "user" if mark == 4 else role
        after += [(turn, role, text)] * (2 if mark == 3 else 1)

    def content(role, text):
        return hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()

    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), content(*r[1:])))
    counts, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in after:
        core = text.strip(BLANK)
        fault = ("blank" if not core else "duplicate" if (role, text) in seen
                 else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
    turns = [t for t, _, _ in after if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
    cost, audit, lines = best_edits(tuple(marked))
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(r, c, n):
    rows, turn = [], r.randint(-1, 2)
    for k in range(n):
        role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"])
        if r.random() < 0.6:
            role = "user" if k % 2 == 0 else "assistant"
        text = r.choice([None, "", " \t", "yes.", "No!", "so", "really?  ", "été", "a.\nb"]) if r.random() < 0.5 else (
            f"line {r.randint(0, 99)}" + r.choice([".", "!", "", "…", ". "]))
        rows.append((c, None if r.random() < 0.05 else turn, role, text))
        turn += r.choice([1, 1, 1, 2, 0])
    return rows


def check(spark, path, rows):
    spark.createDataFrame(
        [(*row, "x", 7) for row in rows], "conv_id long, turn long, role string, text string, token string, rid int"
    ).repartition(4).write.parquet(f"{path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in conv.op11_integer_weights(spark, str(path)).collect()}
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    assert got.keys() == by_conv.keys()
    for c, own in by_conv.items():
        assert got[c] == expected(own), (c, own)


def test_query_agrees_with_exhaustive_search(spark, tmp_path):
    r = random.Random(11)
    rows = [row for c in [None, *range(150)] for row in conversation(r, c, r.randint(1, 9))]
    rows += rows[:5] + [(900, 1, "assistant", "Alone."), (901, None, None, None), (902, 3, "system", "Only."),
                        (903, 0, "user", "Long " * 20000 + ".")]
    # A conversation that the damage removes altogether.
    lost = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    check(spark, tmp_path, [*rows, (lost, 1, "user", "Gone.")])


def test_hot_conversation_is_cut_into_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conv, "BLOCK", 4)
    monkeypatch.setattr(conv, "FAN", 3)
    r = random.Random(3)
    rows = [row for c, n in enumerate([40, 5, 4, 1, 13, 60, 8, 9]) for row in conversation(r, c, n)]
    check(spark, tmp_path, rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    assert conv.op11_integer_weights(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_chained_blocks_equal_the_whole(seed):
    r = random.Random(seed)
    for _ in range(150):
        codes = "".join(conv.row_code(r.randrange(4), r.choice([0, 0, 1, 2])) for _ in range(r.randint(1, 14)))
        whole = conv.solve(codes, conv.ACCEPTED, True)[conv.START]
        cuts = sorted(r.sample(range(1, len(codes)), min(len(codes) - 1, r.randint(0, 3))))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        found, done = conv.table_of(parts[0], len(parts) == 1), len(parts[0])
        for k, part in enumerate(parts[1:], 2):
            found = conv.chain(found, done, conv.table_of(part, k == len(parts)), len(part))
            done += len(part)
        assert conv.plan_of(codes, found[0]) == conv.plan_of(codes, whole)
