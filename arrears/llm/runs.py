"""Operator 13: periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period ``q``, at least ``3 q`` long, that no neighbouring word extends. At
scale ``t`` a position is synchronising if the least hash of the ``t``-word windows beginning in ``[i, i + t]`` is at one
of the two ends; windows that are highly periodic themselves (period at most ``t / 3``) do not compete. Whether ``i`` is
chosen depends on its next ``2 t`` words alone, so a run of period ``p`` in ``[1.5 t, 3 t)`` holds a chosen position and,
``p`` words on, a second one with the same context. Positions with equal contexts propose periods; each proposal is
compared word by word and extended both ways, so hashes decide nothing but what is tried. The highly periodic windows
left out at a scale belong to runs found before, at smaller scales; the smallest periods are detected directly.

Texts are read whole, one row at a time; a row costs a constant number of array passes per scale, and scales double. A
null text has no words. Null ids, repeated rows and other columns make no difference; an empty table gives no rows. A
very long text needs memory in proportion to its own words only.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Shortest run reported, and the least number of periods in a run.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Scales are ``FIRST`` times a power of two; periods under 1.5 ``FIRST`` are detected directly.
FIRST = 6
DIRECT = FIRST * 3 // 2
#: Words of several texts that are handled as one array; a longer text is handled alone.
WORDS_AT_ONCE = 200_000
_FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_LAST = np.uint64(2 ** 64 - 1)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes side by side."""
    x = left * _FACTORS[0] + right
    x ^= x >> np.uint64(29)
    x *= _FACTORS[1]
    return x ^ (x >> np.uint64(32))


def joined(h: np.ndarray, by: int, other: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the windows made of a window and the one beginning ``by`` words on."""
    other = h if other is None else other
    n = max(0, len(other) - by)
    return mixed(h[:n], other[by:by + n])


def least_ahead(v: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` consecutive ones."""
    done = 1
    while done < width:
        step = min(done, width - done)
        v = np.minimum(v[:-step], v[step:])
        done += step
    return v


def stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of true entries, at least ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False]))))
    first, last = edges[::2], edges[1::2]
    long = last - first >= least
    return list(zip(first[long].tolist(), last[long].tolist()))


def synchronising(h: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """Chosen positions, from the hashes of all windows of ``t`` words and whether a window is highly periodic."""
    n = len(h) - t
    if n <= 0:
        return np.zeros(0, np.int64)
    least = least_ahead(np.where(periodic, _LAST, h), t + 1)
    here = ~periodic[:n] & (least == h[:n])
    there = ~periodic[t:] & (least == h[t:])
    return np.flatnonzero(here | there)


def proposals(chosen: np.ndarray, context: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(period, position) of chosen positions with equal contexts whose distance is in ``[low, high)``, sorted.

    Equal contexts at scale ``t`` lie more than ``t / 3`` words apart, as a nearer pair would be highly periodic; so a
    position has at most nine partners within ``high = 3 t`` words, and the loop ends.
    """
    chosen = chosen[chosen < len(context)]
    marks = context[chosen]
    order = np.argsort(marks, kind="stable")
    at, marks = chosen[order], marks[order]
    found, k = [], 1
    while k < len(at):
        apart = at[k:] - at[:-k]
        near = (marks[k:] == marks[:-k]) & (apart < high)
        if not near.any():
            break
        fits = near & (apart >= low)
        found += zip(apart[fits].tolist(), at[:-k][fits].tolist())
        k += 1
    return sorted(found)


def agreement(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words ``period`` apart are identical: first, and end of the left words."""
    n, last, step = len(codes) - period, at, 64
    while last < n:
        stop = min(n, last + step)
        differ = codes[last:stop] != codes[last + period:stop + period]
        if differ.any():
            last += int(differ.argmax())
            break
        last, step = stop, step * 2
    first, step = at, 64
    while first > 0:
        start = max(0, first - step)
        differ = (codes[start:first] != codes[start + period:first + period])[::-1]
        if differ.any():
            first -= int(differ.argmax())
            break
        first, step = start, step * 2
    return first, last


class RunFinder:
    """All runs of several texts at once. Texts are laid end to end with a word of its own between them."""

    def __init__(self, texts: list[list[str]]):
        self.order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        lengths = np.array([len(texts[k]) for k in self.order], np.int64)
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths - 1
        self.lengths = lengths
        known: defaultdict[str, int] = defaultdict(count().__next__)
        codes: list[int] = []
        for rank, k in enumerate(self.order):
            codes += [known[w] for w in texts[k]]
            codes.append(-1 - rank)
        self.codes = np.array(codes, np.int64)
        self.found: dict[tuple[int, int], int] = {}  # (first word, end) -> smallest period

    def add(self, first: int, last: int, period: int) -> None:
        """Keep a stretch of equal words as a run; periods come in rising order, so the smallest stays."""
        if last - first >= (LEAST_PERIODS - 1) * period:
            self.found.setdefault((first, last + period), period)

    def highly_periodic(self, t: int, n: int) -> np.ndarray:
        """Which of ``n`` windows of ``t`` words have a period of at most a third of ``t``."""
        steps = np.zeros(n + 1, np.int32)
        for (first, end), period in self.found.items():
            if LEAST_PERIODS * period <= t <= end - first and first < n:
                steps[first] += 1
                steps[min(n, end - t + 1)] -= 1
        return np.cumsum(steps[:-1]) > 0

    def search(self) -> list[list[tuple[int, int, int]]]:
        """Per text its runs (start, length, period) by start, then period."""
        for period in range(1, DIRECT):
            for first, last in stretches(
                    self.codes[:-period] == self.codes[period:], (LEAST_PERIODS - 1) * period):
                self.add(first, last, period)
        one = mixed(self.codes.astype(np.uint64), np.zeros(len(self.codes), np.uint64))
        two = joined(one, 1)
        h, t = joined(joined(two, 2, one), 3), FIRST
        while True:
            texts = int(np.searchsorted(-self.lengths, -(LEAST_PERIODS * 3 * t) // 2, side="right"))
            if not texts:
                break
            size = int(self.ends[texts - 1])
            h = h[:size - t + 1]
            context = joined(h, t)
            chosen = synchronising(h, self.highly_periodic(t, len(h)), t)
            period, end = 0, -1
            for p, at in proposals(chosen, context, 3 * t // 2, 3 * t):
                if p != period or at >= end:
                    first, end = agreement(self.codes[:size], at, p)
                    self.add(first, end, p)
                    period = p
            h, t = context, 2 * t
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.order]
        for (first, end), p in self.found.items():
            if end - first >= LEAST_WORDS:
                k = int(np.searchsorted(self.starts, first, side="right")) - 1
                out[self.order[k]].append((first - int(self.starts[k]), end - first, p))
        return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def runs_of(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text; texts share arrays of about ``WORDS_AT_ONCE`` words."""
    out, part, size = [], [], 0
    for words in texts:
        if part and size + len(words) > WORDS_AT_ONCE:
            out += RunFinder(part).search()
            part, size = [], 0
        part.append(words)
        size += len(words)
    return out + (RunFinder(part).search() if part else [])


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds behind its first period, joined by blanks."""
    if not runs:
        return " ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return " ".join(w for w, k in zip(words, kept.tolist()) if k)


def split_words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def periodic_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, words: Callable[..., list[str]] = split_words,
) -> DataFrame:
    """Columns ``keep``, the runs of each text and the text with every run collapsed to its first period.

    ``words`` makes the words from the value of the column ``text``, which may also be a struct.
    """

    def factory():
        def work(values: list) -> list[tuple]:
            texts = [words(v) for v in values]
            found = runs_of(texts)
            return [([dict(zip(("start", "length", "period"), r)) for r in runs], collapsed(w, runs))
                    for w, runs in zip(texts, found)]

        return work

    return common.map_rows(
        docs, text, keep or [], "runs array<struct<start:long,length:long,period:long>>, collapsed string", factory)


def planted(value: dict) -> list[str]:
    """Words of a text; one text in ten by the checksum of its id gets a periodic tail."""
    words, mark = split_words(value["text"]), value["mark"]
    if mark is None or mark % 10 or not words:
        return words
    n, g = len(words), mark // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def longest(runs: Column) -> Column:
    """The run with the greatest length over period; of equals the one that starts first, then the smaller period."""

    def compare(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(left > right, -1).when(left < right, 1)
                .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, compare), F.lit(0))


def op13_synchronising_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", F.struct(
        "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("mark")).alias("value"))
    found = periodic_runs(docs, "value", ["doc_id"], planted)
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", longest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
