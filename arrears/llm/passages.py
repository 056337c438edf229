"""Operator 4: repeated passages by sharded Aho-Corasick automata.

A window is ``window`` consecutive words of one document; it is removed where the same words also start in a document
with a smaller id. Four steps, each written:

1. Anchors. Every window names the five-word run with the least hash inside it, so equal windows name equal anchors.
   About one word in five starts an anchor. Anchors of two or more ids are confirmed by a pre-aggregated count.
2. Segments. The windows around a confirmed anchor form a segment; equal segments under one anchor are one row with
   the least id, so a passage that a third of all documents share is one row after the map side.
3. Automata. Segments are sharded by anchor. Each shard compiles the windows of its distinct segments into an
   automaton over word numbers that knows the least id of each window, and streams its segments through it. Anchors
   with more distinct segments than a shard may hold are split: the least id of each of their windows comes from a
   pre-aggregated count, windows are sharded by their hash, and a shard's automaton is built once for every
   ``shard_segments`` segments that hold one of its windows. No frame grows with an anchor or with a window.
4. Every occurrence of a segment, in all documents, takes the least ids found and removes the words of windows that
   belong to a smaller id.

Null texts have no words. Rows that share an id never remove each other's words; a row without an id counts as later
than any id. Texts with fewer words than a window stay whole.
"""

from __future__ import annotations

import re
from functools import partial

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common
from arrears.llm.automaton import merge

WORDS = re.compile(r"[^ \t-\r]+")
WINDOW, ANCHOR = 13, 5
#: Distinct segments in one automaton, on average, and most under one anchor that is not split; about 20 MB.
SHARD_SEGMENTS = 4000
#: Segments that share an automaton, beyond the last one's anchor.
PART_SEGMENTS = 100
LAST = (1 << 63) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


#: The exchanges are several times the input; each ends with the table it serves.
written = partial(common.written, free=True)


class WordHashes:
    """64-bit hashes of words: eight bytes at a time for all words at once, beyond ``LONG`` bytes by the library."""

    LONG = 256
    MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

    def of(self, words: list[str]) -> np.ndarray:
        return self.between(*bounds(" ".join(words).encode()))

    def between(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        padded = text + bytes(8)
        eight = np.ndarray(len(text) + 1, "<u8", padded, strides=(1,))
        sizes = ends - starts
        out = sizes.astype(np.uint64) * _STEP
        at, live = 0, np.arange(len(sizes))
        while len(live) and at < self.LONG:
            left = sizes[live] - at
            mixed = (out[live] ^ (eight[starts[live] + at] & self.MASKS[np.minimum(left, 8)])) * _STEP
            out[live] = mixed ^ (mixed >> np.uint64(29))
            at, live = at + 8, live[left > 8]
        for k in live.tolist():
            out[k] = xxhash.xxh64_intdigest(text[starts[k]:ends[k]])
        return out


def bounds(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text, and where its words start and end; single blanks part them."""
    if not text:
        return text, np.zeros(0, np.int64), np.zeros(0, np.int64)
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return text, np.concatenate(([0], blanks + 1)), np.concatenate((blanks, [len(text)]))


def runs(hashes: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """anchor as signed long, first window's start, last window's start of the runs of windows with one anchor.

    ``hashes`` are the words of several texts in a row, ``sizes`` their numbers of words; starts count from the first
    word of all.
    """
    n = len(hashes) - ANCHOR + 1
    ends = np.repeat(np.cumsum(sizes), sizes)
    whole = np.flatnonzero(np.arange(len(hashes)) + window <= ends)
    if not len(whole):
        return np.zeros(0, np.int64), whole, whole
    mixed = np.zeros(n, np.uint64)
    for k in range(ANCHOR):
        mixed = (mixed + hashes[k:k + n]) * _STEP
        mixed ^= mixed >> np.uint64(31)
    # The leftmost least of ever longer stretches, up to a window's.
    least, place, span, inside = mixed, np.arange(n), 1, window - ANCHOR + 1
    while span < inside:
        step = min(span, inside - span)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        span += step
    place = place[whole]
    cuts = np.flatnonzero(np.diff(place)) + 1
    first, last = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(place)])) - 1
    return mixed[place[first]].view(np.int64), whole[first], whole[last]


def anchors(hashes: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """The runs of one text."""
    return list(zip(*(x.tolist() for x in runs(hashes, np.array([len(hashes)]), window)), strict=True))


class Letters(dict):
    """One character for each word, by order of appearance, so that a sequence of words is a short string."""

    UNKNOWN = "\0"

    def __missing__(self, word: str) -> str:
        n = len(self) + 1
        self[word] = letter = chr(n if n < 0xD800 else n + 0x800)  # no surrogates
        return letter


def compiled(least: dict[str, int]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for key, owner in least.items():
        automaton.add_word(key, owner)
    automaton.make_automaton()
    return automaton


def scan_part(segments: list[str], owners: list[int], window: int) -> list[list[int]]:
    """Least ids of the windows of each segment, by one automaton over the windows of all."""
    letter = Letters().__getitem__
    rows = ["".join(map(letter, s.split(" "))) for s in segments]
    least: dict[str, int] = {}
    get = least.get
    for row, owner in zip(rows, owners, strict=True):
        for k in range(len(row) - window + 1):
            key = row[k:k + window]
            if get(key, LAST) >= owner:
                least[key] = owner
    automaton = compiled(least)
    return [[owner for _, owner in automaton.iter(row)] for row in rows]


def scan_shard(frame: pd.DataFrame, window: int) -> pd.DataFrame:
    """Least ids of the windows of each segment of a shard. Equal windows have one anchor, so an automaton holds whole
    anchors, and a few more than ``PART_SEGMENTS`` segments: a small one stays in a processor's cache."""
    frame = frame.sort_values("anchor")
    anchor, segments, owners = frame["anchor"].to_numpy(), frame["segment"].tolist(), frame["least"].tolist()
    found, at = [], 0
    while at < len(anchor):
        end = int(np.searchsorted(anchor, anchor[min(at + PART_SEGMENTS, len(anchor)) - 1], "right"))
        found += scan_part(segments[at:end], owners[at:end], window)
        at = end
    return pd.DataFrame({"anchor": anchor, "segment_key": frame["segment_key"].to_numpy(), "owners": found})


def scan_split_shard(frame: pd.DataFrame, owned: pd.DataFrame, window: int) -> pd.DataFrame:
    """The windows of one shard, with their least ids, in each segment of ``frame``; the others are found elsewhere."""
    letters = Letters()
    automaton = compiled({
        "".join(map(letters.__getitem__, words.split(" "))): int(owner)
        for words, owner in zip(owned["words"], owned["least"], strict=True)})
    out = [(a, key, end - window + 1, owner)
           for a, key, s in zip(frame["anchor"], frame["segment_key"], frame["segment"], strict=True)
           for end, owner in automaton.iter("".join([letters.get(w, letters.UNKNOWN) for w in s.split(" ")]))]
    return pd.DataFrame(out, columns=["anchor", "segment_key", "at", "owner"])


def shard_scan(window: int):
    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        return scan_shard(frame, window)

    return scan


def split_shard_scan(window: int):
    def scan(frame: pd.DataFrame, owned: pd.DataFrame) -> pd.DataFrame:
        return scan_split_shard(frame, owned, window)

    return scan


def split_owners(segments: DataFrame, window: int, shard_segments: int) -> DataFrame:
    """anchor, segment_key, owners of segments whose anchors are too frequent for one shard."""
    words = F.split("segment", " ")
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)),
                          lambda k: F.array_join(F.slice(words, k, window), " "))
    least = written(segments.select("least", F.explode(windows).alias("words")).groupBy("words").agg(
        F.min("least").alias("least")), "passages-windows")
    shards = max(1, -(-least.count() // shard_segments))

    def shard_of(w):
        return F.pmod(F.xxhash64(w), F.lit(shards))

    asked = written(segments.select(
        "anchor", "segment_key", "segment",
        F.explode(F.array_distinct(F.transform(windows, shard_of))).alias("shard")), "passages-asked")
    parts = written(asked.groupBy("shard").agg(
        F.ceil(F.count("*") / shard_segments).alias("parts")), "passages-parts")
    asked = asked.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("segment_key"), F.col("parts"))).drop("parts")
    owned = least.withColumn("shard", shard_of(F.col("words"))).join(parts, "shard").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    found = asked.groupBy("shard", "part").cogroup(owned.groupBy("shard", "part")).applyInPandas(
        split_shard_scan(window), "anchor long, segment_key long, at long, owner long")
    return found.groupBy("anchor", "segment_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "owner"))), lambda x: x["owner"]).alias("owners"))


def slices(batches):
    for whole in batches:
        for at in range(0, whole.num_rows, common.ROWS_AT_ONCE):
            yield whole.slice(at, common.ROWS_AT_ONCE)


def batch_runs(batch, window: int):
    """The runs of all texts of a batch, the bounds of its words, and the row of each run."""
    sizes = batch["n_words"].to_numpy()
    found = bounds(b" ".join(t.encode() for t in batch["text"].to_pylist() if t))
    anchor, first, last = runs(WordHashes().between(*found), sizes, window)
    return anchor, first, last, found, np.searchsorted(np.cumsum(sizes), first, "right")


def repeated_spans(rows: DataFrame, window: int = WINDOW, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """rid, starts (of windows to remove) from rows (rid, id, text, n_words); rows without any are left out. The words of a
    text are parted by single blanks."""

    def named_anchors(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found, first, _, _, owner = batch_runs(batch, window)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [batch["rid"].take(pa.array(owner)), batch["id"].take(pa.array(owner)), pa.array(found)],
                    names=["rid", "id", "anchor"])

    named = rows.select("rid", "id", "text", "n_words").mapInArrow(named_anchors, "rid long, id long, anchor long")
    confirmed = written(named.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where(
        "a < b").select("anchor"), "passages-anchors")
    flagged = written(
        named.join(confirmed, "anchor").groupBy("rid").agg(F.collect_list("anchor").alias("flagged")),
        "passages-flagged")

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found, first, last, (text, starts, ends), owner = batch_runs(batch, window)
            wanted = np.flatnonzero(np.isin(found, batch["flagged"].flatten().to_numpy()))
            if len(wanted):
                found, first, last, owner = found[wanted], first[wanted], last[wanted], owner[wanted]
                segments = [text[a:b] for a, b in zip(
                    starts[first].tolist(), ends[last + window - 1].tolist(), strict=True)]
                keys = np.array([xxhash.xxh64_intdigest(s, 7) for s in segments], np.uint64) ^ np.uint64(1 << 63)
                own = pa.array(owner)
                begins = np.cumsum(sizes := batch["n_words"].to_numpy()) - sizes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(keys.view(np.int64)), pa.array(segments, pa.string()),
                     batch["rid"].take(own), batch["id"].take(own), pa.array(first - begins[owner])],
                    names=["anchor", "segment_key", "segment", "rid", "id", "first"])

    places = written(rows.select("rid", "id", "text", "n_words").join(flagged, "rid").mapInArrow(
        run, "anchor long, segment_key long, segment string, rid long, id long, first long"), "passages-places")
    segments = written(places.groupBy("anchor", "segment_key").agg(
        F.first("segment").alias("segment"), F.min("id").alias("least")), "passages-segments")
    frequent = written(segments.groupBy("anchor").count().where(F.col("count") > shard_segments).select(
        "anchor"), "passages-frequent")
    split = frequent.count() > 0
    rest = segments.join(frequent, "anchor", "left_anti") if split else segments
    shards = max(1, -(-segments.count() // shard_segments))
    owners = written(rest.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy(
        "shard").applyInPandas(shard_scan(window), "anchor long, segment_key long, owners array<long>"),
        "passages-owners")
    if split:
        owners = owners.union(written(split_owners(
            segments.join(frequent, "anchor", "left_semi"), window, shard_segments), "passages-split-owners"))
    starts = F.filter(F.transform("owners", lambda o, k: F.when(o < F.col("id"), F.col("first") + k)),
                      lambda x: x.isNotNull())
    hit = places.drop("segment").join(owners, ["anchor", "segment_key"]).select("rid", starts.alias("starts")).where(
        F.size("starts") > 0)
    return hit.groupBy("rid").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the words that stay, joined by one blank)."""

    def normal():
        # Bytes are split at the same white space as WORDS.
        return lambda texts: [(b" ".join(words), len(words)) for words in (t.encode().split() if t else [] for t in texts)]

    source = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
                         F.col(text).alias("text"))
    rows = written(
        common.map_rows(source, "text", ["own", "id"], "text string, n_words long", normal, number=True), "passages-rows")
    found = written(repeated_spans(rows, window, shard_segments), "passages-starts")
    joined = rows.join(found, "rid", "left").select("own", "n_words", "text", "starts")

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            removed, kept = [], []
            for text, starts in zip(batch["text"].to_pylist(), batch["starts"].to_pylist(), strict=True):
                if not starts:
                    removed.append(0)
                    kept.append(text)
                    continue
                words, gone, at_word, left = text.split(" "), 0, 0, []
                for a, b in merge([(s, s + window) for s in starts]):
                    left += words[at_word:a]
                    at_word, gone = b, gone + b - a
                removed.append(gone)
                kept.append(" ".join([*left, *words[at_word:]]))
            yield pa.RecordBatch.from_arrays(
                [batch["own"], batch["n_words"], pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[id_col, "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, f"`{id_col}` long, n_words long, n_removed long, kept string")


def op4_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(common.table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
