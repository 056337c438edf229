"""Operator 9: license scans by an exact set-similarity join.

The left side are a few license templates (a parameter), the right side the overlapping blocks of every document: all
runs of as many consecutive words as the template has, divided by ``threshold``, over the whole text, so that line
breaks neither hide nor widen a block. A block meets a template if it holds at least ``threshold`` of the template's
distinct words. Template words are ordered by their frequency over all documents, rarest first. A block that meets a
template of n words must share at least ``need = ceil(threshold * n)`` of them, hence one of the first ``n - need + 1``
(prefix filter), have ``need`` distinct words itself (length filter), and at the place of the first shared word still
have enough template words left (positional filter). What passes is verified exactly. Documents are not shuffled;
templates are broadcast, and their number and length are checked.

Templates of two labels that differ in so few words that the text of one meets the other are rivals. Where blocks of
both overlap, the one that holds the larger share of its template is kept, or that with more words; if a text has no
word that decides between them, both are.

Base labels are places where a phrase's words stand one after the other. Null texts have no words; repeated documents
and null ids give a row each.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
#: Phrases whose places are counted, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices looked for as templates, with their labels.
TEMPLATES = {
    "mit": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person"],
    "apache-2": ["Licensed under the Apache License, Version 2.0"],
    "gpl-3": ["This work is licensed under the GNU General Public License, version 3"],
    "gpl-2": ["This work is licensed under the GNU General Public License, version 2"],
    "cc-by-nc": ["This content is available under CC BY-NC 4.0"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "all-rights-reserved": ["Copyright, all rights reserved", "All rights reserved"],
}
THRESHOLD = 0.8
#: Most template words that may be broadcast.
MOST_WORDS = 1_000_000


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.translate(LOWER)) if text else []


def template_frequencies(docs: DataFrame, vocabulary: frozenset, text: str = "text") -> dict[str, int]:
    """In how many lines of all documents each template word stands."""

    def factory():
        seen: Counter = Counter()

        def add(texts: list) -> None:
            for t in texts:
                for line in (t or "").split("\n"):
                    seen.update(vocabulary.intersection(words_of(line)))

        return add, lambda: list(seen.items())

    rows = common.summarise(docs, text, "word string, n long", factory).groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in rows.collect()}


class TemplateJoin:
    """The templates' side of the join: sorted words, and an index of their prefixes."""

    def __init__(self, templates: dict[str, list[str]], frequency: dict[str, int], threshold: float):
        self.sets, self.prefix, self.width = [], {}, []
        for label, texts in templates.items():
            for t in texts:
                listed = words_of(t)
                ordered = sorted(set(listed), key=lambda w: (frequency.get(w, 0), w))
                if not ordered:
                    continue
                need = ceil(threshold * len(ordered) - 1e-9)
                for place, w in enumerate(ordered[:len(ordered) - need + 1]):
                    self.prefix.setdefault(w, []).append((len(self.sets), place))
                self.sets.append((label, frozenset(ordered), need))
                self.width.append(max(len(listed), ceil(len(listed) / threshold - 1e-9)))
        self.rare = frozenset(self.prefix)
        self.rivals = [[a for a, (other, theirs, _) in enumerate(self.sets)
                        if other != label and len(theirs & mine) >= need] for label, mine, need in self.sets]

    def held(self, block: set[str]) -> list[tuple[int, int]]:
        """The templates that the block meets, with the number of their words that it holds."""
        out = []
        first: dict[int, int] = {}
        for w in self.rare & block:
            for k, place in self.prefix[w]:
                first[k] = min(first.get(k, place), place)
        for k, place in first.items():
            _, words, need = self.sets[k]
            if len(block) >= need and len(words) - place >= need:
                shared = len(words & block)
                if shared >= need:
                    out.append((k, shared))
        return out

    def best(self, block: set[str]) -> dict[str, float]:
        """Labels of the templates that the block meets, with the share of the template it holds."""
        out: dict[str, float] = {}
        for k, shared in self.held(block):
            label, words, _ = self.sets[k]
            out[label] = max(out.get(label, 0.0), shared / len(words))
        return out

    def blocks(self, k: int, words: list[str], low: int, high: int) -> list[list[int]]:
        """[start, end, most template words in one block] of the overlapping blocks that meet template k."""
        _, wanted, need = self.sets[k]
        out: list[list[int]] = []
        inside: deque = deque()
        count: Counter = Counter()
        distinct = 0
        for at in range(low, high):
            if words[at] not in wanted:
                continue
            inside.append(at)
            count[words[at]] += 1
            distinct += count[words[at]] == 1
            while inside[0] <= at - self.width[k]:
                gone = words[inside.popleft()]
                count[gone] -= 1
                distinct -= count[gone] == 0
            if distinct >= need:
                if out and inside[0] < out[-1][1]:
                    out[-1][1:] = [at + 1, max(out[-1][2], distinct)]
                else:
                    out.append([inside[0], at + 1, distinct])
        return out

    def scan(self, words: list[str]) -> dict[str, float]:
        """Labels of the templates that some block of a text meets, without those that lose to a rival there."""
        reach, regions = max(self.width, default=0), []
        for at in [k for k, w in enumerate(words) if w in self.rare]:
            low, high = max(0, at - reach + 1), min(len(words), at + reach)
            if regions and low <= regions[-1][1]:
                regions[-1][1] = high
            else:
                regions.append([low, high])
        found: dict[int, list[tuple[int, int, tuple[float, int]]]] = {}
        for low, high in regions:
            for k, _ in self.held(set(words[low:high])):
                found.setdefault(k, []).extend((start, end, (shared / len(self.sets[k][1]), shared))
                                               for start, end, shared in self.blocks(k, words, low, high))
        out: dict[str, float] = {}
        for k, places in found.items():
            label = self.sets[k][0]
            rivals = sorted(place for a in self.rivals[k] for place in found.get(a, []))
            for (_, _, held), met in zip(places, overlapping(places, rivals), strict=True):
                if all(other <= held for other in met):
                    out[label] = max(out.get(label, 0.0), held[0])
        return out


def overlapping(places: list[tuple], others: list[tuple]) -> list[list[tuple[float, int]]]:
    """For each place (start, end, held), in order of start, what the overlapping others hold."""
    out, active, k = [], [], 0
    for start, end, _ in places:
        while k < len(others) and others[k][0] < end:
            active.append(others[k])
            k += 1
        active = [o for o in active if o[1] > start]
        out.append([o[2] for o in active])
    return out


def phrase_places(words: list[str], phrases: list[tuple[list[str], str]]) -> list[tuple[int, str]]:
    out = []
    for phrase, label in phrases:
        at = -1
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if words[at:at + len(phrase)] == phrase:
                out.append((at, label))
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    vocabulary = frozenset(w for texts in templates.values() for t in texts for w in words_of(t))
    if sum(len(words_of(t)) for texts in templates.values() for t in texts) > MOST_WORDS:
        raise ValueError("too many template words to broadcast; scan in several passes")
    context = docs.sparkSession.sparkContext
    frequency = context.broadcast(template_frequencies(docs, vocabulary, text))
    listed = [(words_of(p), label) for p, label in phrases.items()]

    def factory():
        join = TemplateJoin(templates, frequency.value, threshold)

        def one(t: str | None) -> tuple:
            met: dict[str, float] = {}
            # A phrase or notice may run over a line break, so both are looked for in the text as a whole.
            words = words_of(t)
            n = len(words)
            if not join.rare.isdisjoint(words):
                met = join.scan(words)
            places = phrase_places(words, listed) if n else []
            base = {label for _, label in places}
            starts = [at for at, _ in places]
            return (n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | set(met))), 1.0 if base else max(met.values(), default=0.0))

        return lambda texts: [one(t) for t in texts]

    return common.map_rows(
        docs, text, [id_col], "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double", factory)


def op9_license_join(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(common.table(spark, folder, "documents"))
