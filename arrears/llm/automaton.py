"""A generalised suffix automaton over sequences of word numbers, and what a stream needs from it."""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """All factors of several sequences. ``owners[s]``: sequences in which the factors of state ``s`` occur."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.owners: list[set[int]] = [set()]

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state for factors of ``q`` no longer than those ending in ``p`` and ``word``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int], owner: int) -> int:
        """Add a sequence; gives the state of the whole sequence."""
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
            else:
                new, p = self._state(self.length[last] + 1, 0, {}), last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            self.owners[last].add(owner)
        return last

    def spread_owners(self) -> None:
        """Pass owners on to shorter factors; call once, after the last sequence."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.owners[self.link[s]] |= self.owners[s]


class WindowMatcher:
    """Finds every window of the items in a stream: ``window`` words, or a whole item that is shorter.

    The automaton holds all items. At each word of the stream it gives the longest matching length; a window ends
    there if that length reaches it, and the state that covers the window's own length tells its items.
    """

    #: Length of the word runs looked up at once for a whole batch before the automaton walks what is left.
    RUN, TABLE_BITS = 4, 22

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window, self.ids, self.number, self.sam = window, [i for i, _ in items], {}, SuffixAutomaton()
        rows = [[self.number.setdefault(w, len(self.number) + 1) for w in words] for _, words in items]
        for k, row in enumerate(rows):
            self.sam.add(row, k)
        self.sam.spread_owners()
        self.marks: dict[int, list[tuple[int, int]]] = {}
        for k, row in enumerate(rows):
            if 0 < len(row) < window:
                state = 0
                for w in row:
                    state = self.sam.next[state][w]
                self.marks.setdefault(state, []).append((len(row), k))
        self.found: dict[int, tuple[frozenset, list]] = {}
        self.shortest = min([min(len(r), window) for r in rows if r], default=window)
        self.run = min(self.RUN, self.shortest)
        self.table = np.zeros(1 << self.TABLE_BITS, bool)
        for row in rows:
            if row:
                self.table[self._runs(np.array(row, np.uint64))] = True

    def _runs(self, words: np.ndarray) -> np.ndarray:
        """A table slot for each run of ``run`` words; its first word's place is the index."""
        n = len(words) - self.run + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        mixed = np.zeros(n, np.uint64)
        for k in range(self.run):
            mixed = (mixed + words[k:k + n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)

    def _ends_at(self, state: int) -> tuple[frozenset, list]:
        """Items that own the window ending here, and (length, item) of short items ending here."""
        got = self.found.get(state)
        if got is None:
            owners: frozenset = frozenset()
            short, s = [], state
            while s > 0:
                short += self.marks.get(s, [])
                if self.sam.length[s] >= self.window > self.sam.length[self.sam.link[s]]:
                    owners = frozenset(self.sam.owners[s])
                s = self.sam.link[s]
            got = self.found[state] = (owners, short)
        return got

    def walk(self, words: list[int], shift: int, spans: list[tuple[int, int]], items: set[int]) -> None:
        """Add the spans (end exclusive, from ``shift``) and items of all windows that occur in ``words``."""
        state, length, sam = 0, 0, self.sam
        for at, word in enumerate(words, shift + 1):
            while state >= 0 and word not in sam.next[state]:
                state = sam.link[state]
                length = sam.length[state] if state >= 0 else 0
            if state < 0:
                state = 0
                continue
            state, length = sam.next[state][word], length + 1
            if length < self.shortest:
                continue
            owners, short = self._ends_at(state)
            if length >= self.window:
                spans.append((at - self.window, at))
                items |= owners
            for size, k in short:
                if size <= length:
                    spans.append((at - size, at))
                    items.add(k)

    def match(self, texts: list[list[str]]) -> list[tuple[list[tuple[int, int]], list[str]]]:
        """Per text (its words): merged spans of hit words, and ids of the items found."""
        get = self.number.get
        rows = [[get(w, 0) for w in words] for words in texts]
        flat = np.array([x for row in rows for x in (*row, 0)], np.uint64)
        starts = np.cumsum([0, *(len(r) + 1 for r in rows)])
        hits = np.flatnonzero(self.table[self._runs(flat)])
        out: list[tuple[list, set]] = [([], set()) for _ in rows]
        if len(hits):
            # Runs that overlap or touch make one stretch; each window that occurs lies inside one.
            for part in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
                first, end = int(part[0]), int(part[-1]) + self.run
                if end - first < self.shortest:
                    continue
                k = int(np.searchsorted(starts, first, "right")) - 1
                while k < len(rows) and starts[k] < end:
                    a, b = max(first, int(starts[k])) - int(starts[k]), min(end - int(starts[k]), len(rows[k]))
                    if b - a >= self.shortest:
                        self.walk(rows[k][a:b], a, *out[k])
                    k += 1
        return [(merge(spans), [self.ids[i] for i in sorted(found)]) for spans, found in out]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
