"""Noisy-channel restoring of disguised words: a lattice of readings per token, decoded under a character model.

The model is a trigram model over blank, a to z and "any other letter". A token is a lattice: a letter reads as
itself, a look-alike as the letters it stands for, a run of one letter as one or two of them, a separator inside a
word as nothing. Viterbi decoding gives the likeliest reading.
"""

from __future__ import annotations

import math
import re
from itertools import groupby

import numpy as np

#: Letters that digits and signs commonly stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = "._-*~'/"
SYMBOLS = 28
SUBSTITUTE, SKIP, ONE_OF_RUN, TWO_OF_RUN, TWO_OF_PAIR, NEW_WORD = -1.0, -0.5, -0.3, -1.0, -0.05, -2.0
EDGE = ".,;:!?()[]{}\"'«»¿¡…-_*"
#: Letters written apart: four or more single signs with one separator or blank between them.
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!|+])(?:[ ._\-*](?:[^\W_]|[@$!|+])){3,}(?!\S)")
TRIPLE = re.compile(r"(.)\1\1", re.DOTALL)
_CODES = np.full(256, 0, np.uint8)
_CODES[97:123] = np.arange(1, 27)
_CODES[192:256] = 27
_CODES[63] = 0


def code(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of all trigrams of the texts (lower case), as a flat array."""
    raw = ("  ".join(texts) + "  ").lower().encode("latin-1", "replace")
    codes = _CODES[np.frombuffer(raw, np.uint8)].astype(np.int32)
    return np.bincount(
        (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS ** 3)


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log chance of a symbol after two others, smoothed with the chance after one."""
    tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    bi = tri.sum(0) + 0.1
    bi /= bi.sum(1, keepdims=True)
    return np.log((tri + 4 * bi) / (tri.sum(2, keepdims=True) + 4))


def disguised(token: str) -> bool:
    """Whether a lower-case token may hide a word: look-alikes or separators among letters, or a run of three."""
    if token.isalpha():
        return TRIPLE.search(token) is not None
    return any(map(str.isalpha, token)) and all(
        ch.isalpha() or ch in LOOKALIKES or ch in SEPARATORS for ch in token)


def decode(token: str, model: list, spaced: bool = False) -> str:
    """The likeliest reading of a lower-case token; ``spaced`` tokens may hold several words."""
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for ch, run in groupby(token):
        n = sum(1 for _ in run)
        if ch in SEPARATORS or ch == " ":
            options = [("", SKIP)]
        else:
            reads = [(ch, 0.0)] if ch.isalpha() else [(x, SUBSTITUTE) for x in LOOKALIKES.get(ch, "")]
            if n == 1:
                options = reads
            else:
                double = TWO_OF_PAIR if n == 2 else TWO_OF_RUN
                options = [(x, c + ONE_OF_RUN * (n > 1)) for x, c in reads] + [(x * 2, c + double) for x, c in reads]
            if spaced:
                options = options + [(" " + x, c + NEW_WORD) for x, c in options]
        if not options:
            options = [(" ", 0.0)]
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, back) in paths.items():
            for text, cost in options:
                p, q, s, tail = a, b, score + cost, back
                for x in text:
                    c = code(x)
                    s += model[p][q][c]
                    p, q, tail = q, c, (x, tail)
                if (p, q) not in after or s > after[p, q][0]:
                    after[p, q] = (s, tail)
        paths = after
    _, tail = max(((s + model[a][b][0], t) for (a, b), (s, t) in paths.items()), key=lambda x: x[0])
    out = []
    while tail:
        out.append(tail[0])
        tail = tail[1]
    return "".join(reversed(out))


class Restorer:
    """Distinct restored words of a text, each mapped by ``value``; what a token gives is kept in a bounded cache.

    ``value`` gives a word's entry or None for words of no interest, so that most tokens cost one lookup.
    """

    CACHED = 300_000

    def __init__(self, model: np.ndarray, value=lambda word: True):
        self.model, self.value, self.cache = model.tolist(), value, {}

    def valued(self, words) -> dict:
        return {w: v for w in words for v in [self.value(w)] if v is not None}

    def read(self, raw: str) -> dict:
        plain = raw.strip(EDGE)
        if plain and disguised(plain):
            return self.valued([plain, *decode(plain, self.model).split()])
        return self.valued([plain]) if plain else {}

    def words(self, text: str | None) -> dict:
        if not text:
            return {}
        low, out, cache = text.lower(), {}, self.cache
        if len(cache) > self.CACHED:
            cache.clear()
        for raw in set(low.split()):
            got = cache.get(raw)
            if got is None:
                got = self.read(raw)
                if len(raw) <= 40:
                    cache[raw] = got or _NOTHING
            if got:
                out.update(got)
        for m in SPACED.finditer(low):
            out.update(self.valued(decode(m.group(), self.model, spaced=True).split()))
        return out


#: One object for all tokens of no interest.
_NOTHING: dict = {}


def chance(x: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))
