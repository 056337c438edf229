"""Byte-level BPE of whole texts, and of their units through caches.

The vocabulary file is the library's. Where every token of the file is what its own merges make of it, merging by the
order of the ids gives the library's ids (``by_rank``; checked for all tokens on the driver), and a faster encoder that
merges so takes texts of ordinary characters. Other texts, and other vocabularies, go to the library itself.

The pre-tokeniser never joins a non-space character to the space after it, so a text falls into units (spaces and
line breaks with the run of other characters behind them) whose tokens do not depend on their surroundings. Texts
with other white space, or with a special token's string, are not cut into units.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

UNITS = re.compile(r"[ \n]+[^ \n]*|[^ \n]+")
#: White space other than blank and line feed, and format characters next to it.
ODD_SPACE = r"\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
#: Characters of later blocks, whose classes may differ between the libraries, and white space they may not get through.
UNUSUAL, LONG_GAP = r"\u0250-\U0010ffff", re.compile(r"[ \n]{1000}")
#: Fixed value: the pre-tokeniser of the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_SETTINGS = {"normalizer": None, "post_processor": None, "pre_tokenizer": {
    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
#: Units longer than this are encoded each time; with CACHED it bounds a worker's cache.
LONGEST_CACHED, CACHED = 48, 300_000


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _stored(path: str) -> tuple[dict, dict[str, int]]:
    """The vocabulary file, and its tokens without the special ones."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    special = {t["content"] for t in whole["added_tokens"]}
    return whole, {t: i for t, i in whole["model"]["vocab"].items() if t not in special}


@lru_cache(maxsize=4)
def by_rank(path: str) -> bool:
    """Whether ids are in the order of the merges and every token is what the merges make of its own characters."""
    whole, vocab = _stored(path)
    model = whole["model"]
    if model["type"] != "BPE" or any(whole[k] != v for k, v in PLAIN_SETTINGS.items()) or model.get("dropout"):
        return False
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    if any(x >= y for x, y in zip([-1, *made], made, strict=False)):
        return False
    rank = {m: k for k, m in enumerate(merges)}

    def whole_token(token: str) -> bool:
        parts = list(token)
        while len(parts) > 1:
            k = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            if (parts[k], parts[k + 1]) not in rank:
                return False
            parts[k:k + 2] = ["".join(parts[k:k + 2])]
        return True

    return all(map(whole_token, vocab))


@lru_cache(maxsize=4)
def _ranked(path: str):
    import tiktoken

    # The byte alphabet: printable Latin-1 bytes stand for themselves, the others follow from code point 256 on.
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {bytes(byte[ch] for ch in token): i for token, i in _stored(path)[1].items()}
    return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts as the library gives them; ``ranked`` is what ``by_rank`` says of the vocabulary."""

    def __init__(self, path: str, ranked: bool):
        self.tokenizer = library(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([f"[{ODD_SPACE}]", *map(re.escape, self.special)]))
        self.odd = re.compile(f"[{ODD_SPACE}{UNUSUAL}]")
        self.fast = _ranked(path).encode_ordinary if ranked else None

    def slow(self, text: str) -> bool:
        """Whether the text is left to the library. One character class is searched faster than alternatives; a long gap
        has two equal characters side by side or all three of the last pattern."""
        if self.odd.search(text) or any(token in text for token in self.special):
            return True
        return any(pair in text for pair in ("  ", "\n\n", " \n ")) and LONG_GAP.search(text) is not None

    def ids(self, text: str) -> list[int]:
        if self.fast and not self.slow(text):
            return self.fast(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Units(Encoder):
    """Token counts of units: a fixed first tier, then a bounded cache in the worker, then the encoder."""

    def __init__(self, path: str, ranked: bool, first: dict | None = None):
        super().__init__(path, ranked)
        self.first, self.cache = first or {}, {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.whole.search(text):
            return len(self.ids(text))
        units, first, cache = UNITS.findall(text), self.first, self.cache
        out = list(map(first.get, units))
        for k, got in enumerate(out):
            if got is None:
                u = units[k]
                got = cache.get(u)
                if got is None:
                    got = len(self.ids(u))
                    if len(u) <= LONGEST_CACHED:
                        if len(cache) >= CACHED:
                            cache.clear()
                        cache[u] = got
                out[k] = got
        return sum(out)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    got = array("I", ids)
    if array("H", [1]).tobytes()[0] != 1:
        got.byteswap()
    return got.tobytes()
