"""Operator 1: personal data by bootstrapped contextual extraction.

Base entities (email, ip, card, phone by fixed patterns) are the seeds. The word before a seed, the shape of the seed
and both together are its lexical patterns; the same patterns also cover identifiers that no fixed pattern knows
(candidates). Spark scores the graph of patterns and instances, kind by kind, for a fixed number of rounds: a pattern is
trusted by the mean confidence of its distinct instances, weakened by a prior that counts as one wrong instance; an
instance is trusted if any of its patterns is right (noisy or), and so hands the kind on to its other patterns in the
next round. A context or a shape alone takes part in that once it is trusted itself. Candidates under patterns of high confidence become entities of the pattern's kind.

A card number with a wrong check digit and an address with a part over 255 are wrong instances of their patterns and are
never found. Of candidates inside one another only the outermost counts.

Texts are read once. Base spans and candidates are written with a row number, so that scoring never reads texts
again; the graph's edges are counted before they are shuffled, one row per distinct (pattern, instance).

Null texts are empty. Repeated documents and null ids give a row each and take part in the graph once per instance.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common

#: The four kinds, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same email, found from its "@": the part before it is a run of name characters, so no scan is repeated.
NAME_RUN = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A candidate: a token of at least six signs with a digit or "@" in it, or digits grouped by blanks, brackets and signs.
CANDIDATE = re.compile(r"[^\s,;|<>\"'()\[\]{}]{6,}")
GROUPED = re.compile(r"(?<![\w@.%+-])\+?\(?[0-9]++(?:[\x20()./-]{1,3}[0-9]++)++(?![^\W_])")
MOST_DIGITS = 32
CONTEXT_WORD = re.compile(r"[^\W\d_]+[:=#.]?|[:=#]")
#: Kind of a candidate that a fixed pattern took for its own and then refused.
WRONG = "wrong"
ROUNDS, TRUST, PRIOR, SEED_SHARE = 3, 0.8, 1.0, 3
SPAN = "struct<kind: string, start: long, end: long>"
CANDIDATES = "array<struct<word: string, shape: string, instance: string, kind: string, start: long, end: long>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of the email pattern, in time linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and NAME_RUN.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def matches(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """The fixed patterns' entities by kind, then start; and the matches that failed the test of their kind.

    A number of another length than a card's or a phone's is no failed one: its context may still tell what it is."""
    out, failed = [("email", a, b) for a, b in emails(text)], []
    for m in PATTERNS["ip"].finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
        else:
            failed.append(m.span())
    for m in PATTERNS["card"].finditer(text):
        digits = re.sub(r"[ -]", "", m.group())
        if 13 <= len(digits) <= 19:
            if luhn(digits):
                out.append(("card", *m.span()))
            else:
                failed.append(m.span())
    for m in PATTERNS["phone"].finditer(text):
        if 9 <= sum("0" <= ch <= "9" for ch in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out, sorted(failed)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return matches(text)[0]


def shape(token: str) -> str:
    """Letters and digits as classes, runs joined: the form of an identifier."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", token)))[:24]


def context(text: str, start: int) -> str:
    """The last word (with its sign) among the 32 characters before a place, in lower case."""
    before = CONTEXT_WORD.findall(text[max(0, start - 32):start])
    return before[-1].lower() if before else ""


def candidates(text: str) -> list[tuple[int, int]]:
    out = set()
    for m in CANDIDATE.finditer(text):
        token = m.group().rstrip(".:!?")
        if len(token) >= 6 and any(ch.isdigit() or ch == "@" for ch in token):
            out.add((m.start(), m.start() + len(token)))
    for m in GROUPED.finditer(text):
        if 6 <= sum("0" <= ch <= "9" for ch in m.group()) <= MOST_DIGITS:
            out.add(m.span())
    return sorted(out)


def outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that lie in no other one; a candidate inside another is a piece of it."""
    whole, done = [], 0
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b > done:
            whole.append((a, b))
            done = b
    return whole


def occurrences(text: str, spans: list[tuple[str, int, int]], failed: list[tuple[int, int]]) -> list[dict]:
    """Seeds and candidates with context and shape; the instance is a digest, so no identifier is written.

    A candidate that touches a failed match has the kind ``WRONG``: it speaks against its patterns and is never found.
    """
    out = []

    def note(kind: str | None, a: int, b: int) -> None:
        token = text[a:b]
        out.append({"word": context(text, a), "shape": shape(token), "kind": kind, "start": a, "end": b,
                    "instance": hashlib.blake2b(token.encode(), digest_size=8).hexdigest()})

    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    for kind, a, b in spans:
        note(kind, a, b)
    starts = [a for a, _ in taken]
    no_starts, no_ends = [a for a, _ in failed], list(accumulate((b for _, b in failed), max))
    for a, b in outermost(candidates(text)):
        k = bisect_left(starts, b) - 1
        if k < 0 or taken[k][1] <= a:
            j = bisect_left(no_starts, b) - 1
            note(WRONG if j >= 0 and no_ends[j] > a else None, a, b)
    return out


def with_patterns(seen: DataFrame) -> DataFrame:
    """One row per occurrence and pattern: its shape, its context, and both. Without context only the shape is one."""
    shape = F.concat(F.lit("shape "), "shape")
    word, both = F.concat(F.lit("word "), "word"), F.concat(F.lit("both "), "word", F.lit(" "), "shape")
    return seen.withColumn("pattern", F.explode(F.when(F.col("word") == "", F.array(shape)).otherwise(
        F.array(shape, word, both)))).drop("word", "shape")


def scored_patterns(edges: DataFrame, rounds: int = ROUNDS, trust: float = TRUST) -> DataFrame:
    """pattern, found (its kind), confidence of the patterns that reach ``trust``, from edges (pattern, instance, kind
    or null).

    Every round is written. The graph has one edge per distinct pair; confidences travel along its edges kind by kind
    in two aggregations, and no list of a node's neighbours is ever built. A pattern needs the trust of ``SEED_SHARE``
    instances in all, seeds or found in an earlier round.
    """
    # An instance that is a seed anywhere is that kind; one refused anywhere else counts against its patterns.
    known = F.max(F.when(F.col("kind") != WRONG, F.col("kind")))
    edges = common.written(edges.groupBy("pattern", "instance").agg(
        F.coalesce(known, F.max("kind")).alias("kind")), "pii-edges")
    sizes = common.written(edges.groupBy("pattern").agg(F.count("*").alias("n")), "pii-sizes")
    seeds = common.written(edges.where(F.col("kind") != WRONG).groupBy("instance").agg(F.max("kind").alias("kind")).select(
        "instance", "kind", F.lit(1.0).alias("trust")), "pii-seeds")
    edges = edges.where(~F.col("kind").eqNullSafe(WRONG)).select("pattern", "instance")
    state = seeds
    for k in range(rounds):
        scored = common.written(edges.join(state, "instance").groupBy("pattern", "kind").agg(
            F.sum("trust").alias("total")).join(sizes, "pattern").select(
            "pattern", "kind", (F.col("total") / (F.col("n") + F.lit(PRIOR))).alias("confidence"),
            (F.col("total") >= SEED_SHARE * (1.0 if k == 0 else trust)).alias("shared")), "pii-patterns")
        patterns = scored.where(F.col("shared") & (F.col("confidence") >= trust)).drop("shared")
        if k + 1 < rounds:
            handing = scored.where(F.col("pattern").startswith("both ") | F.col("shared") & (
                F.col("confidence") >= trust))
            found = edges.join(handing, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(
                F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("trust"))
            state = common.written(seeds.union(found.join(seeds, "instance", "left_anti").select(
                "instance", "kind", "trust")), "pii-instances")
    return patterns.groupBy("pattern").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("found"),
                                           F.max("confidence").alias("confidence"))


def trusted_patterns(edges: DataFrame, rounds: int = ROUNDS, trust: float = TRUST) -> DataFrame:
    """pattern, found (its kind): patterns whose confidence reaches ``trust``."""
    return scored_patterns(edges, rounds, trust).select("pattern", "found")


def extract(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: id (and ``keep``), base and added (arrays of kind, start, end; end exclusive, in code points)."""
    keep = list(dict.fromkeys([id_col, *(keep or [])]))

    def factory():
        def work(texts: list) -> list[tuple]:
            rows = []
            for t in texts:
                spans, failed = matches(t or "")
                rows.append(([{"kind": k, "start": a, "end": b} for k, a, b in spans],
                             occurrences(t, spans, failed) if t else []))
            return rows

        return work

    rows = common.written(common.map_rows(
        docs, text, keep, f"base array<{SPAN}>, seen {CANDIDATES}", factory, number=True), "pii-rows")
    seen = rows.select("rid", F.explode("seen").alias("s")).select("rid", "s.*")
    patterns = common.written(scored_patterns(with_patterns(seen).select("pattern", "instance", "kind")), "pii-trusted")
    met = with_patterns(seen.where("kind is null").select("rid", "start", "end", "word", "shape")).join(
        patterns, "pattern").groupBy("rid", "start", "end").agg(
        F.max_by("found", F.struct("confidence", "found")).alias("kind"))
    added = met.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    return rows.drop("seen", "part").join(added, "rid", "left").withColumn(
        "added", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)")))


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def by_kind(spans: Column) -> Column:
    """Spans in the order of the kinds, then of their starts."""
    order = F.array(*map(F.lit, KINDS))
    ranked = F.transform(spans, lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind")))
    return F.transform(F.array_sort(ranked), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    whole = found.withColumn("whole", by_kind(F.concat("base", "added")))
    return whole.select(id_col, *map(count, KINDS), F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("whole").alias("spans"))


def op1_bootstrap_pii(spark: SparkSession, folder: str) -> DataFrame:
    return report(extract(common.table(spark, folder, "documents")))
