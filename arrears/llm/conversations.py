"""Operator 11: repair of conversation structure by a shortest path with big-integer weights.

The rows of a conversation, in order, and the roles a repaired conversation may have (an optional system turn, then
user and assistant in turn) span a small graph: a node is a row and a state of the role pattern, an edge is an edit. The
weight of a path is one integer. Its high digits are the cost; its low digits, as many as any path of the block can
need, hold the letters of the edits from the left, with zeros behind the last one. Less cost is a smaller integer; equal
costs compare as the letters do, and a path that ends earlier is smaller as zero is less than every letter. So the
ordinary minimum of integers decides cost and ties alike. Paths are built from their end: an edit in front moves the
letters one place down and takes the first place.

Nothing depends on a conversation fitting into one task. Rows are numbered by a range sort of narrow columns, cut into
blocks of ``BLOCK`` rows, and a block is solved for every state it may begin and end in. Such solutions are joined like
the blocks themselves (state by state, letters behind letters), many at a time, until one is left. The edits then go
back to the rows by key. Only the digest of a repaired conversation is one stream by nature: it reads one row per block,
in order and batch by batch.

Two inserts in a row before a row, or at the end, are the most that can pay: a third would lead back to a state that one
insert reaches.

Nulls count as one blank, in any column. Rows of equal turn are ordered by role, then by the digest of their text, so
results never depend on the order of the files; exact repeats are repeats. A null id is a conversation of its own. An
empty table gives an empty result; columns beyond the four are ignored and cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common
from arrears.operators.ranks import number_rows

BLOCK = 256
#: Solutions joined at once, for conversations of more than one block.
FAN = 32
BLANKS = r"[\x20\x09-\x0D]"

# --- Fixed values: edits and their costs ----------------------------------------------------------------------------
LETTERS = "DIKR"  # rising ASCII order, so that digits compare as letters do
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
DIGIT = 3  # bits of one letter

# States of the role pattern: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT_ROLE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # what an inserted or re-roled turn must be
AFTER = {"u": USER, "a": ASSISTANT}
ACCEPTED = (START, ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")


def after_keep(state: int, role: str) -> int | None:
    if state == START and role == "s":
        return SYSTEM
    return AFTER[role] if role == NEXT_ROLE[state] else None


# A row is one letter: its role (system, user, assistant, other) and whether it is fine, truncated or must go.
ROLES, KINDS = "suao", 3
FINE, CUT, GONE = range(KINDS)


def row_code(role: int, kind: int) -> str:
    return chr(ord("a") + role * KINDS + kind)


def read_code(code: str) -> tuple[str, int]:
    role, kind = divmod(ord(code) - ord("a"), KINDS)
    return ROLES[role], kind


class Weights:
    """Integer weights of paths with at most ``width`` letters."""

    def __init__(self, width: int):
        self.low = width * DIGIT
        self.mask = (1 << self.low) - 1

    def before(self, letter: int, cost: int, rest: int) -> int:
        """Weight of an edit and the path behind it."""
        return (((rest >> self.low) + cost) << self.low) | (letter << (self.low - DIGIT)) | ((rest & self.mask) >> DIGIT)

    def letters(self, weight: int) -> list[int]:
        places = f"{weight & self.mask:0{self.low // DIGIT}o}"  # a letter is one octal digit
        return [int(digit) for digit in places.rstrip("0")]

    def length(self, weight: int) -> int:
        """Letters of a weight: all places but the zeros at its end."""
        low = weight & self.mask
        if not low:
            return 0
        zeros = (low & -low).bit_length() - 1
        return self.low // DIGIT - zeros // DIGIT


def width_of(rows: int) -> int:
    """Letters that a path over so many rows can have: two inserts and an edit for each, and two inserts at the end."""
    return 3 * rows + 2


def with_inserts(weights: Weights, best: list[int | None]) -> list[int | None]:
    """Least weight from each state when up to two inserts may come first."""
    for _ in range(2):
        best = [least(best[s], None if (rest := best[AFTER[NEXT_ROLE[s]]]) is None
                      else weights.before(INSERT, COSTS[INSERT], rest)) for s in STATES]
    return best


def least(*found: int | None) -> int | None:
    return min((f for f in found if f is not None), default=None)


def solve(codes: str, ends: tuple[int, ...], last: bool) -> list[int | None]:
    """Least weight over the rows from each state to one of ``ends``; behind the ``last`` row inserts may follow."""
    weights = Weights(width_of(len(codes)))
    best: list[int | None] = [0 if s in ends else None for s in STATES]
    if last:
        best = with_inserts(weights, best)
    for code in reversed(codes):
        role, kind = read_code(code)
        extra = TRUNCATED_COST if kind == CUT else 0
        here = []
        for s in STATES:
            edits = [(DELETE, s, COSTS[DELETE])]
            if kind != GONE:
                edits.append((REROLE, AFTER[NEXT_ROLE[s]], COSTS[REROLE] + extra))
                if (kept := after_keep(s, role)) is not None:
                    edits.append((KEEP, kept, COSTS[KEEP] + extra))
            here.append(least(*(weights.before(letter, cost, best[to]) for letter, to, cost in edits
                                if best[to] is not None)))
        best = with_inserts(weights, here)
    return best


def table_of(codes: str, last: bool) -> list[int | None]:
    """Solutions of a block from each state (rows) to each state (columns); the last block ends in column 0 alone."""
    if last:
        found = [solve(codes, ACCEPTED, True), *[[None] * 4] * 3]
    else:
        found = [solve(codes, (end,), False) for end in STATES]
    return [found[end][begin] for begin in STATES for end in STATES]


def chain(left: list[int | None], left_rows: int, right: list[int | None], right_rows: int) -> list[int | None]:
    """Solutions of two neighbouring blocks as one, of ``width_of`` both together.

    Equal costs of the left block never differ by inserts at its end alone (these would cost more), so its letters
    decide before the right block's do, however long they are.
    """
    a, b, both = (Weights(width_of(n)) for n in (left_rows, right_rows, left_rows + right_rows))

    def put(x: int, y: int) -> int:
        cost = (x >> a.low) + (y >> b.low)
        first = (x & a.mask) << (both.low - a.low)
        # The right block's letters begin right behind the left block's last one.
        shift = both.low - b.low - a.length(x) * DIGIT
        second = y & b.mask
        return (cost << both.low) | first | (second << shift if shift >= 0 else second >> -shift)

    out = []
    for begin in STATES:
        for end in STATES:
            out.append(least(*(put(x, y) for mid in STATES
                               if (x := left[4 * begin + mid]) is not None
                               and (y := right[4 * mid + end]) is not None)))
    return out


def plan_of(codes: str, weight: int) -> tuple[str, int, list[str]]:
    """Audit letters, cost, and one token per row.

    A token holds K (keep), D (delete), U or A (re-role to user or assistant), with u or a for each turn inserted before
    it; inserts behind the last row end its token.
    """
    weights = Weights(width_of(len(codes)))
    letters = weights.letters(weight)
    tokens, open_token, state, row = [], "", START, 0
    for letter in letters:
        if letter == INSERT:
            open_token += NEXT_ROLE[state]
            state = AFTER[NEXT_ROLE[state]]
            continue
        if letter == KEEP:
            open_token += "K"
            state = after_keep(state, read_code(codes[row])[0])
        elif letter == REROLE:
            open_token += NEXT_ROLE[state].upper()
            state = AFTER[NEXT_ROLE[state]]
        else:
            open_token += "D"
        tokens.append(open_token)
        open_token, row = "", row + 1
    if open_token:
        tokens[-1] += open_token
    return "".join(LETTERS[x - 1] for x in letters), weight >> weights.low, tokens


def illegal_pairs(codes: str) -> int:
    roles = "".join(read_code(c)[0] for c in codes)
    return sum(roles[i:i + 2] not in LEGAL_PAIRS for i in range(len(roles) - 1))


def packed(found: list[int | None]) -> list[bytes | None]:
    return [None if x is None else x.to_bytes((x.bit_length() + 7) // 8, "big") for x in found]


def unpacked(found: list[bytes | None]) -> list[int | None]:
    return [None if x is None else int.from_bytes(x, "big") for x in found]


# --- Damage ---------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage: by the checksum of ``conv_id:turn`` a row goes, loses its text or its sentence ends, is
    repeated beside itself, or becomes a user's."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    mark = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), mark.alias("mark"))
    text = F.when(F.col("mark") == 1, "").when(F.col("mark") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
        F.col("text"))
    times = F.when(F.col("mark") == 3, 2).otherwise(1)
    return rows.where("mark <> 0").select(
        "conv_id", "turn", F.when(F.col("mark") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy"))


# --- Repair ---------------------------------------------------------------------------------------------------------


def joined_by(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``; a null id is a key like any other."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return left.join(right, match, how).drop(*[f"_{k}" for k in keys])


def numbered(rows: DataFrame) -> DataFrame:
    """Narrow rows (no texts) with their place in the conversation, fault and code; ``rows`` must be written."""
    text = F.col("text")
    blank = ~text.rlike(f"[^{BLANKS[1:]}")
    last_sign = F.regexp_extract(text, rf"([^{BLANKS[1:-1]}]){BLANKS}*\z", 1)
    narrow = rows.select(
        "conv_id", "turn", "copy", "rid", F.substring("role", 1, 1).alias("initial"), "role",
        F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256).alias("content"),
        blank.alias("blank"), (~last_sign.isin(".", "!", "?")).alias("cut"))
    placed = number_rows(narrow, ["conv_id"], [
        F.asc_nulls_first("turn"), F.asc("role"), F.asc("content"), F.asc("copy"), F.asc("rid")])
    placed = common.written(placed.drop("role", "copy"), "placed")
    # The first place of each content; joined back by place, a key without repeats, however often a content occurs.
    firsts = placed.groupBy("conv_id", "content").agg(F.min("position").alias("position")).select(
        "conv_id", "position", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("cut"), "truncated")
    role = F.greatest(F.lit(0), F.instr(F.lit(ROLES[:3]), F.col("initial")) - 1)
    role = F.when(F.col("initial").isin(*ROLES[:3]), role).otherwise(len(ROLES) - 1)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(FINE)
    joined = joined_by(placed, firsts, ["conv_id", "position"], "left").withColumn("fault", fault)
    return common.written(joined.select(
        "conv_id", "turn", "rid", "position", "position_of", "fault",
        F.floor((F.col("position") - 1) / BLOCK).alias("block"),
        F.char(F.lit(ord("a")) + role * KINDS + kind).alias("code")), "numbered")


def solved(rows: DataFrame) -> DataFrame:
    """Per conversation: audit, cost, illegal pairs and the tokens of its rows."""
    keep = ["conv_id"]
    out = "audit string, cost long, illegal long, tokens array<string>"
    in_order = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "code"))), lambda r: r["code"]), "")
    blocks = rows.groupBy("conv_id", "position_of", "block").agg(in_order.alias("codes"))

    def whole() -> Callable:
        def work(values: list) -> list[tuple]:
            found = []
            for codes in values:
                audit, cost, tokens = plan_of(codes, solve(codes, ACCEPTED, True)[START])
                found.append((audit, cost, illegal_pairs(codes), tokens))
            return found

        return work

    single = common.map_rows(blocks.where(F.col("position_of") <= BLOCK), "codes", keep, out, whole)
    longest = rows.agg(F.max("position_of")).first()[0] or 0
    if longest <= BLOCK:
        return common.written(single, "plans")

    def table() -> Callable:
        return lambda values: [(v["codes"], packed(table_of(v["codes"], v["last"]))) for v in values]

    def joined() -> Callable:
        def work(values: list) -> list[tuple]:
            found = []
            for parts in values:
                codes, solutions = parts[0]["codes"], unpacked(parts[0]["found"])
                for part in parts[1:]:
                    solutions = chain(solutions, len(codes), unpacked(part["found"]), len(part["codes"]))
                    codes += part["codes"]
                found.append((codes, packed(solutions)))
            return found

        return work

    last = F.col("block") == F.floor((F.col("position_of") - 1) / BLOCK)
    level = common.written(common.map_rows(
        blocks.where(F.col("position_of") > BLOCK).select(
            "conv_id", "block", F.struct("codes", last.alias("last")).alias("work")),
        "work", ["conv_id", "block"], "codes string, found array<binary>", table), "solutions")
    count = -(-longest // BLOCK)
    while count > 1:
        parts = level.groupBy("conv_id", F.floor(F.col("block") / FAN).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("block", "codes", "found"))).alias("parts"))
        level = common.written(common.map_rows(
            parts, "parts", ["conv_id", "block"], "codes string, found array<binary>", joined), "solutions")
        count = -(-count // FAN)

    def finish() -> Callable:
        def work(values: list) -> list[tuple]:
            found = []
            for v in values:
                audit, cost, tokens = plan_of(v["codes"], int.from_bytes(v["weight"], "big"))
                found.append((audit, cost, illegal_pairs(v["codes"]), tokens))
            return found

        return work

    many = common.map_rows(
        level.select("conv_id", F.struct("codes", F.get("found", F.lit(4 * START)).alias("weight")).alias("work")),
        "work", keep, out, finish)
    return common.written(single.unionByName(many), "plans")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of rows (conv_id, turn, role, text; ``copy`` orders exact repeats).

    Returns a report per conversation (gaps, faults, cost, audit) and the repaired turns: conv_id, position of the row
    they come from, ``step`` within it, block, edit (K, R or I), role and text. Deleted rows have no turn.
    """
    rows = common.written(
        (rows if "copy" in rows.columns else rows.withColumn("copy", F.lit(1)))
        .select("conv_id", "turn", "copy", F.coalesce("role", F.lit(" ")).alias("role"),
                F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("rid")), "turns")
    places = numbered(rows)
    plans = solved(places)

    def faults(name: str) -> Column:
        return F.count_if(F.coalesce(F.col("fault") == name, F.lit(False))).alias(name)

    counts = places.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        faults("blank"), faults("duplicate"), faults("truncated"))
    report = joined_by(counts, plans.drop("tokens"), ["conv_id"])

    tokens = plans.select("conv_id", F.posexplode("tokens").alias("place", "token")).select(
        "conv_id", (F.col("place") + 1).cast("long").alias("position"), "token")
    edits = joined_by(places, tokens, ["conv_id", "position"]).select("rid", "position", "block", "token")
    turns = rows.join(edits, "rid").select(
        "conv_id", "position", "block", "role", "text", F.posexplode(F.split("token", "")).alias("step", "edit"))
    edit = F.col("edit")
    given = F.when(F.lower(edit) == "u", "user").when(F.lower(edit) == "a", "assistant")
    inserted = edit.isin("u", "a")
    turns = turns.where(edit.isin("K", "U", "A", "u", "a")).select(
        "conv_id", "position", "step", "block",
        F.when(inserted, "I").when(edit == "K", "K").otherwise("R").alias("edit"),
        F.when(edit == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    return report, turns


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines. A conversation of several blocks is streamed, block by block,
    so that a task holds one batch of blocks and the state of the digest."""
    line = F.struct("position", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    blocks = common.written(turns.groupBy("conv_id", "block").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(line)), lambda r: r["line"]), "\n").alias("part")), "repaired")
    many = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1").select(
        "conv_id", F.lit(True).alias("long"))
    sized = joined_by(blocks, many, ["conv_id"], "left")
    short = sized.where("long is null").select("conv_id", F.sha2(F.col("part").cast("binary"), 256).alias("sha"))
    kind = turns.schema["conv_id"].dataType.simpleString()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, begun = None, None, False
        names = ["conv_id", "sha"]
        for batch in batches:
            done = []
            for key, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if begun and key == conv:
                    digest.update(b"\n")
                else:
                    if begun:
                        done.append((conv, digest.hexdigest()))
                    conv, digest, begun = key, hashlib.sha256(), True
                digest.update(part.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*done), (batch.schema.types[0], pa.string()))], names=names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.types[0]), pa.array([digest.hexdigest()])],
                                             names=names)

    long = sized.where("long").select("conv_id", "block", "part").repartition("conv_id").sortWithinPartitions(
        "conv_id", "block").mapInArrow(stream, f"conv_id {kind}, sha string")
    return short.unionByName(long)


def op11_integer_weights(spark: SparkSession, folder: str) -> DataFrame:
    source = common.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report, turns = repair(damaged(source))
    shas = digests(turns)
    every = source.select("conv_id").distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    found = joined_by(joined_by(every, report, ["conv_id"], "left"), shas, ["conv_id"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"))
