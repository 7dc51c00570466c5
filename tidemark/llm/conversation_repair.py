"""Conversation structure repair by aligning turns to an alternating grammar.

The roles of a sound conversation spell ``(s?(ua)+)?`` by their initials. Blank and
repeated turns must go; the other, live, turns are aligned to target strings of
every feasible length by Wagner-Fischer: keep 0, rerole to user or assistant 2,
delete 3, insert a user or assistant turn without text 2, and 1 for every
truncated turn that stays. A cheap first alignment gives the incumbent cost, and the
table is filled only inside Ukkonen's band for that cost. Of the cheapest
alignments over all lengths the one with the ASCII-least audit counts.

Targets alternate, so lengths with the same last letter share one table, read from
the end: its columns are the lengths. A conversation may be long: its live turns,
without texts, are cut into blocks along range partitions. What a block is worth
depends only on the letter expected before and after it (four states), so blocks
are aligned in parallel for every pair of states, and a pass over a few numbers a
block picks the states. Inserts belong to the turn they precede, so no audit of a
block is the beginning of another and ties can be settled block by block.
"""

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import stored

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
FAR = 1 << 40
SPACE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# Before a turn: nothing yet, after s, after u, after a. What closes a conversation there.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
CLOSING = ((0, ""), (2 * INSERT, "IuIa"), (INSERT, "Ia"), (0, ""))
STEP = re.compile("[DK]|[IR][ua]")
# Most live turns aligned at a time.
BLOCK = 256


def audit(path: str) -> str:
    """The edits' initials of a path, which also names the roles given."""
    return path.replace("u", "").replace("a", "")


def incumbent(codes: str) -> int:
    """Cost of a plain alignment from the left, one turn looked ahead."""
    cost, expected = 0, "u"
    for k, code in enumerate(codes):
        cost += code.isupper()
        if code.lower() != expected:
            cost += REROLE
            if code in "uaUA" and codes[k + 1 : k + 2].lower() == expected:
                continue  # a missing turn is inserted at the same price
        expected = "a" if expected == "u" else "u"
    return cost


def _letter(last: str, left: int) -> str:
    return last if left % 2 else ("u" if last == "a" else "a")


def distances(codes: str, last: str, most: int) -> list[list[int]]:
    """``[i][r]``: least cost of turns i, i+1, ... against r letters that alternate and
    end in ``last``, for alignments of cost ``most`` or less; others may show more."""
    n = len(codes)
    width = n + most // INSERT + 2
    table = np.full((n + 1, width), FAR, np.int64)
    table[n, 0] = 0
    lengths = np.arange(width)
    odd = lengths % 2 == 1
    for i in range(n - 1, -1, -1):
        low = max(0, n - i - most // DELETE)
        high = min(width, n - i + most // INSERT + 1)
        stays = int(codes[i].isupper())
        costs = {x: stays + (KEEP if codes[i].lower() == x else REROLE) for x in "ua"}
        row = table[i + 1, low:high] + DELETE
        first = max(low, 1)
        taken = np.where(odd[first:high], costs[last], costs[_letter(last, 0)])
        row[first - low :] = np.minimum(row[first - low :], table[i + 1, first - 1 : high - 1] + taken)
        row -= INSERT * lengths[low:high]
        table[i, low:high] = np.minimum.accumulate(row) + INSERT * lengths[low:high]
    return table.tolist()


def _trace(table, codes: str, last: str, i: int, left: int) -> str:
    """The path of least audit (D before I before K before R) at the table's cost."""
    path = []
    while i < len(codes):
        here = table[i][left]
        if here == DELETE + table[i + 1][left]:
            path.append("D")
            i += 1
        elif left and here == INSERT + table[i][left - 1]:
            path.append("I" + _letter(last, left))
            left -= 1
        else:
            letter = _letter(last, left)
            path.append("K" if codes[i].lower() == letter else "R" + letter)
            i, left = i + 1, left - 1
    return "".join(path)


@lru_cache(maxsize=1 << 13)
def block_paths(codes: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cost and path for each state before and after a run of live turns.

    ``codes`` has one character a turn: s, u, a or x for another role, upper case
    where the turn is truncated.
    """
    n, found = len(codes), {}

    def offer(before, after, cost, path):
        known = found.get((before, after))
        if known is None or (cost, audit(path)) < (known[0], audit(known[1])):
            found[before, after] = (cost, path)

    for state in STATES:
        offer(state, state, DELETE * n, "D" * n)
    openings = [i for i, c in enumerate(codes) if c in "sS"]
    for i in openings:
        offer(START, AFTER_S, DELETE * (n - 1) + (codes[i] == "S"), "D" * i + "K" + "D" * (n - 1 - i))
    # From any state to any other costs at most two inserts and one rerole more.
    most = incumbent(codes) + 2 * INSERT + REROLE
    for last, after in (("u", AFTER_U), ("a", AFTER_A)):
        table = distances(codes, last, most)

        def cheapest(i, first):
            lengths = [r for r in range(1, len(table[i])) if _letter(last, r) == first]
            best = min(table[i][r] for r in lengths)
            return best, [r for r in lengths if table[i][r] == best and best < FAR]

        for before in STATES:
            best, lengths = cheapest(0, "a" if before == AFTER_U else "u")
            for r in lengths:
                offer(before, after, best, _trace(table, codes, last, 0, r))
        for i in openings:
            best, lengths = cheapest(i + 1, "u")
            for r in lengths:
                path = "D" * i + "K" + _trace(table, codes, last, i + 1, r)
                offer(START, after, DELETE * i + (codes[i] == "S") + best, path)
    return found


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows, schema: pa.Schema, most: int = 2_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _first_batch(batches):
    """The first batch, for its types, and all batches."""
    first = next(batches, None)

    def all_of():
        if first is not None:
            yield first
        yield from batches

    return first, all_of()


BLOCKS = "part long, seq long, costs array<long>, ranks array<int>, paths array<string>"


def _align(block: int):
    """Blocks of live turns, sorted by conversation and place, with their paths."""

    def align(batches):
        first, batches = _first_batch(iter(batches))
        if first is None:
            return
        part = TaskContext.get().partitionId()
        types = {name: first.schema.field(name).type for name in ("conv", "turn", "role", "digest")}
        key = pa.struct([(name, types[name]) for name in ("turn", "role", "digest")])
        schema = pa.schema(
            [("conv", types["conv"]), ("part", pa.int64()), ("seq", pa.int64()), ("costs", pa.list_(pa.int64())),
             ("ranks", pa.list_(pa.int32())), ("paths", pa.list_(pa.string())), ("turns", pa.list_(key))]
        )

        def blocks():
            seq = 0
            for conv, run in groupby(_rows(batches), key=lambda row: row[0]):
                held = []
                for row in _and_end(run):
                    if held and (row is None or len(held) == block):
                        yield described(conv, seq, held)
                        seq, held = seq + 1, []
                    if row is not None:
                        held.append(row)

        def described(conv, seq, held):
            found = block_paths("".join(row[4] for row in held))
            pairs = [found.get((p, q), (-1, None)) for p in STATES for q in STATES]
            order = {a: k for k, a in enumerate(sorted({audit(path) for _, path in pairs if path is not None}))}
            return {
                "conv": conv, "part": part, "seq": seq,
                "costs": [cost for cost, _ in pairs],
                "ranks": [-1 if path is None else order[audit(path)] for _, path in pairs],
                "paths": [path for _, path in pairs],
                "turns": [{"turn": t, "role": r, "digest": d} for _, t, r, d, _ in held],
            }

        yield from _batches(blocks(), schema, 500)

    return align


def _and_end(rows):
    yield from rows
    yield None


def _pick(batches):
    """The states around each block, for blocks sorted by conversation, last first."""
    first, batches = _first_batch(iter(batches))
    if first is None:
        return
    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("pick", pa.int32()), ("tail", pa.string()), ("conv", first.schema.field("conv").type)])

    def picks():
        for conv, run in groupby(_rows(batches), key=lambda row: row[0]):
            run = list(run)  # a few numbers per block of turns
            worth = [[cost for cost, _ in CLOSING]]
            for _, _, _, costs, _ in run:
                after = worth[-1]
                worth.append([min((costs[4 * p + q] + after[q] for q in STATES if costs[4 * p + q] >= 0), default=FAR) for p in STATES])
            state = START
            for k in range(len(run) - 1, -1, -1):
                _, part, seq, costs, ranks = run[k]
                best = [q for q in STATES if costs[4 * state + q] >= 0 and costs[4 * state + q] + worth[k][q] == worth[k + 1][state]]
                q = min(best, key=lambda q: ranks[4 * state + q])
                yield {"part": part, "seq": seq, "pick": 4 * state + q, "tail": None if k else CLOSING[q][1], "conv": conv}
                state = q

    yield from _batches(picks(), schema)


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def _described(turns: DataFrame) -> DataFrame:
    """Null roles and texts are one space. Equal role and text have equal digests."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = turns.select("conv", "turn", role.alias("role"), text.alias("text"))
    return named.withColumn("digest", _digest(F.col("role"), F.col("text")))


def live_turns(turns: DataFrame) -> DataFrame:
    """The first turn of each role and text that isn't blank, without its text, with
    its ``code``. Turns without a number come first."""
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(last.isin(".", "!", "?"), code).otherwise(F.upper(code))
    found = _described(turns).where(F.length(last) > 0).select("conv", "turn", "role", "digest", code.alias("code"))
    firsts = found.groupBy("conv", "role", "digest", "code").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unnumbered")
    )
    return firsts.select("conv", F.when(~F.col("unnumbered"), F.col("least")).alias("turn"), "role", "digest", "code")


def decisions(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """What to do with each live turn, and what closes each conversation.

    ``turns``: ``conv``, ``turn``, ``role``, ``text``; further columns are ignored. The
    first table has ``conv``, ``turn``, ``role``, ``digest`` and ``path``, the inserts
    before the turn and its own edit; the second ``conv`` and ``tail``. Turns that are
    not in the first table are blank or repeated and go. A conversation is taken by
    turn (nulls first), role and digest; null conversations are one of their own. No
    rows, no rows.
    """
    spark = turns.sparkSession
    live = stored(live_turns(turns), "live-turns")
    kinds = {f.name: f.dataType.simpleString() for f in live.schema}
    row = f"struct<turn:{kinds['turn']},role:string,digest:binary>"
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest")]
    blocks = stored(
        live.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
            _align(block), f"conv {kinds['conv']}, {BLOCKS}, turns array<{row}>"
        ),
        "aligned-blocks",
    )
    down = [F.col("conv"), F.col("part").desc(), F.col("seq").desc()]
    numbers = blocks.select("conv", "part", "seq", "costs", "ranks").repartition("conv").sortWithinPartitions(*down)
    picks = stored(numbers.mapInArrow(_pick, f"part long, seq long, pick int, tail string, conv {kinds['conv']}"), "picked-states")
    path = F.element_at("paths", F.col("pick") + 1)
    steps = F.regexp_extract_all(path, F.lit("((?:I[ua])*(?:D|K|R[ua]))"))
    chosen = blocks.join(picks.drop("conv", "tail"), ["part", "seq"])
    each = chosen.select("conv", F.explode(F.arrays_zip("turns", steps.alias("path"))).alias("it"))
    made = each.select("conv", "it.turns.turn", "it.turns.role", "it.turns.digest", "it.path")
    return made, picks.where("tail is not null").select("conv", "tail")


def repaired(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The repaired conversations, one row a turn.

    ``conv``, ``turn`` (of the turn that was kept, or before which one was inserted;
    null at the end), ``place`` (order within one original turn), ``role``, ``text`` and
    ``edit`` (K, R or I). ``closing`` is true for turns added at the end. Nothing is
    gathered per conversation.
    """
    made, tails = decisions(turns, block)
    texts = _described(turns).groupBy("conv", "turn", "role", "digest").agg(F.first("text").alias("text"))
    same = F.lit(True)
    for c in ("conv", "turn", "role", "digest"):
        same = same & F.col(f"made.{c}").eqNullSafe(F.col(f"texts.{c}"))
    whole = made.alias("made").join(texts.alias("texts"), same).select("made.*", "texts.text")
    ends = tails.selectExpr("conv", "null as turn", "null as role", "null as digest", "tail as path", "null as text")
    rows = whole.withColumn("closing", F.lit(False)).unionByName(ends.withColumn("closing", F.lit(True)))
    steps = F.regexp_extract_all("path", F.lit("([DK]|[IR][ua])"), F.lit(1))
    rows = rows.select("*", F.posexplode(steps).alias("place", "step")).where("step <> 'D'")
    edit = F.substring("step", 1, 1)
    given = F.when(F.col("step").endswith("u"), "user").otherwise("assistant")
    return rows.select(
        "conv", "turn", "digest", "closing", "place",
        F.when(edit == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(edit == "I", F.lit("")).otherwise(F.col("text")).alias("text"),
        edit.alias("edit"),
    )


class _Summary:
    """Counts, audit and running hash of one conversation."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.least = self.most = None
        self.turns = 0
        self.initial = None
        self.edits = []
        self.hash, self.empty = sha256(), True

    def line(self, role, text):
        if not self.empty:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.empty = False

    def step(self, path, role=None, text=None, truncated=False):
        for step in STEP.findall(path):
            self.edits.append(step[0])
            if step[0] == "I":
                self.cost += INSERT
                self.line(ROLE[step[1]], "")
            elif step == "D":
                self.cost += DELETE
            else:
                self.cost += truncated + (REROLE if step[0] == "R" else KEEP)
                self.line(role if step == "K" else ROLE[step[1]], text)

    def turn(self, turn, role, text, path):
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in LEGAL
        self.initial = role[:1]
        words = text.rstrip(SPACE)
        if path is None:
            self.blank += not words
            self.duplicate += bool(words)
            self.step("D")
        else:
            truncated = words[-1] not in ".!?"
            self.truncated += truncated
            self.step(path, role, text, truncated)

    def result(self, conv):
        return {
            "conv": conv,
            "gaps": 0 if self.least is None else self.most - self.least + 1 - self.turns,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "cost": self.cost, "audit": "".join(self.edits), "repaired_sha256": self.hash.hexdigest(),
        }


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
NAMED, TURN, END = range(3)


def _summarise(batches):
    first, batches = _first_batch(iter(batches))
    if first is None:
        return
    numbers = [(name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = pa.schema([("conv", first.schema.field("conv").type), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def summaries():
        for conv, run in groupby(_rows(batches), key=lambda row: row[0]):
            seen, decided = _Summary(), None
            for _, phase, turn, role, digest, path, text in run:
                if phase == END:
                    seen.step(path)
                elif phase == TURN and path is not None:
                    decided = (turn, role, digest, path)
                elif phase == TURN:
                    mine = decided is not None and decided[:3] == (turn, role, digest)
                    seen.turn(turn, role, text, decided[3] if mine else None)
                    decided = None if mine else decided
            yield seen.result(conv)

    yield from _batches(summaries(), schema, 200)


def summaries(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for every ``conv`` of ``convs``: gaps in the numbering, faults, cost, audit
    and hash of its repaired text.

    A conversation's hash is sequential, so its turns pass through one task, row by
    row in sorted order beside their decisions; only the audit, a character a turn,
    is held. Alignment is done before, in parallel. Conversations without turns have
    zeros, an empty audit and the hash of nothing.
    """
    made, tails = decisions(turns, block)
    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    columns = ["conv", "phase", "turn", "role", "digest", "path", "text"]

    def rows(df, phase, **values):
        blank = {"turn": kinds["turn"], "role": "string", "digest": "binary", "path": "string", "text": "string"}
        given = {c: F.lit(None).cast(kind) for c, kind in blank.items() if c not in df.columns and c not in values}
        return df.withColumns({"phase": F.lit(phase), **given, **values}).select(*columns)

    parts = rows(convs.select("conv").distinct(), NAMED)
    parts = parts.unionByName(rows(_described(turns), TURN)).unionByName(rows(made, TURN))
    parts = parts.unionByName(rows(tails, END, path=F.col("tail")))
    order = [F.col("conv"), F.col("phase"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("path").isNull()]
    return parts.repartition("conv").sortWithinPartitions(*order).mapInArrow(_summarise, f"conv {kinds['conv']}, {SUMMARY}")
