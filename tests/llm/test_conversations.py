import itertools
import random
import zlib
from hashlib import sha256

from tidemark.llm import conversation_repair as R
from tidemark.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def legal(letters):
    rest = letters[1:] if letters[:1] == "s" else letters
    return letters == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def cheapest(rows):
    """Plain search: states are what was built so far, edits are tried one by one."""
    seen, turns = set(), []
    for role, text in rows:
        blank = not text.strip(SPACE)
        must = blank or (role, text) in seen
        seen.add((role, text))
        turns.append((role, text, must, not blank and text.rstrip(SPACE)[-1] not in ".!?"))
    best = {("", ""): (0, ())}  # (letters so far shortened, audit) by expected continuation

    def shape(letters):
        return letters[:1] == "s" and len(letters) == 1, letters[-1:], letters == ""

    states = {shape(""): (0, "", "", ())}

    def better(into, letters, cost, audit, lines):
        if not any(legal(letters + end) for end in ("", "a", "ua")):
            return False
        key = shape(letters)
        if key not in into or (cost, audit) < into[key][:2]:
            into[key] = (cost, audit, letters, lines)
            return True
        return False

    def insert(states):
        while any([better(states, l + x, c + 2, a + "I", (*t, f"{R.ROLE[x]}:")) for c, a, l, t in list(states.values()) for x in "ua"]):
            pass

    for role, text, must, cut in turns:
        after = {}
        insert(states)
        for cost, audit, letters, lines in states.values():
            better(after, letters, cost + 3, audit + "D", lines)
            if not must:
                if role[:1]:
                    better(after, letters + role[:1], cost + cut, audit + "K", (*lines, f"{role}:{text}"))
                for x in "ua":
                    better(after, letters + x, cost + 2 + cut, audit + "R", (*lines, f"{R.ROLE[x]}:{text}"))
        states = after
    insert(states)
    cost, audit, _, lines = min(v for v in states.values() if legal(v[2]))
    return cost, audit, sha256("\n".join(lines).encode()).hexdigest()


def expected(rows):
    after = sorted(damaged(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        seen, faults = set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            if not text.strip(SPACE):
                faults["blank"] += 1
            elif (role, text) in seen:
                faults["duplicate"] += 1
            elif text.rstrip(SPACE)[-1] not in ".!?":
                faults["truncated"] += 1
            seen.add((role, text))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out.append((conv, gaps, *faults.values(), illegal, *cheapest([(r[2], r[3]) for r in mine])))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(llm_spark, rows):
    df = llm_spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "'p' as path", "2 as phase", "'d' as digest")
    return sorted((tuple(r[c] for c in COLUMNS) for r in queries.op13(df).collect()), key=str)


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    for conv in range(convs):
        role = rng.choice("sua")
        for turn in range(rng.randint(1, most)):
            role = {"u": "a"}.get(role, "u") if rng.random() < 0.8 else rng.choice("suax")
            text = rng.choice(["yes.", "no", "", " \t", f"word {turn}.", f"word {turn}", "why?\n"])
            yield conv, turn + (rng.random() < 0.1), {"s": "system", "u": "user", "a": "assistant", "x": "tool"}[role], text


def by_turn(rows):
    """No two rows of a turn, whose order the rules leave open."""
    return list({(r[0], r[1]): r for r in rows}.values())


def test_every_alignment_of_short_runs():
    for n in range(1, 6):
        for codes in itertools.product("suaxUS" if n < 5 else "sua", repeat=n):
            codes = "".join(codes)
            roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
            rows = [(roles[c.lower()], f"{k}{'' if c.isupper() else '.'}") for k, c in enumerate(codes)]
            paths = R.block_paths(codes)
            got = min((paths[0, q][0] + c, R.audit(paths[0, q][1] + end)) for q, (c, end) in enumerate(R.CLOSING) if (0, q) in paths)
            assert got == cheapest(rows)[:2], codes


def test_repair_against_plain_search(llm_spark):
    rows = by_turn(random_rows(1, 60, 14))
    rows += [(None, 1, "user", "a."), (None, 2, None, "b."), (500, None, "user", "x."), (500, 3, "user", None), (501, None, None, None)]
    rows += [(600 + k, k, "", "empty role.") for k in range(3)] + [(700, k, "assistant", "same.") for k in range(30)]
    assert found(llm_spark, rows) == expected(rows)


def test_long_conversations_are_cut_into_blocks(llm_spark, monkeypatch):
    rows = by_turn(random_rows(2, 3, 300))
    want = expected(rows)
    turns = llm_spark.createDataFrame(list(damaged(rows)), "conv long, turn long, role string, text string")
    for block in (1, 7, 256):
        summary = R.summaries(turns, turns.select("conv"), block)
        got = sorted(((r.conv, *(r[c] for c in COLUMNS[1:])) for r in summary.collect()), key=str)
        assert got == want


def test_repaired_turns_spell_the_hash(llm_spark):
    rows = list(damaged(by_turn(random_rows(3, 20, 12))))
    turns = llm_spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(5)
    lines = {}
    for r in sorted(R.repaired(turns).collect(), key=lambda r: (r.conv, r.closing, r.turn is not None, r.turn or 0, r.place)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for r in R.summaries(turns, turns.select("conv")).collect():
        assert r.repaired_sha256 == sha256("\n".join(lines.get(r.conv, [])).encode()).hexdigest()


def test_no_rows_and_dropped_conversations(llm_spark):
    assert found(llm_spark, []) == []
    gone = next(c for c in range(1_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = sha256(b"").hexdigest()
    assert found(llm_spark, [(gone, 0, "user", "a.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_query_against_plain_search(llm_spark):
    import duckdb

    from .conftest import SMALL

    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall()
    got = queries.QUERIES["op13_conversation_repair"](llm_spark, SMALL).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == expected(rows)
