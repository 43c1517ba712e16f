from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest

from docketry.llm import turn_alignment as ta

TURNS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64]))


def judged(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.strip(SPACES)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    return faults


def best(rows, faults):
    """Cheapest (cost, audit) by trying every edit in every state, with the roles that they give."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    now = {"": (0, "")}

    def inserts(states):
        for _ in range(2):
            for s, (c, a) in list(states.items()):
                for r in set(step[s]) - {"s"}:
                    states[r] = min(states.get(r, (1 << 30, "")), (c + 5, a + "I"))
        return states

    for (_, role, _), fault in zip(rows, faults, strict=True):
        after = {}
        for s, (c, a) in inserts(now).items():
            options = [(s, 2, "D")]
            if fault in ("", "truncated"):
                more = 5 * bool(fault)
                options += [(r, more, "K") for r in step[s] if r == role[:1]] + [(r, more + 1, "R") for r in step[s] if r != "s"]
            for r, cost, edit in options:
                after[r] = min(after.get(r, (1 << 30, "")), (c + cost, a + edit))
        now = after
    ends = inserts(now)
    return min(ends[s] for s in ("", "a") if s in ends)


def told(rows, audit):
    out, i, state = [], 0, ""
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K" and state == "" and rows[i][1][:1] == "s":
            state = "s"
        else:
            state = "a" if state == "u" else "u"
        role = rows[i][1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
        out.append(f"{role}:" + ("" if edit == "I" else rows[i][2]))
        i += edit != "I"
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(turns):
    chats = {}
    for row in turns:
        chats.setdefault(row[0], []).append(row)
    out = {}
    for conv, given in chats.items():
        rows = damage(given)
        faults = judged(rows)
        known = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit = best(rows, faults)
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False)), cost, audit, told(rows, audit),
        )
    return out


def results(df):
    rows = df.collect()
    got = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def chats(seed=3):
    rng = random.Random(seed)
    turns, conv = [], 0
    for n in (1, 2, 3):
        for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=n):
            turns += [(conv, i, r, rng.choice(["Yes.", "No", "So?", " "])) for i, r in enumerate(roles)]
            conv += 1
    for _ in range(120):
        n, at = rng.randrange(1, 40), 0
        for _ in range(n):
            at += rng.choice([1, 1, 1, 2, 5])
            turns.append((conv, at, rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "uncle"]), rng.choice(["Fine.", "Open", "", None, f"t{at}.", f"t{at}", "Why?\n"])))
        conv += 1
    return turns


def test_matches_exhaustive_search(spark):
    turns = chats()
    turns += [(None, None, None, None), (None, 4, "user", "Null chat."), (None, None, "assistant", "x"), (9999, 7, "user", "b."), (9999, 7, "user", "b."), (9999, 7, "user", "a.")]
    rng = random.Random(8)
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, TURNS)
    assert results(ta.repair(ta.damaged(df))) == expected(turns)


@pytest.mark.parametrize("run", [1, 3, 16])
def test_runs_give_the_same_as_whole_chats(spark, monkeypatch, run):
    monkeypatch.setattr(ta, "RUN", run)
    turns = chats(run)[-700:]
    turns += [(-1, i, ["user", "assistant"][i % 2], f"t{i % 50}" + "." * (i % 7 > 0)) for i in range(150)]
    # The package is sent to the workers as a file, so the run's length is handed over by the codes themselves.
    whole = expected(turns)
    ordered = {}
    for row in turns:
        ordered.setdefault(row[0], []).append(row)
    for conv, given in ordered.items():
        rows = damage(given)
        codes = "".join({"blank": "b", "duplicate": "d"}.get(f, r[1][:1] if r[1][:1] in ("s", "u", "a") else "o") if f != "truncated" else (r[1][:1] if r[1][:1] in ("s", "u", "a") else "o").upper() for r, f in zip(rows, judged(rows), strict=True))
        pieces = [codes[i : i + run] for i in range(0, len(codes), run)] or [""]
        rests = [[c for c, _ in ta._CLOSING]]
        for piece in reversed(pieces):
            m = ta.run_matrix(piece)
            rests.append([min(m[4 * s + e] + rests[-1][e] for e in range(4)) for s in range(4)])
        state, audit = ta.START, ""
        for piece, rest in zip(pieces, rests[-2::-1], strict=True):
            text, state = ta.run_audits(piece, rest)[state]
            audit += text
        assert (rests[-1][ta.START], audit + ta._CLOSING[state][1]) == whole[conv][5:7]


def test_long_chat_over_many_parts(spark):
    rng = random.Random(4)
    turns = [(5, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}", "again.", ""])) for i in range(3000)] + [(6, 0, "user", "x" * 300_000), (6, 1, "assistant", "y." * 200_000)]
    df = spark.createDataFrame(turns, TURNS).repartition(7)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the parts apart
    try:
        got = results(ta.repair(ta.damaged(df)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got == expected(turns)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], TURNS)
    assert ta.repair(ta.damaged(df)).collect() == []
    clash = spark.createDataFrame([(1, 2, "user", "a.", 9, "z")], TURNS + ", part long, audit string")
    assert results(ta.repair(ta.damaged(clash))) == expected([(1, 2, "user", "a.")])
