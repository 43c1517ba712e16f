"""Conversations aligned to the grammar of alternating roles at the least cost, with an audit of the edits.

The legal role strings are the empty one and `s?(ua)+`. The turns of a chat are aligned to the target
string of each feasible length (Wagner-Fischer): all targets end alike, so the tables of the shorter
ones lie inside the table of the longest, whose rows are cut to a band around the diagonal that is as
wide as the cost of a first, greedy repair allows (Ukkonen). Where several targets cost the least,
the audits traced back from each are compared and the least in ASCII order counts.

Turns are dealt out by sorted ranges, so a chat may lie in several parts. A chat within one part and
one run of turns is done there. Of all others each run gives a matrix of least costs between the roles
before and after it, the matrices are chained from the end, each run is aligned for every role that may
come before it, and one pass in order picks the audits and hashes the text as it goes by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docketry.llm.workers import map_arrow
from docketry.session import stage

DELETE, RELABEL, INSERT, TRUNCATED = 2, 1, 5, 5
#: A run holds at most so many turns, and ends once its texts exceed so many characters.
RUN, RUN_CHARS = 512, 4 << 20
#: Chats solved together.
TOGETHER = 4000
#: Cells of one table.
CELLS = 2_000_000
_FAR = 1 << 28
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: What it costs to end after each role, and the empty turns put there.
_CLOSING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
_SPACES = " \t\n\x0b\x0c\r"
#: A code per turn: b(lank), d(uplicate), else the initial s, u, a, or o for any other, upper case if truncated.
_CLASS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def _fits(codes: list[str]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """For runs of equally many turns: who has to go, and the cost of each turn on each role."""
    n = len(codes[0])
    raw = np.frombuffer("".join(codes).encode("ascii"), np.uint8).reshape(len(codes), n)
    low = raw | 0x20
    forced = (raw == ord("b")) | (raw == ord("d"))
    more = np.where(forced, _FAR, np.where(raw < 0x60, TRUNCATED, 0)).astype(np.int32)
    fit = {r: more + np.where(low == ord(c), 0, RELABEL if r != SYSTEM else _FAR).astype(np.int32) for c, r in _CLASS.items()}
    return forced, fit


def _greedy(forced: np.ndarray, fit: dict[int, np.ndarray]) -> np.ndarray:
    """Cost of a repair of each run that deletes truncated turns and relabels the others as needed."""
    rows, n = forced.shape
    state, cost = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    for i in range(n):
        wanted = np.where(state == USER, ASSISTANT, USER)
        onto = np.where(wanted == USER, fit[USER][:, i], fit[ASSISTANT][:, i])
        as_system = (state == START) & (fit[SYSTEM][:, i] == 0)
        gone = ~as_system & (onto > RELABEL)
        cost += np.where(as_system, 0, np.where(gone, DELETE, onto))
        state = np.where(as_system, SYSTEM, np.where(gone, state, wanted))
    cost += np.array([c for c, _ in _CLOSING], np.int32)[state]
    return np.minimum(cost, DELETE * n)


def _table(fit: dict[int, np.ndarray], n: int, end: int, closing: bool, bound: int) -> np.ndarray:
    """[i, run, j]: least cost of aligning the turns from the i-th on to the last j roles of an alternating string that ends in `end`.

    Cells off the diagonal by more deletions or insertions than `bound` pays for stay out of reach.
    With `closing`, empty turns may follow the last turn.
    """
    rows = len(fit[USER])
    width = n + bound // INSERT + 1
    t = np.full((n + 1, rows, width), _FAR, np.int32)
    j = np.arange(width, dtype=np.int32)
    t[n, :, 0] = 0
    if closing:
        t[n] = np.minimum(INSERT * j, _FAR)
        t[n][:, bound // INSERT + 1 :] = _FAR
    other = USER + ASSISTANT - end
    for i in range(n - 1, -1, -1):
        lo, hi = max(0, n - i - bound // DELETE), min(width, n - i + bound // INSERT + 1)
        best = t[i + 1][:, lo:hi] + DELETE
        a = max(lo, 1)
        onto = np.where(j[a:hi] % 2 == 1, fit[end][:, i, None], fit[other][:, i, None])
        best[:, a - lo :] = np.minimum(best[:, a - lo :], t[i + 1][:, a - 1 : hi - 1] + onto)
        best = np.minimum.accumulate(best - INSERT * j[lo:hi], axis=1) + INSERT * j[lo:hi]
        t[i][:, lo:hi] = np.minimum(best, _FAR)
    return t


def _after_system(fit: dict[int, np.ndarray], t: np.ndarray) -> np.ndarray:
    """As the table, for the last j roles with a kept system turn before them."""
    out = np.full_like(t, _FAR)
    for i in range(len(t) - 2, -1, -1):
        out[i] = np.minimum(np.minimum(out[i + 1] + DELETE, t[i + 1] + fit[SYSTEM][:, i, None]), _FAR)
    return out


def _trace(fit: dict[int, np.ndarray], r: int, code: str, t: np.ndarray, s: np.ndarray | None, end: int, j: int) -> str:
    """The least audit among the cheapest alignments of run `r` to j roles, a system turn before them if `s` is given."""
    audit, i, n, other = [], 0, len(code), USER + ASSISTANT - end
    while s is not None:
        here = s[i, r, j]
        if here == DELETE + s[i + 1, r, j]:
            audit.append("D")
        else:
            audit.append("K")
            s = None
        i += 1
    while i < n or j:
        here = t[i, r, j]
        if i < n and here == DELETE + t[i + 1, r, j]:
            audit.append("D")
            i += 1
        elif j and here == INSERT + t[i, r, j - 1]:
            audit.append("I")
            j -= 1
        else:
            role = end if j % 2 else other
            audit.append("K" if _CLASS.get(code[i].lower()) == role else "R")
            i, j = i + 1, j - 1
    return "".join(audit)


def _lengths(start: int, end: int, width: int) -> Iterator[int]:
    """Feasible numbers of roles between two roles, the last being `end`."""
    if start == end:
        yield 0
    if end in _NAMES:
        yield from range(1 if end == _NEXT[start] else 2, width, 2)


def _align_alike(codes: list[str], fit: dict[int, np.ndarray], bound: int, places: list[int], out: list[tuple[int, str]]) -> None:
    """Chats of equally many turns and the same first cost: cost and audit of each go to its place of `out`."""
    t = _table(fit, len(codes[0]), ASSISTANT, True, bound)
    s = _after_system(fit, t)
    plain = list(range(0, t.shape[2], 2))  # no role at all, or pairs of user and assistant
    cost = np.concatenate([t[0][:, plain], s[0][:, plain[1:]]], axis=1)
    least = cost.min(axis=1)
    for r, code in enumerate(codes):
        tied = np.flatnonzero(cost[r] == least[r]).tolist()
        audits = [_trace(fit, r, code, t, None, ASSISTANT, plain[c]) if c < len(plain) else _trace(fit, r, code, t, s, ASSISTANT, plain[c - len(plain) + 1]) for c in tied]
        out[places[r]] = (int(least[r]), min(audits))


def align_chats(codes: list[str]) -> list[tuple[int, str]]:
    """Cost and audit of whole chats, in order."""
    out: list[tuple[int, str]] = [(0, "")] * len(codes)
    by_length: dict[int, list[int]] = {}
    for k, code in enumerate(codes):
        by_length.setdefault(len(code), []).append(k)
    for n, chats in by_length.items():
        if not n:
            continue
        forced, fit = _fits([codes[k] for k in chats])
        bounds = _greedy(forced, fit)
        for bound in np.unique(bounds).tolist():
            who = np.flatnonzero(bounds == bound)
            if not bound:  # nothing but keeping costs nothing
                for r in who.tolist():
                    out[chats[r]] = (0, "K" * n)
                continue
            step = max(1, CELLS // ((n + 1) * (n + bound // INSERT + 1)))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                _align_alike([codes[chats[k]] for k in some.tolist()], {c: x[some] for c, x in fit.items()}, bound, [chats[k] for k in some.tolist()], out)
    return out


def _run_tables(code: str) -> tuple[dict[int, np.ndarray], dict[int, tuple[np.ndarray, np.ndarray]]]:
    fit = _fits([code])[1]
    tables = {}
    for end in (USER, ASSISTANT):  # deleting every turn and putting two empty ones is always a way
        t = _table(fit, len(code), end, False, DELETE * len(code) + 2 * INSERT)
        tables[end] = (t, _after_system(fit, t))
    return fit, tables


def _ways(tables: dict[int, tuple[np.ndarray, np.ndarray]], start: int) -> Iterator[tuple[int, int, int, bool]]:
    """(cost, end, roles, system turn first) of the ways through a run from a role."""
    for end in range(4):
        t, s = tables[end if end in _NAMES else ASSISTANT]
        for j in _lengths(start, end, t.shape[2]):
            yield int(t[0, 0, j]), end, j, False
        if start == START and end != START:
            for j in _lengths(SYSTEM, end, t.shape[2]):
                yield int(s[0, 0, j]), end, j, True


def run_matrix(code: str) -> list[int]:
    """Least cost through a run of turns from each role to each; empty turns after the last turn are the next run's."""
    if not code:
        return [0 if a == b else _FAR for a in range(4) for b in range(4)]
    _, tables = _run_tables(code)
    out = [_FAR] * 16
    for start in range(4):
        for cost, end, _, _ in _ways(tables, start):
            out[4 * start + end] = min(out[4 * start + end], cost)
    return out


def run_audits(code: str, rest: list[int]) -> list[tuple[str, int]]:
    """For each role before a run: the least of its cheapest audits, and the role after it, where `rest` is what the turns after it cost."""
    if not code:
        return [("", s) for s in range(4)]
    fit, tables = _run_tables(code)
    out = []
    for start in range(4):
        ways = [(cost + rest[end], end, j, first) for cost, end, j, first in _ways(tables, start)]
        least = min(w[0] for w in ways)
        found = []
        if least < _FAR:
            for cost, end, j, first in ways:
                if cost == least:
                    t, s = tables[end if end in _NAMES else ASSISTANT]
                    found.append((_trace(fit, 0, code, t, s if first else None, end if end in _NAMES else ASSISTANT, j), end))
        out.append(min(found) if found else ("", start))
    return out


def _lines(audit: str, roles: list[str], texts: list[str], state: int) -> tuple[list[str], int]:
    """The turns that an audit leaves, as `role:text`, and the role after them."""
    out, i = [], 0
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K" and state == START and roles[i][:1] == "s":
            state = SYSTEM
        else:
            state = _NEXT[state]
        role = roles[i] if edit == "K" else _NAMES[state]
        if edit == "I":
            out.append(f"{role}:")
        else:
            out.append(f"{role}:{texts[i]}")
            i += 1
    return out, state


_LEGAL = {"su", "ua", "au"}


class _Chat:
    """The turns of one chat within a part, from one cut to the next."""

    def __init__(self, some: bool, conv, open_: bool):
        self.some, self.conv, self.open, self.run = some, conv, open_, 0
        self.seen: set[bytes] = set()
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.codes, self.keys, self.chars = [], [], [], [], [], 0

    def add(self, turn, role: str, text: str, code: str) -> None:
        key = hashlib.blake2b(f"{role}\0{text}".encode(), digest_size=16).digest()
        # A blank turn is blank wherever it comes; it makes no other turn a duplicate.
        if code != "b":
            code = "d" if key in self.seen else code
            self.seen.add(key)
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.codes.append(code)
        self.keys.append(key)
        self.chars += len(text)

    def counts(self) -> dict:
        known = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        codes = "".join(self.codes)
        return {
            "code": codes, "n_blank": codes.count("b"), "n_duplicate": codes.count("d"), "n_truncated": sum(map(str.isupper, codes)),
            "n_illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "low": known[0] if known else None, "high": known[-1] if known else None, "n_turns": len(set(known)),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        }


_COUNTS = "code string, n_blank long, n_duplicate long, n_truncated long, n_illegal long, low long, high long, n_turns long, first string, last string"


def _pieces(kind: str, arrow_kind: pa.DataType):
    """Sorted turns to rows: whole chats with their result, runs of all other chats with their texts."""
    schema = pa.schema([
        ("some", pa.bool_()), ("conv", arrow_kind), ("part", pa.int32()), ("run", pa.int32()), ("whole", pa.bool_()),
        ("code", pa.string()), ("n_blank", pa.int64()), ("n_duplicate", pa.int64()), ("n_truncated", pa.int64()), ("n_illegal", pa.int64()),
        ("low", pa.int64()), ("high", pa.int64()), ("n_turns", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("keys", pa.list_(pa.binary())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string()),
    ])
    spark_schema = f"some boolean, conv {kind}, part int, run int, whole boolean, {_COUNTS}, keys array<binary>, roles array<string>, texts array<string>, cost long, audit string, repaired string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chat: _Chat | None = None
        whole: list[dict] = []
        part, chars = 0, 0

        def piece() -> pa.RecordBatch:
            row = {"some": chat.some, "conv": chat.conv, "part": part, "run": chat.run, "whole": False, "keys": chat.keys, "roles": chat.roles, "texts": chat.texts}
            out = pa.RecordBatch.from_pylist([row | chat.counts()], schema)
            chat.run, chat.open = chat.run + 1, True
            chat.clear()
            return out

        def solved() -> pa.RecordBatch:
            for row, (cost, audit) in zip(whole, align_chats([row["code"] for row in whole]), strict=True):
                lines, _ = _lines(audit, row.pop("roles"), row.pop("texts"), START)
                row.update(cost=cost, audit=audit, repaired=hashlib.sha256("\n".join(lines).encode()).hexdigest())
            out = pa.RecordBatch.from_pylist(whole, schema)
            whole.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv")
            some = batch.column("some").to_numpy(zero_copy_only=False)
            changes = np.ones(len(some), bool)
            changes[1:] = (some[1:] != some[:-1]) | pc.fill_null(pc.not_equal(conv.slice(1), conv.slice(0, len(conv) - 1)), False).to_numpy(zero_copy_only=False)
            part = batch.column("part")[0].as_py()
            gone, turns, roles, texts, codes = (batch.column(c).to_pylist() for c in ("gone", "turn", "role", "text", "code"))
            starts = np.flatnonzero(changes).tolist()
            for a, b in zip(starts, [*starts[1:], len(some)], strict=True):
                value = conv[a].as_py()
                if chat is None or chat.some != some[a] or chat.conv != value:
                    if chat is not None:
                        if chat.open:
                            yield piece()
                        else:
                            whole.append({"some": chat.some, "conv": chat.conv, "part": part, "run": 0, "whole": True, "roles": chat.roles, "texts": chat.texts} | chat.counts())
                            chars += chat.chars
                            if len(whole) >= TOGETHER or chars > RUN_CHARS:
                                yield solved()
                                chars = 0
                    # The first chat of a part may have begun in the part before.
                    chat = _Chat(bool(some[a]), value, chat is None)
                for k in range(a, b):
                    if not gone[k]:
                        if len(chat.turns) == RUN or chat.chars > RUN_CHARS:
                            yield piece()
                        chat.add(turns[k], roles[k], texts[k], codes[k])
        if chat is not None:  # it may go on in the next part
            yield piece()
        if whole:
            yield solved()

    return run, spark_schema


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`conv, turn, role, text, gone`: turns with the faults that a hash of chat and turn deals out.

    Nulls are read as one space. A dropped turn stays as a row marked `gone`, so that its chat is still known.
    """
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(of(conv), F.lit(":"), of(turn)).cast("binary")) % 20
    given = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), of(role).alias("role"), of(text).alias("text"), fault.alias("fault"))
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")
    return given.select("conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), (F.col("fault") == 0).alias("gone"), copies).drop("copy")


def _code() -> Column:
    solid = F.rtrim(F.col("text"), F.lit(_SPACES))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(F.length(solid) == 0, "b").when(F.right(solid, F.lit(1)).isin(".", "!", "?"), known).otherwise(F.upper(known))


def repair(turns: DataFrame) -> DataFrame:
    """`conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`, one row per chat of `damaged` turns.

    Turns go by `turn` (null first), then role, the first 64 characters of the text and a hash of it.
    The first fault of a turn counts: blank, duplicate (role and text came earlier in the chat), truncated
    (ends without a full stop, exclamation or question mark). Blank and duplicate turns have to be
    deleted; roles count by their initial, others than s, u and a have to be relabelled or deleted.
    A null chat is one chat. Chats without turns, or with dropped ones only, have zeros, an empty audit and the hash of
    an empty text. An empty table gives none.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    order = ["some", "conv", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), "tie"]
    given = turns.select(F.col("conv").isNotNull().alias("some"), "conv", "turn", "role", "text", "gone", _code().alias("code"), F.monotonically_increasing_id().alias("tie"))
    dealt = given.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("part", F.spark_partition_id())
    run, schema = _pieces(kind, to_arrow_type(turns.schema["conv"].dataType))
    found = stage(map_arrow(dealt, run, schema), "chats")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = found.where("whole").select(
        "conv", F.coalesce(F.expr("high - low + 1 - n_turns"), F.lit(0).cast("long")).alias("gaps"), F.col("n_blank").alias("blank"), F.col("n_duplicate").alias("duplicate"),
        F.col("n_truncated").alias("truncated"), F.col("n_illegal").alias("illegal"), "cost", "audit", F.col("repaired").alias("repaired_sha256"),
    )
    return whole.unionByName(_chained(found.where("not whole"), kind).select("conv", *counts))


def _chained(runs: DataFrame, kind: str) -> DataFrame:
    """Results of the chats that lie in several runs, or may do so."""
    at = ["some", "conv", "part", "run"]
    # A turn whose like is in an earlier part: within a part the first stage has marked it.
    keyed = runs.select(*at, F.posexplode("keys").alias("place", "key"), "code").where("substring(code, place + 1, 1) not in ('b', 'd')").drop("code")
    firsts = keyed.groupBy("some", "conv", "key").agg(F.min("part").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    on = F.expr("r.some = l.some and r.conv <=> l.conv and r.part = l.part and r.run = l.run")
    same = F.expr("r.some = l.some and r.conv <=> l.conv and r.key = l.key and r.part > l.least")
    later = keyed.alias("r").join(firsts.alias("l"), same, "left_semi").groupBy(*at).agg(F.collect_list("place").alias("later"))
    joined = runs.alias("r").join(later.alias("l"), on, "left").select("r.*", F.coalesce("l.later", F.array().cast("array<int>")).alias("later"))
    marked = stage(
        joined.withColumn("was", F.col("code"))
        .withColumn("code", F.expr("array_join(transform(split(code, ''), (c, i) -> if(array_contains(later, i), 'd', c)), '')"))
        .withColumn("n_duplicate", F.expr("n_duplicate + size(later)"))
        .withColumn("n_truncated", F.expr("n_truncated - size(filter(later, i -> substring(was, i + 1, 1) in ('S', 'U', 'A', 'O')))"))
        .drop("keys", "later", "was", "whole", "cost", "audit", "repaired"),
        "runs",
    )
    count_names = ["n_blank", "n_duplicate", "n_truncated", "n_illegal", "low", "high", "n_turns", "first", "last"]

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([run_matrix(c) for c in batch.column("code").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*batch.schema.names[:-1], "matrix"])

    costed = map_arrow(marked.select(*at, "code"), matrices, f"some boolean, conv {kind}, part int, run int, matrix array<long>")
    # A chat has a matrix for each part that it reaches into and for every RUN of its turns.
    lists = costed.groupBy("some", "conv").agg(F.reverse(F.sort_array(F.collect_list(F.struct("part", "run", "matrix")))).alias("runs"))

    def rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                rest = [c for c, _ in _CLOSING]
                for r in row["runs"]:
                    out.append({"some": row["some"], "conv": row["conv"], "part": r["part"], "run": r["run"], "rest": rest})
                    rest = [min(_FAR, *(r["matrix"][4 * s + e] + rest[e] for e in range(4))) for s in range(4)]
            yield pa.RecordBatch.from_pylist(out, pa.schema([batch.schema.field("some"), batch.schema.field("conv"), ("part", pa.int32()), ("run", pa.int32()), ("rest", pa.list_(pa.int64()))]))

    rest = map_arrow(lists, rests, f"some boolean, conv {kind}, part int, run int, rest array<long>").alias("l")
    both = marked.alias("r").join(rest, on, "inner").select("r.*", "l.rest")

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at_ in range(0, batch.num_rows, 16):
                rows = batch.slice(at_, 16)
                made = [run_audits(c, v) for c, v in zip(rows.column("code").to_pylist(), rows.column("rest").to_pylist(), strict=True)]
                texts = pa.array([[a for a, _ in m] for m in made], pa.list_(pa.string()))
                ends = pa.array([[e for _, e in m] for m in made], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*rows.columns, texts, ends], [*rows.schema.names, "audits", "ends"])

    columns = f"some boolean, conv {kind}, part int, run int, {_COUNTS}, roles array<string>, texts array<string>, rest array<long>, audits array<string>, ends array<int>"
    solved = map_arrow(both.select("some", "conv", "part", "run", "code", *count_names, "roles", "texts", "rest"), audits, columns)
    in_order = solved.repartition("some", "conv").sortWithinPartitions(*at)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = chat = None

        def done() -> pa.RecordBatch:
            closing = _CLOSING[chat["state"]][1]
            for line in _lines(closing, [], [], chat["state"])[0]:
                say(line)
            row = {k: chat[k] for k in ("some", "conv", "blank", "duplicate", "truncated", "illegal", "cost")}
            gaps = chat["high"] - chat["low"] + 1 - chat["turns"] if chat["turns"] else 0
            return pa.RecordBatch.from_pylist([row | {"gaps": gaps, "audit": "".join(chat["audit"]) + closing, "repaired_sha256": chat["hash"].hexdigest()}], schema)

        def say(line: str) -> None:
            chat["hash"].update((("\n" if chat["lines"] else "") + line).encode())
            chat["lines"] += 1

        for batch in batches:
            longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
            schema = pa.schema([batch.schema.field("some"), batch.schema.field("conv"), *((c, pa.int64()) for c in longs), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if chat is None or (chat["some"], chat["conv"]) != (row["some"], row["conv"]):
                    if chat is not None:
                        yield done()
                    chat = {"some": row["some"], "conv": row["conv"], "state": START, "audit": [], "hash": hashlib.sha256(), "lines": 0, "cost": None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "low": None, "high": None, "turns": 0, "last": None}
                    chat["cost"] = run_cost(row)
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    chat[c] += row[f"n_{c}"]
                if row["first"] is not None:
                    if chat["last"] is not None and chat["last"] + row["first"] not in _LEGAL:
                        chat["illegal"] += 1
                    chat["last"] = row["last"]
                if row["low"] is not None:
                    chat["turns"] += row["n_turns"] - (row["low"] == chat["high"])
                    chat["low"] = row["low"] if chat["low"] is None else chat["low"]
                    chat["high"] = row["high"]
                audit, end = row["audits"][chat["state"]], row["ends"][chat["state"]]
                chat["audit"].append(audit)
                for line in _lines(audit, row["roles"], row["texts"], chat["state"])[0]:
                    say(line)
                chat["state"] = end
        if chat is not None:
            yield done()

    out = f"some boolean, conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return map_arrow(in_order, told, out).drop("some")


def run_cost(row: dict) -> int:
    """Least cost of a chat, from its first run."""
    matrix = run_matrix(row["code"])
    return min(matrix[e] + row["rest"][e] for e in range(4))
