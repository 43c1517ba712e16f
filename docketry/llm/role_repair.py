"""Chats brought into a legal order of roles at the least cost, and rendered.

A legal chat is an optional system turn, then user and assistant in turn, ending with assistant. A
dynamic program over this automaton chooses for every turn to keep it, relabel it, join it to the
turn before, or put empty turns before it. Turns are dealt out in sorted runs; a run of a long chat
is summed up as a matrix of least costs between states, the matrices of a chat are chained, and
each run then makes its own choices between the states it was given. No chat is held in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.workers import send_package
from docketry.session import stage

SYSTEM, USER, ASSISTANT = "system", "user", "assistant"
ROLES = (SYSTEM, USER, ASSISTANT)
#: States: nothing yet, and the role that spoke last.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = {(START, SYSTEM): AFTER_SYSTEM, (START, USER): AFTER_USER, (AFTER_SYSTEM, USER): AFTER_USER, (AFTER_USER, ASSISTANT): AFTER_ASSISTANT, (AFTER_ASSISTANT, USER): AFTER_USER}
COSTS = {"merge": 1, "relabel": 2, "insert": 3}
#: A run of turns that one step works on.
RUN = 512
_FAR = 1 << 40


def _moves(role: str | None, costs: dict[str, int]) -> list[list[tuple[int, int, str, str, str]]]:
    """From each state: (cost, next state, action, role it gets, roles put before it), cheapest first.

    A role other than the three, or null, has to be relabelled, and joined only as that.
    """
    out = []
    for state in range(4):
        options = []
        ways = [(0, state, "")]
        for _ in range(2):  # at most two empty turns lead from any state to any turn
            ways += [(c + costs["insert"], _NEXT[s, r], f"{before},{r}" if before else r) for c, s, before in ways for r in ROLES if (s, r) in _NEXT]
        for cost, s, before in dict.fromkeys(ways):
            for r in ROLES:
                if (s, r) in _NEXT:
                    options.append((cost + (0 if r == role else costs["relabel"]), _NEXT[s, r], "keep" if r == role else "relabel", r, before))
        if state != START:
            own = ROLES[state - 1]
            options.append((costs["merge"] + (0 if own == role else costs["relabel"]), state, "merge", own, ""))
        best: dict[int, tuple] = {}
        for o in sorted(options, key=lambda o: (o[0], ("keep", "merge", "relabel").index(o[2]), len(o[4]), o[3], o[4])):
            best.setdefault(o[1], o)
        out.append(list(best.values()))
    return out


def _closing(costs: dict[str, int]) -> dict[int, tuple[int, str]]:
    """What it costs to end in a state, and the empty turns that are put at the end."""
    return {AFTER_ASSISTANT: (0, ""), AFTER_USER: (costs["insert"], ASSISTANT), AFTER_SYSTEM: (2 * costs["insert"], f"{USER},{ASSISTANT}")}


class _Program:
    def __init__(self, costs: dict[str, int]):
        self.costs = costs
        self.known: dict[str | None, list] = {}

    def moves(self, role: str | None) -> list:
        role = role if role in ROLES else None
        if role not in self.known:
            self.known[role] = _moves(role, self.costs)
        return self.known[role]

    def forward(self, roles: list, start: int) -> tuple[list[int], list[dict[int, tuple]]]:
        """Least cost of each state after all turns, and for each turn how each state was reached."""
        cost = [_FAR] * 4
        cost[start] = 0
        back = []
        for role in roles:
            moves = self.moves(role)
            best: dict[int, tuple] = {}
            for s in range(4):
                if cost[s] < _FAR:
                    for m in moves[s]:
                        c = cost[s] + m[0]
                        if m[1] not in best or c < best[m[1]][0]:
                            best[m[1]] = (c, s, m)
            cost = [best[s][0] if s in best else _FAR for s in range(4)]
            back.append(best)
        return cost, back

    def choices(self, roles: list, start: int, end: int) -> list[tuple]:
        _, back = self.forward(roles, start)
        out = []
        for best in reversed(back):
            _, before, move = best[end]
            out.append(move)
            end = before
        return out[::-1]


def _runs_of(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of equal keys together, from sorted frames; a run never exceeds RUN rows."""
    held: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if frame.empty:
            continue
        codes = frame[keys].apply(tuple, axis=1)
        cut = np.flatnonzero((codes != codes.shift()).to_numpy())
        for a, b in zip(cut, [*cut[1:], len(frame)], strict=True):
            if codes.iloc[a] != last and held:
                yield pd.concat(held)
                held = []
            last = codes.iloc[a]
            held.append(frame.iloc[a:b])
    if held:
        yield pd.concat(held)


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: dict[str, int] | None = None) -> DataFrame:
    """Every turn with what was done to it: `conv, part, place, turn, role, new_role, action, before, after, rendered`.

    `action` is keep, relabel or merge; `before` and `after` list the roles of empty turns put there
    (`after` at the end of a chat only). `rendered` is the turn's piece of the chat: all pieces of a
    chat joined in the order of part and place are its text. Costs are added up, the least total
    wins, and among equal ones keep goes before merge before relabel. Turns are ordered by `turn`
    (null first), then role and text; repeated rows are turns of their own. A null conv is one
    chat. Null texts are empty; roles other than system, user and assistant count as unknown.
    """
    costs = COSTS | (costs or {})
    send_package(turns.sparkSession)
    kind = turns.schema[conv].dataType.simpleString()
    given = turns.select(F.struct(F.col(conv).isNotNull().alias("some"), F.col(conv).alias("c")).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", "turn", "role", "text", "tie"]
    # Written once, so that the dealing and the ties are the same for all that follows.
    dealt = stage(given.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("conv.c").alias("conv"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"), "turn", "role", "text"), "turns")
    # A run is a stretch of one chat within one part, cut every RUN places.
    numbered = dealt.withColumn("run", F.floor(F.col("place") % (1 << 33) / RUN))
    keys = ["conv", "part", "run"]

    narrow = numbered.select(F.col("conv").isNotNull().alias("some"), F.coalesce("conv", F.lit(0).cast(kind)).alias("conv"), "part", "run", "place", "role")
    narrow = narrow.repartition("some", *keys).sortWithinPartitions("some", *keys, "place")

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = _Program(costs)
        for rows in _runs_of(frames, ["some", *keys]):
            roles = rows["role"].tolist()
            first = rows.iloc[0]
            yield pd.DataFrame([{"some": first["some"], "conv": first["conv"], "part": first["part"], "run": first["run"], "matrix": [c for s in range(4) for c in program.forward(roles, s)[0]]}])

    matrices = narrow.mapInPandas(summed, f"some boolean, conv {kind}, part int, run long, matrix array<long>")
    # A chat has a run or two for each part that it reaches into, and one for every RUN turns.
    chains = matrices.groupBy("some", "conv").agg(F.sort_array(F.collect_list(F.struct("part", "run", "matrix"))).alias("runs"))

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        close = _closing(costs)
        for frame in frames:
            out = []
            for some, c, runs in zip(frame["some"], frame["conv"], frame["runs"], strict=True):
                cost, back = [0, _FAR, _FAR, _FAR], []
                for r in runs:
                    m = np.array(r["matrix"]).reshape(4, 4) + np.array(cost)[:, None]
                    back.append(m.argmin(axis=0))
                    cost = np.minimum(m.min(axis=0), _FAR).tolist()
                end = min(close, key=lambda s: (cost[s] + close[s][0], s))
                total, after = cost[end] + close[end][0], close[end][1]
                for k in range(len(runs) - 1, -1, -1):
                    start = int(back[k][end])
                    out.append((some, c, runs[k]["part"], runs[k]["run"], start, end, after if k == len(runs) - 1 else "", total))
                    end = start
            yield pd.DataFrame(out, columns=["some", "conv", "part", "run", "start", "end", "close", "total"])

    states = stage(chains.mapInPandas(chain, f"some boolean, conv {kind}, part int, run long, start int, end int, close string, total long"), "states")

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        program = _Program(costs)
        for rows in _runs_of(frames, ["some", *keys]):
            moves = program.choices(rows["role"].tolist(), int(rows["start"].iloc[0]), int(rows["end"].iloc[0]))
            out = rows[["some", "conv", "part", "place", "turn", "role", "text", "total"]].copy()
            out["action"], out["new_role"], out["before"] = ([m[k] for m in moves] for k in (2, 3, 4))
            out["after"] = [""] * (len(rows) - 1) + [rows["close"].iloc[0]]
            yield out

    wide = numbered.select(F.col("conv").isNotNull().alias("some"), F.coalesce("conv", F.lit(0).cast(kind)).alias("conv"), "part", "run", "place", "turn", "role", "text")
    joined = wide.join(states, ["some", *keys]).repartition("some", *keys).sortWithinPartitions("some", *keys, "place")
    chosen = joined.mapInPandas(choose, f"some boolean, conv {kind}, part int, place long, turn long, role string, text string, total long, action string, new_role string, before string, after string")
    empties = lambda c: F.array_join(F.transform(F.filter(F.split(c, ","), lambda r: r != ""), lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n\n"))), "")
    # A piece opens its own turn and is closed by the next piece that isn't joined to it.
    own = F.when(F.col("action") == "merge", F.concat(F.lit("\n"), "text")).otherwise(F.concat(empties("before"), F.lit("<|"), F.col("new_role"), F.lit("|>\n"), F.col("text")))
    piece = F.concat(F.when((F.col("action") != "merge"), F.lit("\n")).otherwise(""), own, F.when(F.col("after") == "", "").otherwise(F.concat(F.lit("\n"), empties("after"))))
    return chosen.select(F.when(F.col("some"), F.col("conv")).alias(conv), "part", "place", F.col("turn").alias(turn), F.col("role").alias(role), "new_role", "action", "before", "after", "total", piece.alias("rendered"))


def rendered(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """`conv, part, n_turns, n_merged, n_relabelled, n_inserted, cost, chat` per chat and part.

    A chat within one part is one row; a longer one has a row for each of its parts, whose texts
    joined in the order of `part` are the chat. `cost` is that of the whole chat.
    """
    roles = lambda c: F.size(F.filter(F.split(c, ","), lambda r: r != ""))
    count = lambda a: F.sum((F.col("action") == a).cast("long"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "rendered"))), lambda x: x["rendered"]), "")
    return repaired.groupBy(conv, "part").agg(
        F.count("*").alias("n_turns"), count("merge").alias("n_merged"), count("relabel").alias("n_relabelled"), F.sum(roles("before") + roles("after")).cast("long").alias("n_inserted"), F.max("total").alias("cost"), text.alias("chat")
    )
