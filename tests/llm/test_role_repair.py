from __future__ import annotations

import itertools
import random

from docketry.llm import role_repair as rr

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(roles, costs):
    """Least cost over all legal chats, by trying what every turn can become."""
    legal = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    states = {"": 0}  # by the role that spoke last
    for role in roles:
        for _ in range(3):
            for last, cost in list(states.items()):
                for r in legal[last]:
                    if cost + costs["insert"] < states.get(r, 1 << 30):
                        states[r] = cost + costs["insert"]
        after = {}
        for last, cost in states.items():
            options = [(r, 0) for r in legal[last]] + ([(last, costs["merge"])] if last else [])
            for r, more in options:
                c = cost + more + (0 if r == role else costs["relabel"])
                after[r] = min(after.get(r, 1 << 30), c)
        # An empty turn put after a turn is one put before the next.
        states = after
    return min(states.get("assistant", 1 << 30), states.get("user", 1 << 30) + costs["insert"], states.get("system", 1 << 30) + 2 * costs["insert"])


def chats():
    rng = random.Random(6)
    out = [list(x) for n in (1, 2, 3) for x in itertools.product(["system", "user", "assistant", "tool"], repeat=n)]
    out += [[rng.choice(["system", "user", "assistant", "user", "assistant", None]) for _ in range(rng.randrange(4, 60))] for _ in range(40)]
    return out


def check(text):
    roles = [line[2:-2] for line in text.split("\n") if line.startswith("<|")]
    body = roles[1:] if roles[0] == "system" else roles
    assert body and len(body) % 2 == 0 and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(body)), roles
    return roles


def test_least_cost_and_legal_text(spark, monkeypatch):
    for run, costs in ((512, rr.COSTS), (3, {"merge": 2, "relabel": 5, "insert": 3})):
        monkeypatch.setattr(rr, "RUN", run)
        given = chats()
        rows = [(c, t, role, f"t{t}.") for c, roles in enumerate(given) for t, role in enumerate(roles)]
        random.Random(1).shuffle(rows)
        repaired = rr.repair(spark.createDataFrame(rows, TURNS).repartition(5), costs=costs)
        parts = {}
        for r in rr.rendered(repaired).collect():
            parts.setdefault(r.conv_id, []).append(r)
        assert len(parts) == len(given)
        for c, roles in enumerate(given):
            own = sorted(parts[c], key=lambda r: r.part)
            text = "".join(r.chat for r in own)
            check(text)
            assert [w for w in text.split() if w.startswith("t")] == [f"t{t}." for t in range(len(roles))]
            assert {r.cost for r in own} == {cheapest(roles, costs)}


def test_odd_rows(spark):
    rows = [(None, 0, "user", None), (None, None, None, "x"), (1, 0, "user", "same"), (1, 0, "user", "same"), (1, 1, "assistant", ""), (0, 1, "user", "zero")]
    got = {r.conv_id: (r.n_turns, r.n_merged, r.n_relabelled, r.n_inserted, r.chat) for r in rr.rendered(rr.repair(spark.createDataFrame(rows, TURNS))).collect()}
    assert got[1] == (3, 1, 0, 0, "\n<|user|>\nsame\nsame\n<|assistant|>\n")
    assert got[0][:4] == (1, 0, 0, 1)
    assert set(got) == {None, 0, 1}
    assert rr.rendered(rr.repair(spark.createDataFrame([], TURNS))).collect() == []
    extra = spark.createDataFrame([(*r, "a", 1) for r in rows], TURNS + ", part string, cost int")
    assert rr.rendered(rr.repair(extra)).count() == 3


def test_a_chat_over_many_parts(spark):
    rows = [(7, t, ("user", "user", "assistant")[t % 3], f"t{t}.") for t in range(5000)] + [(c, 0, "user", "a") for c in range(6)]
    out = rr.rendered(rr.repair(spark.createDataFrame(rows, TURNS).repartition(6))).where("conv_id = 7").orderBy("part").collect()
    text = "".join(r.chat for r in out)
    check(text)
    assert [w for w in text.split() if w.startswith("t")] == [f"t{t}." for t in range(5000)]
    assert sum(r.n_turns for r in out) == 5000
