from __future__ import annotations

import itertools
import random

from docketry.operators import neighbours


def expected(rows, n_flags, k):
    counts = {}
    for row in rows:
        counts[row] = counts.get(row, 0) + 1
    out = {}
    for p in counts:
        near = []
        for q, n in counts.items():
            n -= p == q
            if n:
                d = sum((a - b) ** 2 for a, b in zip(p, q, strict=True))
                near.append((round(d, 9), "".join(str(f) for f in reversed(q[:n_flags])), q[n_flags:], n))
        told, upto = [], 0
        for _, bits, numbers, n in sorted(near):
            if upto >= k:
                break
            upto += n
            told.append((bits, numbers, upto))
        out["".join(str(f) for f in reversed(p[:n_flags])), p[n_flags:]] = told
    return out


def check(spark, rows, n_flags, n_numbers, k):
    flags, numbers = [f"f{i}" for i in range(n_flags)], [f"x{i}" for i in range(n_numbers)]
    df = spark.createDataFrame(rows, ", ".join([*[f"{f} int" for f in flags], *[f"{x} double" for x in numbers]]))
    got = {(r.bits, tuple(r[x] for x in numbers)): [(x.near_bits, tuple(x.near_numbers), x.upto) for x in r.reach] for r in neighbours.nearest(df, flags, numbers, k).collect()}
    want = expected(rows, n_flags, k)
    assert {p: r for p, r in want.items() if r} == {p: r for p, r in got.items() if r}


def test_nearest_of_flags_and_numbers(spark):
    rng = random.Random(5)
    crowd = [(*[0] * 17, round(rng.random() / 50, 4), 0.5) for _ in range(30)]
    spread = [(*[int(rng.random() < 0.3) for _ in range(17)], round(rng.random() * 3, 2), round(rng.random(), 2)) for _ in range(60)]
    check(spark, crowd + spread + spread[:5], 17, 2, 5)


def test_nearest_of_very_many_flags_only(spark):
    rng = random.Random(6)
    rows = [tuple(int(rng.random() < 0.1) for _ in range(70)) for _ in range(40)]
    check(spark, rows + rows[:3] * 2, 70, 0, 3)


def test_fewer_rows_than_neighbours(spark):
    check(spark, [(0, 1, 0.5), (1, 1, 9.0), (1, 1, 9.0)], 2, 1, 5)


def test_segments_meet_whatever_differs():
    for n, r in ((7, 2), (20, 3), (5, 4)):
        cuts = neighbours._segments(n, r)
        for flips in itertools.combinations(range(n), r):
            assert any(all(not a - 1 <= f < a - 1 + m for f in flips) for a, m in cuts)


def test_exploded_sides_are_sent_to_all_tasks_only_by_their_rows(spark, capsys):
    """By their files both sides would be small enough; with segments and cells they are not."""
    points = neighbours.patterns(spark.range(200).selectExpr("cast(id % 2 AS int) AS a", "cast(id % 3 = 0 AS int) AS b", "id / 200 AS x"), ["a", "b"], ["x"])
    for asked, sent in ((200, True), (neighbours.FEW, False)):
        neighbours._met(points, asked, points, ["x"], 2, 1.0).explain()
        assert ("BroadcastHashJoin" in capsys.readouterr().out) == sent
