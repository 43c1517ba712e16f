from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from docketry.operators import coherence, topic_levels, training
from docketry.streaming import jobs


def test_patterns_in_folders_label_all_levels(spark, tmp_path):
    for name, lines in {"a/b c/x": "one\n# no\n\n tw[o0] \n", "a/y": "three", "a": "zero", "d": "nothing"}.items():
        path = tmp_path / "levels" / f"{name}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(lines)
    patterns = topic_levels.read_patterns(spark, str(tmp_path / "levels"))
    assert {(r.node, r.pattern) for r in patterns.collect()} == {("a/b c/x", "one"), ("a/b c/x", "tw[o0]"), ("a/y", "three"), ("a", "zero"), ("d", "nothing")}
    docs = spark.createDataFrame([(1, "tw0 three"), (2, "zero"), (3, "no match"), (4, None), (5, "one")], "id int, t string")
    got = {(r.id, r.level, r.topic) for r in topic_levels.label_levels(docs, ["id"], "t", patterns).collect()}
    assert got == {(1, 1, "a"), (1, 2, "a/b c"), (1, 3, "a/b c/x"), (1, 2, "a/y"), (2, 1, "a"), (5, 1, "a"), (5, 2, "a/b c"), (5, 3, "a/b c/x")}
    assert topic_levels.label_levels(docs, ["id"], "t", patterns.limit(0)).count() == 0


def by_windows(texts, topics, size):
    seen, total = [], 0
    for tokens in texts:
        for at in range(max(1, len(tokens) - size + 1)) if tokens else ():
            seen.append(set(tokens[at : at + size]))
            total += 1
    share = lambda *w: sum(set(w) <= s for s in seen) / total
    out = {}
    for topic, words in topics.items():
        v = {(a, b): math.log((share(a, b) + 1e-12) / (share(a) * share(b))) / -math.log(share(a, b) + 1e-12) if share(a) and share(b) else 0 for a in words for b in words}
        s = {b: sum(v[a, b] for a in words) for b in words}
        cos = lambda a: sum(v[a, b] * s[b] for b in words) / math.sqrt(sum(v[a, b] ** 2 for b in words) * sum(x * x for x in s.values())) if any(v[a, b] for b in words) else 0
        out[topic] = sum(map(cos, words)) / len(words)
    return out


def test_c_v_equals_listed_windows(spark, monkeypatch):
    monkeypatch.setattr(coherence, "BLOCK", 7)
    rng = random.Random(1)
    texts = [[rng.choice("abcdefgh") for _ in range(n)] for n in (0, 1, 3, 5, 6, 40, 90)] + [["a"] * 30, ["q", "r"] * 9]
    topics = {"0": ["a", "b", "c"], "1": ["a", "d", "z"], "2": ["e", "q"]}
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, tokens array<string>")
    words = spark.createDataFrame([(t, w, i) for t, ws in topics.items() for i, w in enumerate(ws, 1)], "topic string, term string, rank int")
    for size in (1, 5, 110):
        got = {r.topic: r.c_v for r in coherence.coherence_cv(docs, "id", "tokens", words, size=size).collect()}
        want = by_windows(texts, topics, size)
        assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-5 for t in want), size


def test_open_days_are_read_by_partition(spark, tmp_path):
    rows = [(i, dt.date(2024, 1 + i % 3, 1 + i % 5), "text") for i in range(60)] + [(99, None, "text")]
    docs = spark.createDataFrame(rows, "id int, day date, text string").withColumn("month", F.trunc("day", "month"))
    docs.write.partitionBy("month").parquet(f"{tmp_path}/docs")
    done = docs.filter("month <> date'2024-02-01' OR dayofmonth(day) = 1").select("day")
    left = training.unscored(spark.read.parquet(f"{tmp_path}/docs"), done, "day", "month")
    want = [r[0] for r in rows if r[1] is None or (r[1].month == 2 and r[1].day != 1)]
    assert sorted(r.id for r in left.collect()) == sorted(want)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_calls_meet_cases_of_two_days_and_state_is_dropped(spark, tmp_path):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    calls = [[(1, 10, at(2, 23))], [(2, 11, at(3, 0))], [(1, 12, at(9, 12))], [(1, 13, at(2, 23)), (1, 14, at(12, 1))]]
    cases = [[(1, 20, at(1, 0)), (1, 21, at(2, 23)), (2, 22, at(2, 0)), (2, 23, at(1, 23))], [(1, 24, at(3, 1))], [(1, 25, at(9, 23)), (1, 26, at(10, 0))], [(1, 27, at(12, 0))]]
    for name, batches in (("calls", calls), ("cases", cases)):
        for rows in batches:
            spark.createDataFrame(rows, f"k int, {name}_id int, {name}_at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    streams = [jobs.file_stream(spark, f"{tmp_path}/{n}", f"k int, {n}_id int, {n}_at timestamp", per_trigger=1) for n in ("calls", "cases")]
    query = jobs.append_files(jobs.join_day_before(*streams, "k", "calls_at", "cases_at", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {(r.calls_id, r.cases_id) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(10, 20), (10, 21), (11, 22), (12, 25), (14, 27)}  # call 13 comes eight days late
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 5
