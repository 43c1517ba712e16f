"""What a staged result leaves on disk."""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from docketry import session
from docketry.llm.compact_windows import passages


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_the_shuffle_files_of_a_staged_result_go(spark):
    before = shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    kept = session.stage(counts, "counts")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert {r["k"] for r in kept.collect()} == {r["k"] for r in counts.collect()} == set(range(7))
    assert spark.conf.get(session.CLEAR_SHUFFLES) == "false"


def test_unstaged_results_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    one, two = (session.stage(spark.range(3), n) for n in ("one", "two"))
    session.unstage(one)
    assert os.listdir(tmp_path) == ["two"]
    assert two.count() == 3


def test_passages_leave_no_windows_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    text = " ".join(f"w{i * i % 997}" for i in range(80))
    docs = spark.createDataFrame([(n, f"{'x ' * n}{text}") for n in range(4)], "doc_id long, text string").coalesce(1)
    found = passages(docs)
    assert sorted(os.listdir(tmp_path)) == ["passage-keys", "passage-pairs", "passages", "wanted-windows"]
    assert {r["doc_id"] for r in found.collect()} == {0, 1, 2, 3}


def test_a_factorization_keeps_no_tokens_and_clears_its_messages(spark, tmp_path, monkeypatch):
    from docketry.catalog.topics import nmf_weights
    from docketry.operators import topics

    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    given, als = {}, topics.ALS
    monkeypatch.setattr(topics, "ALS", lambda **how: given.update(how) or als(**how))
    texts = ["red green green", "red blue", "green blue blue"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/in/documents.parquet")
    weights = nmf_weights(spark, f"{tmp_path}/in")
    assert not os.path.exists(f"{tmp_path}/tokens")
    assert {(r["doc_id"], r["term"]) for r in weights.collect()} == {(0, "red"), (0, "green"), (1, "red"), (1, "blue"), (2, "green"), (2, "blue")}
    monkeypatch.undo()
    monkeypatch.setattr(topics, "ALS", lambda **how: given.update(how) or als(**how))
    model, *numbered = topics.nmf_model(weights, "doc_id", 2, iterations=1)
    assert model.rank == 2 and given["checkpointInterval"] == 1
    again, rated, _ = topics.nmf_model(weights, "doc_id", 1, iterations=1, numbered=numbered)
    assert again.rank == 1 and rated is numbered[0]
