"""Costs that grow with the text: what is computed once, what stays in its row, what blocks hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docketry.operators import topics
from docketry.streaming import jobs


@pytest.fixture
def docs(spark):
    texts = ["a b a c", "b c d", "a a e", "c d e b", ""]
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", F.filter(F.split("text", " "), lambda t: t != "").alias("tokens")).coalesce(1)


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_the_words_of_a_row_are_counted_once(docs, capsys):
    vocab = docs.sparkSession.createDataFrame([("a",), ("b",)], "term string")
    plan = plan_of(topics.bag_of_words(docs, "id", "tokens", vocab), capsys)
    assert plan.count("sort_array(") == 1
    got = {tuple(r) for r in topics.bag_of_words(docs, "id", "tokens", vocab).collect()}
    assert got == {(0, "a", 2), (0, "b", 1), (1, "b", 1), (2, "a", 2), (3, "b", 1)}


def test_topic_counts_leave_the_texts_behind(docs):
    models, counted, vocab = topics.lda_models(docs, "tokens", ks=(2,), passes=1, keep=4)
    assert vocab == ["a", "b", "c", "d"]  # by count, then by word
    assert counted.columns == ["id", "counts"]
    assert models[2].vocabSize() == 4
    again, same, words = topics.lda_models(docs, "tokens", ks=(3,), passes=1, keep=4, counted=(counted, vocab))
    assert same is counted and words is vocab
    assert again[3].vocabSize() == 4


def test_blocks_grow_with_the_weights_and_the_error_is_that_of_the_model(spark, monkeypatch):
    monkeypatch.setattr(topics, "BLOCK_WEIGHTS", 2)
    rows = [(d, f"t{t}", 0.1 * (d % 3 + 1) * (t % 2 + 1)) for d in range(8) for t in range(4)]
    weights = spark.createDataFrame(rows, "id int, term string, weight double").coalesce(1)
    model, rated, _ = topics.nmf_model(weights, "id", 2, iterations=2)
    assert topics.nmf_blocks(rated) == 16
    error = spark.range(1).select(topics.nmf_error(model, rated)).first()[0]
    want = model.transform(rated).agg(F.sum(F.pow(F.col("weight") - F.col("prediction"), 2))).first()[0]
    assert error == pytest.approx(want, abs=1e-6)


def test_calls_meet_cases_by_key_and_day(spark, tmp_path, capsys):
    for name in ("calls", "cases"):
        spark.createDataFrame([], f"k int, {name}_at timestamp").write.parquet(f"{tmp_path}/{name}")
    calls, cases = (jobs.file_stream(spark, f"{tmp_path}/{n}", f"k int, {n}_at timestamp") for n in ("calls", "cases"))
    plan = plan_of(jobs.join_day_before(calls, cases, "k", "calls_at", "cases_at", "1 hour"), capsys)
    join = next(line for line in plan.splitlines() if "StreamingSymmetricHashJoin" in line)
    assert "_asked" in join and "_day" in join


def test_phrases_by_passes_are_the_same_and_rare_pairs_are_not_kept(docs, monkeypatch):
    from docketry.session import stage

    kept = {}
    monkeypatch.setattr(topics, "stage", lambda df, name, *how: kept.setdefault(f"{name} {len(kept)}", stage(df, name, *how)))
    twice = docs.unionAll(docs.withColumn("id", F.col("id") + 10))
    one, many = (topics.phrases(twice, "tokens", 4, 0.0, passes) for passes in (1, 3))
    want = {("c", "d"): (4, 0.0)}
    counts = [df for name, df in kept.items() if name.startswith("phrase-counts")]
    assert len(counts) == 4
    assert {tuple(r) for r in counts[0].filter("b is not null").collect()} == {(a, b, n) for (a, b), (n, _) in want.items()}
    one, many = (topics.phrases(twice, "tokens", 2, 0.0, passes) for passes in (1, 3))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) == [("c", "d", 4, 1.166667)]
    merged = [topics.apply_phrases(twice, one, "id", "tokens", passes=passes).orderBy("id").collect() for passes in (1, 3)]
    assert merged[0] == merged[1]
    assert merged[0][1]["tokens"] == ["b", "c_d"]
    monkeypatch.setattr(topics, "PASS_TOKENS", 9)
    assert topics.phrase_passes(twice, "tokens") == 4
    assert topics.phrase_passes(docs.limit(0), "tokens") == 1
