from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import values
from docketry.operators import topics, training

WORDS = ["new", "york", "city", "hall", "a", "b", "c", "d"]


def token_docs(n=60, seed=5):
    rng = random.Random(seed)
    docs = []
    for _ in range(n):
        doc = []
        for _ in range(rng.randint(0, 12)):
            doc += ["new", "york", "new", "york"] if rng.random() < 0.2 else [rng.choice(WORDS)]
        docs.append(doc)
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(token_docs())), "id int, tokens array<string>").cache()


def phrases_by_hand(docs, minimum, threshold):
    single = Counter(t for d in docs for t in d)
    pair = Counter(p for d in docs for p in zip(d, d[1:]))
    size = len(single) + len(pair)
    score = {p: (n - minimum) / single[p[0]] / single[p[1]] * size for p, n in pair.items() if n >= minimum}
    return {p for p, s in score.items() if round(s, 6) > threshold}


def merge_by_hand(doc, phrases):
    out, i = [], 0
    while i < len(doc):
        if i + 1 < len(doc) and (doc[i], doc[i + 1]) in phrases:
            out.append(f"{doc[i]}_{doc[i + 1]}")
            i += 2
        else:
            out.append(doc[i])
            i += 1
    return out


def test_phrases_and_merging(docs):
    found = topics.phrases(docs, "tokens", 3, 0.3)
    want = phrases_by_hand(token_docs(), 3, 0.3)
    assert {(r.a, r.b) for r in found.collect()} == want and want
    merged = values(topics.apply_phrases(docs, found, "id", "tokens"), "tokens")
    assert merged == [merge_by_hand(d, want) for d in token_docs()]


def test_term_counts(docs):
    got = values(docs.withColumn("c", topics.term_counts(F.col("tokens"))), "c")
    assert [Counter({r.term: r.n for r in c or []}) for c in got] == [Counter(d) for d in token_docs()]


def test_tfidf_rows_sum_to_one(docs):
    rows = topics.tfidf(docs, "id", "tokens").collect()
    data = token_docs()
    df = Counter(t for d in data for t in set(d))
    idf = {t: math.log(len(data) / n) + 1 for t, n in df.items()}
    for r in rows:
        counts = Counter(data[r.id])
        want = counts[r.term] * idf[r.term] / sum(n * idf[t] for t, n in counts.items())
        assert abs(r.weight - want) < 1e-8


def test_vocabulary_limits(docs):
    got = {r.term: r.df for r in topics.vocabulary(docs, "tokens", min_df=2, max_df=0.5).collect()}
    df = Counter(t for d in token_docs() for t in set(d))
    assert got == {t: n for t, n in df.items() if 2 <= n <= 30}


def test_coherence(spark, docs):
    topic = spark.createDataFrame([(0, "new", 1), (0, "york", 2), (0, "d", 3)], "topic int, term string, rank int")
    row = topics.coherence(docs, "id", "tokens", topic).first()
    sets, n = [set(d) for d in token_docs()], 60
    count = lambda *ws: sum(all(w in s for w in ws) for s in sets)
    pairs = [("new", "york"), ("new", "d"), ("york", "d")]
    npmi = [math.log(count(a, b) * n / count(a) / count(b)) / -math.log(count(a, b) / n) for a, b in pairs]
    umass = [math.log((count(a, b) + 1) / count(a)) for a, b in pairs]
    assert abs(row.npmi - sum(npmi) / 3) < 1e-6 and abs(row.umass - sum(umass) / 3) < 1e-6


def test_cleaning(spark):
    df = spark.createDataFrame([(0, "Don't  panic: 42 CAFÉS, I'm\tfine!")], "id int, text string")
    assert values(df.withColumn("t", topics.tokenize(F.col("text"))), "t") == [["do", "not", "panic", "cafes", "i", "am", "fine"]]


def test_oversampling_finds_exact_neighbours(spark):
    rng = random.Random(2)
    flags = ["f0", "f1", "f2", "f3"]
    rows = [(i, *[int(rng.random() < 0.3) for _ in flags]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, f0 int, f1 int, f2 int, f3 int")
    made = training.oversample(df, flags, "id", copies=3, k=5).collect()
    assert len(made) == 120
    by_id = {r[0]: r[1:] for r in rows}
    for m in made:
        own, new = by_id[m.id], tuple(m[f] for f in flags)
        steps = {round(abs(n - o), 6) for n, o in zip(new, own)} - {0.0}
        assert len(steps) <= 1  # one step along the line to one neighbour
        moved = sum(n != o for n, o in zip(new, own))
        nearest = sorted(sum(a != b for a, b in zip(own, other)) for i, other in by_id.items() if i != m.id)[:5]
        assert moved <= nearest[-1]


def test_weighted_patterns_fit_like_rows(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        a, b = int(rng.random() < 0.5), int(rng.random() < 0.3)
        rows.append((i, a, b, int(rng.random() < 0.2 + 0.5 * a)))
    df = spark.createDataFrame(rows, "id int, a int, b int, label int")
    from_rows = training.fit_risk_model(df.withColumn("weight", F.lit(1.0)), ["a", "b"]).stages[-1]
    from_patterns = training.fit_risk_model(training.patterns(df, ["a", "b"]), ["a", "b"]).stages[-1]
    assert max(abs(x - y) for x, y in zip(from_rows.coefficients, from_patterns.coefficients)) < 1e-3


def test_sampling_is_repeatable_and_splits_are_disjoint(spark):
    df = spark.range(5000).toDF("id")
    first = {r.id for r in training.sample_fraction(df, 0.07, "id").collect()}
    again = {r.id for r in training.sample_fraction(df.repartition(7), 0.07, "id").collect()}
    assert first == again and 250 < len(first) < 450
    share = training.add_split(df, "id").filter("is_train").count() / 5000
    assert abs(share - 0.8) < 0.03
