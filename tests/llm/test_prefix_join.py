from __future__ import annotations

import random

from helpers import DOC, ODD, classes, documents, prose, shingles

from docketry.llm import prefix_join


def corpus(seed):
    rng = random.Random(seed)
    texts = list(ODD)
    line = prose(rng, 30)
    for _ in range(6):
        base = prose(rng, rng.choice([8, 40, 150])).split()
        for _ in range(rng.choice([2, 5, 9])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 25)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            texts.append(" ".join(copy[: len(copy) - rng.randrange(4)]))
    texts += [line + " " + prose(rng, 60) for _ in range(12)]
    # A chain: neighbours are similar, the ends are not.
    row = prose(rng, 200).split()
    texts += [" ".join(row[5 * i : 120 + 5 * i]).upper() for i in range(12)]
    rng.shuffle(texts)
    return texts


def expected(texts):
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = classes(range(len(sets)), links)
    return {i: (len(sets[i]), label[i]) for i in range(len(sets))}


def test_links_of_all_pairs(spark):
    for seed in (1, 2, 3):
        texts = corpus(seed)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.near_duplicates(documents(spark, texts)).collect()}
        assert got == expected(texts)


def test_a_large_family_writes_few_pairs(spark, monkeypatch):
    """Near copies that the pivot does not link with each other, long ones that share a passage, and blocks of few rows."""
    rng = random.Random(9)
    base = prose(rng, 130, 3000).split()
    texts = []
    for _ in range(150):
        copy = list(base)
        for at in rng.sample(range(130), rng.randrange(1, 5)):
            copy[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    passage = prose(rng, 700, 9000)
    texts += [f"{passage} {prose(rng, 800, 9000)}" for _ in range(60)]
    want = expected(texts)
    written = []
    across = prefix_join._across

    def counted(rows, percent, closest):
        found = across(rows, percent, closest)
        written.append(found.count())
        return found

    monkeypatch.setattr(prefix_join, "_across", counted)
    for rounds in (0, 3):
        monkeypatch.setattr(prefix_join, "ROUNDS", rounds)
        written.clear()
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.near_duplicates(documents(spark, texts)).collect()}
        assert got == want
        if rounds:
            assert sum(written) < 20 * len(texts)


def test_repeated_rows_null_keys_and_clashing_columns(spark):
    text = prose(random.Random(4), 50)
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", "b", 1), (None, text, "en", "b", 1), (None, None, "en", "b", 1), (3, "", None, None, None)]
    docs = spark.createDataFrame(rows, DOC).withColumnRenamed("n_chars", "n").withColumnRenamed("lang", "unit").withColumnRenamed("source", "component_id")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in prefix_join.near_duplicates(docs).collect())
    assert got == [(0, 0, None), (0, 46, None), (1, 46, 1), (1, 46, 1), (2, 46, 1), (3, 0, 3)]
    kept = prefix_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3]


def test_empty_table(spark):
    assert prefix_join.near_duplicates(spark.createDataFrame([], DOC)).collect() == []
    assert prefix_join.keep_one(spark.createDataFrame([], DOC)).collect() == []
