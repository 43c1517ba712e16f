from __future__ import annotations

import numpy as np
from helpers import classes

from docketry.llm import sign_hashing

VEC = "vec_id long, embedding array<float>, label int"


def cloud(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        centre = rng.standard_normal(dim)
        for _ in range(rng.choice([1, 1, 2, 6, 40])):
            out.append((centre + rng.standard_normal(dim) * rng.choice([0.0, 0.1, 0.35])).astype(np.float32) * rng.choice([1, 3]))
    return np.array(out[:n], np.float32)


def expected(rows):
    good = {i: np.array(v, np.float64) for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    label = classes(range(len(rows)), links)
    return [(sum(i in x for x in links), rows[label[i]][0], label[i] == i) for i in range(len(rows))], len(links)


def test_all_pairs(spark, monkeypatch):
    for seed, block in ((1, 1000), (2, 7)):
        monkeypatch.setattr(sign_hashing, "BLOCK", block)
        rows = [(i, v.tolist()) for i, v in enumerate(cloud(seed))]
        odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf"), *[1.0] * 15], [None, *[1.0] * 15], [1.0, 2.0], [1.0, 2.1], [1e-30] * 16, [3e30] * 16]
        rows += [(1000 + i, v) for i, v in enumerate(odd)]
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in sign_hashing.near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in rows], VEC), recall=0.999999).collect()}
        want, links = expected(rows)
        assert links > 300
        assert [got[i] for i, _ in rows] == want


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.orderBy("vec_id").collect()]
    got = {r.vec_id: r.n_links for r in sign_hashing.near_duplicates(df).collect()}
    want, _ = expected(rows)
    assert sum(got.values()) >= 0.99 * sum(w[0] for w in want)
    assert all(got[i] <= w[0] for (i, _), w in zip(rows, want, strict=True))


def test_repeated_rows_null_keys_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.1], 0), (None, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, VEC).withColumnRenamed("label", "m")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in sign_hashing.near_duplicates(df).collect())
    assert got == [(0, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert sign_hashing.near_duplicates(spark.createDataFrame([], VEC)).collect() == []
