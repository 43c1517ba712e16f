from __future__ import annotations

import hashlib
import random
from collections import Counter

from helpers import DOC, ODD, documents, prose

from docketry.llm import prefix_doubling


def expected(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    parts = [prose(rng, rng.choice([10, 30, 45, 60, 90]), 5000) for _ in range(12)]
    texts = list(ODD)
    for _ in range(30):
        texts.append("é".join(rng.choice(parts) if rng.random() < 0.5 else prose(rng, rng.randrange(3, 80), 5000) for _ in range(rng.randrange(1, 6))))
    base = prose(rng, 120, 5000)
    texts += [base, base, base[:-1], "x" + base, base + base, base[:300] + "#" + base[301:], base[100:299], base[100:300], base[100:301], "ab" * 400, "a" * 199, "a" * 200, "a" * 201]
    texts += [base[k * 40 : k * 40 + 260] for k in range(8)]
    rng.shuffle(texts)
    return texts


def test_every_string_counted(spark):
    for seed, length in ((1, 200), (2, 200), (3, 64)):
        texts = corpus(seed)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in prefix_doubling.without_repeats(documents(spark, texts), length=length).collect()}
        want = expected(texts, length)
        assert [got[i] for i in range(len(texts))] == want


def test_shuffled_join_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(prefix_doubling, "SMALL_ROWS", 0)
    texts = corpus(4)
    docs = documents(spark, texts).withColumnRenamed("lang", "ranges").withColumnRenamed("source", "_t").withColumnRenamed("n_chars", "kept")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in prefix_doubling.without_repeats(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [w[1:3] for w in expected(texts, 200)]
    text = prose(random.Random(5), 100, 5000)
    rows = [(1, text, "", "", 0), (1, text, "", "", 0), (1, text[:150], "", "", 0), (None, text[:150], "", "", 0), (None, None, "", "", 0)]
    got = sorted((r.n_bytes, r.n_removed) for r in prefix_doubling.without_repeats(spark.createDataFrame(rows, DOC)).collect())
    n = len(text)
    assert got == [(0, 0), (150, 0), (150, 0), (n, n), (n, n)]
    assert prefix_doubling.without_repeats(spark.createDataFrame([], DOC)).collect() == []
