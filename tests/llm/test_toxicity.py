from __future__ import annotations

import random
import zlib

from helpers import DOC, ODD, documents, prose

from docketry.llm import toxicity
from docketry.llm.catalog import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, n=600):
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(n):
        sentences = [prose(rng, rng.randrange(4, 15)) for _ in range(rng.randrange(1, 60))]
        bad = i % 8 == 0
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["Nasty1", "nasty2,", "(nasty3)"])
        texts.append(". ".join(sentences))
        labels.append((i, 1, int(bad)))
    return texts, labels


def test_held_out_accuracy_and_sentences(spark):
    texts, labels = labelled(spark)
    docs = documents(spark, texts)
    model = toxicity.fit(docs, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(labels[i][2]) for i in held) >= 0.97 * len(held)
    found = toxicity.offending_sentences(docs, model).collect()
    assert found and sum("asty" in r.sentence for r in found) >= 0.95 * len(found)
    assert all(texts[r.doc_id].encode()[r.start : r.end].decode() == r.sentence for r in found)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_held_out_labels_and_other_columns_make_no_difference(spark):
    texts, labels = labelled(spark, 200)
    docs = documents(spark, texts)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a = toxicity.fit(docs, spark.createDataFrame(labels, LABELS), rounds=10)
    b = toxicity.fit(docs, spark.createDataFrame([*other, (None, 1, 1), (1, 1, None)], LABELS), rounds=10)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_odd_rows_and_missing_labels(spark):
    docs = documents(spark, ODD)
    none = toxicity.fit(docs, spark.createDataFrame([], LABELS))
    assert all(0 <= r.score < 0.01 for r in toxicity.score(docs, none).collect())
    one = toxicity.fit(docs, spark.createDataFrame([(i, 1, 1) for i in range(9)], LABELS))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, one).collect()}
    assert [scores[i] for i in range(3)] == [0, 0, 0] and scores[3] > 0.99
    empty = spark.createDataFrame([], DOC)
    assert toxicity.score(empty, none).collect() == [] and toxicity.keep_clean(empty, none).collect() == []


def test_query(spark, sf):
    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.92 * len(held)
