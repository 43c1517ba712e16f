from __future__ import annotations

import random
from fractions import Fraction

from helpers import DOC, documents
from pyspark.sql import functions as F

from docketry.llm import pfair


def test_every_prefix_is_less_than_a_block_off(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(0, 30), "en", rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOC)
    weights = {"a": 2.0, "b": 1.0, "c": 1.5, None: 0.5}
    got = pfair.interleave(docs, weights, size=F.length("text"), block=40, slots=50).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    line = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        assert line.setdefault(r.position, (r.source, r.block, r.cycle)) == (r.source, r.block, r.cycle)
    assert sorted(line) == list(range(len(line)))
    share = pfair.shares(weights, 50)
    assert sum(share.values()) == 50
    # Within a cycle each source is less than a block from its part of that cycle, at every slot.
    cycles = {}
    for p in sorted(line):
        cycles.setdefault(line[p][2], []).append(line[p][0])
    full = 0
    for slots in cycles.values():
        wants = {s: slots.count(s) for s in weights}
        full += wants == share
        had = dict.fromkeys(weights, 0)
        for t, s in enumerate(slots, 1):
            had[s] += 1
            assert all(abs(had[x] - Fraction(wants[x] * t, len(slots))) < 1 for x in weights)
    assert full >= 3
    # Blocks of a source come in their order.
    for s in weights:
        own = [line[p][1] for p in sorted(line) if line[p][0] == s]
        assert own == list(range(len(own)))


def test_default_weights_mixed_rows_and_odd_tables(spark):
    texts = [None, "", "a" * 500, *["bb"] * 40]
    docs = documents(spark, texts).withColumnRenamed("lang", "position").withColumnRenamed("n_chars", "slot")
    docs = docs.unionByName(docs)
    assert sorted(r.doc_id for r in pfair.interleave(docs, block=4).collect()) == sorted(2 * list(range(len(texts))))
    out = pfair.mixed(docs, size=F.length("text"), block=4)
    assert out.columns == docs.columns
    key = lambda r: str(tuple(r))
    assert sorted(out.collect(), key=key) == sorted(docs.collect(), key=key)
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert pfair.interleave(nulls, block=4).count() == docs.count()
    assert pfair.interleave(spark.createDataFrame([], DOC)).collect() == []
    assert pfair.mixed(spark.createDataFrame([], DOC)).collect() == []


def test_mix_follows_positions(spark):
    docs = documents(spark, ["x"] * 500)
    where = {r.doc_id: r.position for r in pfair.interleave(docs, block=5).collect()}
    order = [where[r.doc_id] for r in pfair.mixed(docs, block=5).collect()]
    assert order == sorted(order)


def test_long_documents_take_the_slots_they_cover(spark):
    rows = [(i, "x" * 400, "en", "long", 0) for i in range(30)] + [(100 + i, "x" * 20, "en", "short", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, DOC)
    got = pfair.interleave(docs, {"long": 1.0, "short": 1.0}, size=F.length("text"), block=40, slots=20).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    # 12 000 characters each: at every place the sources are a document and a block apart at most.
    had = {"long": 0, "short": 0}
    for r in sorted(got, key=lambda r: (r.position, r.doc_id)):
        had[r.source] += 400 if r.source == "long" else 20
        assert abs(had["long"] - had["short"]) <= 400 + 2 * 40
