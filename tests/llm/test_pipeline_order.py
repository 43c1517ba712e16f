from __future__ import annotations

import random

from helpers import DOC, prose
from pyspark.sql import functions as F

import corpus_pipeline
from docketry.llm import pfair


def test_token_files_follow_the_mix(spark, tmp_path):
    rng = random.Random(4)
    # Without the mix, all of one source would come before the other.
    rows = [(i, prose(rng, 8000), "en", "a" if i < 40 else "b", 0) for i in range(80)]
    docs = spark.createDataFrame(rows, DOC)
    corpus_pipeline.mix_sources(spark, docs, "").write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    got = corpus_pipeline.write_tokens(spark, mixed, "").orderBy("start").collect()
    assert sorted(r.doc_id for r in got) == list(range(80))
    at = {r.doc_id: r.position for r in pfair.interleave(docs, size=F.length("text")).collect()}
    order = [at[r.doc_id] for r in got]
    assert order == sorted(order)
    assert [r.doc_id for r in got] != list(range(80))
