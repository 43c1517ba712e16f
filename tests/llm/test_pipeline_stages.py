"""Each stage of the pipeline over the smallest tables, against a plain version on the stage's own input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from helpers import classes, shingles
from test_decontamination import expected as overlapping
from test_decontamination import words

import corpus_pipeline as cp
from docketry.llm import toxicity
from docketry.llm.catalog import tokenizer_file
from docketry.session import table


@pytest.fixture(scope="module")
def outputs(spark, sf, tmp_path_factory):
    """What every stage read and gave, by name."""
    docs, out = table(spark, sf, "documents"), {}
    root = tmp_path_factory.mktemp("stages")
    for name, stage in cp.STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_toxic_documents_go(spark, sf, outputs):
    before, after = outputs["toxicity"]
    scored = toxicity.score(before, toxicity.fit(before, table(spark, sf, "labels"))).collect()
    assert ids(after) == sorted(r.doc_id for r in scored if r.score < 0.5)
    assert after.columns == before.columns and 0 < after.count() < before.count()


def test_one_document_of_a_class_stays(outputs):
    before, after = outputs["ngram_jaccard"]
    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    keys = sorted(sets)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert links and ids(after) == sorted(set(classes(keys, links).values()))


def test_contaminated_documents_go(spark, sf, outputs):
    before, after = outputs["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    bags = [(i, t, set(words(t))) for i, t in items]
    found = set()
    for r in before.collect():
        own = set(words(r.text))
        # Fewer than five shared tokens meet no rule.
        near = [(i, t) for i, t, bag in bags if len(bag & own) >= 5]
        found |= {d for d, _ in overlapping([(r.doc_id, r.text)], near)}
    assert ids(after) == sorted(set(ids(before)) - found) and found


def test_mixing_keeps_every_row_and_the_tokens_follow_the_mix(outputs):
    from tokenizers import Tokenizer

    before, after = outputs["mixing"]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    mixed, told = outputs["token_output"]
    rows = told.orderBy("start").collect()
    text = {r.doc_id: r.text for r in mixed.collect()}
    model, at = Tokenizer.from_file(tokenizer_file()), 0
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        own = [*model.encode(text[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
    assert [r.doc_id for r in rows] != sorted(text)
