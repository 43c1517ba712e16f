from __future__ import annotations

import tempfile
import zlib

import numpy as np
from helpers import DOC, ODD, documents
from tokenizers import Tokenizer

from docketry.llm import length_histogram, token_files
from docketry.llm.catalog import tokenizer_file


def ids_of(text):
    return Tokenizer.from_file(tokenizer_file()).encode(text or "", add_special_tokens=False).ids


def written(docs, **options):
    path = tempfile.mkdtemp() + "/tokens"
    token_files.write_tokens(docs, path, tokenizer_file(), **options)
    return path


def test_round_trip(spark):
    texts = [*ODD, "don't  stop 's'\r\n12 it's 'The", "日 日 ", "x" * 70_000]
    for encoding in ("dictionary", "delta"):
        path = written(documents(spark, texts, first=5).repartition(3), encoding=encoding, row_group_bytes=1 << 16)
        at = 0
        stored = {r.doc_id: r.tokens for r in token_files.read_tokens(spark, path).collect()}
        index = {r.doc_id: r for r in token_files.token_index(spark, path).collect()}
        for k, text in enumerate(texts, 5):
            ids = [*ids_of(text), 0]
            assert stored[k] == ids
            assert (index[k].start, index[k].n_tokens, index[k].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)


def test_repeated_and_null_keys_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "", "", 0), (1, "a b", "", "", 0), (None, "c", "", "", 0)], DOC).withColumnRenamed("lang", "tokens").withColumnRenamed("source", "part")
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_files.token_index(spark, written(docs)).collect())
    assert got == [(0, None, 2), (2, 1, 3), (5, 1, 3)]
    assert token_files.token_index(spark, written(spark.createDataFrame([], DOC))).collect() == []


def test_histogram(spark):
    texts = [*ODD, *["a b c"] * 5, "one two three four"]
    sizes = sorted(len(ids_of(t)) for t in texts)
    histogram = length_histogram.length_histogram(documents(spark, texts), tokenizer_file())
    rows = histogram.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes))
    for r in rows:
        longer = [x for x in sizes if x >= r.length]
        assert (r.n_docs, r.docs_from, r.tokens_from, r.docs_to) == (sizes.count(r.length), len(longer), sum(longer), sum(x <= r.length for x in sizes))
        assert (r.truncated_tokens, r.lost_tokens) == (sum(min(x, r.length) for x in sizes), sum(x - r.length for x in longer))
    for r in length_histogram.at_limits(histogram, [0, 3, 10**6]).collect():
        assert (r.n_longer, r.kept_tokens, r.lost_tokens) == (sum(x > r.limit for x in sizes), sum(min(x, r.limit) for x in sizes), sum(max(0, x - r.limit) for x in sizes))
    for r in length_histogram.quantile_lengths(histogram, [0.1, 0.5, 1.0]).collect():
        assert r.length == min(x for x in sizes if sum(y <= x for y in sizes) >= r.share * len(sizes))
    assert length_histogram.length_histogram(spark.createDataFrame([], DOC), tokenizer_file()).collect() == []
