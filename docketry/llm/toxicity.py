"""Toxic documents by multiple-instance learning: a document is toxic if any sentence is.

A sentence's score is a logistic function of its words; noisy-or makes a document's score of those
of its sentences, `1 - prod(1 - p)`. Weights are fitted to document labels alone, so the sentence
scores, which nobody labelled, tell where the toxic part is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.text_batches import SPACE, ByteSums, mix, pieces, word_spans
from docketry.llm.workers import give_back, map_arrow

FEATURE_BITS = 20
#: Besides itself, a longer word has the features of its beginnings of so many bytes.
STEMS = (6, 8)
_BREAKS = SPACE.copy()
_BREAKS[[x for x in range(128) if not chr(x).isalnum()]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[*b".!?\n"]] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The logit of each sentence, given the words of all and where each starts."""
        if not len(first):
            return np.zeros(0)
        return np.add.reduceat(self.weights[features].sum(axis=1, dtype=np.float64), first) + self.bias


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the features of each word, its start and end, each sentence's first word and its text."""
    starts, ends, _ = word_spans(data, offsets, _BREAKS)
    sums = ByteSums(data, lowered=True)
    features = np.zeros((len(starts), 1 + len(STEMS)), np.int32)
    for k, stem in enumerate((None, *STEMS)):
        some = np.flatnonzero(ends - starts > (stem or 0))
        stop = ends[some] if stem is None else starts[some] + stem
        # A stem and a word of the same bytes are two features; feature 0 stands for none.
        features[some, k] = np.maximum(1, mix(sums.of(starts[some], stop) + np.uint64(k)) >> np.uint64(64 - FEATURE_BITS))
    text = np.searchsorted(offsets, starts, "right") - 1
    place = np.cumsum(_ENDS[data])[starts] if len(starts) else starts
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return features, starts, ends, first, text[first]


def in_sample(key: str) -> F.Column:
    """Rows whose label may be learned: a fifth, by crc32 of the key as text, is held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = 2000, rounds: int = 200) -> Model:
    """Fit on at most `per_class` labelled documents of each class, taken in the order of a hash of the key.

    Classes are weighted back to their share among the labels. Held-out rows, null labels and null
    keys are not used; of several labels of a key the highest counts. Without labels of both
    classes the model gives every sentence the same score: next to 0 if nothing is toxic.
    """
    known = labels.where(in_sample(key) & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    shares = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), 30.0 if shares.get(1) else -30.0)
    picked = None
    for y in shares:
        one = known.where(F.col("y") == y).orderBy(F.xxhash64(key), key).limit(per_class)
        picked = one if picked is None else picked.unionAll(one)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            features, _, _, first, of = sentences(data, offsets)
            counts = np.bincount(of, minlength=len(offsets) - 1)
            sizes = np.diff(np.append(first, len(features)))
            words = np.bincount(of, sizes, len(offsets) - 1).astype(np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(v)) for n, v in ((words * features.shape[1], features.ravel()), (counts, sizes.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([rows.column("y"), *lists], ["y", "words", "sizes"])

    # `picked` has at most twice per_class rows.
    rows = map_arrow(docs.join(F.broadcast(picked), key).select("y", text), run, "y int, words array<int>, sizes array<int>").toArrow()
    model = _fit(rows, shares, rounds)
    del rows
    give_back()  # the driver goes on with other work
    return model


def _fit(rows: pa.Table, shares: dict[int, int], rounds: int, rare: int = 4, sparse: float = 5e-5, pace: float = 0.3) -> Model:
    weights = np.zeros(1 << FEATURE_BITS)
    rows = rows.filter(pc.greater(pc.list_value_length(rows["sizes"]), 0)).combine_chunks()
    if rows.num_rows == 0 or len(pc.unique(rows["y"])) < 2:
        return Model(weights.astype(np.float32), -30.0)
    y = rows["y"].to_numpy()
    words, sizes = (pc.list_flatten(rows[c]).to_numpy() for c in ("words", "sizes"))
    per_doc = pc.list_value_length(rows["sizes"]).to_numpy()
    doc_of_sentence = np.repeat(np.arange(len(y), dtype=np.int32), per_doc)
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes * (1 + len(STEMS)))
    # Words of few documents tell nothing that would hold elsewhere. Counted in parts, to spare memory.
    common = np.zeros(1 << FEATURE_BITS, np.int32)
    ends = np.searchsorted(doc_of_sentence[sentence], np.arange(0, len(y) + 200, 200))
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        pairs = np.unique(doc_of_sentence[sentence[a:z]].astype(np.int64) << FEATURE_BITS | words[a:z])
        common += np.bincount(pairs & ((1 << FEATURE_BITS) - 1), minlength=1 << FEATURE_BITS).astype(np.int32)
    common[0] = 0
    kept = common[words] >= rare
    words, sentence = words[kept], sentence[kept]
    used = np.flatnonzero(common >= rare)
    place = np.zeros(1 << FEATURE_BITS, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    column = place[words]
    del words, kept
    seen = np.bincount(y, minlength=2)
    cost = np.where(y == 1, shares[1] / seen[1], shares[0] / seen[0])
    cost = cost / cost.sum()
    w, b = np.zeros(len(used)), float(-np.log(np.median(per_doc) * 4))
    moments = [np.zeros(len(used) + 1), np.zeros(len(used) + 1)]
    for step in range(1, rounds + 1):
        z = np.bincount(sentence, w[column], len(sizes)) + b
        total = np.bincount(doc_of_sentence, np.logaddexp(0, z), len(y))
        pull = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-9, 700)), 1.0) * cost
        g = pull[doc_of_sentence] / (1 + np.exp(-np.clip(z, -60, 60)))
        grad = np.append(np.bincount(column, g[sentence], len(used)), g.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.99 * moments[1] + 0.01 * grad**2
        scale = pace / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-4)
        move = scale * moments[0] / (1 - 0.9**step)
        w, b = w - move[:-1], b - move[-1]
        # A word must pay for its weight; most get none.
        w = np.sign(w) * np.maximum(0, np.abs(w) - scale[:-1] * sparse)
    weights[used] = w
    return Model(weights.astype(np.float32), b)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, score` of every row in [0, 1]; a text without words, empty or null has no toxic sentence and scores 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            features, _, _, first, of = sentences(data, offsets)
            total = np.bincount(of, np.logaddexp(0, model.sentence_scores(features, first)), len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(1 - np.exp(-total))], [key, "score"])

    return map_arrow(docs.select(key, text), run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of `docs` that score below `limit`, with all their columns; no shuffle."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            features, _, _, first, of = sentences(data, offsets)
            total = np.bincount(of, np.logaddexp(0, model.sentence_scores(features, first)), len(offsets) - 1)
            kept = rows.filter(pa.array(1 - np.exp(-total) < limit))
            yield pa.RecordBatch.from_arrays(kept.columns, names)

    return map_arrow(docs, run, docs.schema)


def offending_sentences(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", limit: float = 0.5) -> DataFrame:
    """`key, start, end, score, sentence` (byte range of its words) for every sentence that scores `limit` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            features, starts, ends, first, of = sentences(data, offsets)
            p = 1 / (1 + np.exp(-np.clip(model.sentence_scores(features, first), -60, 60)))
            hit = np.flatnonzero(p >= limit)
            last = np.append(first[1:], len(starts)) - 1
            a, b = (starts[first], ends[last]) if len(first) else (first, first)
            said = [data[s:e].tobytes().decode() for s, e in zip(a[hit], b[hit], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(key).take(pa.array(of[hit])), pa.array(a[hit] - offsets[of[hit]]), pa.array(b[hit] - offsets[of[hit]]), pa.array(p[hit]), pa.array(said, pa.string())],
                [key, "start", "end", "score", "sentence"],
            )

    return map_arrow(docs.select(key, text), run, f"`{key}` {docs.schema[key].dataType.simpleString()}, start long, end long, score double, sentence string")
