"""Exact removal of repeated byte strings, by prefix doubling over ranks that Spark sorts.

A full suffix array of a corpus sorts a rank pair for every byte in every round. Here a round only
holds positions that are still open. Every window of 200 bytes shows, in its first half, the same
content-chosen position wherever it occurs (the least 16-byte rank); windows that follow each other
and share it are one row. Round one ranks the pair of the two parts of the 101 bytes after that
position: all windows of a row hold them, so a row whose rank is unique has no repeated window. Of
the other rows, those whose whole range occurs again are settled together. What remains goes on in
bands of 25 windows with ranks of the 176 bytes that a band has in common, and then window by
window with ranks of all 200. Ranks are 64-bit names of equal strings; ranges are the same if two of
them agree, of the core and of the whole range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.text_batches import ByteSums, mix, pieces, signed, window_minima
from docketry.llm.workers import SMALL_ROWS, map_arrow
from docketry.session import stage

LENGTH = 200
_GRAM = 16


def _ranges(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Rows of windows that share their chosen position: text, first and last start, that position."""
    n, half = len(data), length // 2
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    grams = ByteSums(data)
    at = np.arange(n - _GRAM + 1)
    # Windows that end within their text; their grams do too.
    starts, chosen = window_minima(grams.of(at, at + _GRAM), np.array([0, n]), half)
    text = np.searchsorted(offsets, starts, "right") - 1
    fits = starts + length <= offsets[text + 1]
    starts, chosen, text = starts[fits], chosen[fits], text[fits]
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return text[first], starts[first], starts[last], chosen[first]


def _pair(sums: ByteSums, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One name for the pair of ranks of [start, middle) and [middle, end)."""
    return signed(mix(sums.of(start, middle) * np.uint64(3) + sums.of(middle, end)))


def _rows(docs: DataFrame, length: int, with_places: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "_t"):
            text, lo, hi, chosen = _ranges(data, offsets, length)
            sums = ByteSums(data)
            end = chosen + length - length // 2 + 1
            core = pa.array(_pair(sums, chosen, chosen + length // 4, end))
            if not with_places:
                yield pa.RecordBatch.from_arrays([core], ["core"])
                continue
            yield pa.RecordBatch.from_arrays(
                [core, rows.column("_id").take(pa.array(text)), pa.array((lo - offsets[text]).astype(np.int32)), pa.array((hi - offsets[text]).astype(np.int32)), pa.array((chosen - offsets[text]).astype(np.int32)), pa.array(signed(sums.of(lo, hi + length)))],
                ["core", "_id", "lo", "hi", "c", "a"],
            )

    return map_arrow(docs, run, "core long, _id long, lo int, hi int, c int, a long" if with_places else "core long")


def _finer(docs: DataFrame, length: int, band: int) -> DataFrame:
    """The wanted ranges (column `ranges`) in bands of windows at like distances from the chosen position.

    Rows are as those of _rows, with `known` handed on. All windows of a band share its core,
    whichever of them a range has; a band of one window has the whole window as its core.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "_t"):
            sums = ByteSums(data)
            wanted = rows.column("ranges")
            counts = np.diff(np.asarray(wanted.offsets))
            spans = wanted.flatten()
            lo, hi, c = (spans.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "hi", "c"))
            near, far = (c - hi) // band, (c - lo) // band
            many = far - near + 1
            at = np.repeat(np.arange(len(lo)), many)
            k = near[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            text = np.repeat(np.arange(len(counts)), counts)[at]
            lo, hi, c = np.maximum(lo[at], c[at] - k * band - band + 1), np.minimum(hi[at], c[at] - k * band), c[at]
            base = offsets[text]
            a, z = base + c - k * band, base + c - k * band - band + 1 + length
            yield pa.RecordBatch.from_arrays(
                [pa.array(_pair(sums, a, a + length // 2, z)), rows.column("_id").take(pa.array(text)), *(pa.array(x.astype(np.int32)) for x in (lo, hi, c)), pa.array(signed(sums.of(base + lo, base + hi + length))), spans.field("known").take(pa.array(at))],
                ["core", "_id", "lo", "hi", "c", "a", "known"],
            )

    return map_arrow(docs, run, "core long, _id long, lo int, hi int, c int, a long, known boolean")


def _settled(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Ranges that occur again as a whole (hi is the last window's start), and those to be looked at more finely.

    Where some range of a core stands alone, its windows may still be those of other ranges: it
    goes on, with one range of each other kind of that core. `known` ranges are settled already
    and only serve as partners.
    """
    classes = stage(rows.groupBy("core", "a").agg(F.count("*").alias("n"), F.bool_and("known").alias("known"), F.min(F.struct("_id", "lo", "hi", "c")).alias("one")), name)
    alone = F.col("n") == 1
    cores = classes.groupBy("core").agg(F.max(alone & ~F.col("known")).alias("unsettled"), F.count("*").alias("kinds")).where("unsettled and kinds > 1").select("core")
    wanted = classes.join(cores, "core").select("one.*", (~alone | F.col("known")).alias("known"))
    whole = rows.join(classes.where(~alone).select("core", "a"), ["core", "a"]).select("_id", "lo", "hi")
    return whole, stage(wanted.groupBy("_id", "lo", "hi", "c").agg(F.bool_and("known").alias("known")), f"{name}-open")


def _runs(spans: DataFrame) -> DataFrame:
    """Maximal runs of the covered bytes of each document, from overlapping `_id, lo, hi` (hi excluded)."""
    ordered = spans.repartition("_id").sortWithinPartitions("_id", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, int] | None = None
        for batch in batches:
            who, lo, hi = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            out = []
            for w, a, b in zip(who.tolist(), lo.tolist(), hi.tolist(), strict=True):
                if held and held[0] == w and a <= held[2]:
                    if b > held[2]:
                        held = (w, held[1], b)
                else:
                    if held:
                        out.append(held)
                    held = (w, a, b)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["_id", "lo", "hi"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held, (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["_id", "lo", "hi"])

    return map_arrow(ordered, run, "_id long, lo int, hi int")


def _per_document(spans: DataFrame, how_many: int) -> DataFrame:
    """The ranges of each document in one row; broadcast only if all of them are counted to be few."""
    one = spans.groupBy("_id").agg(F.sort_array(F.collect_list(F.struct(*[c for c in ("lo", "hi", "c", "known") if c in spans.columns]))).alias("ranges"))
    return F.broadcast(one) if how_many <= SMALL_ROWS else one.hint("merge")


def _identity(docs: DataFrame, key: str, text: str) -> F.Column:
    """What tells documents apart: the key if it is a number that is never null or repeated, else a hash of key and text.

    Sorted numbers pack well in shuffles. Rows that repeat key and text have the same runs anyway.
    """
    if docs.schema[key].dataType.simpleString() in ("bigint", "int"):
        n = docs.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys")).first()
        if n["rows"] == n["keys"]:
            return F.col(key).cast("long")
    return F.xxhash64(key, text)


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`_id, lo, hi`: maximal runs of bytes covered by a string of `length` bytes that starts elsewhere too."""
    named = docs.select(_identity(docs, key, text).alias("_id"), F.col(text).alias("_t")).where(F.octet_length("_t") >= length)
    again = _rows(named, length, False).groupBy("core").count().where("count > 1").select("core")
    rows = stage(_rows(named, length, True).join(again, "core").withColumn("known", F.lit(False)), "ranges")
    whole, wanted = _settled(rows, "range-classes")
    for band in (length // 8, 1):
        asked = named.join(_per_document(wanted, wanted.count()), "_id")
        rows = stage(_finer(asked, length, band), f"bands-{band}")
        found, wanted = _settled(rows, f"band-classes-{band}")
        whole = whole.unionAll(found)
    return stage(_runs(whole.withColumn("hi", F.col("hi") + length)), "runs")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`key, n_bytes, n_removed, n_spans, kept_sha256, kept` for every row; `kept` are the bytes left.

    Texts are UTF-8 bytes, null an empty one. All strings are judged on the input; overlaps count,
    and matches don't cross documents. Texts shorter than `length` keep all. Rows with equal or
    null keys are documents of their own.
    """
    runs = repeated_runs(docs, key, text, length)
    named = docs.select(key, _identity(docs, key, text).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    joined = named.join(_per_document(runs, runs.count()), "_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, "_t"):
            raw = data.tobytes()
            spans = rows.column("ranges").to_pylist()
            out = []
            for k, own in enumerate(spans):
                a, b, at, left = int(offsets[k]), int(offsets[k + 1]), int(offsets[k]), []
                for s in own or ():
                    left.append(raw[at : a + s["lo"]])
                    at = a + s["hi"]
                kept = b"".join([*left, raw[at:b]])
                out.append((b - a, b - a - len(kept), len(own or ()), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([rows.column(key), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True))], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(joined.select(key, "_t", "ranges"), run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
