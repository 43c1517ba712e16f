"""Near-duplicate vectors by signs of random projections in several tables, verified by cosine.

Vectors whose signs agree in all bits of a table meet in a bucket. There the exact cosines are
computed block by block; a pair counts in the first table where it meets, so that links are
counted without listing them, and a bucket gives one link per vector towards its component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.components import components
from docketry.llm.workers import if_small, map_arrow
from docketry.session import stage

#: Buckets beyond so many vectors are cut into blocks, and each pair of blocks is a task's work.
BLOCK = 1000


def plan(n: int, cosine: float = 0.9, recall: float = 0.999, per_bucket: int = 24) -> tuple[int, int]:
    """Bits per table for buckets of about `per_bucket` of n spread vectors, and tables for the recall of a pair just at `cosine`."""
    bits = min(30, max(6, math.ceil(math.log2(max(n, 1) / per_bucket)) if n > per_bucket else 6))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _codes(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Each vector once a table, with its codes in all tables; vectors of different lengths never meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                v = rows.column("v").combine_chunks() if isinstance(rows.column("v"), pa.ChunkedArray) else rows.column("v")
                sizes = np.diff(np.asarray(v.offsets))
                for dim in np.unique(sizes).tolist():
                    who = np.flatnonzero(sizes == dim)
                    x = np.array(v.take(pa.array(who)).flatten(), np.float64).reshape(len(who), dim)
                    planes = np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, tables * bits))
                    codes = ((x @ planes > 0).reshape(len(who), tables, bits) @ place).astype(np.int32)
                    own = rows.take(pa.array(np.repeat(who, tables)))
                    table = np.tile(np.arange(tables, dtype=np.int32), len(who))
                    offsets = pa.array((np.arange(len(table) + 1) * tables).astype(np.int32))
                    lists = pa.ListArray.from_arrays(offsets, pa.array(np.repeat(codes, tables, axis=0).ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(table), pa.array(codes.ravel()), pa.array(np.full(len(table), dim, np.int32)), own.column("id"), own.column("m"), own.column("v"), lists], ["t", "code", "dim", "id", "m", "v", "codes"])

    return map_arrow(reps.select("id", "m", "v"), run, "t int, code int, dim int, id long, m long, v array<float>, codes array<int>")


def _links(rows: DataFrame, cosine: float) -> DataFrame:
    """`id, n, least` per vector and bucket part: newly counted links, and a vector to tie it to."""

    def bucket(t: int, own: bool, v: np.ndarray, ids: np.ndarray, m: np.ndarray, codes: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        v = v / np.sqrt((v * v).sum(axis=1))[:, None]
        a = np.arange(len(ids)) if own else np.flatnonzero(left)
        b = a if own else np.flatnonzero(~left)
        near = v[a] @ v[b].T >= cosine
        if own:
            np.fill_diagonal(near, False)
        i, j = np.nonzero(near)
        if not len(i):
            return
        i, j = a[i], b[j]
        new = np.ones(len(i), bool)
        for earlier in range(t):
            new &= codes[i, earlier] != codes[j, earlier]
        n = np.bincount(i[new], m[j[new]], len(ids))
        if not own:
            n += np.bincount(j[new], m[i[new]], len(ids))
        least = np.arange(len(ids))
        while True:
            before = least.copy()
            np.minimum.at(least, i, least[j])
            np.minimum.at(least, j, least[i])
            if (before == least).all():
                break
        some = np.flatnonzero((n > 0) | (least != np.arange(len(ids))))
        yield ids[some], n[some].astype(np.int64), ids[least[some]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            t, x, y = (rows.column(c)[0].as_py() for c in ("t", "x", "y"))
            k = rows.num_rows
            v = rows.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(k, -1)
            codes = rows.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(k, -1)
            for out in bucket(t, x == y, v, rows.column("id").to_numpy(), rows.column("m").to_numpy(), codes, rows.column("blk").to_numpy() == x):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["id", "n", "least"])

        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("t", "code", "dim", "x", "y")], axis=1)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)], strict=True):
                if b <= a:
                    continue
                key = tuple(keys[a])
                if last is not None and key != last and sum(h.num_rows for h in held) > 1:
                    yield from done()
                if key != last:
                    held, last = [], key
                held.append(batch.slice(a, b - a))
        if sum(h.num_rows for h in held) > 1:
            yield from done()

    return map_arrow(rows, run, "id long, n long, least long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", cosine: float = 0.9, recall: float = 0.999, seed: int = 7) -> DataFrame:
    """`key, n_links, component_id, kept` for every row.

    `n_links` counts the other rows linked directly, copies included. A pair just at `cosine` is
    found with a probability of `recall`, a closer one with a higher one; none below is linked.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor
    do rows with a null key, whose component is null. Vectors of different lengths don't link. Equal
    vectors are compared once; repeated rows count as rows.
    """
    v = F.transform(column, lambda x: x.cast("float"))
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    fit = F.coalesce((F.size(column) > 0) & ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (square > 0), F.lit(False)) & F.col(key).isNotNull()
    rows = vectors.select(F.col(key).alias("k"), v.alias("v"), fit.alias("fit"))
    rows = rows.select("k", "fit", "v", F.when(F.col("fit"), F.xxhash64("v")).alias("f"), F.when(F.col("fit"), F.hash("v")).alias("g"))
    reps = stage(rows.where("fit").groupBy("f", "g").agg(F.min(F.col("k").cast("long")).alias("id"), F.count("*").alias("m"), F.first("v").alias("v")), "distinct-vectors")
    bits, tables = plan(reps.count(), cosine, recall)
    placed = _codes(reps, bits, tables, seed)
    full = stage(placed.groupBy("t", "code", "dim").agg(F.count("*").alias("c")).where(F.col("c") > BLOCK), "full-buckets")
    blocks = F.ceil(F.coalesce("c", F.lit(1)) / BLOCK).cast("int")
    dealt = placed.join(if_small(full), ["t", "code", "dim"], "left").withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select("t", "code", "dim", F.least("blk", "o").alias("x"), F.greatest("blk", "o").alias("y"), "blk", "id", "m", "v", "codes")
    part = ["t", "code", "dim", "x", "y"]
    found = stage(_links(dealt.repartition(*part).sortWithinPartitions(*part), cosine), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("others"))
    ties = components(found.where("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v")), "vector-components")
    final = reps.select("f", "g", "id", "m").join(counts, "id", "left").join(ties, F.col("id") == F.col("node"), "left")
    final = final.select("f", "g", (F.coalesce("others", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(final, ["f", "g"], "left").select(F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", F.col("k").cast("long")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
