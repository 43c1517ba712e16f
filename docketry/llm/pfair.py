"""Mixing sources to target weights by Pfair scheduling, with built-in functions only.

Texts of a source are cut into blocks of equal size. Block k of a source with share a of a cycle of
B slots is released at floor(k B / a) and due at ceil((k + 1) B / a); in every slot the released
block that is due first goes next. On one line of slots this keeps every due time, so after any
slot a source is less than one block away from its share. Cycles are alike until a source runs
out, so one schedule for each kind of cycle places any number of blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.workers import if_small
from docketry.session import stage

#: Slots of a full cycle: weights are rounded to so many parts.
SLOTS = 1000
#: Rows that one task ranks; a source is cut into ranges of about so many.
RANGE_ROWS = 50_000
#: Sources and schedules are small tables: at most this many sources are accepted.
MOST_SOURCES = 2_000


def shares(weights: dict[str | None, float], slots: int = SLOTS) -> dict[str | None, int]:
    """Whole slots per cycle by largest remainder; every source has one at least."""
    if not weights or len(weights) > min(slots, MOST_SOURCES) or any(not (w > 0 and math.isfinite(w)) for w in weights.values()):
        raise ValueError("weights are positive, for one source at least and no more than there are slots")
    total = sum(weights.values())
    exact = {s: w * slots / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (out[s] - exact[s], str(s)))
    while sum(out.values()) < slots:
        for s in by_rest[: slots - sum(out.values())]:
            out[s] += 1
    while sum(out.values()) > slots:
        out[max(out, key=lambda s: (out[s] - exact[s] if out[s] > 1 else -math.inf, str(s)))] -= 1
    return out


def _slots_of(cycles: DataFrame) -> DataFrame:
    """`kind, source, k, slot`: where the k-th block of a source goes in a cycle of this kind.

    `wants` has the blocks each source has in the cycle, `b` their sum. The state is what each
    source has had and the sources of the slots so far. Ties go to the source listed first.
    """
    pick = (
        "array_min(transform(wants, (w, k) -> if(w > s.had[k] and floor(cast(s.had[k] as bigint) * b / greatest(w, 1)) < t,"
        " named_struct('due', ceil((cast(s.had[k] as bigint) + 1) * b / greatest(w, 1)), 'k', k), null))).k"
    )
    # A one-element transform names the choice, so that it is computed once a slot.
    step = f"transform(array({pick}), c -> named_struct('had', transform(s.had, (h, k) -> if(k = c, h + 1, h)), 'line', array_append(s.line, c)))[0]"
    line = f"aggregate(sequence(1, b), named_struct('had', transform(wants, w -> 0), 'line', cast(array() as array<int>)), (s, t) -> {step}, s -> s.line)"
    placed = cycles.select("kind", "sources", F.posexplode(F.expr(line)).alias("slot", "c"))
    own = Window.partitionBy("kind", "c").orderBy("slot")
    return placed.select("kind", F.expr("sources[c]").alias("source"), (F.row_number().over(own) - 1).alias("k"), "slot")


def _ranked(docs: DataFrame, key: str, source: str, size: Column) -> DataFrame:
    """All rows with `before`: the size of the rows ahead of it in its source, in the order of a hash of the key.

    A source is ranked range by range of that hash, the ranges' totals by another sum; no task
    holds a source.
    """
    n = docs.count()
    ranges = max(1, math.ceil(n / RANGE_ROWS))
    rows = docs.withColumn("_size", size.cast("bigint")).withColumn("_hash", F.xxhash64(key))
    rows = rows.withColumn("_range", F.floor((F.col("_hash") / 2.0**64 + 0.5) * ranges).cast("bigint"))
    totals = rows.groupBy(source, "_range").agg(F.sum("_size").alias("_n"))
    # One row a source and range: a millionth part of the documents.
    ahead = Window.partitionBy(source).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(source).alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(source, "_range").orderBy("_hash", key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return rows.join(totals, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))).withColumn("before", F.col("_inside") + F.col("_ahead"))


def interleave(docs: DataFrame, weights: dict[str | None, float] | None = None, key: str = "doc_id", source: str = "source", size: Column | None = None, block: int = 65_536, slots: int = SLOTS) -> DataFrame:
    """Key, source and place in the mix of every row, which stays exactly once.

    Columns: key, source, `block` (the source's block in which the row starts), `release` and
    `deadline` of that block in slots of its cycle, `cycle`, `slot`, and `position`: the block's
    place in the whole mix, in which places within a longer row stay empty. `weights` gives the target of each source; None means the square root
    of its total size. `size` is a row's size, by default 1, of which `block` fill a block.

    A source that runs out gives its last blocks in its last cycle; the others share the next
    cycles by their weights. Sources missing from `weights` are an error, a null source is one of
    its own, rows of equal or null keys follow each other, an empty table has no rows.
    """
    size = F.lit(1) if size is None else size
    narrow = docs.select(F.col(key).alias("_k"), F.col(source).alias("_src"), F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).alias("_z"))
    ranked = stage(_ranked(narrow, "_k", "_src", F.col("_z")).select("_k", "_src", "before", "_size"), "ranked")
    # A row takes all the slots that its size covers and stands in the first of them.
    found = stage(ranked.select("_src", F.floor(F.col("before") / block).alias("block")).distinct(), "blocks")
    by_source = ranked.groupBy("_src").agg(F.sum("_size").alias("total"), F.max(F.floor(F.col("before") / block)).alias("last"))
    by_source = by_source.limit(MOST_SOURCES + 1).collect()
    if len(by_source) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if not by_source:
        return ranked.select(F.col("_k").alias(key), F.col("_src").alias(source), *[F.lit(0).cast("bigint").alias(c) for c in ("block", "release", "deadline", "cycle", "slot", "position")])
    # What the last row has over whole blocks takes no slot of its own.
    blocks = {r._src: max(r.last + 1, r.total // block) for r in by_source}
    if weights is None:
        weights = {r._src: math.sqrt(max(1, r.total)) for r in by_source}
    if missing := set(blocks) - set(weights):
        raise ValueError(f"no weight for {sorted(map(str, missing))}")
    share = shares({s: weights[s] for s in blocks}, slots)
    names = sorted(blocks, key=lambda s: (s is None, s or ""))
    ends = sorted({x for s in names for x in (blocks[s] // share[s], blocks[s] // share[s] + 1)})
    kinds, first, position = [], 0, 0
    for kind, end in enumerate(e for e in ends if e > 0):
        wants = [max(0, min(share[s], blocks[s] - first * share[s])) for s in names]
        kinds.append((kind, first, sum(wants), position, wants))
        position += (end - first) * sum(wants)
        first = end
    spark = docs.sparkSession
    cycles = spark.createDataFrame([(k, f, b, p, w, names) for k, f, b, p, w in kinds if b], "kind int, first bigint, b int, at bigint, wants array<int>, sources array<string>")
    table = _slots_of(cycles).join(cycles.select("kind", "first", "b", "at", F.explode(F.arrays_zip("sources", "wants")).alias("x")).select("kind", "first", "b", "at", F.col("x.sources").alias("_s"), F.col("x.wants").alias("a")), "kind")
    table = table.where(F.col("source").eqNullSafe(F.col("_s"))).select("kind", "first", "b", "at", F.col("source").alias("_s"), "a", "k", "slot")
    share_map = spark.createDataFrame([(s, share[s]) for s in names], "_s string, share int")
    starts = [f for _, f, b, _, _ in kinds if b]

    numbered = found.join(F.broadcast(share_map), F.col("_src").eqNullSafe(F.col("_s"))).drop("_s")
    numbered = numbered.select("_src", "block", F.floor(F.col("block") / F.col("share")).alias("cycle"), (F.col("block") % F.col("share")).alias("_in"))
    kind = F.size(F.filter(F.array(*[F.lit(x) for x in starts]), lambda x: x <= F.col("cycle"))) - 1
    # The schedules have at most (2 sources + 1) x slots rows, whatever the documents are.
    at = numbered.withColumn("_kind", kind).join(F.broadcast(table), (F.col("_kind") == F.col("kind")) & F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_in") == F.col("k")))
    w, j = F.greatest("a", F.lit(1)), F.col("k").cast("bigint")
    at = at.select(
        F.col("_src").alias("_bs"), "block", F.floor(j * F.col("b") / w).alias("release"), F.ceil((j + 1) * F.col("b") / w).alias("deadline"), "cycle", F.col("slot").cast("bigint").alias("slot"),
        (F.col("at") + (F.col("cycle") - F.col("first")) * F.col("b") + F.col("slot")).alias("position"),
    )
    rows = ranked.withColumn("_own", F.floor(F.col("before") / block))
    rows = rows.join(at, F.col("_src").eqNullSafe(F.col("_bs")) & (F.col("_own") == F.col("block")))
    return rows.select(F.col("_k").alias(key), F.col("_src").alias(source), "block", "release", "deadline", "cycle", "slot", "position")


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """All rows and columns of `docs` in the order of the mix: sorted within ranges of positions that follow each other."""
    places = interleave(docs.select(key, source, *_needed(docs, options)), weights, key, source, **options)
    places = places.groupBy(F.col(key).alias("_key")).agg(F.min("position").alias("_position"))
    joined = docs.join(if_small(stage(places, "places")), F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.repartitionByRange("_position").sortWithinPartitions("_position", key).select(*docs.columns)


def _needed(docs: DataFrame, options: dict) -> list[str]:
    return ["text"] if options.get("size") is not None and "text" in docs.columns else []
