"""Exact nearest neighbours among rows of 0/1 flags and numbers, by buckets that grow.

The distance is Euclidean over all features. Within a radius r two rows differ in at most r^2 flags,
so of r^2 + 1 segments of their flags one is the same; and their numbers lie in the same or in adjoining cells of
width r. Rows meet by an equi-join on segment and cell. A row that has found its k neighbours within the radius is
done; the others look again within a larger one, until the radius spans all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.session import stage

#: The first cells are the widest, in powers of two, that hold no more patterns than so many times k.
CROWD = 16
FINEST = 12
#: Probes with their segments and cells are sent to all tasks up to so many rows. Stored sizes say little about them: the
#: planner takes a side that is exploded for as small as its files.
FEW = 50_000


def patterns(df: DataFrame, flags: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Distinct rows of the features with their count: `bits` (flags as a text, the last one first), the numbers, `rows`."""
    bits = F.concat(*[F.col(f"`{f}`").cast("int").cast("string") for f in reversed(flags)]) if flags else F.lit("")
    return df.withColumn("bits", bits).groupBy("bits", *numbers).agg(F.count(F.lit(1)).alias("rows"))


def _cell(number: str, width: float) -> Column:
    return F.floor(F.col(number) / width)


def _first_width(points: DataFrame, numbers: Sequence[str], k: int) -> float:
    """Width of the first cells, from the counts of all widths at once."""
    if not numbers:
        return 0.0
    widths = [2.0**-i for i in range(FINEST + 1)]
    keys = F.array(*[F.concat_ws("/", F.lit(i), *[_cell(n, w).cast("string") for n in numbers]) for i, w in enumerate(widths)])
    crowds = points.select(F.posexplode(keys).alias("i", "cell")).groupBy("i", "cell").count().groupBy("i").agg(F.max("count").alias("most"))
    fine = [r["i"] for r in crowds.filter(F.col("most") <= CROWD * k).collect()]
    return widths[min(fine, default=FINEST)]


def _segments(n: int, squared: float) -> list[tuple[int, int]]:
    """(start, length) of flag segments of which one has to be equal; none where the radius spans all flags."""
    parts = int(squared) + 1
    if parts > n:
        return []
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a + 1, b - a) for a, b in zip(cuts, cuts[1:])]


def _met(probes: DataFrame, asked: int, points: DataFrame, numbers: Sequence[str], n_flags: int, squared: float) -> DataFrame:
    """Pairs of one of the `asked` probes and a point within the radius, each once, with their distance `d` squared."""
    width = math.sqrt(squared) * (1 + 1e-9) or 1e-9
    segments = _segments(n_flags, squared)
    keys = F.array(*[F.concat_ws("/", F.lit(i), F.substring("bits", a, m)) for i, (a, m) in enumerate(segments)]) if segments else F.array(F.lit("all"))
    cells = [_cell(n, width) for n in numbers]
    placed = points.select("*", F.explode(keys).alias("_seg"), *[c.alias(f"_c{i}") for i, c in enumerate(cells)])
    asking = probes.select("*", F.explode(keys).alias("_seg"), *[c.alias(f"_c{i}") for i, c in enumerate(cells)])
    for i in range(len(numbers)):
        around = F.array(F.col(f"_c{i}") - 1, F.col(f"_c{i}"), F.col(f"_c{i}") + 1)
        asking = asking.withColumn(f"_c{i}", F.explode(around))
    names = {"bits": "near_bits", "rows": "near_rows", **{n: f"near_{n}" for n in numbers}}
    on = ["_seg", *[f"_c{i}" for i in range(len(numbers))]]
    few = asked * max(1, len(segments)) * 3 ** len(numbers) <= FEW
    both = asking.drop("rows").hint("broadcast" if few else "merge").join(placed.withColumnsRenamed(names), on)
    flipped = _hamming("bits", "near_bits", n_flags)
    apart = [(F.col(n) - F.col(f"near_{n}")) * (F.col(n) - F.col(f"near_{n}")) for n in numbers]
    pairs = both.withColumn("d", reduce(lambda a, b: a + b, apart, flipped.cast("double"))).filter(F.col("d") <= squared)
    if segments:  # a pair counts in the first segment that both share
        first = reduce(lambda a, b: F.coalesce(a, b), [F.when(F.substring("bits", a, m) == F.substring("near_bits", a, m), F.lit(i)) for i, (a, m) in enumerate(segments)])
        pairs = pairs.filter(F.substring_index("_seg", "/", 1) == first.cast("string"))
    return pairs.drop(*on)


def _hamming(a: str, b: str, n: int) -> Column:
    """Places where two texts of 0 and 1 differ, by words of up to 60 places."""
    words = [(at + 1, min(60, n - at)) for at in range(0, n, 60)]
    number = lambda c, at, m: F.conv(F.substring(c, at, m), 2, 10).cast("bigint")
    counts = [F.bit_count(number(a, at, m).bitwiseXOR(number(b, at, m))) for at, m in words]
    return reduce(lambda x, y: x + y, counts, F.lit(0))


def nearest(df: DataFrame, flags: Sequence[str], numbers: Sequence[str] = (), k: int = 5) -> DataFrame:
    """For each pattern its nearest others, `reach`: (near_bits, near_numbers, upto) in order of distance, then of pattern.

    Rows count as often as they come; `upto` is how many neighbours the patterns so far bring, and the list ends once that
    is k. Fewer than k other rows give a shorter list. Numbers have to be set.
    """
    points = stage(patterns(df, flags, numbers), "points")
    spans = points.agg(F.sum("rows"), *[F.max(n) - F.min(n) for n in numbers]).first()
    whole = len(flags) + sum(float(s or 0) ** 2 for s in spans[1:]) + 1e-6
    squared = _first_width(points, numbers, k) ** 2
    own = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"near_{n}") for n in numbers], F.col("bits") == F.col("near_bits"))
    by = Window.partitionBy("bits", *numbers).orderBy(F.round("d", 9), "near_bits", *[f"near_{n}" for n in numbers])
    told, open_, asked = None, points, points.count()
    while True:
        last = squared >= whole
        others = _met(open_, asked, points, numbers, len(flags), squared).withColumn("others", F.col("near_rows") - own.cast("int")).filter("others > 0")
        ranked = others.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= k)
        upto = F.sum("others").over(by.rowsBetween(Window.unboundedPreceding, 0))
        near = ranked.withColumn("upto", upto).groupBy("bits", *numbers).agg(
            F.sort_array(F.collect_list(F.struct(F.col("_rank"), "near_bits", F.array(*[F.col(f"near_{n}").cast("double") for n in numbers]).alias("near_numbers"), "upto"))).alias("reach"),
            F.max("upto").alias("found"),
        )
        found = stage(near if last else near.filter(F.col("found") >= k), "near")
        told = found if told is None else told.unionByName(found)
        if last:
            break
        left = open_.join(found.select("bits", *numbers).hint("merge"), ["bits", *numbers], "left_anti")
        open_ = stage(left, "open")
        asked = open_.count()
        if not asked:
            break
        squared = min(whole, 4 * squared if squared else 2.0)
    cut = F.filter("reach", lambda x, i: (i == 0) | (F.get(F.col("reach"), i - 1)["upto"] < k))
    return told.select("bits", *numbers, F.transform(cut, lambda x: F.struct(x["near_bits"].alias("near_bits"), x["near_numbers"].alias("near_numbers"), x["upto"].alias("upto"))).alias("reach"))
