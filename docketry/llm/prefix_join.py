"""Exact Jaccard join of documents on word shingles, by grouped prefixes.

Two sets with a Jaccard index of t or more share a good part of any fixed share of their least
hashes. Each set therefore shows a prefix only, and sets with the same prefix and size are one
group. Hashes that occur in one group link nothing and go; what is left of a prefix must still be
long enough to hold the shared part. Of the remaining hashes the rarest are joined. Each of their
groups is first compared with one pivot; pairs are formed only across the components that this
leaves, then expanded to the members and verified on whole sets. That goes in rounds: a member first
names the closest one of another component that a hash shows it, and the components that
its true links join are not compared again; what no round joins is compared in full. No true link between
components is lost, and a large family of near copies costs a few comparisons for each member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.components import components
from docketry.llm.text_batches import list_array, mix, pieces, shingle_sets, signed, word_hashes
from docketry.llm.workers import if_small, map_arrow
from docketry.session import stage

#: Sets of up to SHORT[1] hashes are compared with each other by prefixes that have LONG_SPARE percent
#: more hashes than a join needs, sets of more than SHORT[0] by prefixes with SPARE percent more. The
#: two ranges overlap by the ratio of sizes that linked sets can have, so each pair has its range.
#: A long prefix is cheap for a short text and keeps passages that many texts share from pairing them.
SHORT = (256, 320)
LONG_SPARE, SPARE = 60, 8
#: Bits of a set's parity map: each hash flips one. Two maps differ in no more bits than the sets do in hashes.
BITS = 512
#: Of the hashes that a group shares with others, each of its rows carries so many least ones.
FIRSTS = 16
#: Fills the lists of those with fewer.
NONE = (1 << 31) - 1
#: At most so many rounds in which each row names its closest partner; one that joins nothing ends them, and all partners are named.
ROUNDS = 3
#: Rows of a hash that one step compares with each other; more are cut into blocks, pair by pair.
BLOCK = 2000


def _prefix(n: int, percent: int, more: int) -> tuple[int, int]:
    """Length of the prefix of a set of n, and how many of its hashes any partner's prefix shares.

    Prefixes of n - ceil(t n) + l hashes of two linked sets share at least the smaller l.
    """
    least = -(-percent * n // 100)
    spare = lambda k: max(1, math.ceil(more * k / 100))
    return min(n, n - least + spare(n)), spare(least)


def _prefixes(s: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """The prefixes of a sorted set, long and short, as 31-bit hashes with the kind in the last bit, and what is shared."""
    out = []
    for kind, more in ((0, LONG_SPARE), (1, SPARE)):
        if (len(s) > SHORT[1]) if kind == 0 else (len(s) * 100 <= SHORT[1] * percent):
            out.append((np.zeros(0, np.int32), 0))
            continue
        length, need = _prefix(len(s), percent, more)
        short = np.unique((s[:length] >> np.uint64(33)).astype(np.uint32) << np.uint32(1) | np.uint32(kind))
        # Two hashes that fall together may be one shared hash less.
        out.append((short.view(np.int32), max(1, need - (length - len(short)))))
    return out


def shingle_table(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: size of its set, fingerprints of set and prefix, and the prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            hashes, first = word_hashes(data, offsets)
            out: list[tuple] = []
            prefixes: list[list[np.ndarray]] = [[], []]
            parity: list[bytes] = []
            for s in shingle_sets(hashes, first, words):
                whole = mix(s * np.uint64(0x9E3779B97F4A7C15))
                (long, a), (short, b) = _prefixes(s, percent) if len(s) else [(np.zeros(0, np.int32), 0)] * 2
                shown = mix((long if len(long) else short).view(np.uint32).astype(np.uint64) + np.uint64(1))
                names = np.array([whole.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(whole)), shown.sum(dtype=np.uint64)], np.uint64)
                out.append((len(s), a, b, *signed(names).tolist()))
                parity.append(np.packbits(np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).tobytes())
                prefixes[0].append(long)
                prefixes[1].append(short)
            columns = [np.array(c, np.int64) for c in zip(*out, strict=True)]
            lists = [list_array(np.concatenate(x), np.fromiter(map(len, x), np.int64, len(x)), pa.int32()) for x in prefixes]
            yield pa.RecordBatch.from_arrays([rows.column(key), *(pa.array(c) for c in columns), *lists, pa.array(parity, pa.binary())], [key, "n", "need0", "need1", "f1", "f2", "p", "prefix0", "prefix1", "parity"])

    kind = docs.schema[key].dataType.simpleString()
    return map_arrow(docs.select(key, text), run, f"`{key}` {kind}, n long, need0 long, need1 long, f1 long, f2 long, p long, prefix0 array<int>, prefix1 array<int>, parity binary")


def _sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in pieces(batches, text):
            sets = [signed(s) for s in shingle_sets(*word_hashes(data, offsets), words)]
            counts = np.fromiter(map(len, sets), np.int64, len(sets))
            yield pa.RecordBatch.from_arrays([rows.column(key), list_array(np.concatenate(sets) if sets else np.zeros(0, np.int64), counts, pa.int64())], ["unit", "shingles"])

    return map_arrow(docs.select(key, text), run, f"unit {docs.schema[key].dataType.simpleString()}, shingles array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of units whose whole sets are similar enough."""
    left = sets.select(F.col("unit").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("unit").alias("v"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", shared.alias("i"), (F.size("a") + F.size("b")).alias("t"))
    return both.where(F.expr(f"100 * i >= {percent} * (t - i)")).select("u", "v").distinct()


def similar(percent: int) -> F.Column:
    """Whether sizes m and n allow the similarity at all."""
    return (100 * F.least("m", "n") >= percent * F.greatest("m", "n")) & (F.col("m") > 0)


def _torn(rows: DataFrame) -> DataFrame:
    """The rows of those hashes that still occur in several components."""
    torn = rows.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("many")).where("lo < hi").select("h", "many")
    return rows.join(torn, "h").select("h", "many", "unit", "n", "c", "parity", "firsts")


def _across(rows: DataFrame, percent: int, closest: bool) -> DataFrame:
    """`h, u, v`: pairs of units that share a hash and may be similar, judged by sizes and parity maps.

    Units of one component are not compared again. A pair is left to a lower hash where the `firsts` of
    both show one: the least hash that two units share always writes it, and seldom does another.
    With `closest`, each row names at most one partner in each block, the one whose parity map is nearest.
    """
    kind = rows.schema["unit"].dataType.simpleString()
    dealt = rows.withColumn("blocks", F.ceil(F.col("many") / BLOCK).cast("int")).withColumn("blk", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")).select("h", F.least("blk", "o").alias("x"), F.greatest("blk", "o").alias("y"), "blk", "unit", "n", "c", "parity", "firsts")

    def compared(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        unit, n, c, blk = (part.column(k).to_numpy() for k in ("unit", "n", "c", "blk"))
        own = part.column("x")[0].as_py() == part.column("y")[0].as_py()
        h = part.column("h")[0].as_py()
        firsts = pc.list_flatten(part.column("firsts")).to_numpy().reshape(len(unit), FIRSTS)
        bits = np.frombuffer(b"".join(part.column("parity").to_pylist()), np.uint64).reshape(len(unit), -1)
        one = np.arange(len(unit)) if own else np.flatnonzero(blk == part.column("x")[0].as_py())
        two = one if own else np.flatnonzero(blk != part.column("x")[0].as_py())
        us, vs = [], []
        for i in one.tolist():
            j = two[(two > i) if own else slice(None)]
            j = j[(c[j] != c[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = apart * (100 + percent) <= (100 - percent) * (n[j] + n[i])
            j, apart = j[near], apart[near]
            if len(j):
                lower = firsts[i][(firsts[i] < h) & (firsts[i] != NONE)]
                own_pair = (firsts[j][:, :, None] != lower).all(axis=(1, 2))
                j, apart = j[own_pair], apart[own_pair]
                if closest and len(j):
                    j = j[[int(np.argmin(apart))]]
            us.append(np.full(len(j), unit[i]))
            vs.append(unit[j])
        u, v = np.concatenate(us), np.concatenate(vs)
        return (np.full(len(u), h), np.minimum(u, v), np.maximum(u, v)) if len(u) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done() -> Iterator[pa.RecordBatch]:
            if sum(h.num_rows for h in held) > 1 and (found := compared(pa.Table.from_batches(held).combine_chunks().to_batches()[0])):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["h", "u", "v"])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("h", "x", "y")], axis=1)
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b > a:
                    if tuple(keys[a]) != last:
                        yield from done()
                        held, last = [], tuple(keys[a])
                    held.append(batch.slice(a, b - a))
        yield from done()

    part = ["h", "x", "y"]
    return map_arrow(dealt.repartition(*part).sortWithinPartitions(*part), run, f"h long, u {kind}, v {kind}")


def _nearer_heads(links: DataFrame) -> DataFrame:
    """`c, head`: for each end of links (u, v) the least end that it reaches in one step, and from there in one more.

    Ends with one head are of one component. Not all of a component need have one head: they are then compared once more.
    """
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.min("u")).alias("head"))
    again = least.select(F.col("c").alias("head"), F.col("head").alias("further"))
    return stage(least.join(again, "head").select("c", F.col("further").alias("head")), "heads")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """`key, n_shingles, component_id` for every row; the component is the least key that links reach.

    Words are split at white space and A-Z lowered. Fewer than `words` words make one shingle;
    texts without words and null texts have none and are linked with nothing. Rows with a null key
    keep a null component. Rows that share a key are one document: what links one links the other.
    """
    rows = stage(shingle_table(docs, key, text, words, percent), "shingles")
    linked = rows.where(F.col("n") > 0).where(F.col(key).isNotNull())
    units = stage(linked.groupBy("n", "p", "f1", "f2").agg(F.min(key).alias("unit"), F.min("parity").alias("parity")), "units")
    sizes = units.groupBy("n", "p").agg(F.min("unit").alias("grp"), F.count("*").alias("k"))
    members = stage(units.join(sizes, ["n", "p"]).select("unit", "grp", "n", "k"), "members")
    # Of each group one document shows its prefixes.
    heads = members.where("unit = grp").select("grp", "n")
    shown = linked.join(if_small(heads.select(F.col("grp").alias(key))), key, "left_semi")
    hashes = shown.select(F.col(key).alias("grp"), F.explode(F.concat("prefix0", "prefix1")).alias("h"))
    shared = hashes.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    left = hashes.join(shared, "h").groupBy("grp", F.col("h").bitwiseAND(F.lit(1)).alias("kind")).agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("q"))
    need = shown.select(F.col(key).alias("grp"), "n", "need0", "need1").dropDuplicates(["grp"])
    left = left.join(need, "grp").withColumn("need", F.when(F.col("kind") == 0, F.col("need0")).otherwise(F.col("need1")))
    rare = left.where(F.size("q") >= F.col("need")).select("grp", "n", F.explode(F.expr("slice(q, 1, cast(size(q) - need + 1 as int))")).alias("x"))
    rare = stage(rare.select("grp", "n", F.col("x.h").alias("h")), "rare")
    again = rare.groupBy("h").agg(F.min(F.struct("n", "grp")).alias("pivot"), F.count("*").alias("c")).where("c > 1")

    starred = rare.join(again, "h").select("grp", "n", F.col("pivot.grp").alias("v"), F.col("pivot.n").alias("m")).where(similar(percent)).where("grp <> v").select("grp", "v").distinct()
    inner = members.where("unit <> grp").select(F.col("unit").alias("u"), F.col("grp").alias("v"))
    pairs = stage(starred.join(members, "grp").select(F.col("unit").alias("u"), "v").unionAll(inner).distinct(), "pairs")
    several = members.where("k > 1").select("grp", "unit")
    asked = rare.join(again.select("h"), "h", "left_semi").select("grp").distinct()
    wanted = stage(asked.join(members, "grp").select("unit").unionAll(several.select("unit")).distinct(), "wanted")
    sets = stage(_sets(docs.select(key, text).join(if_small(wanted.withColumnRenamed("unit", key)), key, "left_semi"), key, text, words), "sets")
    links = stage(_verified(pairs, sets, percent), "links")

    found = stage(components(links), "found")
    placed = members.join(found, F.col("unit") == F.col("node"), "left").select("unit", "grp", "n", F.coalesce("component", "unit").alias("c"))
    placed = stage(placed.join(if_small(wanted), "unit", "left_semi"), "placed")
    met = rare.join(again.select("h"), "h", "left_semi").select("grp", "h")
    # Two units of different components that both have a hash keep it in _torn, so any hash of these lists will do.
    fill = F.array_repeat(F.lit(NONE), FIRSTS)
    firsts = met.groupBy("grp").agg(F.slice(F.concat(F.sort_array(F.collect_set("h")), fill), 1, FIRSTS).alias("firsts"))
    of = placed.join(units.select("unit", "parity"), "unit").join(firsts, "grp", "left").withColumn("firsts", F.coalesce("firsts", fill))
    shown = met.select(F.col("h").cast("long").alias("h"), "grp").join(of.select("grp", "unit", "n", "c", "parity", "firsts"), "grp")
    # Members of one group meet under a number of their own.
    inner = of.select(F.col("grp").cast("long").alias("h"), "grp", "unit", "n", "c", "parity", "firsts")
    rows_of = _torn(shown).unionByName(_torn(inner).withColumn("h", F.lit(1 << 62) - F.col("h")))
    torn = stage(rows_of, "torn")
    closest, step = True, 0
    while True:
        more = stage(_across(torn, percent, closest), "residual")
        if more.isEmpty():
            break
        named = more.select("u", "v").distinct()
        asked = more.select(F.explode(F.array("u", "v")).alias("unit")).distinct()
        true = stage(_verified(named, sets.join(if_small(asked), "unit", "left_semi"), percent), "links")
        links = links.unionAll(true)
        if not closest:
            break
        step += 1
        closest = step < ROUNDS and not true.isEmpty()
        # Only hashes that named a pair can name another one.
        c_of = torn.select("unit", "c").distinct()
        ends = true.join(c_of.withColumnsRenamed({"unit": "u", "c": "a"}), "u").join(c_of.withColumnsRenamed({"unit": "v", "c": "b"}), "v")
        merged = _nearer_heads(ends.select(F.col("a").alias("u"), F.col("b").alias("v")))
        left = torn.join(if_small(more.select("h").distinct()), "h", "left_semi")
        moved = left.join(merged, "c", "left").withColumn("c", F.coalesce("head", "c")).drop("head", "many")
        torn = stage(_torn(moved), "torn")

    final = units.join(components(links), F.col("unit") == F.col("node"), "left").select("n", "p", "f1", "f2", F.coalesce("component", "unit").alias("component_id"))
    out = rows.select(key, "n", "p", "f1", "f2").join(final, ["n", "p", "f1", "f2"], "left")
    own = F.when(F.col(key).isNull(), F.lit(None)).otherwise(F.coalesce("component_id", key))
    return out.select(key, F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs`, with all their columns, but for near duplicates of a kept one.

    Of each component the document with the least key stays, once; rows with a null key stay.
    """
    found = stage(near_duplicates(docs, key, text, words, percent).groupBy(key).agg(F.min("component_id").alias("c"), F.count("*").alias("k")), "classes")
    gone = found.where(f"c <> `{key}`").select(key)
    repeated = found.where(f"c = `{key}` and k > 1").select(key)
    single = docs.join(if_small(gone.unionAll(repeated)), key, "left_anti")
    return single.unionByName(docs.join(if_small(repeated), key, "left_semi").dropDuplicates([key]))
