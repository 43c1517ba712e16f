"""Benchmark passages in training documents, found by spaced seeds and tolerant of substitutions.

A seed hashes the tokens at the set positions of a fixed mask, so a substitution at an ignored
position leaves it whole. Seeds of documents are joined with those of the benchmark; around each
hit the two texts are compared token by token along its diagonal. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.text import bind
from docketry.session import stage

#: Which of the tokens in a row count. Light masks keep passages in which a third of the tokens was replaced: of items
#: of 12 tokens or more that meet the rule at such a rate, 99 % have a seed hit (README), and no two
#: substitutions in 13 tokens leave none.
MASKS = ("1111", "110011", "1010011")
WINDOW = 13
#: A window of agreeing tokens has at least so many; items of fewer have to be there whole.
LEAST = 8
#: Seeds and found diagonals are looked up in a broadcast table if it has at most so many rows, else by a shuffle.
SMALL_SEEDS = 1_000_000


def tokens(text: str) -> Column:
    """Hashes of the lower-cased runs of characters other than white space and ASCII punctuation; none for null."""
    words = F.array_remove(F.split(F.lower(text), r"[\s\p{Punct}]+"), "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def _seeded(df: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """`i, _seed` for each row with tokens `t` and each place and mask; the seed is null where the mask does not fit.

    The outer forms of explode have no test of their own that would compute the tokens a second time.
    """
    span = min(map(len, masks))
    placed = df.withColumn("i", F.explode_outer(F.when(F.size("t") >= span, F.sequence(F.lit(0), F.size("t") - span))))
    at = lambda k: F.get("t", F.col("i") + k)
    seeds = [F.when(at(len(m) - 1).isNotNull(), F.xxhash64(F.lit(n), *[at(k) for k, bit in enumerate(m) if bit == "1"])) for n, m in enumerate(masks)]
    return placed.withColumn("_seed", F.explode_outer(F.array(*seeds))).drop("t")


def _equal(a: Column, b: Column) -> Column:
    """1 where two arrays agree, 0 where not, for each place."""
    return F.zip_with(a, b, lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0)))


def _along(doc: Column, item: Column, diagonal: Column) -> Column:
    """Agreement of document and item along a diagonal, over the places that both have."""
    start, skipped = F.greatest(diagonal, F.lit(0)), F.greatest(-diagonal, F.lit(0))

    def placed(t: Column) -> Column:
        n = F.least(F.size(t) - start, F.size(item) - skipped)
        return _equal(F.slice(t, start + 1, n), F.slice(item, skipped + 1, n))

    return bind(doc, placed)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW, window_percent: int = 80, item_percent: int = 60
) -> DataFrame:
    """`key, item, doc_token, best_window, equal_tokens, item_tokens` for each document and item that overlap.

    They overlap if along the diagonal of a seed hit some `window` tokens in a row agree in `window_percent`
    (where the diagonal is shorter, all of it, which has to be LEAST tokens), or the item's tokens do in
    `item_percent`; of items of fewer than LEAST tokens all have to agree. The row tells the best such diagonal: where it starts in the
    document and what agreed. Items and documents with fewer tokens than any mask are compared as a whole
    and overlap when equal; empty and null texts overlap with nothing. Rows that repeat a key, and rows with a null key, count as
    one document; rows that repeat an item id, or have none, are items of their own under that id. Extra columns are not read.
    """
    span = min(map(len, masks))
    items = benchmark.select(F.monotonically_increasing_id().alias("_no"), F.col(item).alias("_item"), tokens(item_text).alias("t"))
    items = stage(items.where(F.size("t") > 0), "items")
    n = items.agg(F.sum(F.size("t")), F.max(F.when(F.size("t") < span, 1))).first()
    few = (n[0] or 0) * len(masks) <= SMALL_SEEDS
    small = F.broadcast if few else lambda df: df.hint("merge")
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    seeds = _seeded(items.select("_no", "t"), masks).where("_seed is not null")
    lists = seeds.groupBy("_seed").agg(F.collect_list(F.struct("_no", F.col("i").alias("j"))).alias("_hits"))
    probes = _seeded(named.select("_key", tokens("_text").alias("t")), masks)
    met = probes.join(small(lists), "_seed").select("_key", "i", F.explode("_hits").alias("_h"))
    found = met.select("_key", F.col("_h._no").alias("_no"), (F.col("i") - F.col("_h.j")).alias("_d"))
    if n[1]:
        whole = items.where(F.size("t") < span).select("_no", F.col("t").alias("_tokens"))
        short = named.where(F.octet_length("_text") < 1 << 10).select("_key", tokens("_text").alias("_tokens"))
        found = found.unionByName(short.join(small(whole), "_tokens").select("_key", "_no", F.lit(0).alias("_d")))
    # Each diagonal is compared once, however many seeds met on it.
    found = stage(found.distinct(), "diagonals")
    listed = found.count() <= SMALL_SEEDS
    again = F.broadcast if listed else lambda df: df.hint("merge")
    keys = found.select(F.col("_key").alias("_same")).distinct()
    texts = named.join(again(keys), F.col("_key").eqNullSafe(F.col("_same")), "left_semi")
    pairs = texts.join(again(found.withColumnRenamed("_key", "_same")), F.col("_key").eqNullSafe(F.col("_same"))).drop("_same")
    hits = pairs.join(small(items.withColumnRenamed("t", "_b")), "_no")
    # Written, since the sums below read it at every place.
    agree = stage(hits.select("_key", "_item", "_d", F.size("_b").alias("item_tokens"), _along(tokens("_text"), F.col("_b"), F.col("_d")).alias("_e")), "agreement")
    # Sums of all windows: the running sum of agreement less the one a window earlier.
    width = F.least(F.lit(window), F.size("_e"))
    sums = F.expr(f"transform(sequence(0, size(_e) - least({window}, size(_e))), k -> aggregate(slice(_e, k + 1, least({window}, size(_e))), 0, (s, x) -> s + x))")
    rated = agree.select("_key", "_item", "_d", "item_tokens", F.size("_e").alias("_n"), width.alias("_w"), F.array_max(sums).alias("best_window"), F.aggregate("_e", F.lit(0), lambda s, x: s + x).alias("equal_tokens"))
    wide, long = F.col("_n") >= LEAST, F.col("item_tokens") >= LEAST
    close = rated.where((F.col("equal_tokens") == F.col("item_tokens")) | long & ((wide & (F.col("best_window") * 100 >= F.col("_w") * window_percent)) | (F.col("equal_tokens") * 100 >= F.col("item_tokens") * item_percent)))
    best = close.groupBy("_key", "_item").agg(F.max(F.struct("equal_tokens", "best_window", (-F.col("_d")).alias("_d"), "item_tokens")).alias("x"))
    return best.select(F.col("_key").alias(key), F.col("_item").alias(item), F.greatest(-F.col("x._d"), F.lit(0)).alias("doc_token"), "x.best_window", "x.equal_tokens", "x.item_tokens")


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, whose document overlaps with no benchmark item."""
    found = overlaps(docs, benchmark, key, **options).select(F.col(key).alias("_found")).distinct()
    return docs.join(found, F.col(key).eqNullSafe(F.col("_found")), "left_anti")
