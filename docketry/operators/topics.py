"""Text to tokens, phrases, term weights and topics.

Token arrays stay in their document's row as long as possible: cleaning, pairing and term
counting need no shuffle. Shuffles carry terms with their counts.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import LDA, KMeans, KMeansModel, LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V
from docketry.functions.text import bind, explode_once
from docketry.session import stage
from docketry.sources.counted import Counted


def clean_text(text: Column) -> Column:
    """Punctuation out, lower case, accents and digits out, single blanks."""
    lowered = F.lower(F.regexp_replace(text, f"[{re.escape(string.punctuation)}0-9]+", ""))
    plain = bind(
        lowered,
        lambda t: F.when(t.rlike("[^\\x00-\\x7f]"), F.translate(t, V.ACCENTED, V.UNACCENTED)).otherwise(t),
    )
    return F.trim(F.regexp_replace(plain, "[ \\t\\n\\r\\f\\u000b]+", " "))


def expand_contractions(tokens: Column) -> Column:
    """'dont' becomes 'do', 'not'. Few texts have any; the others stay as they are."""
    full = F.create_map(*[F.lit(x) for kv in V.CONTRACTIONS.items() for x in kv])
    words = list(V.CONTRACTIONS)
    spread = lambda ts: F.flatten(F.transform(ts, lambda t: F.when(t.isin(words), F.split(F.try_element_at(full, t), " ")).otherwise(F.array(t))))
    return bind(tokens, lambda ts: F.when(F.arrays_overlap(ts, F.array(*map(F.lit, words))), spread(ts)).otherwise(ts))


def tokenize(text: Column) -> Column:
    """Words of a cleaned text."""
    return F.filter(expand_contractions(F.split(clean_text(text), " ")), lambda t: t != "")


def stopword_table(base: DataFrame, custom: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """(base and custom) without the removed, with the added; all are one-column word tables."""
    return base.unionByName(custom).join(removed, "word", "left_anti").unionByName(added).distinct()


def remove_stopwords(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are no stop word, repeats kept; the list becomes a hash set in the plan."""
    return F.filter(tokens, lambda t: ~t.isin(list(words)))


def word_frequencies(df: DataFrame, tokens: str, top: int | None = None) -> DataFrame:
    """Words by how often they occur; all of them unless `top` is given."""
    words = df.select(explode_once(tokens).alias("word")).filter(F.col("word").isNotNull())
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return _first(counts, top, F.desc("n"), "word")


def _first(df: DataFrame, n: int | None, *order: Column | str) -> DataFrame:
    return df if n is None else df.orderBy(*order).limit(n)


def pairs(tokens: Column) -> Column:
    """Neighbouring tokens as {a, b}, in order."""
    return bind(
        tokens,
        lambda t: F.zip_with(
            F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0))),
            F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        ),
    )


#: Tokens that a pass counts, and the passes at most: pairs of words are shuffled pass by pass, so that their files are a part of the text.
PASS_TOKENS, PASSES = 10_000_000, 4


def phrase_passes(df: DataFrame, tokens: str) -> int:
    """Passes for the pairs of a table of tokens; one for few of them."""
    many = df.agg(F.sum(F.greatest(F.size(tokens), F.lit(0)))).first()[0] or 0
    return min(PASSES, max(1, -(-many // PASS_TOKENS)))


def _in_pass(n: int, passes: int) -> Column:
    return F.pmod(F.xxhash64("a", "b"), F.lit(passes)) == n if passes > 1 else F.lit(True)


def phrases(df: DataFrame, tokens: str, min_count: int, threshold: float, passes: int = 1) -> DataFrame:
    """Collocations (a, b, n, score) with score = (n_ab - min) * V / (n_a * n_b) above the threshold.

    V counts distinct words and distinct pairs, which share one vocabulary. One shuffle (one a pass)
    counts both kinds; V is counted as the words and the pairs that are frequent enough are staged. The
    joins that follow see each of these once.
    """
    single = F.transform(tokens, lambda t: F.struct(t.alias("a"), F.lit(None).cast("string").alias("b")))
    each = df.select(explode_once(F.concat(single, pairs(F.col(tokens)))).alias("g")).filter("g IS NOT NULL").select("g.a", "g.b")
    parts, size = [], 0
    for n in range(passes):
        counted = Counted(each.filter(_in_pass(n, passes)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
        parts.append(stage(counted.df.filter(F.col("b").isNull() | (F.col("n") >= min_count)), "phrase-counts"))
        size += counted.rows
    counts = reduce(DataFrame.unionAll, parts)
    words = counts.filter(F.col("b").isNull()).select("a", F.col("n").alias("n_a"))
    often = counts.filter(F.col("b").isNotNull() & (F.col("n") >= min_count))
    scored = often.join(words, "a").join(words.select(F.col("a").alias("b"), F.col("n_a").alias("n_b")), "b")
    scored = scored.withColumn("_v", F.lit(float(size))).withColumn(
        "score", F.round((F.col("n") - min_count) / F.col("n_a") / F.col("n_b") * F.col("_v"), 6)
    )
    return scored.filter(F.col("score") > threshold).select("a", "b", "n", "score")


def apply_phrases(df: DataFrame, found: DataFrame, key: str, tokens: str, into: str | None = None, passes: int = 1) -> DataFrame:
    """Join the words of a phrase with '_', left to right without overlap.

    In a run of neighbouring hits every second one is taken, counted from the start of the
    run. Only the places of the hits are grouped, then cut the token array in its row. With several
    passes the pairs of each are matched and their hits staged one after the other.
    """
    at = df.select(key, F.posexplode_outer(pairs(F.col(tokens))).alias("pos", "p")).filter("pos IS NOT NULL")
    placed, wanted = at.select(key, "pos", F.col("p.a").alias("a"), F.col("p.b").alias("b")), found.select("a", "b")
    if passes > 1:
        wanted = stage(wanted, "phrases")
        some = [placed.filter(_in_pass(n, passes)).join(wanted.filter(_in_pass(n, passes)), ["a", "b"]).select(key, "pos") for n in range(passes)]
        hits = reduce(DataFrame.unionAll, [stage(x, "phrase-hits") for x in some])
    else:
        hits = placed.join(wanted, ["a", "b"])
    w = Window.partitionBy(key).orderBy("pos")
    runs = hits.select(key, "pos").withColumn("_run", F.col("pos") - F.row_number().over(w))
    first = F.min("pos").over(Window.partitionBy(key, "_run"))
    taken = runs.withColumn("_from", first).filter((F.col("pos") - F.col("_from")) % 2 == 0)
    places = taken.groupBy(key).agg(F.sort_array(F.collect_list("pos")).alias("_at"))

    t, m = F.col(tokens), F.col("_at")
    after = lambda i: F.coalesce(F.get(m, i - 1) + 2, F.lit(0))
    joined = lambda p: F.concat(F.get(t, p), F.lit("_"), F.get(t, p + 1))
    pieces = F.transform(m, lambda p, i: F.concat(F.slice(t, after(i) + 1, p - after(i)), F.array(joined(p))))
    end = F.element_at(m, -1) + 2
    merged = F.concat(F.flatten(pieces), F.slice(t, end + 1, F.size(t)))
    out = df.join(places, key, "left").withColumn(into or tokens, F.when(m.isNull(), t).otherwise(merged))
    return out.drop("_at")


def term_counts(tokens: Column) -> Column:
    """Array of {term, n} of one document, by sorting its tokens in place."""

    def count(s: Column) -> Column:
        n = F.size(s)
        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | (F.get(s, i) != F.get(s, i + 1)))
        return bind(
            ends,
            lambda e: F.transform(
                e,
                lambda i, j: F.struct(F.get(s, i).alias("term"), (i - F.coalesce(F.get(e, j - 1), F.lit(-1))).alias("n")),
            ),
        )

    return F.when(F.size(tokens) > 0, bind(F.sort_array(tokens), count))


def vocabulary(
    df: DataFrame, tokens: str, min_df: int = 2, max_df: float = 0.9, keep: int | None = None
) -> DataFrame:
    """(term, df, n) of terms in at least ``min_df`` and at most a share of documents; all unless `keep` is given."""
    total = df.agg(F.count(F.lit(1)).cast("double").alias("d")).scalar()
    counts = (
        df.select(explode_once(term_counts(F.col(tokens))).alias("c"))
        .filter("c IS NOT NULL")
        .groupBy(F.col("c.term").alias("term"))
        .agg(F.count(F.lit(1)).alias("df"), F.sum("c.n").alias("n"))
        .withColumn("_d", total)
    )
    kept = counts.filter((F.col("df") >= min_df) & (F.col("df") <= F.col("_d") * max_df)).drop("_d")
    return _first(kept, keep, F.desc("df"), "term")


def bag_of_words(df: DataFrame, key: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """(key, term, n) for terms of the vocabulary."""
    counted = df.select(key, explode_once(term_counts(F.col(tokens))).alias("c")).filter("c IS NOT NULL").select(key, "c.term", "c.n")
    return counted.join(vocab.select("term"), "term", "left_semi").select(key, "term", "n")


def tfidf(df: DataFrame, key: str, tokens: str, max_features: int | None = None, digits: int = 9) -> DataFrame:
    """(key, term, weight): count times ln(N/df)+1, rows normed to sum 1.

    An L2 norm before the L1 norm is a factor that cancels out, so it is left out.
    """
    total = df.agg(F.count(F.lit(1)).cast("double").alias("d")).scalar()
    each = df.select(key, explode_once(term_counts(F.col(tokens))).alias("c")).filter("c IS NOT NULL")
    counted = stage(each.select(key, "c.term", "c.n"), "term-counts")
    terms = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("_n"))
    top = _first(terms, max_features, F.desc("_n"), "term").withColumn("_d", total)
    idf = top.select("term", (F.log(F.col("_d") / F.col("df")) + 1).alias("_idf"))
    weighted = counted.join(idf, "term").withColumn("_w", F.col("n") * F.col("_idf"))
    row = F.sum("_w").over(Window.partitionBy(key))
    return weighted.withColumn("weight", F.round(F.col("_w") / row, digits)).select(key, "term", "weight")


def class_tfidf(df: DataFrame, topic: str, tokens: str, digits: int = 6) -> DataFrame:
    """(topic, term, n, weight): share of the term in its topic times ln(1 + A / n_term).

    A is the mean number of words per topic. The counts are staged: four steps read them.
    """
    counts = (
        df.select(topic, explode_once(term_counts(F.col(tokens))).alias("c"))
        .filter("c IS NOT NULL")
        .groupBy(topic, F.col("c.term").alias("term"))
        .agg(F.sum("c.n").alias("n"))
    )
    counts = stage(counts, "class-counts")
    per_topic = counts.groupBy(topic).agg(F.sum("n").alias("_words"))
    per_term = counts.groupBy("term").agg(F.sum("n").alias("_all"))
    mean = per_topic.agg(F.avg("_words").alias("a")).scalar()
    joined = counts.join(per_topic, topic).join(per_term, "term").withColumn("_a", mean)
    weight = F.col("n") / F.col("_words") * F.log(1 + F.col("_a") / F.col("_all"))
    return joined.select(topic, "term", "n", F.round(weight, digits).alias("weight"))


def top_terms(weights: DataFrame, topic: str, weight: str = "weight", n: int = 10) -> DataFrame:
    """The n heaviest terms of each topic with their rank."""
    w = Window.partitionBy(topic).orderBy(F.desc(weight), "term")
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def coherence(docs: DataFrame, key: str, tokens: str, topics: DataFrame, digits: int = 6) -> DataFrame:
    """(topic, npmi, umass) for topic words (topic, term, rank), from document co-occurrence.

    Only topic words are paired, inside their document, so a document brings at most one
    row per topic and word pair.
    """
    total = docs.agg(F.count(F.lit(1)).cast("double").alias("d")).scalar()
    # Words of no topic leave inside their row.
    wanted_words = [r[0] for r in topics.select("term").distinct().collect()]
    held = F.array_distinct(F.filter(F.col(tokens), lambda t: t.isin(wanted_words)))
    words = docs.select(key, explode_once(held).alias("term")).filter("term IS NOT NULL")
    # A topic holds a fixed, small number of words, and so does each group of this aggregate.
    present = words.join(topics, "term").groupBy(key, "topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("t")
    )
    couples = F.flatten(
        F.transform(
            "t",
            lambda x, i: F.transform(
                F.slice(F.col("t"), i + 1, F.size("t")), lambda y: F.struct(x["rank"].alias("a"), y["rank"].alias("b"))
            ),
        )
    )
    counts = present.select("topic", F.explode(couples).alias("p")).groupBy("topic", "p.a", "p.b").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    ranks = topics.select("topic", F.col("rank").alias("a"))
    wanted = ranks.join(ranks.withColumnRenamed("a", "b"), "topic").filter("a < b")
    alone = counts.filter("a = b").select("topic", "a", F.col("n").alias("n_a"))
    both = counts.filter("a < b").withColumnRenamed("n", "n_ab")
    joined = (
        wanted.join(both, ["topic", "a", "b"], "left")
        .join(alone, ["topic", "a"])
        .join(alone.select("topic", F.col("a").alias("b"), F.col("n_a").alias("n_b")), ["topic", "b"])
        .withColumn("_d", total)
    )
    n, d = F.col("n_ab"), F.col("_d")
    npmi = F.when(n.isNull(), -1.0).when(n == d, 1.0).otherwise(
        F.log(n * d / (F.col("n_a") * F.col("n_b"))) / -F.log(n / d)
    )
    umass = F.log((F.coalesce(n, F.lit(0.0)) + 1) / F.col("n_a"))
    return joined.groupBy("topic").agg(F.round(F.avg(npmi), digits).alias("npmi"), F.round(F.avg(umass), digits).alias("umass"))


def lda_models(
    df: DataFrame, tokens: str, ks: Sequence[int] = (2, 3, 4, 5), passes: int = 10, seed: int = 1111,
    min_df: int = 2, max_df: float = 0.9, *, keep: int, counted: tuple[DataFrame, list[str]] | None = None,
) -> tuple[dict[int, LDAModel], DataFrame, list[str]]:
    """One LDA model per topic count over the same counts, with the counts and the vocabulary.

    The vocabulary, the most frequent words, is counted from the rows; nothing keeps the texts in memory. More models of
    the same rows and bounds can be given what was `counted` before, the counts and the vocabulary.
    """
    if counted is None:
        found = vocabulary(df, tokens, min_df, max_df).orderBy(F.desc("n"), "term").limit(keep)
        vectorizer = CountVectorizerModel.from_vocabulary([r["term"] for r in found.collect()], inputCol=tokens, outputCol="counts")
        counted = stage(vectorizer.transform(df).drop(tokens), "counts"), vectorizer.vocabulary
    counts, words = counted
    models = {
        k: LDA(k=k, maxIter=passes, seed=seed, featuresCol="counts", optimizeDocConcentration=True).fit(counts) for k in ks
    }
    return models, counts, words


def lda_terms(model: LDAModel, vocab: list[str], n: int = 10) -> DataFrame:
    """(topic, rank, term, weight) of a fitted model; the vocabulary is capped when it is learned."""
    described = model.describeTopics(n)
    words = described.sparkSession.createDataFrame(list(enumerate(vocab)), "term_no int, term string")
    rows = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
    numbered = rows.select(
        "topic", (F.col("rank") + 1).alias("rank"), F.col("t.termIndices").alias("term_no"), F.col("t.termWeights").alias("weight")
    )
    return numbered.join(words, "term_no").select("topic", "rank", "term", "weight")


def assign_topics(model: LDAModel, counted: DataFrame, key: str) -> DataFrame:
    """(key, topic, probability): likeliest topic of each document."""
    shares = model.transform(counted).select(key, vector_to_array("topicDistribution").alias("p"))
    top = F.array_max("p")
    return shares.select(key, (F.array_position("p", top) - 1).cast("int").alias("topic"), top.alias("probability"))


def dense_numbers(df: DataFrame, key: str, into: str, groups: int = 256) -> DataFrame:
    """(key, number): the distinct keys of any type numbered from 0 without gaps.

    Keys are numbered within groups of a hash, and the groups' sizes give where each starts.
    """
    keys = stage(df.select(key).distinct().withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups))), "keys")
    sizes = keys.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_group", before.alias("_start"))  # a row per group
    own = F.row_number().over(Window.partitionBy("_group").orderBy(key)) - 1
    return keys.withColumn("_own", own).join(starts, "_group").select(key, (F.col("_own") + F.col("_start")).cast("int").alias(into))


#: Weights in a block of the factorization. A block is held by one task.
BLOCK_WEIGHTS = 1_000_000


def nmf_blocks(rated: DataFrame) -> int:
    """Blocks that grow with the weights; ten, the default, for few of them."""
    return max(10, -(-rated.count() // BLOCK_WEIGHTS))


def numbered_weights(weights: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(doc_no, term_no, weight) of (key, term, weight), and (term, term_no)."""
    docs, terms = dense_numbers(weights, key, "doc_no"), dense_numbers(weights, "term", "term_no")
    return stage(weights.join(docs, key).join(terms, "term").select("doc_no", "term_no", F.col("weight").cast("float").alias("weight")), "rated"), terms


def nmf_model(
    weights: DataFrame, key: str, topics: int, iterations: int = 10, seed: int = 11111, numbered: tuple[DataFrame, DataFrame] | None = None
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """A non-negative factorization of (key, term, weight), the numbered weights, and (term, term_no).

    The factorization takes at most 2^31 documents; their keys may be of any type. Several models of the
    same weights can share what an earlier one has `numbered`.
    """
    rated, terms = numbered or numbered_weights(weights, key)
    blocks = nmf_blocks(rated)
    # With a checkpoint of the term loads in each round, which are few, the fit removes the round's messages from disk.
    als = ALS(
        rank=topics, maxIter=iterations, nonnegative=True, seed=seed, userCol="doc_no", itemCol="term_no", ratingCol="weight",
        numUserBlocks=blocks, numItemBlocks=min(blocks, 100), checkpointInterval=1,
    )
    return als.fit(rated), rated, terms


def nmf_error(model: ALSModel, rated: DataFrame) -> Column:
    """Sum of the squared errors of a factorization, as a scalar. Its loads are written first, so that joins go by their sizes."""
    docs = stage(model.userFactors.select(F.col("id").alias("doc_no"), F.col("features").alias("_d")), "doc-loads")
    terms = stage(model.itemFactors.select(F.col("id").alias("term_no"), F.col("features").alias("_t")), "term-loads")
    told = sum((F.get("_d", F.lit(i)) * F.get("_t", F.lit(i)) for i in range(model.rank)), F.lit(0.0))
    both = rated.join(terms, "term_no").join(docs, "doc_no")
    return both.agg(F.sum(F.pow(F.col("weight") - told, 2)).alias("e")).scalar()


def nmf_terms(weights: DataFrame, key: str, topics: int, n: int = 10, iterations: int = 10, seed: int = 11111) -> DataFrame:
    """(topic, rank, term, weight) of a non-negative factorization of (key, term, weight)."""
    model, _, numbers = nmf_model(weights, key, topics, iterations, seed)
    loads = model.itemFactors.select(F.col("id").alias("term_no"), F.posexplode("features").alias("topic", "weight"))
    return top_terms(loads.join(numbers, "term_no").select("topic", "term", "weight"), "topic", n=n)


def embedding_model(df: DataFrame, vector: str, k: int, seed: int = 7, into: str = "topic") -> tuple[KMeansModel, DataFrame]:
    """A clustering of embeddings, and the rows with their cluster number."""
    points = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol=into).fit(points)
    return model, model.transform(points).drop("_v")


def embedding_clusters(df: DataFrame, vector: str, k: int, seed: int = 7, into: str = "topic") -> DataFrame:
    """Cluster number of each embedding."""
    return embedding_model(df, vector, k, seed, into)[1]
