"""Queries for tokens, phrases, term weights and topics, over the whole documents table."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from docketry.catalog.base import query
from docketry.functions import fixed_values as V
from docketry.operators import coherence, topics
from docketry.session import stage, table, text_table, unstage

_PUNCT = string.punctuation.replace("'", "''")
SQL_CLEAN = f"""trim(regexp_replace(regexp_replace(translate(lower(translate(text, '{_PUNCT}', '')), '{V.ACCENTED}', '{V.UNACCENTED}'), '[0-9]+', '', 'g'),
  '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))"""
_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in V.CONTRACTIONS.items()) + "}"
TOKEN_CTE = f"""WITH cleaned AS (SELECT doc_id, source, {SQL_CLEAN} AS x FROM documents),
 expanded AS (SELECT doc_id, source, list_filter(flatten(list_transform(string_split(x, ' '), lambda t: string_split(coalesce({_MAP}[t], t), ' '))), lambda t: t <> '') AS all_toks FROM cleaned),
 toks AS (SELECT doc_id, source, list_filter(all_toks, lambda t: t NOT IN ({', '.join(f"'{w}'" for w in V.STOPWORDS)})) AS ts FROM expanded),
 words AS (SELECT doc_id, source, unnest(ts) AS term, generate_subscripts(ts, 1) - 1 AS pos FROM toks)"""


def tokens(spark, sf, *keep):
    docs = text_table(spark, sf, "documents")
    kept = topics.remove_stopwords(topics.tokenize(F.col("text")), V.STOPWORDS)
    return docs.select("doc_id", *keep, kept.alias("tokens"))


def staged_tokens(spark, sf, *keep):
    """Token arrays that several steps read are written once."""
    return stage(tokens(spark, sf, *keep), "tokens", "zstd")


@query("text_clean", f"SELECT doc_id, {SQL_CLEAN} AS content FROM documents")
def text_clean(spark, sf):
    return text_table(spark, sf, "documents").select("doc_id", topics.clean_text(F.col("text")).alias("content"))


@query("tokenize", TOKEN_CTE + " SELECT doc_id, len(all_toks) AS n_tokens, array_to_string(all_toks, ' ') AS tokens FROM expanded")
def tokenize(spark, sf):
    words = text_table(spark, sf, "documents").select("doc_id", topics.tokenize(F.col("text")).alias("t"))
    return words.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query(
    "stopword_set",
    f"""SELECT DISTINCT w AS word FROM (SELECT unnest([{', '.join(f"'{w}'" for w in V.STOPWORDS)}]) AS w UNION ALL SELECT lower(role) FROM conversations
       UNION ALL SELECT lower(source) FROM documents) WHERE w NOT IN ('no', 'not', 'out', 'system') UNION SELECT DISTINCT lang FROM documents""",
)
def stopword_set(spark, sf):
    base = spark.createDataFrame([(w,) for w in V.STOPWORDS], "word string")
    docs = text_table(spark, sf, "documents")
    custom = table(spark, sf, "conversations").select(F.lower("role").alias("word")).unionByName(docs.select(F.lower("source").alias("word")))
    removed = spark.createDataFrame([(w,) for w in ("no", "not", "out", "system")], "word string")
    return topics.stopword_table(base, custom, removed, docs.select(F.col("lang").alias("word")))


@query("remove_stopwords", TOKEN_CTE + " SELECT doc_id, array_to_string(ts, ' ') AS tokens FROM toks")
def remove_stopwords(spark, sf):
    return tokens(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("word_frequencies", TOKEN_CTE + " SELECT term AS word, count(*) AS n FROM words GROUP BY term ORDER BY n DESC, term LIMIT 5000")
def word_frequencies(spark, sf):
    return topics.word_frequencies(tokens(spark, sf), "tokens", top=5000)


def _phrase_sql(source: str, minimum: int, threshold: float, name: str) -> str:
    """CTEs {name}_counts and {name} with the phrases among the words of a (doc_id, term, pos) table."""
    return f""", {name}_pairs AS (SELECT a.term AS a, b.term AS b FROM {source} a JOIN {source} b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
 {name}_counts AS (SELECT a, b, count(*) AS n FROM {name}_pairs GROUP BY a, b), {name}_words AS (SELECT term, count(*) AS n FROM {source} GROUP BY term),
 {name}_size AS (SELECT (SELECT count(*) FROM {name}_counts) + (SELECT count(*) FROM {name}_words) AS v),
 {name}_all AS (SELECT c.a, c.b, c.n, round(cast(c.n - {minimum} AS double) / x.n / y.n * v, 6) AS score FROM {name}_counts c JOIN {name}_words x ON x.term = c.a JOIN {name}_words y ON y.term = c.b, {name}_size WHERE c.n >= {minimum}),
 {name} AS (SELECT * FROM {name}_all WHERE score > {threshold})"""


# Hits in a run are taken alternately from its start; the second word of a taken pair goes away.
def _merge_sql(source: str, phrases: str, name: str) -> str:
    return f""", {name}_hits AS (SELECT a.doc_id, a.pos FROM {source} a JOIN {source} b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 JOIN {phrases} p ON p.a = a.term AND p.b = b.term),
 {name}_runs AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM {name}_hits),
 {name}_taken AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS k FROM {name}_runs) WHERE k % 2 = 1),
 {name}_kept AS (SELECT w.doc_id, w.pos, CASE WHEN t.pos IS NOT NULL THEN w.term || '_' || n.term ELSE w.term END AS term FROM {source} w
   LEFT JOIN {name}_taken t ON t.doc_id = w.doc_id AND t.pos = w.pos LEFT JOIN {source} n ON n.doc_id = w.doc_id AND n.pos = w.pos + 1
   WHERE NOT EXISTS (SELECT 1 FROM {name}_taken g WHERE g.doc_id = w.doc_id AND g.pos = w.pos - 1)),
 {name} AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos FROM {name}_kept)"""


BIGRAM_CTE = TOKEN_CTE + _phrase_sql("words", 5, 10.0, "bigrams")
MERGED_CTE = BIGRAM_CTE + _merge_sql("words", "bigrams", "merged")
TRIGRAM_CTE = MERGED_CTE + _phrase_sql("merged", 3, 5.0, "trigrams")


@query("phrase_bigrams", BIGRAM_CTE + " SELECT a, b, n, score FROM bigrams")
def phrase_bigrams(spark, sf):
    words = staged_tokens(spark, sf)
    return topics.phrases(words, "tokens", 5, 10.0, topics.phrase_passes(words, "tokens"))


def bigram_docs(words, passes):
    return topics.apply_phrases(words, topics.phrases(words, "tokens", 5, 10.0, passes), "doc_id", "tokens", passes=passes)


@query(
    "phrase_bigram_docs",
    MERGED_CTE + """ SELECT t.doc_id, coalesce(string_agg(m.term, ' ' ORDER BY pos), '') AS tokens FROM toks t LEFT JOIN merged m ON t.doc_id = m.doc_id GROUP BY t.doc_id""",
)
def phrase_bigram_docs(spark, sf):
    words = staged_tokens(spark, sf)
    return bigram_docs(words, topics.phrase_passes(words, "tokens")).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("phrase_trigrams", TRIGRAM_CTE + " SELECT a, b, n, score FROM trigrams")
def phrase_trigrams(spark, sf):
    words = staged_tokens(spark, sf)
    passes = topics.phrase_passes(words, "tokens")
    merged = stage(bigram_docs(words, passes), "bigram-docs", "zstd")
    unstage(words)
    return topics.phrases(merged, "tokens", 3, 5.0, passes)


VOCAB_CTE = TOKEN_CTE + """, vocab AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS n FROM words GROUP BY term
   HAVING count(DISTINCT doc_id) >= 2 AND count(DISTINCT doc_id) <= 0.9 * (SELECT count(*) FROM documents) ORDER BY df DESC, term LIMIT 10000)"""


@query("vocab_filter", VOCAB_CTE + " SELECT term, df, n FROM vocab")
def vocab_filter(spark, sf):
    return topics.vocabulary(tokens(spark, sf), "tokens", keep=10_000)


@query("bag_of_words", VOCAB_CTE + " SELECT doc_id, term, cast(count(*) AS int) AS n FROM words WHERE term IN (SELECT term FROM vocab) GROUP BY doc_id, term")
def bag_of_words(spark, sf):
    words = staged_tokens(spark, sf)
    return topics.bag_of_words(words, "doc_id", "tokens", topics.vocabulary(words, "tokens", keep=10_000))


TFIDF_SQL = TOKEN_CTE + """, tf AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL),
  top AS (SELECT term, ln((SELECT count(*) FROM documents) / count(*)) + 1 AS idf FROM tf GROUP BY term ORDER BY sum(n) DESC, term LIMIT 5000)
  SELECT doc_id, term, round(n * idf / sum(n * idf) OVER (PARTITION BY doc_id), 6) AS weight FROM tf JOIN top USING (term)"""


@query("tfidf", TFIDF_SQL)
def tfidf(spark, sf):
    return topics.tfidf(staged_tokens(spark, sf), "doc_id", "tokens", max_features=5000, digits=6)


def class_weights(topic_sql: str) -> str:
    return TOKEN_CTE + f""", ct AS (SELECT {topic_sql} AS topic, term, count(*) AS n FROM words {'LEFT JOIN embeddings ON vec_id = doc_id' if 'label' in topic_sql else ''} GROUP BY ALL),
  tw AS (SELECT topic, sum(n) AS words FROM ct GROUP BY topic), f AS (SELECT term, sum(n) AS total FROM ct GROUP BY term),
  cw AS (SELECT ct.topic, ct.term, cast(n AS bigint) AS n, round(n / words * ln(1 + (SELECT avg(words) FROM tw) / total), 6) AS weight FROM ct JOIN tw ON ct.topic = tw.topic JOIN f ON f.term = ct.term),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM cw)"""


#: Documents without a vector are a class of their own.
LABEL = "coalesce(label, -1)"


@query("class_tfidf", class_weights(LABEL) + " SELECT topic, term, n, weight FROM cw")
def class_tfidf(spark, sf):
    return topics.class_tfidf(labelled_tokens(spark, sf), "topic", "tokens")


def labelled_tokens(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic"))
    labelled = tokens(spark, sf).join(vectors, "doc_id", "left").withColumn("topic", F.coalesce("topic", F.lit(-1)))
    return stage(labelled, "labelled-tokens")


@query("topic_top_terms", class_weights(LABEL) + " SELECT topic, cast(rank AS int) AS rank, term, n, weight FROM ranked WHERE rank <= 10")
def topic_top_terms(spark, sf):
    return topics.top_terms(topics.class_tfidf(labelled_tokens(spark, sf), "topic", "tokens"), "topic")


@query(
    "topic_coherence",
    class_weights("source")
    + """, tt AS (SELECT topic, term, rank FROM ranked WHERE rank <= 10), dt AS (SELECT DISTINCT doc_id, term FROM words),
      p AS (SELECT x.topic, x.term AS a, y.term AS b, x.rank AS ra, y.rank AS rb FROM tt x JOIN tt y ON x.topic = y.topic AND x.rank < y.rank),
      k AS (SELECT p.*, (SELECT count(*) FROM dt WHERE dt.term = p.a) AS na, (SELECT count(*) FROM dt WHERE dt.term = p.b) AS nb,
        (SELECT count(*) FROM dt d1 JOIN dt d2 ON d1.doc_id = d2.doc_id WHERE d1.term = p.a AND d2.term = p.b) AS nab, (SELECT count(*) FROM documents) AS d FROM p)
      SELECT topic, round(avg(CASE WHEN nab = 0 THEN -1 WHEN nab = d THEN 1 ELSE ln(nab * d / (na * nb)) / -ln(nab / d) END), 6) AS npmi,
        round(avg(ln((nab + 1) / na)), 6) AS umass FROM k GROUP BY topic""",
)
def topic_coherence(spark, sf):
    words = staged_tokens(spark, sf, F.col("source").alias("topic"))
    best = topics.top_terms(topics.class_tfidf(words, "topic", "tokens"), "topic").select("topic", "term", "rank")
    return topics.coherence(words, "doc_id", "tokens", stage(best, "topic-words"))


CV_WINDOW, CV_WORDS = 10, 5


@query(
    "topic_coherence_cv",
    class_weights("source")
    + f""", tt AS (SELECT topic, term FROM ranked WHERE rank <= {CV_WORDS}), l AS (SELECT doc_id, greatest(len(ts) - {CV_WINDOW} + 1, 1) AS nw FROM toks WHERE len(ts) > 0),
      total AS (SELECT sum(nw)::double AS w FROM l),
      seen AS (SELECT DISTINCT doc_id, term, unnest(range(greatest(pos - {CV_WINDOW} + 1, 0), least(pos, nw - 1) + 1)) AS at FROM words JOIN l USING (doc_id) WHERE term IN (SELECT term FROM tt)),
      one AS (SELECT term, count(*)::double AS n FROM seen GROUP BY term),
      two AS (SELECT x.term AS a, y.term AS b, count(*)::double AS n FROM seen x JOIN seen y ON x.doc_id = y.doc_id AND x.at = y.at GROUP BY ALL),
      c AS (SELECT x.topic, x.term AS a, y.term AS b, coalesce(two.n, 0) / w + 1e-12 AS p, oa.n / w AS pa, ob.n / w AS pb FROM tt x JOIN tt y ON x.topic = y.topic JOIN one oa ON oa.term = x.term
        JOIN one ob ON ob.term = y.term LEFT JOIN two ON two.a = x.term AND two.b = y.term, total),
      v AS (SELECT topic, a, b, ln(p / (pa * pb)) / -ln(p) AS v FROM c), s AS (SELECT topic, b, sum(v) AS s FROM v GROUP BY ALL)
      SELECT topic, round(avg(r), 6) AS c_v FROM (SELECT topic, a, sum(v * s) / sqrt(sum(v * v) * sum(s * s)) AS r FROM v JOIN s USING (topic, b) GROUP BY ALL) GROUP BY topic""",
)
def topic_coherence_cv(spark, sf):
    words = staged_tokens(spark, sf, F.col("source").alias("topic"))
    best = topics.top_terms(topics.class_tfidf(words, "topic", "tokens"), "topic", n=CV_WORDS).select("topic", "term", "rank")
    return coherence.coherence_cv(words, "doc_id", "tokens", stage(best, "topic-words"), size=CV_WINDOW)


def lda_by_count(spark, sf):
    """Documents and counts, and the topic words of a model for each number of topics with their c_v."""
    words = staged_tokens(spark, sf)
    models, counted, vocab = topics.lda_models(words, "tokens", keep=10_000)
    out = None
    for k, model in models.items():
        best = topics.lda_terms(model, vocab).withColumn("k", F.lit(k))
        out = best if out is None else out.unionByName(best)
    best = stage(out.withColumn("model_topic", F.concat_ws("/", "k", "topic")), "lda-terms")
    told = coherence.coherence_cv(words, "doc_id", "tokens", best.select(F.col("model_topic").alias("topic"), "term", "rank"))
    return words, models, (counted, vocab), stage(best.join(told.withColumnRenamed("topic", "model_topic"), "model_topic"), "lda-told")


@query("lda_topics")
def lda_topics(spark, sf):
    """Topic words of each number of topics; the number whose topics are the most coherent on average is chosen."""
    words, _, _, told = lda_by_count(spark, sf)
    counts = topics.coherence(words, "doc_id", "tokens", told.select(F.col("model_topic").alias("topic"), "term", "rank"))
    by_k = told.groupBy("k").agg(F.round(F.avg("c_v"), 6).alias("mean_c_v"))
    chosen = by_k.agg(F.max_by("k", F.struct("mean_c_v", -F.col("k")))).scalar()
    joined = told.join(counts.withColumnRenamed("topic", "model_topic"), "model_topic").join(by_k, "k")
    return joined.select("k", "topic", "rank", "term", "npmi", "umass", "c_v", "mean_c_v", (F.col("k") == chosen).alias("chosen"))


@query("topic_assignment")
def topic_assignment(spark, sf):
    models, counted, _ = topics.lda_models(staged_tokens(spark, sf), "tokens", ks=(4,), keep=10_000)
    return topics.assign_topics(models[4], counted, "doc_id")


def nmf_weights(spark, sf):
    """Term weights for a factorization; the tokens go once they are weighed."""
    words = staged_tokens(spark, sf)
    weights = stage(topics.tfidf(words, "doc_id", "tokens", max_features=5000), "weights")
    unstage(words)
    return weights


@query("nmf_topics")
def nmf_topics(spark, sf):
    return topics.nmf_terms(nmf_weights(spark, sf), "doc_id", 4)


@query("embedding_topics")
def embedding_topics(spark, sf):
    """Clusters of embeddings, described by the words of their documents."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    clustered = topics.embedding_clusters(vectors, "embedding", 5).select("doc_id", "topic")
    words = stage(tokens(spark, sf).join(clustered, "doc_id"), "clustered-tokens")
    return topics.top_terms(topics.class_tfidf(words, "topic", "tokens"), "topic")
