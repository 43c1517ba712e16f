"""A corpus from raw documents to token files, in five stages that each write their result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import decontamination, pfair, prefix_join, token_files, toxicity
from docketry.llm.catalog import tokenizer_file
from docketry.session import scratch_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from those whose labels are not held out."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the one with the least doc_id stays."""
    return prefix_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, dealt out so that sources follow each other by their target weights."""
    return pfair.mixed(docs, size=F.length("text"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents in the order of the mixed files, and where each document lies in them."""
    path = scratch_dir(spark, "corpus-tokens")
    placed = docs.select("doc_id", "text", token_files.file_place().alias("_part"), F.col("_metadata.row_index").alias("_row"))
    token_files.write_tokens(placed, path, tokenizer_file(), order=("_part", "_row"))
    return token_files.token_index(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: A fitted model and a tokenizer have no SQL form. Each operator is tested against a brute-force version by itself; run() as a whole is not yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
