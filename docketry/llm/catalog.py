"""The queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import compact_windows, decontamination, length_histogram, pfair, pii_bootstrap, prefix_doubling, prefix_join, role_repair, sign_hashing, spelling_tries, token_files, toxicity, turn_alignment
from docketry.session import scratch_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op6_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.length_histogram(table(spark, sf_dir, "documents"), tokenizer_file())


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_files.token_index(spark, path)


@query
def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return pfair.interleave(docs, size=F.length("text"))


@query
def op7_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (~toxicity.in_sample("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_doubling.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op9_sign_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sign_hashing.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.passages(table(spark, sf_dir, "documents"))


@query
def op4_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.rendered(role_repair.repair(table(spark, sf_dir, "conversations")))


@query
def op13_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_alignment.damaged(table(spark, sf_dir, "conversations"))
    return turn_alignment.repair(turns).withColumnRenamed("conv", "conv_id")


@query
def op12_spelling_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_tries.variants(table(spark, sf_dir, "documents"))


@query
def op11_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.personal_data(table(spark, sf_dir, "documents"))
