"""Topics found by patterns that lie in folders, the folders being the levels of the topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_patterns(spark: SparkSession, root: str, ending: str = ".txt") -> DataFrame:
    """(node, pattern) from texts below a folder: a line is a pattern, a text's path without its ending is its node.

    Blank lines and lines that start with # are left out. A file beside a folder of its name gives a node between the levels patterns of its own.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{ending}").text(root)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    folder = root.rstrip("/").rsplit("/", 1)[1]
    node = F.substring_index(F.substring_index(path, f"/{folder}/", -1), ending, 1)
    return lines.select(node.alias("node"), F.trim("value").alias("pattern")).filter((F.col("pattern") != "") & ~F.startswith("pattern", F.lit("#")))


def closure(patterns: DataFrame) -> DataFrame:
    """(node, ancestor, level): every node with itself and all nodes above it; the uppermost has level 1."""
    nodes = patterns.select("node").distinct().withColumn("parts", F.split("node", "/"))
    each = nodes.select("node", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("level"), "parts")
    return each.select("node", F.array_join(F.slice("parts", F.lit(1), F.col("level")), "/").alias("ancestor"), "level")


def label_levels(docs: DataFrame, keys: list[str], text: str, patterns: DataFrame) -> DataFrame:
    """keys, level, topic: a row for each node of each level that a text belongs to, a parent where one of its children does.

    The patterns are a job's settings and come to the driver; a text is tested once per node, in its row, and only
    keys and nodes leave it. Null texts have no topic.
    """
    rules: dict[str, list[str]] = {}
    for r in patterns.orderBy("node", "pattern").collect():
        rules.setdefault(r["node"], []).append(r["pattern"])
    if not rules:
        return docs.select(*keys, F.lit(0).alias("level"), F.lit("").alias("topic")).limit(0)
    hits = F.array(*[F.when(F.col(text).rlike("|".join(f"(?:{p})" for p in ps)), node) for node, ps in rules.items()])
    found = docs.select(*keys, F.explode_outer(F.array_compact(hits)).alias("node")).filter("node IS NOT NULL")
    return found.join(closure(patterns), "node").select(*keys, "level", F.col("ancestor").alias("topic")).distinct()


def daily_counts(labels: DataFrame, day: str) -> DataFrame:
    """Texts per day, level and topic."""
    return labels.groupBy(day, "level", "topic").agg(F.count(F.lit(1)).alias("n"))
