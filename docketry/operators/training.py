"""Labelled sets, sampling, splits, oversampling, model comparison and metrics.

Features are 0/1 flags, so a table of any size has few distinct rows. Models are fitted on
those patterns with their counts as weights: the fit sees thousands of rows however many
documents were read, and gives the same model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.functions.text import hash_bucket
from docketry.operators import neighbours
from docketry.session import scratch_dir

SCALE = 10_000


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Only the columns of the schema, cast to its types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def sample_fraction(df: DataFrame, fraction: float, key: str, salt: str = "") -> DataFrame:
    """A repeatable share of the rows, by hash of the key; reruns and retries pick the same rows."""
    bucket = hash_bucket(F.concat(F.col(key).cast("string"), F.lit(salt)), SCALE)
    return df.filter(bucket < int(round(fraction * SCALE)))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order by hash of key and seed, the same after a retry and for any partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key)


def label_and_union(positives: DataFrame, others: DataFrame, fraction: float, key: str, label: str = "label") -> DataFrame:
    """Positives as 1, a sample of the others as 0."""
    negatives = sample_fraction(others, fraction, key)
    return positives.withColumn(label, F.lit(1)).unionByName(negatives.withColumn(label, F.lit(0)))


def add_split(df: DataFrame, key: str, train_share: float = 0.8, salt: str = "split") -> DataFrame:
    """is_train by hash of the key."""
    bucket = hash_bucket(F.concat(F.col(key).cast("string"), F.lit(salt)), SCALE)
    return df.withColumn("is_train", bucket < int(round(train_share * SCALE)))


def add_fold(df: DataFrame, key: str, folds: int = 5, salt: str = "fold") -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.concat(F.col(key).cast("string"), F.lit(salt)), folds).cast("int"))


def oversample(minority: DataFrame, flags: Sequence[str], key: str, copies: int = 1, k: int = 5, numbers: Sequence[str] = ()) -> DataFrame:
    """Synthetic minority rows between a row and one of its k nearest neighbours.

    Features are any number of 0/1 flags, and numbers that the caller has scaled to the flags. The
    neighbour and the step towards it come from the hash of the key. A row without any neighbour gives none.
    """
    table = neighbours.nearest(minority, flags, numbers, k).withColumnRenamed("reach", "_reach")
    bits = F.concat(*[F.col(f"`{f}`").cast("int").cast("string") for f in reversed(flags)]) if flags else F.lit("")
    made = minority.withColumn("bits", bits).join(table.hint("merge"), ["bits", *numbers]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    seed = F.concat(F.col(key).cast("string"), F.lit("/"), F.col("_copy").cast("string"))
    known = F.element_at("_reach", -1)["upto"]
    pick = hash_bucket(F.concat(seed, F.lit("n")), k) % F.least(known, F.lit(k)) + 1
    made = made.filter(F.size("_reach") > 0).withColumn("_pick", pick)
    chosen = F.get(F.filter("_reach", lambda x: x["upto"] >= F.col("_pick")), F.lit(0))
    made = made.withColumn("_near", chosen).withColumn("_step", hash_bucket(F.concat(seed, F.lit("s")), SCALE) / SCALE)
    values = []
    for i, f in enumerate([*flags, *numbers]):
        own = F.col(f"`{f}`").cast("double")
        flag = i < len(flags)
        there = F.substring("_near.near_bits", len(flags) - i, 1).cast("double") if flag else F.get(F.col("_near.near_numbers"), F.lit(i - len(flags)))
        values.append(F.round(own + F.col("_step") * (there - own), 6).alias(f))
    return made.select(key, F.col("_copy").alias("copy"), *values)


def patterns(df: DataFrame, flags: Sequence[str], label: str = "label", extra: Sequence[str] = ()) -> DataFrame:
    """Distinct (flags, label) rows with their count as weight."""
    return df.groupBy(*[F.col(f"`{f}`") for f in flags], label, *extra).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def classifiers(seed: int = 42) -> dict[str, object]:
    common = {"labelCol": "label", "featuresCol": "features", "weightCol": "weight"}
    return {
        "LR": LogisticRegression(**common),
        "RF": RandomForestClassifier(numTrees=20, seed=seed, **common),
        "SVM": LinearSVC(**common),
        "GBT": GBTClassifier(maxIter=10, seed=seed, **common),
        "DT": DecisionTreeClassifier(seed=seed, **common),
    }


class WithoutSummary(Estimator):
    """Fits an estimator and gives its model as saved and loaded, without the summary of the training.

    A summary holds the session, and scoring sends the model to the executors with its summary. Once a frame of the
    session has been observed, the session cannot be sent any more.
    """

    def __init__(self, estimator: Estimator):
        super().__init__()
        self.estimator = estimator

    def _fit(self, dataset: DataFrame) -> Model:
        model = self.estimator.fit(dataset)
        if not getattr(model, "hasSummary", False):
            return model
        path = scratch_dir(dataset.sparkSession, "model")
        model.write().save(path)
        return type(model).load(path)


def _pipeline(model: Estimator, flags: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(flags), outputCol="features"), WithoutSummary(model)])


def plain_names(df: DataFrame) -> DataFrame:
    """Feature names without '&', which the assembler cannot take."""
    return df.toDF(*[c.replace("&", "_and_") for c in df.columns])


def compare_models(df: DataFrame, flags: Sequence[str], folds: int = 5, seed: int = 42, parallelism: int = 1) -> DataFrame:
    """(model, mean_accuracy, is_best) of k-fold cross-validation on weighted patterns with a fold column.

    The models are alternatives for the last stage of one pipeline, so one cross-validator
    compares them. It fits one at a time by default: fits that run side by side share the stages' parameters,
    and now and then one is sent to the executors while another is being set.
    """
    models = classifiers(seed)
    pipeline = Pipeline(stages=[])
    grid = [{pipeline.stages: _pipeline(model, flags).getStages()} for model in models.values()]
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label", weightCol="weight")
    fitted = CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    ).fit(df)
    means = dict(zip(models, fitted.avgMetrics))
    best = max(means, key=means.get)
    rows = [(name, float(mean), name == best) for name, mean in means.items()]
    return df.sparkSession.createDataFrame(rows, "model string, mean_accuracy double, is_best boolean")


def fit_risk_model(weighted: DataFrame, flags: Sequence[str]) -> PipelineModel:
    """Logistic regression on weighted patterns."""
    return _pipeline(classifiers()["LR"], flags).fit(weighted)


def score_with_model(df: DataFrame, model: PipelineModel, into: str = "risk_score", digits: int = 3) -> DataFrame:
    """Probability of class 1 for every row, computed where the row is."""
    scored = model.transform(df)
    return scored.withColumn(into, F.round(vector_to_array("probability")[1], digits)).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def unscored(stored: DataFrame, scored: DataFrame, day: str, partition: str | None = None) -> DataFrame:
    """Rows of days that were processed but not scored yet, from a table stored by ``partition`` (the day itself by default).

    The open days are found on days alone and come to the driver, one value per day and partition; the
    rows are then read by a filter that picks the partitions, so no row takes part in a join. Rows without a day are open
    for ever.
    """
    partition = partition or day
    days = stored.select(day, partition).distinct() if partition != day else stored.select(day).distinct()
    open_ = days.join(scored.select(day).distinct(), day, "left_anti").collect()
    some = [r[day] for r in open_ if r[day] is not None]
    wanted = F.col(day).isin(some) if some else F.lit(False)
    if any(r[day] is None for r in open_):
        wanted = wanted | F.col(day).isNull()
    parts = {r[partition] for r in open_}
    picked = F.col(partition).isin([p for p in parts if p is not None])
    return stored.filter((picked | F.col(partition).isNull() if None in parts else picked) & wanted)


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def weighted_metrics(counts: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """accuracy, and precision, recall and F1 weighted by class size, from confusion counts."""
    right = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    actual = counts.groupBy(F.col(label).alias("c")).agg(F.sum("n").alias("actual"), F.sum(right).alias("hit"))
    told = counts.groupBy(F.col(prediction).alias("c")).agg(F.sum("n").alias("told"))
    per = actual.join(told, "c", "left").withColumn("told", F.coalesce("told", F.lit(0)))
    precision = F.when(F.col("told") > 0, F.col("hit") / F.col("told")).otherwise(0.0)
    recall = F.col("hit") / F.col("actual")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    weighted = lambda x: F.round(F.sum(x * F.col("actual")) / F.sum("actual"), digits)
    return per.agg(
        F.round(F.sum("hit") / F.sum("actual"), digits).alias("accuracy"),
        weighted(precision).alias("precision"), weighted(recall).alias("recall"), weighted(f1).alias("f1"),
    )

