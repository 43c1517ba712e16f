"""Session helpers shared by tests, the bench and the entry point."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Session setting: deal text tables out to so many partitions. Unset, they are read as they are split.
TEXT_PARTITIONS = "spark.docketry.textPartitions"


def local_session(cores: int | str = 8, app: str = "docketry") -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter brings the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(cores if str(cores).isdigit() else 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config(TEXT_PARTITIONS, str(cores if str(cores).isdigit() else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder that the session names.

    Only a local session without that setting falls back to a temporary folder: on a
    cluster, executors could not see a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "docketry-checkpoints")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose rows carry long texts.

    Text work is bound by the processor. A session over small inputs, which are one task each, can
    ask for more partitions by TEXT_PARTITIONS; nothing looks at sizes or cores by itself.
    """
    df = table(spark, sf_dir, name)
    df = df.select(*columns) if columns else df
    parts = spark.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


#: Spark keeps the shuffle files of a query until the driver collects its garbage, unless this is set when the query runs.
CLEAR_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a result that several later steps read to the shared folder, and read it back.

    Used where a plan would otherwise run twice over the big input. The copy outlives lost
    executors, and each reader takes only the columns it needs. The shuffle files of its making go
    as soon as it is written: nothing reads them any more.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEAR_SHUFFLES)
    spark.conf.set(CLEAR_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEAR_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*staged: DataFrame) -> None:
    """Delete the copies of staged results that no step reads any more."""
    for df in staged:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
