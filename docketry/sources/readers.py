"""Sources by path: delimited text, line JSON, XML manifests, dated folders, listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.operators.projections import strict_name

MANIFEST_SCHEMA = (
    "_transactionid string, "
    "page array<struct<_batchsequence:string, image:array<struct<_filename:string, _side:string>>>>"
)


def read_containers(spark: SparkSession, containers: Mapping[str, str]) -> DataFrame:
    """Parquet folders whose schemas may differ, unioned by name and tagged with their id."""
    parts = [
        spark.read.option("mergeSchema", "true").parquet(path).withColumn("source_container", F.lit(name))
        for name, path in containers.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Header CSV with a declared schema, so that no pass over the data infers one."""
    return spark.read.schema(schema).option("header", True).csv(path)


def sidecar_names(spark: SparkSession, header_path: str) -> list[str]:
    """Cleaned column names out of a header-only file."""
    return [strict_name(c) for c in spark.read.option("header", True).option("sep", "\t").csv(header_path).columns]


def read_tsv_with_sidecar(spark: SparkSession, data_path: str, header_path: str, time_col: str = "date_time") -> DataFrame:
    """Headerless tab data under the names of a header file, with load time and hit date."""
    names = sidecar_names(spark, header_path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    hits = spark.read.schema(schema).option("sep", "\t").csv(data_path)
    return hits.withColumns(
        {"load_timestamp": F.current_timestamp(), "hit_date": F.col(time_col).try_cast("timestamp_ntz").cast("date")}
    )


def read_lookup(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """Two string columns named after the table."""
    schema = T.StructType([T.StructField(f"{table}id", T.StringType()), T.StructField(table, T.StringType())])
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """path, modificationTime, length of every file below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "modificationTime", "length")


def read_binary(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """path and content of what matches."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    )


def table_of(path: Column) -> Column:
    """Table a file belongs to: its stem, or its folder for the parts of a written table."""
    stem = F.regexp_extract(path, r"/([^/.]+)[^/]*$", 1)
    return F.when(stem.startswith("part-"), F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)).otherwise(stem)


def dispatch(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Route every table below a folder to its loader; a table's locations are read as one table.

    Each location of hits goes with the header of its own folder, or with the only header there is.
    What comes to the driver is a row per table and folder, or per input where inputs are not parts.
    """
    written = F.col("path").rlike("/part-[^/]*$")
    named = list_files(spark, root).select(
        table_of(F.col("path")).alias("table"),
        F.when(written, F.regexp_extract("path", r"^(.*)/[^/]+$", 1)).otherwise(F.col("path")).alias("location"),
    )
    places: dict[str, list[str]] = {}
    for r in named.distinct().sort("table", "location").collect():
        places.setdefault(r["table"], []).append(r["location"])
    headers = places.get("column_headers", [])
    beside = {h.rsplit("/", 1)[0]: h for h in headers}
    loaded = {}
    for table, locations in places.items():
        if table == "hit_data":
            for location in locations:
                header = beside.get(location.rsplit("/", 1)[0]) or (headers[0] if len(headers) == 1 else None)
                if header is None:
                    raise ValueError(f"no header for {location}")
                part = read_tsv_with_sidecar(spark, location, header)
                loaded[table] = loaded[table].unionByName(part, allowMissingColumns=True) if table in loaded else part
        elif table != "column_headers":
            loaded[table] = read_lookup(spark, locations, table)
    return loaded


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Distinct JSON lines below a folder; each line carries one leading sign that is cut off."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    kept = lines.filter(F.length("value") > 1)
    return kept.select(F.substring("value", F.lit(2), F.length("value")).alias("json_value")).distinct()


def existing_days(
    spark: SparkSession, root: str, start: dt.date | str, end: dt.date | str, prefix: str = ""
) -> list[str]:
    """Names of the yyyymmdd folders that exist within the range, from one listing of the root."""
    first, last = (str(d).replace("-", "") for d in (start, end))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    days = [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
    return [prefix + d for d in sorted(days) if len(d) == 8 and d.isdigit() and first <= d <= last]


def read_date_folders(
    spark: SparkSession, root: str, start: dt.date | str, end: dt.date | str, schema: str | T.StructType, prefix: str = ""
) -> DataFrame:
    """All existing day folders of a range in one scan; an empty table of the schema when there is none."""
    days = existing_days(spark, root, start, end, prefix)
    if not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{d}" for d in days])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Batch manifest: one row per transaction with its pages and their images."""
    return spark.read.format("xml").option("rowTag", "transaction").schema(MANIFEST_SCHEMA).load(path)


def manifest_images(manifest: DataFrame) -> DataFrame:
    """One row per image with a file name."""
    pages = manifest.select(F.col("_transactionid").alias("transaction_id"), F.explode("page").alias("p"))
    images = pages.select("transaction_id", F.col("p._batchsequence").alias("batch_sequence"), F.explode("p.image").alias("i"))
    return images.select(
        "transaction_id", "batch_sequence", F.col("i._filename").alias("filename"), F.col("i._side").alias("side")
    ).filter(F.coalesce(F.col("filename"), F.lit("")) != "")


def manifest_json(manifest: DataFrame) -> DataFrame:
    """Nested JSON per transaction, with its page and image counts.

    The nesting of the source row is kept, so nothing is exploded and grouped again.
    """
    named = lambda i: F.coalesce(i["_filename"], F.lit("")) != ""
    image = lambda i: F.struct(i["_filename"].alias("filename"), i["_side"].alias("side"))
    pages = F.transform(
        "page",
        lambda p: F.struct(
            p["_batchsequence"].alias("batch_sequence"),
            F.transform(F.filter(p["image"], named), image).alias("images"),
        ),
    )
    nested = manifest.select(F.col("_transactionid").alias("transaction_id"), pages.alias("pages"))
    return nested.select(
        "transaction_id",
        F.to_json(F.struct("transaction_id", "pages")).alias("manifest"),
        F.size("pages").alias("total_pages"),
        F.aggregate("pages", F.lit(0), lambda n, p: n + F.size(p["images"])).alias("total_images"),
    )


def attach_manifest(docs: DataFrame, images: DataFrame, file_col: str = "file_name") -> DataFrame:
    """Transaction, sequence and side of each document, joined on the file name."""
    keyed = images.withColumnRenamed("filename", file_col)
    return docs.join(keyed, file_col, "left")


def document_ids(listing: DataFrame, day: Column, extensions: Sequence[str] = ("jpg", "tif", "pdf", "png")) -> DataFrame:
    """obj_id = date_name for documents of the wanted kinds."""
    name = F.element_at(F.split("path", "/"), -1)
    kept = listing.filter(F.col("path").rlike(rf"\.({'|'.join(extensions)})$"))
    return kept.select(F.concat_ws("_", day, name).alias("obj_id"), F.col("path").alias("img_path"))
