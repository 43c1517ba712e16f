"""Queries for sources and sinks: what they write to the shared folder is read back and returned."""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, claim_docs, query
from docketry.session import scratch_dir, table
from docketry.sources import readers, sinks
from docketry.sources.keyed import KeyedTable
from docketry.sources.tables import ChangeTable, VersionedTable


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'")
def scan_parquet(spark, sf):
    items = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return items.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "scan_parquet_merge_schema",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority, 'box_' || o_orderstatus AS source_container FROM orders""",
)
def scan_parquet_merge_schema(spark, sf):
    orders, root = table(spark, sf, "orders"), scratch_dir(spark, "containers")
    columns = {
        "F": ["o_orderkey", "o_totalprice", "o_orderpriority"], "O": ["o_orderkey", "o_totalprice"], "P": ["o_orderkey"],
    }
    for status, kept in columns.items():
        orders.filter(F.col("o_orderstatus") == status).select(*kept).write.parquet(f"{root}/{status}")
    return readers.read_containers(spark, {f"box_{s}": f"{root}/{s}" for s in columns})


@query("scan_csv", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, sf):
    path = scratch_dir(spark, "csv")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    sinks.write_csv(customer, path)
    return readers.read_csv(spark, path, customer.schema)


def clickstream(spark, sf):
    """Hit data without a header, a header file, and two lookups, as an export would leave them."""
    root, events = scratch_dir(spark, "hits"), table(spark, sf, "events")
    hits = events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"), "user_id", "event_type")
    hits.write.option("sep", "\t").csv(f"{root}/hit_data")
    header = events.select(F.lit("event(id)\tdate_time\tuser-id\tevent;type")).limit(1)
    header.write.text(f"{root}/column_headers")
    for name, key, label in (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name")):
        table(spark, sf, name).select(key, label).write.option("sep", "\t").csv(f"{root}/{name}")
    return root


@query(
    "scan_tsv_sidecar_header",
    "SELECT cast(event_id AS varchar) AS eventid, cast(user_id AS varchar) AS user_id, event_type AS eventtype, cast(ts AS date) AS hit_date FROM events",
)
def scan_tsv_sidecar_header(spark, sf):
    root = clickstream(spark, sf)
    hits = readers.read_tsv_with_sidecar(spark, f"{root}/hit_data", f"{root}/column_headers")
    return hits.select("eventid", "user_id", "eventtype", "hit_date")


@query("scan_lookup_tsv", "SELECT cast(n_nationkey AS varchar) AS nationid, n_name AS nation FROM nation")
def scan_lookup_tsv(spark, sf):
    return readers.read_lookup(spark, f"{clickstream(spark, sf)}/nation", "nation")


@query(
    "dispatch_by_filename",
    """SELECT 'hit_data' AS table_name, count(*) AS n, 6 AS n_columns FROM events UNION ALL SELECT 'nation', count(*), 2 FROM nation
       UNION ALL SELECT 'region', count(*), 2 FROM region""",
)
def dispatch_by_filename(spark, sf):
    out = None
    for name, df in readers.dispatch(spark, clickstream(spark, sf)).items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(len(df.columns)).alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "scan_json_lines_recursive",
    "SELECT DISTINCT user_id, event_type, cast(json_extract(props, '$.k') AS bigint) AS k FROM events",
)
def scan_json_lines_recursive(spark, sf):
    path, events = scratch_dir(spark, "json-lines"), table(spark, sf, "events")
    line = F.to_json(F.struct("user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    lines = events.select(F.concat(F.lit(","), line).alias("value"), F.to_date("ts").alias("day"))
    blanks = events.filter("event_type = 'error'").select(F.lit("x").alias("value"), F.to_date("ts").alias("day"))
    lines.unionByName(blanks).hint("rebalance", "day").write.partitionBy("day").text(path)
    read = readers.read_json_lines(spark, path)
    parsed = F.from_json("json_value", "user_id bigint, event_type string, k bigint")
    return read.select(parsed.alias("r")).select("r.*")


@query(
    "scan_binary_files",
    "SELECT cast(sum(strlen(html)) + count(*) AS bigint) AS total_bytes FROM pages",
)
def scan_binary_files(spark, sf):
    path = scratch_dir(spark, "binary")
    table(spark, sf, "pages").select("html").write.text(path)
    found = readers.read_binary(spark, path, "*.txt")
    return found.agg(F.sum(F.length("content")).alias("total_bytes"))


@query(
    "scan_table_versioned",
    """SELECT c_custkey, c_acctbal + 1 AS c_acctbal, false AS existed_before, true AS exists_after FROM customer""",
)
def scan_table_versioned(spark, sf):
    stored = VersionedTable(spark, scratch_dir(spark, "versioned"))
    before = stored.exists()
    stored.overwrite(table(spark, sf, "customer").select("c_custkey", "c_acctbal"))
    stored.overwrite(stored.read().withColumn("c_acctbal", F.col("c_acctbal") + 1))
    return stored.read().withColumns({"existed_before": F.lit(before), "exists_after": F.lit(stored.exists())})


@query(
    "scan_date_folders",
    "SELECT event_id, event_type FROM events WHERE cast(ts AS date) BETWEEN DATE '2024-01-20' AND DATE '2024-02-10'",
)
def scan_date_folders(spark, sf):
    root, events = scratch_dir(spark, "days"), table(spark, sf, "events")
    by_day = events.select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("d"))
    by_day.hint("rebalance", "d").write.partitionBy("d").parquet(root)
    return readers.read_date_folders(
        spark, root, "2024-01-20", "2024-02-10", "event_id bigint, event_type string", prefix="d="
    )


def manifest(spark, sf):
    """XML manifest of a scan batch: orders are transactions of two pages, the first with two sides.

    Back sides of pending orders were not scanned and have an empty file name.
    """
    path = scratch_dir(spark, "manifest")
    name = lambda side: F.concat(F.col("o_orderkey"), F.lit(f"-{side}.tif"))
    back = F.when(F.col("o_orderstatus") == "P", "").otherwise(name("b"))
    image = lambda file, side: F.struct(file.alias("_filename"), F.lit(side).alias("_side"))
    page = lambda no, *images: F.struct(F.lit(no).alias("_batchsequence"), F.array(*images).alias("image"))
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("t"), F.col("o_orderkey")).alias("_transactionid"),
        F.array(page("1", image(name("f"), "front"), image(back, "back")), page("2", image(name("x"), "front"))).alias("page"),
    )
    orders.write.format("xml").option("rowTag", "transaction").option("rootTag", "batch").save(path)
    return readers.read_manifest(spark, path)


IMAGE_SQL = """SELECT 't' || o_orderkey AS transaction_id, unnest([{'s': '1', 'f': o_orderkey || '-f.tif', 'd': 'front'},
   {'s': '1', 'f': CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderkey || '-b.tif' END, 'd': 'back'},
   {'s': '2', 'f': o_orderkey || '-x.tif', 'd': 'front'}]) AS i FROM orders"""


@query(
    "scan_batch_manifest",
    f"SELECT transaction_id, i.s AS batch_sequence, i.f AS filename, i.d AS side FROM ({IMAGE_SQL}) WHERE i.f <> ''",
)
def scan_batch_manifest(spark, sf):
    return readers.manifest_images(manifest(spark, sf))


@query(
    "manifest_by_transaction",
    """WITH l AS (SELECT 't' || o_orderkey AS transaction_id, o_orderkey AS f, o_orderstatus = 'P' AS gone FROM orders)
      SELECT transaction_id, '{"transaction_id":"' || transaction_id || '","pages":[{"batch_sequence":"1","images":[{"filename":"' || f || '-f.tif","side":"front"}'
        || CASE WHEN gone THEN '' ELSE ',{"filename":"' || f || '-b.tif","side":"back"}' END
        || ']},{"batch_sequence":"2","images":[{"filename":"' || f || '-x.tif","side":"front"}]}]}' AS manifest,
        2 AS total_pages, CASE WHEN gone THEN 2 ELSE 3 END AS total_images FROM l""",
)
def manifest_by_transaction(spark, sf):
    return readers.manifest_json(manifest(spark, sf))


@query(
    "manifest_by_filename",
    """SELECT o_orderkey || '-b.tif' AS file_name, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN 't' || o_orderkey END AS transaction_id,
        CASE WHEN o_orderstatus <> 'P' THEN '1' END AS batch_sequence, CASE WHEN o_orderstatus <> 'P' THEN 'back' END AS side FROM orders""",
)
def manifest_by_filename(spark, sf):
    name = F.concat(F.col("o_orderkey"), F.lit("-b.tif")).alias("file_name")
    docs = table(spark, sf, "orders").select(name, "o_totalprice")
    return readers.attach_manifest(docs, readers.manifest_images(manifest(spark, sf)))


@query(
    "list_documents",
    """WITH f AS (SELECT cast(cast(o_orderdate AS date) AS varchar) AS d, 'store/' || replace(cast(cast(o_orderdate AS date) AS varchar), '-', '') || '/scan' || o_orderkey
        || CASE o_orderpriority WHEN '1-URGENT' THEN '.jpg' WHEN '2-HIGH' THEN '.tif' WHEN '3-MEDIUM' THEN '.pdf' WHEN '5-LOW' THEN '.png' ELSE '.txt' END AS p FROM orders)
      SELECT d || '_' || string_split(p, '/')[3] AS obj_id, p AS img_path FROM f WHERE p NOT LIKE '%.txt'""",
)
def list_documents(spark, sf):
    day = F.to_date("o_orderdate").cast("string")
    kinds = F.create_map(*[F.lit(x) for kv in (("1-URGENT", ".jpg"), ("2-HIGH", ".tif"), ("3-MEDIUM", ".pdf"), ("5-LOW", ".png")) for x in kv])
    path = F.concat(
        F.lit("store/"), F.translate(day, "-", ""), F.lit("/scan"), F.col("o_orderkey"), F.coalesce(kinds[F.col("o_orderpriority")], F.lit(".txt"))
    )
    listing = table(spark, sf, "orders").select(path.alias("path"), day.alias("day"))
    return readers.document_ids(listing, F.col("day"))


@query("sink_parquet_overwrite", "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def sink_parquet_overwrite(spark, sf):
    stored = VersionedTable(spark, scratch_dir(spark, "overwrite"))
    stored.overwrite(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))
    return stored.overwrite(stored.read().withColumn("o_totalprice", F.col("o_totalprice") * 2))


@query(
    "sink_partition_overwrite",
    """SELECT o_orderkey, cast(date_trunc('year', o_orderdate) AS date) AS eff, CASE WHEN year(o_orderdate) = 2000 THEN 'second' ELSE 'first' END AS load FROM orders""",
)
def sink_partition_overwrite(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "year").alias("eff"))
    stored = ChangeTable(spark, scratch_dir(spark, "partitions"), "eff")
    stored.write(orders.withColumn("load", F.lit("first")), first_load=True)
    stored.write(orders.filter(F.year("eff") == 2000).withColumn("load", F.lit("second")))
    return stored.read()


@query("sink_daily_append", "SELECT event_id, event_type, cast(ts AS date) AS dt FROM events")
def sink_daily_append(spark, sf):
    path = scratch_dir(spark, "daily")
    events = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("dt"))
    sinks.write_daily(events, path)
    sinks.write_daily(events.filter("dt >= date'2024-01-20'"), path)  # a rerun of the last days adds no copies
    return spark.read.parquet(path)


@query(
    "sink_partition_append",
    "SELECT event_id, cast(ts AS date) AS hit_date FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, cast(ts AS date) FROM events WHERE event_type <> 'click'",
)
def sink_partition_append(spark, sf):
    path = scratch_dir(spark, "append")
    events = table(spark, sf, "events").withColumn("hit_date", F.to_date("ts"))
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        sinks.append_partitioned(events.filter(part).select("event_id", "hit_date"), path)
    return spark.read.parquet(path)


@query("sink_csv", CLAIM_CTE + " SELECT doc_id, content, handwritten_percentage FROM docs")
def sink_csv(spark, sf):
    path = scratch_dir(spark, "csv-out")
    docs = claim_docs(spark, sf).select("doc_id", "content", "handwritten_percentage")
    sinks.write_csv(docs.withColumn("content", F.rtrim("content")), path)
    return readers.read_csv(spark, path, docs.schema).withColumn("content", F.concat("content", F.lit(" ")))


@query(
    "sink_json",
    "SELECT 't' || o_orderkey AS transaction_id, 2 AS pages, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS images FROM orders",
)
def sink_json(spark, sf):
    path = scratch_dir(spark, "json-out")
    sinks.write_json(readers.manifest_json(manifest(spark, sf)), path)
    back = spark.read.schema("transaction_id string, manifest string, total_pages int, total_images int").json(path)
    nested = F.from_json("manifest", "pages array<struct<images:array<struct<filename:string>>>>")
    return back.withColumn("m", nested).select(
        "transaction_id", F.size("m.pages").alias("pages"), F.size(F.flatten("m.pages.images")).alias("images")
    )


@query(
    "upsert_by_key",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN 'new' ELSE 'old' END AS state, CASE WHEN o_orderdate < DATE '2001-01-01' THEN o_totalprice END AS price
       FROM orders""",
)
def upsert_by_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    stored = KeyedTable(spark, scratch_dir(spark, "upsert"), ["o_orderkey"], buckets=8)
    old = orders.filter("o_orderdate < date'2001-01-01'").select("o_orderkey", F.lit("old").alias("state"), "price")
    new = orders.filter("o_orderdate >= date'2000-01-01'").select("o_orderkey", F.lit("new").alias("state"))
    stored.upsert(old)
    return stored.upsert(new)
