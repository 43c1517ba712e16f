"""Queries for change data capture, SCD2 history and masking.

Landing snapshots come from orders: one per calendar year, with one row per client that
ordered in it. Clients come, go and change, so every operation occurs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import query
from docketry.functions import masking
from docketry.functions.fixed_values import EFF, OPS
from docketry.operators import cdc
from docketry.plans import change_flow
from docketry.session import scratch_dir, stage, table

KEYS = ["client"]
RUN_TS, BATCH_ID = "2024-03-02 01:00:00", 7
LAST, LAST_BUT_ONE = "2001-01-01", "2000-01-01"
#: A batch that no landing has.
NEVER = "2001-06-01"

LANDING_CTE = """WITH landings AS (SELECT cast(date_trunc('year', o_orderdate) AS date) AS batch_date, o_custkey AS client,
   max(o_orderpriority) AS priority, max(o_orderstatus) AS status FROM orders GROUP BY ALL),
 batches AS (SELECT DISTINCT batch_date FROM landings),
 pairs AS (SELECT batch_date AS d, lag(batch_date) OVER (ORDER BY batch_date) AS p FROM batches),
 changes AS (
   SELECT coalesce(n.client, o.client) AS client, CASE WHEN n.client IS NULL THEN o.priority ELSE n.priority END AS priority,
     CASE WHEN n.client IS NULL THEN o.status ELSE n.status END AS status,
     CASE WHEN o.client IS NULL THEN 'I' WHEN n.client IS NULL THEN 'D' ELSE 'U' END AS op, coalesce(n.d, o.d) AS eff
   FROM (SELECT d, l.* FROM pairs JOIN landings l ON l.batch_date = d) n
   FULL JOIN (SELECT d, l.* FROM pairs JOIN landings l ON l.batch_date = p) o ON n.d = o.d AND n.client = o.client
   WHERE n.client IS NULL OR o.client IS NULL OR n.priority <> o.priority OR n.status <> o.status)"""
STAMP = "TIMESTAMP '2024-03-02 01:00:00' AS \"DL_ETL_RUN_DT\", 7 AS \"DL_ETL_BATCH_ID\""
CHANGE_COLS = f'client, priority, status, op AS "DL_ETL_OPS_IND", eff AS "DL_ETL_EFF_DT", {STAMP}'


def landings(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.trunc("o_orderdate", "year").alias("batch_date"), F.col("o_custkey").alias("client")).agg(
        F.max("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status")
    )


def landing_of(spark, sf, day):
    return landings(spark, sf).filter(F.col("batch_date") == F.lit(day).cast("date")).drop("batch_date")


def changes_of(spark, sf):
    stacked = landings(spark, sf)
    return cdc.diff_all(stacked, stacked, KEYS, RUN_TS, BATCH_ID)


def earlier_changes(spark, sf):
    """Changes up to the last batch but one, as a stored table would hold them."""
    stacked = landings(spark, sf).filter(F.col("batch_date") < F.lit(LAST).cast("date"))
    return cdc.diff_all(stacked, stacked, KEYS, RUN_TS, BATCH_ID)


@query(
    "cdc_batch_plan",
    """WITH n AS (SELECT cast(date_trunc('month', o_orderdate) AS date) AS batch_date, count(*) AS landing_rows FROM orders GROUP BY 1),
      b AS (SELECT cast(unnest(generate_series((SELECT min(batch_date) FROM n), (SELECT max(batch_date) + INTERVAL 2 MONTH FROM n), INTERVAL 1 MONTH)) AS date) AS batch_date)
      SELECT b.batch_date, coalesce(landing_rows, 0) AS landing_rows,
        CASE WHEN b.batch_date = (SELECT min(batch_date) FROM b) THEN 'initial_load' WHEN landing_rows > 0 THEN 'diff'
        WHEN b.batch_date = (SELECT max(batch_date) FROM b) THEN 'restamp_current' ELSE 'skip' END AS action
      FROM b LEFT JOIN n ON b.batch_date = n.batch_date""",
)
def cdc_batch_plan(spark, sf):
    landing = table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("batch_date"))
    bounds = landing.agg(F.min("batch_date").alias("a"), F.add_months(F.max("batch_date"), 2).alias("b"))
    batches = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("batch_date"))
    return cdc.batch_plan(landing, batches, first_run=True, mode="delta")


@query(
    "cdc_initial_load",
    LANDING_CTE
    + f""" SELECT 'changes' AS target, client, priority, status, DATE '1995-01-01' AS "DL_ETL_EFF_DT", 'I' AS "DL_ETL_OPS_IND", CAST(NULL AS DATE) AS "DL_ETL_END_DT", {STAMP} FROM landings WHERE batch_date = DATE '1995-01-01'
      UNION ALL SELECT 'history', client, priority, status, DATE '1995-01-01', 'I', DATE '9999-12-31', {STAMP} FROM landings WHERE batch_date = DATE '1995-01-01'
      UNION ALL SELECT 'current', client, priority, status, DATE '1995-01-01', NULL, NULL, {STAMP} FROM landings WHERE batch_date = DATE '1995-01-01'""",
)
def cdc_initial_load(spark, sf):
    first = landing_of(spark, sf, "1995-01-01")
    loaded = cdc.initial_load(first, KEYS, "1995-01-01", RUN_TS, BATCH_ID)
    parts = [df.withColumn("target", F.lit(name)) for name, df in loaded.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


@query(
    "cdc_latest_per_key",
    LANDING_CTE
    + f""", r AS (SELECT *, row_number() OVER (PARTITION BY client ORDER BY eff DESC) AS rn FROM changes WHERE eff < DATE '{LAST}')
      SELECT {CHANGE_COLS} FROM r WHERE rn = 1 AND op <> 'D'""",
)
def cdc_latest_per_key(spark, sf):
    return cdc.latest_before(changes_of(spark, sf), KEYS, LAST)


@query(
    "cdc_row_hash",
    """SELECT c_custkey, md5(concat_ws(chr(31), '=' || cast(c_custkey AS varchar), '=' || trim(upper(c_name)), coalesce('=' || trim(upper(nullif(c_mktsegment, 'HOUSEHOLD'))), '*'))) AS hash_id
      FROM customer""",
)
def cdc_row_hash(spark, sf):
    customer = table(spark, sf, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")))
    return customer.select("c_custkey", cdc.row_hash(["c_custkey", "c_name", "segment"]).alias("hash_id"))


@query("cdc_changes_all", LANDING_CTE + f" SELECT {CHANGE_COLS} FROM changes")
def cdc_changes_all(spark, sf):
    return changes_of(spark, sf)


def _one_op(name, op):
    @query(name, LANDING_CTE + f" SELECT {CHANGE_COLS} FROM changes WHERE eff = DATE '{LAST}' AND op = '{op}'")
    def run(spark, sf):
        day = cdc.diff(landing_of(spark, sf, LAST), earlier_changes(spark, sf), KEYS, LAST, RUN_TS, BATCH_ID)
        return day.filter(F.col(OPS) == op)


_one_op("cdc_inserts", "I")
_one_op("cdc_updates", "U")
_one_op("cdc_deletes", "D")

# The same day brings a second delivery: clients with urgent orders, everything in it upgraded.
SECOND_CTE = LANDING_CTE + f""", first_part AS (SELECT * FROM changes WHERE eff <= DATE '{LAST}' AND op <> 'D'),
 second AS (SELECT o_custkey AS client, min(o_orderpriority) AS priority, max(o_orderstatus) AS status FROM orders
   WHERE o_orderdate >= DATE '{LAST}' AND o_orderpriority = '1-URGENT' GROUP BY 1),
 merged AS (SELECT * FROM second UNION ALL
   SELECT client, priority, status FROM first_part f WHERE eff = DATE '{LAST}' AND NOT EXISTS (SELECT 1 FROM second s WHERE s.client = f.client)),
 latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client ORDER BY eff DESC) AS rn FROM changes WHERE eff < DATE '{LAST}') WHERE rn = 1 AND op <> 'D')"""


def second_delivery(spark, sf):
    orders = table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= F.lit(LAST).cast("date")) & (F.col("o_orderpriority") == "1-URGENT")
    )
    return orders.groupBy(F.col("o_custkey").alias("client")).agg(
        F.min("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status")
    )


@query(
    "cdc_delta_dimension_merge",
    SECOND_CTE
    + f""" SELECT m.client, m.priority, m.status, CASE WHEN l.client IS NULL THEN 'I' ELSE 'U' END AS "DL_ETL_OPS_IND", DATE '{LAST}' AS "DL_ETL_EFF_DT", {STAMP}
      FROM merged m LEFT JOIN latest l ON m.client = l.client
      WHERE l.client IS NULL OR l.priority <> m.priority OR l.status <> m.status""",
)
def cdc_delta_dimension_merge(spark, sf):
    known = changes_of(spark, sf).filter((F.col(OPS) != "D") | (F.col(EFF) < F.lit(LAST).cast("date")))
    return cdc.diff(second_delivery(spark, sf), known, KEYS, LAST, RUN_TS, BATCH_ID, load="delta")


@query(
    "cdc_delta_transaction",
    SECOND_CTE + f""" SELECT client, priority, status, DATE '{LAST}' AS "DL_ETL_EFF_DT", {STAMP} FROM merged""",
)
def cdc_delta_transaction(spark, sf):
    known = changes_of(spark, sf).filter(F.col(OPS) != "D").drop(OPS)
    return cdc.diff(second_delivery(spark, sf), known, KEYS, LAST, RUN_TS, BATCH_ID, load="delta", table="transaction")


@query(
    "cdc_reject_late_batch",
    LANDING_CTE
    + f""" SELECT b.batch_date, (SELECT max(eff) FROM changes WHERE eff < DATE '{LAST}') AS max_eff,
        b.batch_date < (SELECT max(eff) FROM changes WHERE eff < DATE '{LAST}') AS rejected FROM batches b""",
)
def cdc_reject_late_batch(spark, sf):
    return cdc.late_batches(landings(spark, sf), earlier_changes(spark, sf))


CURRENT_SQL = """ SELECT client, priority, status, eff AS "DL_ETL_EFF_DT", {stamp} FROM
   (SELECT *, row_number() OVER (PARTITION BY client ORDER BY eff DESC) AS rn FROM changes) WHERE rn = 1 AND op <> 'D'"""


@query("cdc_current", LANDING_CTE + CURRENT_SQL.format(stamp=STAMP))
def cdc_current(spark, sf):
    return cdc.current(changes_of(spark, sf), KEYS, RUN_TS, BATCH_ID)


@query(
    "cdc_refresh_current",
    LANDING_CTE + CURRENT_SQL.format(stamp="TIMESTAMP '2024-03-03 02:30:00' AS \"DL_ETL_RUN_DT\", 8 AS \"DL_ETL_BATCH_ID\""),
)
def cdc_refresh_current(spark, sf):
    return cdc.restamp(cdc.current(changes_of(spark, sf), KEYS, RUN_TS, BATCH_ID), "2024-03-03 02:30:00", 8)


HISTORY_CTE = LANDING_CTE + """, hist AS (SELECT * FROM (SELECT *, coalesce(lead(eff) OVER (PARTITION BY client ORDER BY eff) - 1, DATE '9999-12-31') AS end_dt
   FROM changes) WHERE op <> 'D')"""
HISTORY_COLS = f'client, priority, status, op AS "DL_ETL_OPS_IND", eff AS "DL_ETL_EFF_DT", end_dt AS "DL_ETL_END_DT", {STAMP}'


@query("scd2_history", HISTORY_CTE + f" SELECT {HISTORY_COLS} FROM hist")
def scd2_history(spark, sf):
    return cdc.history(changes_of(spark, sf), KEYS)


@query(
    "scd2_rollback",
    HISTORY_CTE.replace("FROM changes)", f"FROM changes WHERE eff < DATE '{LAST}')") + f" SELECT {HISTORY_COLS} FROM hist",
)
def scd2_rollback(spark, sf):
    return cdc.roll_back(cdc.history(changes_of(spark, sf), KEYS), LAST)


@query("scd2_apply_day", HISTORY_CTE + f" SELECT {HISTORY_COLS} FROM hist")
def scd2_apply_day(spark, sf):
    changes = stage(changes_of(spark, sf), "changes")
    before = cdc.roll_back(cdc.history(changes, KEYS), LAST)
    return cdc.apply_day(before, changes.filter(F.col(EFF) == F.lit(LAST).cast("date")), KEYS)


@query(
    "scd2_as_of",
    HISTORY_CTE + f" SELECT {HISTORY_COLS} FROM hist WHERE eff <= DATE '1998-06-30' AND end_dt >= DATE '1998-06-30'",
)
def scd2_as_of(spark, sf):
    return cdc.as_of(cdc.history(changes_of(spark, sf), KEYS), "1998-06-30")


@query(
    "cdc_flow_daily",
    HISTORY_CTE + f" SELECT {HISTORY_COLS} FROM hist",
)
def cdc_flow_daily(spark, sf):
    """The stored-table flow, batch after batch, ends with the same History as the closed form."""
    tables = change_flow.load_batches(spark, landings(spark, sf), KEYS, RUN_TS, BATCH_ID)
    return tables.history()


@query(
    "mask_full",
    "SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[a-zA-Z]', 'X', 'g'), '[0-9]', 'n', 'g') AS c_name FROM customer",
)
def mask_full(spark, sf):
    return masking.apply_masks(table(spark, sf, "customer").select("c_custkey", "c_name"), "mask:C_NAME")


@query(
    "mask_show_first_n",
    """SELECT c_custkey, substr(c_name, 1, 10) || regexp_replace(regexp_replace(substr(c_name, 11), '[a-zA-Z]', 'X', 'g'), '[0-9]', 'n', 'g') AS c_name,
      substr(c_mktsegment, 1, 2) || regexp_replace(substr(c_mktsegment, 3), '[a-zA-Z]', 'X', 'g') AS c_mktsegment FROM customer""",
)
def mask_show_first_n(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return masking.apply_masks(customer, "mask_show_first_10:c_name,mask_show_first_2:c_mktsegment")


@query(
    "mask_date_month",
    """SELECT l_orderkey, l_linenumber, cast(date_trunc('month', l_shipdate) AS date) AS ship_day, cast(date_trunc('month', l_shipdate) AS timestamp) AS l_shipdate
      FROM lineitem""",
)
def mask_date_month(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"), "l_shipdate")
    return masking.apply_masks(items, "datemask:ship_day,datemask:L_SHIPDATE")


@query(
    "audit_counts",
    HISTORY_CTE
    + f""", s AS (SELECT count(*) FILTER (batch_date = DATE '{LAST_BUT_ONE}') AS s0, count(*) FILTER (batch_date = DATE '{LAST}') AS s1 FROM landings),
      c AS (SELECT count(*) AS c1, count(*) FILTER (op <> 'D') AS opened FROM changes WHERE eff = DATE '{LAST}'),
      t AS (SELECT 'Changes' AS step, DATE '{LAST_BUT_ONE}' AS batch_date, s0 AS source_rows, s0 AS target_rows FROM s
        UNION ALL SELECT 'History', DATE '{LAST_BUT_ONE}', s0, s0 FROM s UNION ALL SELECT 'Current', DATE '{LAST_BUT_ONE}', s0, s0 FROM s
        UNION ALL SELECT 'Changes', DATE '{LAST}', s1, c1 FROM s, c UNION ALL SELECT 'History', DATE '{LAST}', s1, s0 + opened FROM s, c
        UNION ALL SELECT 'Current', DATE '{LAST}', s1, s1 FROM s),
      d AS (SELECT unnest([DATE '{LAST_BUT_ONE}', DATE '{LAST}', DATE '{NEVER}']) AS batch_date), n AS (SELECT unnest(['Changes', 'History', 'Current']) AS step)
      SELECT step || m AS step, batch_date, status, source_rows, target_rows FROM
        (SELECT step, batch_date, 'SUCCESS' AS status, source_rows, target_rows FROM t UNION ALL SELECT step, batch_date, 'STARTED', NULL, NULL FROM n, d
         UNION ALL SELECT step, DATE '{NEVER}', 'FAILED', 0, 0 FROM n), (VALUES (''), ('-MASK')) v(m)""",
)
def audit_counts(spark, sf):
    """The journal of two batches and of one that fails, since its landing holds keys twice."""
    flow = change_flow.ChangeFlow(spark, scratch_dir(spark, "audited"), KEYS, mask_plan="mask:priority")
    last = landing_of(spark, sf, LAST)
    flow.first_load(landing_of(spark, sf, LAST_BUT_ONE), LAST_BUT_ONE, RUN_TS, BATCH_ID)
    flow.batch(last, LAST, RUN_TS, BATCH_ID)
    try:
        flow.batch(last.unionByName(last), NEVER, RUN_TS, BATCH_ID)
    except ValueError:
        pass  # the journal tells
    return flow.journal.read().select("step", "batch_date", "status", "source_rows", "target_rows")
