"""Queries for calls, surveys, run logs, run dates and calendars.

Contact records come from events, transcripts from documents (a line is an utterance),
cases from events; a contact is a user of the events table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docketry.catalog.base import CLAIM_CTE, claim_docs, query
from docketry.operators import calendar, calls, projections, runlog, surveys, topic_levels
from docketry.session import scratch_dir, table, text_table
from docketry.sources.keyed import KeyedTable

def k():
    return F.get_json_object("props", "$.k").cast("bigint")

def unit():
    """Business unit of an event: big values belong to B1."""
    return F.when(F.col("value") > 10, "B1").otherwise("B0")


SQL_K = "cast(json_extract(props, '$.k') AS bigint)"
SQL_UNIT = "CASE WHEN value > 10 THEN 'B1' ELSE 'B0' END"
CONTACT_KEYS = {
    "Contact_ID": ["ContactId", ""], "Call_Start_Time": ["ConnectedToSystemTimestamp", ""], "Agent_ID": ["Agent", "Username"],
    "Number_Holds": ["Agent", "NumberOfHolds"], "BU": ["Attributes", "BU"], "Language": ["Attributes", "Language__c"],
    "SF_Case_ID": ["Attributes", "sfCaseID"], "Last_Update_Time": ["LastUpdateTimestamp", ""], "Missing": ["Queue", "Name"],
}
TRANSCRIPT_KEYS = {
    "Contact_ID": ["CustomerMetadata", "ContactId"], "trans_Transcript": ["Transcript", ""],
    "Matched_Categories": ["Categories", "MatchedCategories"],
}
CASE_NAMES = {"SF_Case_ID": "Id", "SF_Case_CreatedDate": "CreatedDate", "SF_Type": "Type"}
DAY = "2024-01-10"


def contact_json(spark, sf):
    """Contact records as JSON lines; a third of the events leaves out the agent."""
    agent = F.struct(F.concat(F.lit("agent"), k() % 7).alias("Username"), (k() % 4).alias("NumberOfHolds"))
    record = F.struct(
        F.concat(F.lit("c-"), F.col("user_id")).alias("ContactId"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ConnectedToSystemTimestamp"),
        F.when(F.col("event_type") != "error", agent).alias("Agent"),
        F.struct(
            unit().alias("BU"), F.lit("English").alias("Language__c"),
            F.concat(F.lit("case-"), k()).alias("sfCaseID"),
        ).alias("Attributes"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss."), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("LastUpdateTimestamp"),
    )
    return text_table(spark, sf, "events").select(F.to_json(record).alias("json_value"))


CONTACT_CTE = f"""WITH contacts AS (SELECT 'c-' || user_id AS "Contact_ID", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Call_Start_Time",
   CASE WHEN event_type <> 'error' THEN 'agent' || ({SQL_K} % 7) END AS "Agent_ID", CASE WHEN event_type <> 'error' THEN cast({SQL_K} % 4 AS varchar) END AS "Number_Holds",
   {SQL_UNIT} AS "BU", 'English' AS "Language", 'case-' || {SQL_K} AS "SF_Case_ID",
   strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(cast(event_id AS varchar), 12, '0') AS "Last_Update_Time" FROM events),
 newest AS (SELECT * EXCLUDE (rn, "Last_Update_Time") FROM (SELECT *, row_number() OVER (PARTITION BY "Contact_ID" ORDER BY "Last_Update_Time" DESC) AS rn FROM contacts) WHERE rn = 1)"""


@query("json_extract_map", CONTACT_CTE + ' SELECT *, CAST(NULL AS varchar) AS "Missing" FROM contacts')
def json_extract_map(spark, sf):
    return calls.extract_map(contact_json(spark, sf), CONTACT_KEYS)


def latest_contacts(spark, sf):
    return calls.contact_latest(calls.extract_map(contact_json(spark, sf), CONTACT_KEYS)).drop("Missing")


@query("ctr_latest", CONTACT_CTE + " SELECT * FROM newest")
def ctr_latest(spark, sf):
    return latest_contacts(spark, sf)


def transcript_json(spark, sf):
    """A transcript per document: each line is an utterance, callers and agents take turns."""
    pick = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), (i % len(names) + 1).cast("int"))
    utterances = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            pick(["CUSTOMER", "AGENT"], i).alias("ParticipantId"), line.alias("Content"),
            pick(["NEUTRAL", "POSITIVE", "NEGATIVE"], i).alias("Sentiment"),
        ),
    )
    record = F.struct(
        F.struct(F.concat(F.lit("c-"), F.col("doc_id")).alias("ContactId")).alias("CustomerMetadata"),
        utterances.alias("Transcript"),
        F.struct(F.array(F.col("source")).alias("MatchedCategories")).alias("Categories"),
    )
    return text_table(spark, sf, "documents").select(F.to_json(record).alias("json_value"))


@query(
    "transcript_conversations",
    """WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS "Text", generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
      SELECT 'c-' || doc_id AS "Contact_ID", '["' || source || '"]' AS "Matched_Categories", cast(pos AS int) AS pos, ['CUSTOMER', 'AGENT'][1 + pos % 2] AS "Caller_Type", "Text",
        ['NEUTRAL', 'POSITIVE', 'NEGATIVE'][1 + pos % 3] AS "Sentiment" FROM l""",
)
def transcript_conversations(spark, sf):
    turns = calls.transcripts(transcript_json(spark, sf), TRANSCRIPT_KEYS)
    placed = turns.select("Contact_ID", "Matched_Categories", F.posexplode_outer("Conversations").alias("pos", "c"))
    return placed.filter("pos IS NOT NULL").select("Contact_ID", "Matched_Categories", "pos", "c.*")


def cases(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("case-"), k()).alias("Id"), F.col("ts").alias("CreatedDate"), F.col("ts").alias("LastModifiedDate"),
        F.col("event_type").alias("Type"), "event_id",
    )


def _case_sql(day: str) -> str:
    return f"""(SELECT 'case-' || {SQL_K} AS "SF_Case_ID", ts AS "SF_Case_CreatedDate", event_type AS "SF_Type" FROM events
      WHERE cast(ts AS date) BETWEEN {day} - 1 AND {day}
      QUALIFY row_number() OVER (PARTITION BY {SQL_K} ORDER BY ts DESC, event_id DESC) = 1)"""


CASE_SQL = _case_sql(f"DATE '{DAY}'")


@query("case_latest_window", f"SELECT * FROM {CASE_SQL}")
def case_latest_window(spark, sf):
    return calls.case_latest(cases(spark, sf), DAY, CASE_NAMES, ties=["event_id"])


@query(
    "join_call_case",
    CONTACT_CTE
    + f""" SELECT 'c-' || d.doc_id AS "Contact_ID", '["' || source || '"]' AS "Matched_Categories", n.* EXCLUDE ("Contact_ID"), c.* EXCLUDE ("SF_Case_ID"),
        cast(len(string_split(text, chr(10))) AS int) AS turns
      FROM documents d LEFT JOIN newest n ON n."Contact_ID" = 'c-' || d.doc_id LEFT JOIN {CASE_SQL} c ON c."SF_Case_ID" = n."SF_Case_ID" WHERE "BU" = 'B1'""",
)
def join_call_case(spark, sf):
    trans = calls.transcripts(transcript_json(spark, sf), TRANSCRIPT_KEYS)
    trans = trans.withColumn("turns", F.size("Conversations")).drop("Conversations")
    day_cases = calls.case_latest(cases(spark, sf), DAY, CASE_NAMES, ties=["event_id"])
    return calls.join_call_case(trans, latest_contacts(spark, sf), day_cases, "B1")


DAILY_SQL = f"""WITH days AS (SELECT cast(unnest(generate_series(DATE '2024-01-05', DATE '2024-01-12', INTERVAL 1 DAY)) AS date) AS call_day),
  c AS (SELECT call_day, 'case-' || {SQL_K} AS "SF_Case_ID", ts AS "SF_Case_CreatedDate", event_type AS "SF_Type" FROM events, days
    WHERE cast(ts AS date) BETWEEN call_day - 1 AND call_day QUALIFY row_number() OVER (PARTITION BY call_day, {SQL_K} ORDER BY ts DESC, event_id DESC) = 1),
  t AS (SELECT cast(ts AS date) AS call_day, 'c-' || user_id AS "Contact_ID", {SQL_UNIT} AS "BU", 'case-' || {SQL_K} AS "SF_Case_ID" FROM events
    WHERE cast(ts AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'
    QUALIFY row_number() OVER (PARTITION BY cast(ts AS date), user_id ORDER BY ts DESC, event_id DESC) = 1)
  SELECT t.*, "SF_Case_CreatedDate", "SF_Type" FROM t LEFT JOIN c ON t.call_day = c.call_day AND t."SF_Case_ID" = c."SF_Case_ID" WHERE "BU" = 'B1'"""


@query("daily_union", DAILY_SQL)
def daily_union(spark, sf):
    """Eight days of calls with their cases, as one job over the range."""
    start, end = "2024-01-05", "2024-01-12"
    events = table(spark, sf, "events").withColumn("call_day", F.to_date("ts")).filter(F.col("call_day").between(start, end))
    newest = calls.newest_per_key(events, ["call_day", "user_id"], F.desc("ts"), F.desc("event_id"))
    contact = F.concat(F.lit("c-"), F.col("user_id")).alias("Contact_ID")
    contacts = newest.select("call_day", contact, unit().alias("BU"), F.concat(F.lit("case-"), k()).alias("SF_Case_ID"))
    day_cases = calls.case_latest_range(cases(spark, sf), start, end, CASE_NAMES, ties=["event_id"])
    trans = contacts.select("call_day", "Contact_ID")
    return calls.join_call_case(trans, contacts, day_cases, "B1", on_day="call_day")


@query(
    "dialogue_text",
    """SELECT conv_id, string_agg(role || ': ' || text, ' ' ORDER BY turn) AS "Dialogue_Text" FROM conversations GROUP BY conv_id""",
)
def dialogue_text(spark, sf):
    return calls.dialogue_from_turns(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")


@query(
    "dialogue_text_nested",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
      SELECT 'c-' || doc_id AS "Contact_ID", string_agg(['CUSTOMER', 'AGENT'][1 + pos % 2] || ': ' || line, ' ' ORDER BY pos) AS "Dialogue_Text" FROM l GROUP BY doc_id""",
)
def dialogue_text_nested(spark, sf):
    turns = calls.transcripts(transcript_json(spark, sf), TRANSCRIPT_KEYS)
    return turns.select("Contact_ID", calls.dialogue_text(F.col("Conversations")).alias("Dialogue_Text"))


SURVEY_A = {
    "NPS_Contact_Id": "contact", "NPS_Call_Date": "interaction_date", "NPS_Survey_Id": "survey_id", "NPS_Case_Number": "case_number",
    "NPS_Language": "language", "NPS_Business_Unit": "unit", "NPS_LTR": "ltr", "NPS_Customer_Type": "customer_type", "NPS_Status": "status",
}
SURVEY_B = {
    "NPS_Call_Date": "CallDate", "NPS_Survey_Id": "responseid", "NPS_Case_Number": "InquiryKey", "NPS_Language": "l",
    "NPS_Business_Unit": "BusinessUnit", "NPS_LTR": "LTR", "NPS_Status": "status",
}


def survey_a(spark, sf):
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("c-"), F.col("user_id")).alias("contact"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("interaction_date"),
        F.concat(F.lit("a"), k()).alias("survey_id"), F.concat(F.lit("case-"), k()).alias("case_number"), F.lit("EN").alias("language"),
        unit().alias("unit"), (k() % 11).cast("string").alias("ltr"),
        F.lit("member").alias("customer_type"), F.col("event_type").alias("status"),
    )
    return surveys.project_a(rows, {"status": "purchase", "unit": "B1", "language": "EN"}, SURVEY_A)


def survey_b(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("b"), F.col("o_custkey")).alias("responseid"), F.col("o_orderdate").alias("last_touched"), F.col("o_orderkey").alias("seq"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("CallDate"), F.concat(F.lit("case-"), F.col("o_custkey") % 100).alias("InquiryKey"),
        F.lit("EN").alias("l"), F.col("o_orderpriority").alias("BusinessUnit"), (F.floor("o_totalprice") % 11).cast("string").alias("LTR"),
        F.col("o_orderstatus").alias("status"),
    )
    wanted = {"status": "O", "BusinessUnit": "1-URGENT", "l": "EN"}
    return surveys.latest_b(rows, wanted, SURVEY_B, ties=["seq"])


SQL_A = f"""(SELECT DISTINCT 'c-' || user_id AS "NPS_Contact_Id", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "NPS_Call_Date", 'a' || {SQL_K} AS "NPS_Survey_Id", 'case-' || {SQL_K} AS "NPS_Case_Number",
  'EN' AS "NPS_Language", 'B1' AS "NPS_Business_Unit", cast({SQL_K} % 11 AS varchar) AS "NPS_LTR", 'member' AS "NPS_Customer_Type", event_type AS "NPS_Status"
  FROM events WHERE event_type = 'purchase' AND {SQL_UNIT} = 'B1')"""
SQL_B = """(SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "NPS_Call_Date", 'b' || o_custkey AS "NPS_Survey_Id", 'case-' || (o_custkey % 100) AS "NPS_Case_Number", 'EN' AS "NPS_Language",
  o_orderpriority AS "NPS_Business_Unit", cast(cast(floor(o_totalprice) AS bigint) % 11 AS varchar) AS "NPS_LTR", o_orderstatus AS "NPS_Status"
  FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')"""
SQL_UNIFIED = f"""(SELECT *, 'A' AS "NPS_Source" FROM {SQL_A} UNION ALL BY NAME SELECT *, 'B' AS "NPS_Source" FROM {SQL_B})"""


@query("survey_project_a", f"SELECT * FROM {SQL_A}")
def survey_project_a(spark, sf):
    return survey_a(spark, sf)


@query("survey_latest_b", f"SELECT * FROM {SQL_B}")
def survey_latest_b(spark, sf):
    return survey_b(spark, sf)


def unified(spark, sf):
    return surveys.unify({"A": survey_a(spark, sf), "B": survey_b(spark, sf)})


@query("survey_unify", f"SELECT * FROM {SQL_UNIFIED}")
def survey_unify(spark, sf):
    return unified(spark, sf)


@query(
    "survey_maturity_gate",
    f"""SELECT * REPLACE (cast("NPS_Call_Date"::timestamp AS date) AS "NPS_Call_Date") FROM {SQL_UNIFIED}
      WHERE "NPS_Call_Date"::timestamp::date BETWEEN DATE '2000-01-01' AND DATE '2024-01-31' AND DATE '2024-02-01' - "NPS_Call_Date"::timestamp::date > 21""",
)
def survey_maturity_gate(spark, sf):
    return surveys.mature(unified(spark, sf), "2000-01-01", "2024-01-31", as_of="2024-02-01")


def log_writes(spark, sf):
    """Writes to a run log: a run per user and day; error events bring a message, others a row count."""
    return table(spark, sf, "events").select(
        F.concat(F.col("user_id"), F.lit("/"), F.to_date("ts")).alias("id"), F.col("ts").alias("written_at"), F.col("event_id").alias("seq"),
        F.to_date("ts").alias("Date"), F.when(F.col("event_type") == "error", "failed").alias("Error_Message"),
        F.when(F.col("event_type") != "error", k()).alias("Rows_Entered"),
    )


LOG_CTE = f"""WITH writes AS (SELECT user_id || '/' || cast(ts AS date) AS id, ts, event_id, cast(ts AS date) AS "Date",
    CASE WHEN event_type = 'error' THEN 'failed' END AS err, CASE WHEN event_type <> 'error' THEN {SQL_K} END AS n FROM events),
  log AS (SELECT id, min(ts) AS "Created_Date", max("Date") AS "Date", max(err) AS "Error_Message", arg_max(n, event_id) AS "Rows_Entered",
    count(*) > 1 AND arg_max(CASE WHEN err IS NULL THEN 1 ELSE 0 END, event_id) = 1 AS "Success" FROM writes GROUP BY id)"""


@query("run_log_upsert", LOG_CTE + ' SELECT * FROM log')
def run_log_upsert(spark, sf):
    """The log up to mid-month is stored first; the runs of the later days are merged into it."""
    writes, stored = log_writes(spark, sf), KeyedTable(spark, scratch_dir(spark, "run-log"), ["id"], buckets=8)
    early = F.col("Date") <= F.lit("2024-01-15").cast("date")
    stored.upsert(runlog.fold_run_log(writes.filter(early)))
    return stored.upsert(runlog.fold_run_log(writes.filter(F.col("Date") >= F.lit("2024-01-15").cast("date"))))


def water_marks(spark, sf):
    """A high-water mark per day of events; a day with too many errors did not complete."""
    errors = F.count_if(F.col("event_type") == "error") * 5 > F.count(F.lit(1))
    runs = table(spark, sf, "events").groupBy(F.to_date("ts").cast("string").alias("pipelinerunid")).agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("lo"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("hi"),
        F.when(errors, "too many errors").otherwise("").alias("Error_Txt"), F.count(F.lit(1)).alias("n"),
    )
    return runlog.watermark_row(runs, F.col("lo"), F.col("hi"), F.col("Error_Txt"), F.col("n"))


MARK_CTE = """WITH marks AS (SELECT cast(cast(ts AS date) AS varchar) AS pipelinerunid, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS "WatermarkValue_start_ts",
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS "WatermarkValue_end_ts", CASE WHEN count(*) FILTER (event_type = 'error') * 5 > count(*) THEN 'error' ELSE 'complete' END AS "Status",
    count(*) AS "Count" FROM events GROUP BY cast(ts AS date))"""


@query(
    "watermark_default",
    """SELECT coalesce(max(strftime(ts, '%Y-%m-%d')), '1800-01-01') AS watermark_start FROM events WHERE event_type = 'nothing'""",
)
def watermark_default(spark, sf):
    none_yet = water_marks(spark, sf).withColumn("Status", F.lit("starting"))
    return runlog.watermark_value(none_yet, "date")


@query(
    "watermark_select",
    MARK_CTE + """ SELECT coalesce(max("WatermarkValue_end_ts") FILTER ("Status" = 'complete'), '1800-01-01 00:00:00') AS watermark_start FROM marks""",
)
def watermark_select(spark, sf):
    return runlog.watermark_value(water_marks(spark, sf), "timestamp")


@query(
    "watermark_upsert",
    MARK_CTE
    + """ SELECT pipelinerunid, 'load ' || pipelinerunid AS pipelinerunname, 'events' AS "TableName", 'stream' AS "SourceName", '/events' AS "ParamPathName", 'ts' AS "CheckColumn",
      'timestamp' AS "CheckColumnType", "WatermarkValue_start_ts", "WatermarkValue_end_ts", "Status", 60 AS "RunTime", "Count", 'rows: ' || cast("Count" AS varchar) AS "LogOutput",
      CASE WHEN "Status" = 'error' THEN 'too many errors' ELSE '' END AS "Error_Txt", "WatermarkValue_end_ts" AS "CreateTs" FROM marks""",
)
def watermark_upsert(spark, sf):
    """Every run first enters as starting without an end; its final row then replaces what a run may change, and keeps what it was entered with."""
    names = {"TableName": "events", "SourceName": "stream", "ParamPathName": "/events", "CheckColumn": "ts", "CheckColumnType": "timestamp"}
    marks = water_marks(spark, sf).withColumns({"pipelinerunname": F.concat(F.lit("load "), "pipelinerunid"), **{c: F.lit(v) for c, v in names.items()}})
    failed = F.when(F.col("Status") == "error", "too many errors").otherwise("")
    told = {"RunTime": F.lit(60), "LogOutput": F.concat(F.lit("rows: "), F.col("Count").cast("string")), "Error_Txt": failed, "CreateTs": F.col("WatermarkValue_end_ts")}
    final = marks.withColumns(told)
    opened = marks.withColumns(
        {"WatermarkValue_end_ts": F.lit(""), "Status": F.lit("starting"), "Count": F.lit(0).cast("bigint"), "RunTime": F.lit(0), "LogOutput": F.lit(""), "Error_Txt": F.lit(""), "CreateTs": F.lit("")}
    )
    stored = KeyedTable(spark, scratch_dir(spark, "marks"), ["pipelinerunid"], buckets=4)
    entered = F.col("pipelinerunid") <= "2024-01-20"  # the other runs were never entered and come with all their columns
    stored.upsert(opened.filter(entered))
    renamed = final.withColumns({c: F.when(entered, "changed").otherwise(F.col(c)) for c in ("pipelinerunname", *names)})
    return runlog.finish_marks(stored, renamed)


@query(
    "incremental_read",
    MARK_CTE
    + """ SELECT event_id, ts FROM events WHERE ts > (SELECT coalesce(max("WatermarkValue_end_ts") FILTER ("Status" = 'complete' AND pipelinerunid <= '2024-01-20'), '1800-01-01')::timestamp FROM marks)
        AND ts <= TIMESTAMP '2024-01-28 12:00:00'""",
)
def incremental_read(spark, sf):
    marks = water_marks(spark, sf).filter("pipelinerunid <= '2024-01-20'")
    start = runlog.watermark_value(marks, "timestamp").select(F.col("watermark_start").cast("timestamp_ntz")).scalar()
    end = F.lit("2024-01-28 12:00:00").cast("timestamp_ntz")
    return runlog.incremental_read(table(spark, sf, "events"), "ts", start, end).select("event_id", "ts")


def day_log(spark, sf):
    """Run log by day: a day succeeded when less than a fifth of its events are errors."""
    errors = F.count_if(F.col("event_type") == "error") * 5
    return table(spark, sf, "events").groupBy(F.to_date("ts").alias("Date")).agg((errors < F.count(F.lit(1))).alias("Success"))


@query(
    "run_dates_from_log",
    """WITH log AS (SELECT cast(ts AS date) AS d, count(*) FILTER (event_type = 'error') * 5 < count(*) AS ok FROM events GROUP BY 1),
      b AS (SELECT max(d) AS last_d, max(d) FILTER (ok) AS good FROM log)
      SELECT 'Weekly' AS frequency, good + 1 AS start_date, last_d + 7 AS end_date FROM b
      UNION ALL SELECT 'Daily', good + 1, CASE WHEN DATE '2024-02-09' - good > 2 THEN good + 3 ELSE DATE '2024-02-09' END FROM b
      UNION ALL SELECT 'Retry', last_d, CASE WHEN DATE '2024-01-31' - (last_d - 1) > 2 THEN last_d + 2 ELSE DATE '2024-01-31' END FROM b""",
)
def run_dates_from_log(spark, sf):
    log = day_log(spark, sf)
    weekly = runlog.run_dates(log, "Weekly", "2024-02-10").withColumn("frequency", F.lit("Weekly"))
    daily = runlog.run_dates(log, "Daily", "2024-02-10").withColumn("frequency", F.lit("Daily"))
    retry = runlog.run_dates(log.withColumn("Success", F.lit(False)), "Daily", "2024-02-01").withColumn("frequency", F.lit("Retry"))
    return weekly.unionByName(daily).unionByName(retry)


def order_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))


@query(
    "date_range",
    """SELECT cast(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS date) AS "Date" """,
)
def date_range(spark, sf):
    bounds = table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("start_date"), F.to_date(F.max("o_orderdate")).alias("end_date"))
    return runlog.date_range(bounds)


# Easter by the anonymous Gregorian algorithm, weekdays by isodow (Monday = 1).
CALENDAR_CTE = """WITH ys AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
 e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM ys),
 e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
 e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
 e4 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e3),
 es AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM e4),
 days AS (SELECT cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS date) AS d FROM ys),
 named AS (
   SELECT d AS "Date", 'Sunday' AS "Name" FROM days WHERE isodow(d) = 7
   UNION ALL SELECT CASE WHEN isodow(make_date(y, 1, 1)) > 5 THEN make_date(y, 1, 1) + cast(8 - isodow(make_date(y, 1, 1)) AS int) ELSE make_date(y, 1, 1) END, 'New Year''s Day' FROM ys
   UNION ALL SELECT d, 'Family Day' FROM days WHERE month(d) = 2 AND isodow(d) = 1 AND day(d) BETWEEN 15 AND 21
   UNION ALL SELECT easter - 2, 'Good Friday' FROM es UNION ALL SELECT easter + 1, 'Easter Monday' FROM es
   UNION ALL SELECT d, 'Victoria Day' FROM days WHERE month(d) = 5 AND isodow(d) = 1 AND day(d) BETWEEN 18 AND 24
   UNION ALL SELECT CASE WHEN isodow(make_date(y, 7, 1)) > 5 THEN make_date(y, 7, 1) + cast(8 - isodow(make_date(y, 7, 1)) AS int) ELSE make_date(y, 7, 1) END, 'Canada Day' FROM ys
   UNION ALL SELECT d, 'Civic Day' FROM days WHERE month(d) = 8 AND isodow(d) = 1 AND day(d) <= 7
   UNION ALL SELECT d, 'Labour Day' FROM days WHERE month(d) = 9 AND isodow(d) = 1 AND day(d) <= 7
   UNION ALL SELECT d, 'Thanksgiving' FROM days WHERE month(d) = 10 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14
   UNION ALL SELECT make_date(y, 12, 25) + CASE WHEN isodow(make_date(y, 12, 25)) > 5 THEN 2 ELSE 0 END, 'Christmas' FROM ys
   UNION ALL SELECT make_date(y, 12, 26) + CASE WHEN isodow(make_date(y, 12, 26)) > 5 THEN 2 ELSE 0 END, 'Boxing Day' FROM ys)"""


@query("business_calendar", CALENDAR_CTE + ' SELECT "Date", "Name" FROM named')
def business_calendar(spark, sf):
    return calendar.business_calendar(order_years(spark, sf))


@query(
    "exclude_non_business",
    CALENDAR_CTE + ' SELECT DISTINCT cast(o_orderdate AS date) AS "Date" FROM orders WHERE cast(o_orderdate AS date) NOT IN (SELECT "Date" FROM named)',
)
def exclude_non_business(spark, sf):
    dates = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return calendar.exclude_non_business(dates, calendar.business_calendar(order_years(spark, sf)))


TOPICS = {"contact": ["[a-z]+@[a-z]+", r"\d{3}-\d{4}"], "license": ["licen[cs]e", "copyright"], "money": [r"\$\d"], "quoted": ['"[^"]+"']}


@query(
    "topic_search_labels",
    "SELECT doc_id, " + ", ".join(f"regexp_matches(text, '{'|'.join(f'(?:{p})' for p in ps)}') AS topic_{n}" for n, ps in TOPICS.items()) + " FROM documents",
)
def topic_search_labels(spark, sf):
    docs = text_table(spark, sf, "documents", "doc_id", "text")
    return calls.search_topics(docs, "text", TOPICS).drop("text")


#: Patterns by the path of their file.
TOPIC_FOLDERS = {
    "care/physio": ["physiotherapy", "referral by dr"], "care/drugs/pharmacy": ["pharmacy", "drug"], "care/drugs/device": ["medical device"],
    "forms": ["plan contract number"], "forms/benefits": ["explanation of benefits", "claims? confirmation"], "money/cash": ["paid.{0,6}cash"], "money/card": ["visa|credit"],
}


def _level_sql() -> str:
    hits = " UNION ALL ".join(
        f"SELECT doc_id, batch_date, '{node}' AS node FROM docs WHERE regexp_matches(t, '{'|'.join(f'(?:{p})' for p in ps)}')" for node, ps in TOPIC_FOLDERS.items()
    )
    return CLAIM_CTE + f""", hits AS ({hits}), up AS (SELECT DISTINCT doc_id, batch_date, l AS level, array_to_string(string_split(node, '/')[1:l], '/') AS topic
      FROM hits, range(1, 4) r(l) WHERE l <= len(string_split(node, '/')))"""


def topic_levels_of(spark, sf):
    root = f"{scratch_dir(spark, 'patterns')}/levels"
    for node, patterns in TOPIC_FOLDERS.items():
        spark.createDataFrame([("# patterns",), *[(p,) for p in patterns], ("",)], "value string").coalesce(1).write.text(f"{root}/{node}.txt")
    # Spark writes folders; what a node's folder holds belongs to the node.
    patterns = topic_levels.read_patterns(spark, root, ending=".txt")
    docs = claim_docs(spark, sf).select("doc_id", "batch_date", F.lower("content").alias("t"))
    return topic_levels.label_levels(docs, ["doc_id", "batch_date"], "t", patterns)


@query("topic_search_levels", _level_sql() + " SELECT doc_id, batch_date, cast(level AS int) AS level, topic FROM up")
def topic_search_levels(spark, sf):
    return topic_levels_of(spark, sf)


@query("topic_levels_daily", _level_sql() + " SELECT batch_date, cast(level AS int) AS level, topic, count(*) AS n FROM up GROUP BY ALL")
def topic_levels_daily(spark, sf):
    return topic_levels.daily_counts(topic_levels_of(spark, sf), "batch_date")
