"""Queries for labelled sets, sampling, models and metrics.

A confirmed case is a claim document of an urgent order; all others are the population
that negatives are sampled from.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.catalog.base import claim_docs, query
from docketry.catalog.scoring import FEATURE_CTE, FEATURE_LIST, FLAG_CTE, SCORE_CTE
from docketry.operators import scoring, training
from docketry.plans import claim_risk
from docketry.session import scratch_dir, stage, table

FEATURES = [f.replace("&", "_and_") for f in claim_risk.FEATURES]
BUCKET = "cast('0x' || substr(md5({}), 1, 8) AS bigint)"


def _bucket(text: str, n: int) -> str:
    return f"({BUCKET.format(text)} % {n})"


def confirmed(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    return urgent.select(F.col("o_orderkey").alias("doc_id"))


def labelled(spark, sf):
    """Features of every claim document with its label, staged as a narrow table."""
    feats = training.plain_names(claim_risk.features(claim_docs(spark, sf))).drop("payment_amount")
    cases = confirmed(spark, sf).withColumn("label", F.lit(1))
    return stage(feats.join(cases, "doc_id", "left").fillna({"label": 0}), "labelled")


@query(
    "label_and_union",
    FEATURE_CTE
    + f""" SELECT doc_id, {FEATURE_LIST}, 1 AS label FROM feats JOIN orders ON o_orderkey = doc_id WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT doc_id, {FEATURE_LIST}, 0 FROM feats JOIN orders ON o_orderkey = doc_id WHERE o_orderpriority <> '1-URGENT' AND {_bucket('cast(doc_id AS varchar)', 10000)} < 700""",
)
def label_and_union(spark, sf):
    feats = stage(claim_risk.features(claim_docs(spark, sf)).drop("payment_amount"), "features")
    cases = confirmed(spark, sf)
    positives, others = feats.join(cases, "doc_id", "left_semi"), feats.join(cases, "doc_id", "left_anti")
    return training.label_and_union(positives, others, 0.07, "doc_id")


@query(
    "align_schemas",
    """SELECT cast(c_custkey AS varchar) AS party, cast(c_acctbal AS float) AS balance, c_nationkey AS nation FROM customer
       UNION ALL SELECT cast(s_suppkey AS varchar), cast(s_acctbal AS float), s_nationkey FROM supplier""",
)
def align_schemas(spark, sf):
    schema = T.StructType(
        [T.StructField("party", T.StringType()), T.StructField("balance", T.FloatType()), T.StructField("nation", T.IntegerType())]
    )
    clients = table(spark, sf, "customer").withColumnsRenamed({"c_custkey": "party", "c_acctbal": "balance", "c_nationkey": "nation"})
    vendors = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "party", "s_acctbal": "balance", "s_nationkey": "nation"})
    return training.align(clients, schema).unionByName(training.align(vendors, schema))


@query(
    "sample_fraction",
    f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {_bucket('cast(o_orderkey AS varchar)', 10000)} < 700",
)
def sample_fraction(spark, sf):
    return training.sample_fraction(table(spark, sf, "orders"), 0.07, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("shuffle_rows", "SELECT o_orderkey, o_totalprice FROM orders")
def shuffle_rows(spark, sf):
    return training.shuffle_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 443)


@query(
    "train_test_split",
    f"SELECT o_orderkey, {_bucket('''o_orderkey || 'split' ''', 10000)} < 8000 AS is_train FROM orders",
)
def train_test_split(spark, sf):
    return training.add_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


_FLAGS = claim_risk.BASE_FLAGS
_CODE = " + ".join(f"{f} * {1 << i}" for i, f in enumerate(_FLAGS))
_SEED = "doc_id || '/' || copy"


@query(
    "oversample_minority",
    FLAG_CTE
    + f""", m AS (SELECT f.*, {_CODE} AS code FROM flags f JOIN orders ON o_orderkey = doc_id WHERE o_orderpriority = '1-URGENT'),
      pc AS (SELECT code, count(*) AS n FROM m GROUP BY code),
      nb AS (SELECT a.code, b.code AS near, bit_count(xor(a.code, b.code)) AS dist, CASE WHEN a.code = b.code THEN b.n - 1 ELSE b.n END AS others FROM pc a, pc b),
      cum AS (SELECT code, near, sum(others) OVER (PARTITION BY code ORDER BY dist, near) AS upto, sum(others) OVER (PARTITION BY code) AS known FROM nb),
      c AS (SELECT m.*, copy FROM m, (VALUES (1), (2)) v(copy)),
      p AS (SELECT c.*, {_bucket(_SEED + " || 'n'", 5)} % least(5, (SELECT max(known) FROM cum WHERE cum.code = c.code)) + 1 AS pick, {_bucket(_SEED + " || 's'", 10000)} / 10000.0::double AS step FROM c),
      s AS (SELECT p.*, (SELECT arg_min(near, upto) FROM cum WHERE cum.code = p.code AND upto >= p.pick AND upto > 0) AS near FROM p)
      SELECT doc_id, copy, """
    + ", ".join(f"round({f} + step * (((near >> {i}) & 1) - {f}), 6) AS {f}" for i, f in enumerate(_FLAGS))
    + " FROM s",
)
def oversample_minority(spark, sf):
    flags = scoring.flags_to_int(claim_risk.rule_flags(claim_docs(spark, sf)), _FLAGS).select("doc_id", *_FLAGS)
    minority = stage(flags.join(confirmed(spark, sf), "doc_id", "left_semi"), "minority")
    return training.oversample(minority, _FLAGS, "doc_id", copies=2)


_TWENTY = {f"f{i}": f"cast((o_orderkey * {2 * i + 1} + o_custkey) % {i + 2} = 0 AS int)" for i in range(20)}
_SCALED = {"price": "round(o_totalprice / 500000.0, 2)", "placed": "round(datediff(cast(o_orderdate AS date), DATE '1992-01-01') / 2500.0, 2)"}
_TWENTY_CODE = " || ".join(f"cast(f{i} AS varchar)" for i in reversed(range(20)))


@query(
    "oversample_numeric",
    "WITH m AS (SELECT o_orderkey, " + ", ".join(f"{e} AS {f}" for f, e in _TWENTY.items())
    + """, round(o_totalprice / 500000.0::double, 2) AS price, round(date_diff('day', DATE '1992-01-01', cast(o_orderdate AS date)) / 2500.0::double, 2) AS placed
      FROM orders WHERE o_orderpriority = '1-URGENT'),
      c AS (SELECT *, """ + _TWENTY_CODE + """ AS code FROM m),
      pt AS (SELECT code, price, placed, count(*) AS n FROM c GROUP BY ALL),
      nb AS (SELECT a.code, a.price, a.placed, b.code AS near, b.price AS nprice, b.placed AS nplaced, b.n - (a.code = b.code AND a.price = b.price AND a.placed = b.placed)::int AS others,
        hamming(a.code, b.code) + (a.price - b.price) * (a.price - b.price) + (a.placed - b.placed) * (a.placed - b.placed) AS d FROM pt a, pt b),
      top AS (SELECT * FROM nb WHERE others > 0 QUALIFY row_number() OVER (PARTITION BY code, price, placed ORDER BY round(d, 9), near, nprice, nplaced) <= 5),
      cum AS (SELECT *, sum(others) OVER (PARTITION BY code, price, placed ORDER BY round(d, 9), near, nprice, nplaced) AS upto FROM top),
      k AS (SELECT code, price, placed, max(upto) AS known FROM cum GROUP BY ALL),
      x AS (SELECT c.*, copy, """
    + _bucket("o_orderkey || '/' || copy || 'n'", 5) + " % least(5, known) + 1 AS pick, " + _bucket("o_orderkey || '/' || copy || 's'", 10000)
    + """ / 10000.0::double AS step FROM c JOIN k USING (code, price, placed), (VALUES (1), (2)) v(copy)),
      s AS (SELECT x.*, near, nprice, nplaced FROM x JOIN cum USING (code, price, placed) WHERE upto >= pick
        QUALIFY row_number() OVER (PARTITION BY o_orderkey, copy ORDER BY upto) = 1)
      SELECT o_orderkey, copy, """
    + ", ".join(f"round(f{i} + step * (cast(substr(near, {20 - i}, 1) AS int) - f{i}), 6) AS f{i}" for i in range(20))
    + ", round(price + step * (nprice - price), 6) AS price, round(placed + step * (nplaced - placed), 6) AS placed FROM s",
)
def oversample_numeric(spark, sf):
    """Urgent orders with twenty flags and two numbers."""
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    features = {**_TWENTY, **_SCALED}
    minority = stage(urgent.selectExpr("o_orderkey", *[f"cast({e} AS double) AS {f}" if f in _SCALED else f"{e} AS {f}" for f, e in features.items()]), "minority")
    return training.oversample(minority, list(_TWENTY), "o_orderkey", copies=2, numbers=list(_SCALED))


@query("cv_model_compare")
def cv_model_compare(spark, sf):
    folded = training.add_fold(labelled(spark, sf), "doc_id")
    weighted = stage(training.patterns(folded, FEATURES, extra=["fold"]), "patterns")
    return training.compare_models(weighted, FEATURES)


@query("fit_risk_model")
def fit_risk_model(spark, sf):
    """Coefficients of the fitted model, which is saved and loaded again on the way."""
    weighted = stage(training.patterns(labelled(spark, sf), FEATURES), "patterns")
    path = scratch_dir(spark, "risk-model")
    training.fit_risk_model(weighted, FEATURES).write().save(path)
    fitted = training.PipelineModel.load(path).stages[-1]
    pairs = list(zip([*FEATURES, "intercept"], [*map(float, fitted.coefficients), float(fitted.intercept)]))
    total = weighted.agg(F.sum("weight").alias("w")).scalar()
    return spark.createDataFrame(pairs, "feature string, coefficient double").withColumn("rows_fitted", total)


@query("score_with_model")
def score_with_model(spark, sf):
    rows = labelled(spark, sf)
    weighted = stage(training.patterns(rows, FEATURES), "patterns")
    scored = training.score_with_model(rows, training.fit_risk_model(weighted, FEATURES))
    return scored.select("doc_id", "risk_score").orderBy(F.desc("risk_score"), "doc_id")


@query(
    "incremental_scoring",
    FEATURE_CTE.replace("SELECT doc_id, member_id, payment_amount,", "SELECT doc_id, batch_date, member_id, payment_amount,")
    .replace("feats AS (SELECT doc_id,", "feats AS (SELECT doc_id, batch_date,")
    + """, done AS (SELECT DISTINCT cast(ts AS date) + 0 AS d FROM events UNION SELECT DISTINCT cast(o_orderdate AS date) FROM orders WHERE o_orderdate < DATE '2000-06-01')
      SELECT doc_id, batch_date, has_bulk_treatment FROM feats WHERE batch_date NOT IN (SELECT d FROM done)""",
)
def incremental_scoring(spark, sf):
    """Documents lie in a table by month; only the months with open days are read."""
    path = scratch_dir(spark, "documents-by-month")
    docs = claim_docs(spark, sf).withColumn("batch_month", F.trunc("batch_date", "month"))
    docs.repartition("batch_month").write.partitionBy("batch_month").parquet(path)
    early = table(spark, sf, "orders").filter("o_orderdate < date'2000-06-01'").select(F.to_date("o_orderdate").alias("batch_date"))
    scored = early.unionByName(table(spark, sf, "events").select(F.to_date("ts").alias("batch_date")))
    todo = training.unscored(spark.read.parquet(path), scored, "batch_date", "batch_month")
    return claim_risk.features(todo, extra=("batch_date",)).select("doc_id", "batch_date", "has_bulk_treatment")


def predictions(spark, sf):
    """Suspicious levels as the prediction, confirmed cases as the label."""
    scored = claim_risk.scored(claim_docs(spark, sf))
    cases = confirmed(spark, sf).withColumn("label", F.lit(1))
    told = scored.join(cases, "doc_id", "left").fillna({"label": 0})
    return told.select("doc_id", "label", (F.col("risk_level") != "Not Suspicious").cast("int").alias("prediction"))


CONFUSION_CTE = SCORE_CTE + """, pr AS (SELECT cast(o_orderpriority = '1-URGENT' AS int) AS label, cast(risk_level <> 'Not Suspicious' AS int) AS prediction
   FROM levels JOIN orders ON o_orderkey = doc_id)"""


@query("confusion_matrix", CONFUSION_CTE + " SELECT label, prediction, count(*) AS n FROM pr GROUP BY ALL")
def confusion_matrix(spark, sf):
    return training.confusion(predictions(spark, sf))


@query(
    "weighted_metrics",
    CONFUSION_CTE
    + """, k AS (SELECT c, count(*) FILTER (label = c) AS actual, count(*) FILTER (prediction = c) AS told, count(*) FILTER (label = c AND prediction = c) AS hit
        FROM pr, (VALUES (0), (1)) v(c) GROUP BY c),
      m AS (SELECT *, CASE WHEN told > 0 THEN hit / told ELSE 0 END AS p, hit / actual AS r FROM k)
      SELECT round(sum(hit) / sum(actual), 6) AS accuracy, round(sum(p * actual) / sum(actual), 6) AS precision, round(sum(r * actual) / sum(actual), 6) AS recall,
        round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * actual) / sum(actual), 6) AS f1 FROM m""",
)
def weighted_metrics(spark, sf):
    return training.weighted_metrics(training.confusion(predictions(spark, sf)))
