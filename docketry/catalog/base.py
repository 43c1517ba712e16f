"""Query registry and the derived inputs that the queries of several families share.

Derived inputs are written as portable SQL expressions, so that Spark and the checking
engine build the same rows from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketry.session import text_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query and, where SQL can express it, its twin."""

    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


CLAIM_CONTENT = """'Document ' || cast(o_orderkey AS string) || ' '
 || CASE o_orderkey % 7 WHEN 0 THEN 'Invoice number 7 ' WHEN 1 THEN 'Invoice # 1234 ' WHEN 2 THEN 'invoice# 77777 '
      WHEN 3 THEN 'Invoice num date ' WHEN 5 THEN '' ELSE 'Invoice # A' || cast(o_orderkey AS string) || ' ' END
 || 'date ' || replace(cast(cast(o_orderdate AS date) AS string), '-', '/') || ' '
 || CASE o_orderkey % 5 WHEN 0 THEN 'paid by cash ' WHEN 1 THEN 'paid cash at cashier ' WHEN 2 THEN 'cashier took cash '
      WHEN 3 THEN 'paid cash or visa ' ELSE 'paid by credit ' END
 || CASE o_orderkey % 4 WHEN 0 THEN 'total $' || cast(cast(floor(o_totalprice) AS bigint) % 900 AS string) || '.50' || ' '
      WHEN 1 THEN 'total ' || cast(cast(floor(o_totalprice) AS bigint) % 900 AS string) || '.50' || ' '
      WHEN 2 THEN 'amount due ' ELSE 'fee $12.50 total $1,234.56 ' END
 || CASE o_orderkey % 6 WHEN 0 THEN 'address 12 main street toronto ontario m5v 2t6 ' WHEN 1 THEN 'address unknown '
      WHEN 2 THEN 'email address jo@site.ca ' WHEN 3 THEN 'mail to k1a 0b6 ' ELSE '' END
 || CASE o_orderkey % 8 WHEN 0 THEN 'reg # 12345 ' WHEN 1 THEN 'register no: A-77 ' ELSE '' END
 || CASE o_orderkey % 9 WHEN 0 THEN 'tel 416-555-0100 fax: 416-555-0199 ' WHEN 1 THEN 'f: (905) 555 0101 ' ELSE '' END
 || CASE WHEN o_orderkey % 11 = 0 THEN 'seen 2023/01/02 2023/01/09 2023/01/16 ' ELSE '' END
 || CASE o_orderkey % 10 WHEN 0 THEN 'physiotherapy clinic receipt ' WHEN 1 THEN 'pharmacy drug prescription din rx mfr dr medication record '
      WHEN 2 THEN 'claims confirmation mailing instruction vision care expenses ' WHEN 3 THEN 'shop receipt items payments '
      WHEN 4 THEN 'explanation of benefits '
      WHEN 5 THEN 'extended health care claim 1 of 2 plan contract number plan member name plan member information plan member address spouse patient information '
      WHEN 6 THEN 'physiotherapy referral by dr. smith ' ELSE 'letter ' END"""

VISITS = """CASE o_orderkey % 12 WHEN 0 THEN 'visits jan 5 2023 jan 12 2023 sept 9 2023 pays din ' WHEN 1 THEN 'on 3 feb 2024 no charge '
      WHEN 2 THEN 'due 07/15/2023 and 02/30/2023 total pays ' WHEN 3 THEN 'seen 05-mar-24 to 19-mar-24 din din ' ELSE '' END"""

CLAIM_COLUMNS = {
    "doc_id": "o_orderkey",
    "member_id": "o_custkey",
    "batch_date": "cast(o_orderdate AS date)",
    "content": CLAIM_CONTENT,
    "handwritten_percentage": "cast((o_orderkey % 100) / 100.0 AS double)",
    "has_stamp": "o_orderkey % 13 = 0",
}
VISIT_COLUMNS = CLAIM_COLUMNS | {"content": f"{CLAIM_CONTENT} || {VISITS}"}


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ",\n ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"


CLAIM_SQL = _select(CLAIM_COLUMNS, "orders")
VISIT_SQL = _select(VISIT_COLUMNS, "orders")
CLAIM_CTE = f"WITH claim_docs AS ({CLAIM_SQL}),\n docs AS (SELECT *, lower(content) AS t FROM claim_docs)"
VISIT_CTE = f"WITH claim_docs AS ({VISIT_SQL}),\n docs AS (SELECT *, lower(content) AS t FROM claim_docs)"


def claim_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim documents written from orders; every rule has positive and negative rows."""
    return text_table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in CLAIM_COLUMNS.items()])


def visit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim documents with dates in every supported layout."""
    return text_table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in VISIT_COLUMNS.items()])


def sql_words(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_hits(text: str, words: list[str]) -> str:
    """How many of the words a text contains, in the checking engine."""
    return f"len(list_filter({sql_words(words)}, lambda w: contains({text}, w)))"
