"""Predicates of the rules as SQL functions, for queries that are written as text.

Their bodies are expressions, so a call is planned like the expression itself.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name and body of each function of a `token`.
PREDICATES = {
    "single_digit": "token RLIKE '^[0-9]$'",
    "repeated_group": r"token RLIKE r'([1-9]+)\1\1\1+'",
    "consecutive_digits": "exists(regexp_extract_all(token, '[0-9]{4}', 0), c -> contains('0123456789', c))",
    "made_up_number": "coalesce(single_digit(token) OR repeated_group(token) OR consecutive_digits(token), false)",
}


def register_predicates(spark: SparkSession) -> list[str]:
    """Create the functions in the session; their names."""
    for name, body in PREDICATES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(token STRING) RETURNS BOOLEAN RETURN {body}")
    return list(PREDICATES)
