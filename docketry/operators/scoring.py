"""Features, weighted score, risk level and the profiles read from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions import fixed_values as V


def payment_bands(
    df: DataFrame, bands: Sequence[int] = (200, 400, 500), amount: str = "payment_amount", inclusive: bool = False
) -> DataFrame:
    """payment_above_N per band; an unknown amount is above nothing."""
    a = F.col(amount)
    over = {f"payment_above_{b}": F.coalesce(a >= b if inclusive else a > b, F.lit(False)) for b in bands}
    return df.withColumns(over)


def gate_address(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """invalid_addr counts only where handwriting does not explain it."""
    gated = (F.col("handwritten_percentage") <= threshold) & F.col("has_invalid_addr")
    return df.withColumn("invalid_addr", F.coalesce(gated, F.lit(False)))


def flags_to_int(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.col(f).cast("int") for f in flags})


def interactions(df: DataFrame, flag_bands: Mapping[str, str] = V.FLAG_BANDS, keep: Sequence[str] = ()) -> DataFrame:
    """Split each 0/1 flag by its amount band into flag&payment_below and flag&payment_above."""
    below = [(F.col(f) * (1 - F.col(b))).alias(f"{f}&payment_below") for f, b in flag_bands.items()]
    above = [(F.col(f) * F.col(b)).alias(f"{f}&payment_above") for f, b in flag_bands.items()]
    return df.select(*keep, *below, *above)


def weighted_score(
    df: DataFrame, weights: Mapping[str, float] = V.SCORE_WEIGHTS, into: str = "risk_score", digits: int = 6
) -> DataFrame:
    """Sum of weight times flag, weights bound by name."""
    terms = [F.col(f"`{name}`") * F.lit(w) for name, w in weights.items()]
    return df.withColumn(into, F.round(reduce(lambda a, b: a + b, terms), digits))


def risk_level(
    scored: DataFrame, score: str = "risk_score", exact: bool = True, min_score: float | None = None
) -> DataFrame:
    """Level by the 99th and 95th percentile of all scores.

    The cut-offs are a scalar subquery, so one row and no join reaches the big side. The
    exact percentile keeps one counter per distinct score, of which weighted flags allow
    few thousand; ``exact=False`` uses the sketch for free-valued scores.
    """
    s = F.col(score)
    cut = F.percentile if exact else F.percentile_approx
    quantiles = scored.agg(F.struct(cut(s, F.lit(0.99)).alias("must"), cut(s, F.lit(0.95)).alias("should")).alias("q"))
    at_least = lambda name: (s >= F.col("_cuts")[name]) & (
        F.lit(True) if min_score is None else s >= min_score
    )
    return (
        scored.withColumn("_cuts", quantiles.scalar())
        .withColumn(
            "risk_level",
            F.when(at_least("must"), "Must Investigate")
            .when(at_least("should"), "Should Investigate")
            .otherwise("Not Suspicious"),
        )
        .drop("_cuts")
    )


def rank_top_n(df: DataFrame, by: str, key: str, n: int = 50) -> DataFrame:
    """The n highest rows; the key breaks ties."""
    return df.orderBy(F.desc(by), F.asc(key)).limit(n)


def high_payment(df: DataFrame, amount: str = "payment_amount", over: float = 300) -> DataFrame:
    return df.filter(F.col(amount) > over)


def flag_profile(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, value, n) for every flag, from one pass."""
    sums = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(f"`{f}`").cast("bigint")).alias(f"_s{i}") for i, f in enumerate(flags)]
    )
    rows = []
    for i, f in enumerate(flags):
        rows.append(F.struct(F.lit(f).alias("flag"), F.lit(1).alias("value"), F.col(f"_s{i}").alias("n")))
        rows.append(F.struct(F.lit(f).alias("flag"), F.lit(0).alias("value"), (F.col("_n") - F.col(f"_s{i}")).alias("n")))
    return sums.select(F.inline(F.array(*rows)))


def flag_correlation(df: DataFrame, flags: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of 0/1 columns, as (flag_a, flag_b, corr).

    Counts of single flags and of pairs are whole numbers from one aggregate; the matrix is
    laid out afterwards from that single row. A constant flag has no correlation (null).
    """
    c = lambda f: F.col(f"`{f}`").cast("bigint")
    pairs = [(i, j) for i in range(len(flags)) for j in range(i, len(flags))]
    one = df.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(c(f)).cast("double").alias(f"s{i}") for i, f in enumerate(flags)],
        *[F.sum(c(flags[i]) * c(flags[j])).cast("double").alias(f"p{i}_{j}") for i, j in pairs],
    )

    def corr(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        n, a, b = F.col("n"), F.col(f"s{i}"), F.col(f"s{j}")
        spread = (n * a - a * a) * (n * b - b * b)
        return F.when(spread > 0, F.round((n * F.col(f"p{i}_{j}") - a * b) / F.sqrt(spread), digits))

    cells = [
        F.struct(F.lit(a).alias("flag_a"), F.lit(b).alias("flag_b"), corr(i, j).alias("corr"))
        for i, a in enumerate(flags)
        for j, b in enumerate(flags)
    ]
    return one.select(F.inline(F.array(*cells)))
