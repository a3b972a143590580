"""Table rules as queries for their violations.

As with SQL checks, a rule that evaluates to NULL is satisfied.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.functions.parsing import compute_once, to_finite, to_price


def violations(df: DataFrame, rule: Column) -> DataFrame:
    return df.where(~F.coalesce(rule, F.lit(True)))


def ohlc_rule() -> Column:
    o, h, lo, c = (F.col(f"{n}_price") for n in ("open", "high", "low", "close"))
    return (h >= o) & (h >= c) & (lo <= o) & (lo <= c) & (h >= lo) & (o > 0) & (h > 0) & (lo > 0) & (c > 0)


def check_ohlc(df: DataFrame) -> DataFrame:
    """Bars whose high or low does not enclose open and close, or not positive."""
    return violations(df, ohlc_rule())


def check_intraday(df: DataFrame) -> DataFrame:
    """The daily price rule, and an intraday granularity."""
    return violations(df, ohlc_rule() & F.col("granularity").isin(S.INTRADAY_GRANULARITIES))


def check_action_dates(df: DataFrame) -> DataFrame:
    """Record and payment dates, where given, not before the ex-date."""
    ex = F.col("ex_date")
    return violations(
        df,
        ex.isNotNull()
        & (F.col("record_date").isNull() | (F.col("record_date") >= ex))
        & (F.col("payment_date").isNull() | (F.col("payment_date") >= ex)),
    )


def check_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return violations(df, reduce(lambda a, b: a & b, [F.col(c) > 0 for c in columns]))


def check_domain(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return violations(df, F.col(column).isin(list(values)))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count.

    Keys holding a NULL never clash, as in a SQL unique constraint.
    """
    given = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    return df.where(given).groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_reference(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent; a NULL key needs none."""
    parents = parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull())
    return child.where(F.col(key).isNotNull()).join(parents, key, "left_anti").select(*child.columns)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def check_limits(stage: DataFrame, max_length: int = S.MAX_SYMBOL_LENGTH) -> DataFrame:
    """Staged rows with text over the column width, or prices over decimal(15,6)."""
    texts = [*S.PRICE_STRINGS, "adj_close_str"]
    fits = {f"_fits_{c}": to_finite(c).isNull() | to_price(c).isNotNull() for c in texts}
    short = [F.coalesce(F.length(c) <= max_length, F.lit(True)) for c in S.STAGE_COLUMNS]
    rule = reduce(lambda a, b: a & b, [*short, *[F.coalesce(name, F.lit(True)) for name in fits]])
    return violations(compute_once(stage, fits), rule).select(*stage.columns)
