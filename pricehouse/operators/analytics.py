"""Return, volatility and outlier series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.operators.joins import null_safe_join
from pricehouse.operators.quantiles import exact_quantiles


def daily_returns(
    df: DataFrame, by: Sequence[str], day: str = "price_date", price: str = "close_price"
) -> DataFrame:
    """Simple returns against the last known price; the first of a series is dropped.

    A missing price counts as unchanged. A move from zero is infinite, zero to
    zero has no return. A series has one row per day, which bounds its window.
    """
    value = df.select(*by, day, F.col(price).cast("double").alias("_p"))
    value = value.withColumn("_p", F.when(~F.isnan("_p"), F.col("_p")))
    before = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    seen = value.withColumn("_prev", F.last("_p", ignorenulls=True).over(before))
    now, prev = F.coalesce("_p", "_prev"), F.col("_prev")
    change = F.when(prev != 0, now / F.when(prev != 0, prev) - 1).when(
        now != 0, F.when(now > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    )
    return (
        seen.where("_prev is not null")
        .select(*by, day, change.alias("daily_return"))
        .where("daily_return is not null")
    )


def volatility(returns: DataFrame, by: Sequence[str], annualize: bool = True) -> DataFrame:
    """Sample deviation of returns per series, 0 for fewer than two."""
    spread = F.stddev_samp("daily_return")
    if annualize:
        spread = spread * F.sqrt(F.lit(float(S.TRADING_DAYS_PER_YEAR)))
    return returns.groupBy(*by).agg(
        F.when(F.count("*") < 2, F.lit(0.0)).otherwise(spread).alias("volatility")
    )


def detect_outliers(
    df: DataFrame, value: str, by: Sequence[str] = (), method: str = "iqr", threshold: float = 1.5
) -> DataFrame:
    """Add ``is_outlier`` by interquartile range or z-score, strict inequality.

    Values that are missing or NaN, and groups whose bounds are (as with infinite
    quartiles), have no outliers.
    """
    by = list(by)
    v = F.col(value).cast("double")
    if method == "iqr":
        stats = exact_quantiles(df, by, value, {"_q1": 0.25, "_q3": 0.75})
        spread = (F.col("_q3") - F.col("_q1")) * threshold
        stats = stats.select(*by, (F.col("_q1") - spread).alias("_low"), (F.col("_q3") + spread).alias("_high"))
    elif method == "zscore":
        clean = F.when(~F.isnan(v), v)
        around = df.groupBy(*by).agg(F.avg(clean).alias("_mean"), F.stddev_samp(clean).alias("_sd"))
        stats = around.where("_sd > 0").select(*by, "_mean", (F.col("_sd") * threshold).alias("_far"))
    else:
        raise ValueError(f"no such outlier method: {method}")
    names = [c for c in stats.columns if c not in by]
    if by:
        judged = null_safe_join(df, stats, by)
    else:  # one row at most: scalar subqueries
        judged = df.withColumns({n: stats.agg(F.max(n)).scalar() for n in names})
    if method == "iqr":
        flag = ((v < F.col("_low")) & ~F.isnan("_low")) | ((v > F.col("_high")) & ~F.isnan("_high"))
    else:
        flag = (F.abs(v - F.col("_mean")) > F.col("_far")) & ~F.isnan("_far") & ~F.isnan("_mean")
    return judged.withColumn("is_outlier", F.coalesce(flag & ~F.isnan(v), F.lit(False))).drop(*names)
