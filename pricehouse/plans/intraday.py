"""Intraday bars: monthly partitions and pruned reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("price_month", F.date_format("price_datetime", "yyyy_MM"))


def write_intraday(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write bars into one folder per month, created as needed.

    Bars are sorted by asset and time inside a file. Spark sizes the partitions by
    what it measures, so a crowded month is spread over as many tasks as it needs.
    """
    order = ["price_month", "asset_id", "price_datetime"]
    (
        with_month(df).hint("rebalance", "price_month", "asset_id").sortWithinPartitions(*order)
        .write.mode(mode).partitionBy("price_month").parquet(path)
    )


def read_intraday(
    spark: SparkSession, path: str, start: datetime | str, end: datetime | str,
    asset_ids: Sequence[int] | None = None,
) -> DataFrame:
    """Bars with ``start <= price_datetime < end``, reading only their months."""
    first, last = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    bars = spark.read.parquet(path).where(
        F.col("price_month").between(F.date_format(first, "yyyy_MM"), F.date_format(last, "yyyy_MM"))
        & (F.col("price_datetime") >= first)
        & (F.col("price_datetime") < last)
    )
    return bars.where(F.col("asset_id").isin(list(asset_ids))) if asset_ids is not None else bars
