"""Consecutive ids without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKS = 1024


def number_rows(df: DataFrame, keys: Sequence[str], name: str, start: Column | int = 0) -> DataFrame:
    """Add ``name``: ``start + 1, start + 2, ...``, one number per distinct row.

    Rows fall into a fixed number of chunks by key hash; chunk sizes give each
    chunk its offset. The offset table has at most ``CHUNKS`` rows, which is why
    it may be broadcast. ``keys`` must identify a row; the same rows get the same
    numbers on every run.
    """
    chunked = df.withColumn("_chunk", F.pmod(F.xxhash64(*keys), F.lit(CHUNKS)))
    sizes = chunked.groupBy("_chunk").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(*keys))
    first = F.lit(start) if isinstance(start, int) else start
    return (
        chunked.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_chunk")
        .withColumn(name, first + F.col("_offset") + F.col("_inside"))
        .drop("_chunk", "_inside", "_offset")
    )
