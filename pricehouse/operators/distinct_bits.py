"""Exact distinct counts that are kept per load and merged: bitmaps of day numbers and ids.

A row of bits covers a bucket of 32,768 numbers; bits of several loads are merged by OR, so
what loads have in common counts once. A second load reads its own rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_number(day: Column) -> Column:
    """Days since 1970-01-01, negative before."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint")


def number_bits(rows: DataFrame, kinds: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by..., kind, bucket, bits, least, most): which numbers occur, per kind.

    Combined before the shuffle; a group is one row for each bucket of numbers. NULLs count nothing.
    """
    by = list(by)

    def one(kind: str, number: Column) -> DataFrame:
        named = rows.select(*by, number.cast("bigint").alias("number")).where("number is not null")
        return named.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"), F.min("number").alias("least"), F.max("number").alias("most")
        ).select(*by, F.lit(kind).alias("kind"), "bucket", "bits", "least", "most")

    return reduce(DataFrame.unionByName, [one(k, c) for k, c in kinds.items()])


def merged_bits(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bits of all loads as one row for each group, kind and bucket."""
    return bits.groupBy(*by, "kind", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def distinct_counts(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., kind, numbers, least, most) of merged bits."""
    return merged_bits(bits, by).groupBy(*by, "kind").agg(
        F.sum(F.bitmap_count("bits")).alias("numbers"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def coverage_of(bits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., trading_days, earliest_date, latest_date, asset_count) from bits of kinds day and asset."""
    counts = distinct_counts(bits, by)

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    start = F.lit("1970-01-01").cast("date")
    return counts.groupBy(*by).agg(
        of("day", "numbers").alias("trading_days"),
        F.date_add(start, of("day", "least").cast("int")).alias("earliest_date"),
        F.date_add(start, of("day", "most").cast("int")).alias("latest_date"),
        of("asset", "numbers").alias("asset_count"),
    )
