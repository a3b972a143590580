"""Exchange lists: overlaps, priority mapping, matching, updating, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse import schemas as S


def symbol_overlaps(lists: DataFrame) -> DataFrame:
    """The exchanges each symbol is listed on, sorted, and how many."""
    per_symbol = lists.groupBy("symbol").agg(F.sort_array(F.collect_set("exchange")).alias("exchanges"))
    return per_symbol.withColumn("exchange_count", F.size("exchanges"))


def overlap_histogram(lists: DataFrame) -> DataFrame:
    """Number of symbols by number of exchanges."""
    return symbol_overlaps(lists).groupBy("exchange_count").agg(F.count("*").alias("symbols"))


def list_sizes(lists: DataFrame) -> DataFrame:
    return lists.groupBy("exchange").agg(F.countDistinct("symbol").alias("symbols"))


def priority_mapping(lists: DataFrame, order: Sequence[str] = S.EXCHANGE_PRIORITY) -> DataFrame:
    """One exchange per symbol: the first of ``order`` that lists it."""
    rank = F.array_position(F.array(*[F.lit(e) for e in order]), F.col("exchange"))
    ranked = lists.withColumn("_rank", rank).where("_rank > 0")
    return ranked.groupBy("symbol").agg(F.min_by("exchange", "_rank").alias("exchange"))


def stock_symbols(asset: DataFrame) -> DataFrame:
    """Distinct symbols of active stocks."""
    return asset.where("asset_type = 'STOCK' and is_active").select("symbol").distinct()


def match_symbols(mapping: DataFrame, asset: DataFrame) -> DataFrame:
    """Every symbol of the mapping or of the active stocks, with its ``side``.

    ``matched`` is in both, ``mapping_only`` and ``stock_only`` in one.
    """
    stocks = stock_symbols(asset).withColumn("_stock", F.lit(True))
    listed = mapping.select("symbol", "exchange", F.lit(True).alias("_listed"))
    both = listed.join(stocks, "symbol", "full_outer")
    side = (
        F.when(F.col("_stock") & F.col("_listed"), F.lit("matched"))
        .when(F.col("_listed"), F.lit("mapping_only"))
        .otherwise(F.lit("stock_only"))
    )
    return both.select("symbol", "exchange", side.alias("side"))


def unmapped_symbols(asset: DataFrame, mapping: DataFrame) -> DataFrame:
    """Active stocks no exchange lists."""
    return stock_symbols(asset).join(mapping.select("symbol"), "symbol", "left_anti")


def apply_exchanges(asset: DataFrame, mapping: DataFrame, now: Column | None = None) -> DataFrame:
    """Stocks get their mapped exchange where it is missing or different.

    ``updated_at`` moves only on rows that change.
    """
    listed = mapping.select("symbol", F.col("exchange").alias("_new"))
    change = (
        (F.col("asset_type") == "STOCK")
        & F.col("_new").isNotNull()
        & ~F.col("exchange").eqNullSafe(F.col("_new"))
    )
    stamp = now if now is not None else F.current_timestamp()
    return (
        asset.join(listed, "symbol", "left")
        .withColumn("updated_at", F.when(change, stamp).otherwise(F.col("updated_at")))
        .withColumn("exchange", F.when(change, F.col("_new")).otherwise(F.col("exchange")))
        .select(*asset.columns)
    )


def update_stats(before: DataFrame, mapping: DataFrame) -> DataFrame:
    """Updated and skipped symbols, and updated per active stock symbol in percent."""
    held = before.where("asset_type = 'STOCK'").select("symbol", F.col("exchange").alias("_held"))
    per_symbol = (
        match_symbols(mapping, before)
        .join(held, "symbol", "left")
        .groupBy("symbol", "side")
        .agg(F.bool_or(~F.col("_held").eqNullSafe(F.col("exchange"))).alias("changed"))
    )
    matched = F.col("side") == "matched"
    return per_symbol.agg(
        F.count_if(matched).alias("total_symbols"),
        F.count_if(matched & F.col("changed")).alias("updated"),
        F.count_if(matched & ~F.col("changed")).alias("skipped"),
        F.count_if(F.col("side") != "mapping_only").alias("stock_symbols"),
    ).withColumn(
        "coverage_pct", F.coalesce(F.try_divide(F.col("updated") * 100.0, F.col("stock_symbols")), F.lit(0.0))
    )


def exchange_distribution(
    asset: DataFrame, asset_type: str = "STOCK", active_only: bool = False
) -> DataFrame:
    """Assets per exchange, largest first; missing exchanges count as ``NULL``."""
    kept = asset.where("is_active") if active_only else asset
    return (
        kept.where(F.col("asset_type") == asset_type)
        .groupBy(F.coalesce("exchange", F.lit("NULL")).alias("exchange"))
        .agg(F.count("*").alias("symbol_count"))
        .orderBy(F.desc("symbol_count"), "exchange")
    )
