"""The query surface: prices, lookups, latest bars, summaries, health."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse import schemas as S

PRICE_COLUMNS = [
    "symbol", "price_date", "open_price", "high_price", "low_price", "close_price",
    "volume", "adj_close_price", "asset_type", "currency", "exchange",
]


def _day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def _in_symbols(symbols: Sequence[str]) -> Column:
    return F.col("symbol").isin([s.upper() for s in symbols])


def in_years(table: DataFrame, start: Column, end: Column | None = None) -> Column:
    """The years a date range touches, where the table is split by year."""
    if "price_year" not in table.columns:
        return F.lit(True)
    late_enough = F.col("price_year") >= F.year(start)
    return late_enough if end is None else late_enough & (F.col("price_year") <= F.year(end))


def prices(gold: DataFrame, tickers: Sequence[str], start: date | str, end: date | str) -> DataFrame:
    """Daily bars of some tickers in a closed date range, by ticker and date."""
    if not tickers:
        return gold.select(*PRICE_COLUMNS).limit(0)
    first, last = _day(start), _day(end)
    return (
        gold.where(_in_symbols(tickers) & F.col("price_date").between(first, last) & in_years(gold, first, last))
        .select(*PRICE_COLUMNS)
        .orderBy("symbol", "price_date")
    )


def total_return(gold: DataFrame, ticker: str, start: date | str, end: date | str) -> DataFrame:
    """The adjusted close of one ticker as its total-return series."""
    return prices(gold, [ticker], start, end).select("price_date", "adj_close_price")


def available_symbols(
    asset: DataFrame, asset_type: str | None = None, exchange: str | None = None
) -> DataFrame:
    kept = asset.where("is_active")
    if asset_type:
        kept = kept.where(F.col("asset_type") == asset_type)
    if exchange:
        kept = kept.where(F.col("exchange") == exchange)
    return kept.select("symbol").distinct().orderBy("symbol")


def asset_info(asset: DataFrame, symbol: str, asset_type: str | None = None) -> DataFrame:
    """One asset by symbol (12 columns), or by exact symbol and type (8 columns)."""
    if asset_type is None:
        return asset.where(F.col("symbol") == symbol.upper()).select(
            "asset_id", "symbol", "asset_type", "currency", "exchange", "company_name",
            "sector", "industry", "market_cap", "is_active", "created_at", "updated_at",
        )
    return asset.where((F.col("symbol") == symbol) & (F.col("asset_type") == asset_type)).select(
        "asset_id", "symbol", "asset_type", "currency", "exchange", "company_name",
        "sector", "is_active",
    )


def active_sources(data_source: DataFrame) -> DataFrame:
    return data_source.where("is_active").select("source_name", "source_id")


def source_id(data_source: DataFrame, name: str) -> int:
    """Id of an active source; an unknown or inactive name is an error."""
    row = active_sources(data_source).where(F.col("source_name") == name).first()
    if row is None:
        raise ValueError(f"no active source is named {name!r}")
    return row["source_id"]


def list_sources(data_source: DataFrame) -> DataFrame:
    return data_source.select(
        "source_name", "source_type", "is_active", "rate_limit_per_minute", "api_key_required"
    ).orderBy("source_type", "source_name")


def recent_batches(batch_meta: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` batches started last."""
    return (
        batch_meta.orderBy(F.desc("start_time"), F.desc("batch_id"))
        .limit(n)
        .select("batch_name", "status", "quality_score", "row_count", "start_time")
    )


LATEST_COLUMNS = ["symbol", "price_date", "close_price", "volume", "asset_type", "exchange"]


def latest_prices(
    gold: DataFrame, symbols: Sequence[str] | None = None, limit: int | None = 100, by: str = "symbol"
) -> DataFrame:
    """The newest bar per symbol (or per ``asset_id``), one row each.

    One aggregate, combined before the shuffle; the table is read once.
    """
    kept = gold.where(_in_symbols(symbols)) if symbols else gold
    bar = F.struct("price_date", "asset_id", *[c for c in LATEST_COLUMNS if c != "price_date"])
    newest = kept.where(F.col(by).isNotNull()).groupBy(by).agg(F.max(bar).alias("bar"))
    rows = newest.select(*[F.col(f"bar.{c}").alias(c) for c in LATEST_COLUMNS]).orderBy("symbol")
    return rows.limit(limit) if limit is not None else rows


def latest_prices_join(
    gold: DataFrame, symbols: Sequence[str] | None = None, limit: int | None = 100
) -> DataFrame:
    """All bars on each symbol's newest date; assets sharing a symbol all show."""
    rows = _on_latest_day(gold, symbols, "symbol").select("asset_id", *LATEST_COLUMNS)
    rows = rows.orderBy("symbol", "asset_id")
    return (rows.limit(limit) if limit is not None else rows).drop("asset_id")


def _on_latest_day(gold: DataFrame, symbols: Sequence[str] | None, by: str) -> DataFrame:
    """Bars of each key's newest date.

    The dates come from a hash aggregate over two columns; the wide rows are then
    filtered by them instead of being sorted or shuffled as a whole.
    """
    kept = gold.where(_in_symbols(symbols)) if symbols else gold
    newest = kept.groupBy(by).agg(F.max("price_date").alias("price_date"))
    return kept.join(newest, [by, "price_date"], "left_semi")


def top_latest(
    gold: DataFrame, n: int, exchange: str | None = None, symbol: str | None = None
) -> DataFrame:
    """The ``n`` newest bars of an exchange or symbol."""
    kept = gold
    if exchange:
        kept = kept.where(F.col("exchange") == exchange)
    if symbol:
        kept = kept.where(F.col("symbol") == symbol)
    return (
        kept.orderBy(F.desc("price_date"), "symbol", "asset_id")
        .limit(n)
        .select("symbol", "price_date", "close_price", "volume", "exchange")
    )


def price_summary(gold: DataFrame, symbol: str, days: int = 30, as_of: date | str | None = None) -> DataFrame:
    """Statistics of one symbol over the last ``days`` days, and its latest close.

    One pass: the date limit sits inside the aggregates because the latest close
    looks at all dates. No row comes back when the window is empty.
    """
    if not isinstance(days, int) or days < 1 or days > 365:
        raise ValueError("days: a whole number from 1 to 365")
    today = _day(as_of) if as_of else F.current_date()
    bars = gold.where(F.col("symbol") == symbol.upper())
    recent = F.col("price_date") >= F.date_sub(today, days)

    def only(name: str) -> Column:
        return F.when(recent, F.col(name))

    close = only("close_price").cast("double")
    return (
        bars.groupBy("symbol")
        .agg(
            F.count_if(recent).alias("trading_days"),
            F.min(only("low_price")).cast("double").alias("min_price"),
            F.max(only("high_price")).cast("double").alias("max_price"),
            F.avg(close).alias("avg_price"),
            F.stddev_samp(close).alias("price_volatility"),
            F.avg(only("volume")).cast("bigint").alias("avg_volume"),
            F.min(only("price_date")).alias("start_date"),
            F.max(only("price_date")).alias("end_date"),
            F.max_by("close_price", F.struct("price_date", "asset_id")).cast("double").alias("latest_price"),
        )
        .where("trading_days > 0")
        .withColumn("analysis_days", F.lit(days))
    )


def date_range(gold: DataFrame, symbol: str | None = None) -> DataFrame:
    kept = gold.where(F.col("symbol") == symbol.upper()) if symbol else gold
    return kept.agg(F.min("price_date").alias("min_date"), F.max("price_date").alias("max_date"))


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, date range and distinct symbols of a price table."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.min("price_date").alias("min_date"),
        F.max("price_date").alias("max_date"),
        F.countDistinct("symbol").alias("symbol_count"),
    )


def coverage(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.min("price_date").alias("earliest_date"),
        F.max("price_date").alias("latest_date"),
        F.countDistinct("price_date").alias("trading_days"),
    )


def freshness(raw: DataFrame, gold: DataFrame, max_age_hours: float = S.MAX_GOLD_AGE_HOURS) -> DataFrame:
    """Hours gold lags behind raw, and whether that is acceptable.

    Both maxima come from one aggregate over a tagged union.
    """
    stamps = raw.select("created_at", F.lit(True).alias("is_raw")).unionByName(
        gold.select("created_at", F.lit(False).alias("is_raw"))
    )
    latest = stamps.agg(
        F.max(F.when(F.col("is_raw"), F.col("created_at"))).alias("latest_raw"),
        F.max(F.when(~F.col("is_raw"), F.col("created_at"))).alias("latest_gold"),
    )
    lag = (F.unix_micros("latest_raw") - F.unix_micros("latest_gold")) / F.lit(3600e6)
    return latest.withColumn("hours_behind", lag).withColumn(
        "is_fresh", F.coalesce(F.col("hours_behind") <= max_age_hours, F.lit(False))
    )


def warehouse_counts(
    asset: DataFrame, price_raw: DataFrame, batch_meta: DataFrame, gold: DataFrame
) -> DataFrame:
    """Row counts and the latest gold date, in one row."""

    def tagged(df: DataFrame, name: str, day: Column) -> DataFrame:
        return df.select(F.lit(name).alias("name"), day.cast("date").alias("day"))

    nothing = F.lit(None)
    rows = (
        tagged(asset, "asset", nothing)
        .unionByName(tagged(price_raw, "price", nothing))
        .unionByName(tagged(batch_meta, "batch", nothing))
        .unionByName(tagged(gold, "gold", F.col("price_date")))
    )
    return rows.agg(
        F.count_if(F.col("name") == "asset").alias("asset_count"),
        F.count_if(F.col("name") == "price").alias("price_count"),
        F.count_if(F.col("name") == "batch").alias("batch_count"),
        F.max("day").alias("latest_date"),
    )


def prices_by_asset_type(gold: DataFrame, asset: DataFrame) -> DataFrame:
    """Bars per asset type, counted per asset before the join."""
    per_asset = gold.groupBy("asset_id").agg(F.count("*").alias("bars"))
    return (
        per_asset.join(asset.select("asset_id", "asset_type"), "asset_id")
        .groupBy("asset_type")
        .agg(F.sum("bars").alias("price_records"))
    )
