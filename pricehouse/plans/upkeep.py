"""Upkeep of the asset summary: statistics follow the bars that changed, not all bars.

Counts and sums (exact decimals) take the removed bars out and the added ones in. Minima, maxima and
first and last dates follow added bars directly; only assets that lost a bar which held one of
them are looked up in gold again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = {
    "bars": "bigint", "close_sum": "decimal(38,6)", "close_squares": "decimal(38,12)", "volume_sum": "decimal(38,0)", "volumes": "bigint",
}
_WATCHED = ["close_price", "low_price", "high_price", "volume"]


def _sums(sign: int) -> list[Column]:
    close = F.col("close_price")
    parts = {
        "bars": F.count("*"), "close_sum": F.sum(close), "close_squares": F.sum((close * close).cast("decimal(31,12)")),
        "volume_sum": F.sum(F.col("volume").cast("decimal(20,0)")), "volumes": F.count("volume"),
    }
    return [(F.coalesce(parts[n], F.lit(0)) * sign).cast(kind).alias(n) for n, kind in _SUMS.items()]


def _extremes() -> list[Column]:
    return [
        F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date"),
        F.min("low_price").alias("min_price"), F.max("high_price").alias("max_price"),
    ]


def asset_stats(gold: DataFrame) -> DataFrame:
    """One row per asset: counts, exact sums and extremes of its bars."""
    return gold.groupBy("asset_id").agg(*_sums(1), *_extremes())


def changed_bars(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars that went and bars that came, between two states of the same years of gold.

    A bar whose watched values differ is in both. One shuffle by (asset, day).
    """
    columns = ["asset_id", "price_date", *_WATCHED]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("asset_id", "price_date", F.struct(*columns).alias(name))

    pairs = side(before, "old").join(side(after, "new"), ["asset_id", "price_date"], "full")
    differ = pairs.where(~F.col("old").eqNullSafe(F.col("new")))
    return differ.where("old is not null").select("old.*"), differ.where("new is not null").select("new.*")


def maintained_stats(stats: DataFrame, removed: DataFrame, added: DataFrame, gold: DataFrame) -> DataFrame:
    """``asset_stats`` of ``gold``, from those before, and the bars that changed since.

    ``gold`` is read for assets that lost an extreme only.
    """
    names = ["first_date", "last_date", "min_price", "max_price"]
    change = removed.groupBy("asset_id").agg(*_sums(-1)).unionByName(added.groupBy("asset_id").agg(*_sums(1)))
    totals = stats.select("asset_id", *_SUMS).unionByName(change).groupBy("asset_id").agg(
        *[F.sum(n).cast(kind).alias(n) for n, kind in _SUMS.items()]
    ).where("bars > 0")
    gone = removed.groupBy("asset_id").agg(*_extremes())
    held = stats.select("asset_id", *[F.col(n).alias(f"was_{n}") for n in names])
    lost = gone.join(held, "asset_id").where(" or ".join(f"{n} = was_{n}" for n in names)).select("asset_id")
    again = gold.join(lost, "asset_id", "left_semi").groupBy("asset_id").agg(*_extremes())
    kept = stats.select("asset_id", *names).join(lost, "asset_id", "left_anti")
    met = kept.unionByName(again).unionByName(added.groupBy("asset_id").agg(*_extremes()))
    extremes = met.groupBy("asset_id").agg(*[
        (F.min(n) if n in ("first_date", "min_price") else F.max(n)).alias(n) for n in names
    ])
    return totals.join(extremes, "asset_id").select(*stats.columns)


def summary_of(asset: DataFrame, stats: DataFrame) -> DataFrame:
    """The asset summary mart (see ``marts.asset_summary``) from kept statistics."""
    n, total = F.col("bars").cast("double"), F.col("close_sum").cast("double")
    spread = F.greatest(F.col("close_squares").cast("double") - total * total / n, F.lit(0.0))
    shown = stats.select(
        "asset_id", F.col("bars").alias("trading_days"), "first_date", "last_date", (total / n).alias("avg_price"),
        "min_price", "max_price", F.try_divide(F.col("volume_sum").cast("double"), F.col("volumes")).alias("avg_volume"),
        F.when(F.col("bars") > 1, F.sqrt(spread / (n - 1))).alias("price_volatility"),
    )
    described = asset.where("is_active").select("asset_id", "symbol", "asset_type", "currency", "exchange", "company_name")
    return described.join(shown, "asset_id", "left").withColumn("trading_days", F.coalesce("trading_days", F.lit(0).cast("bigint")))


def changed_years(before: Sequence[tuple[int, str]], after: Sequence[tuple[int, str]]) -> list[int]:
    """Years whose stored folder differs between two versions of gold."""
    old, new = dict(before), dict(after)
    return sorted(y for y in old.keys() | new.keys() if old.get(y) != new.get(y))
