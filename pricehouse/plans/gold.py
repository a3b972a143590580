"""The gold table: one trusted daily bar per asset and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricehouse import schemas as S


def _newest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row per key.

    The ``= 1`` filter lets Spark keep only each task's best row per key before
    the shuffle, so a key that holds a large share of the rows stays cheap.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def _current_order() -> list:
    """Of several bars of a key, the live one comes first."""
    return [F.desc("load_seq"), F.desc("batch_id"), F.desc("row_number"), F.desc("price_id")]


def _gold_order() -> list:
    """Of several bars of an asset and day, the one that gold has comes first."""
    return [F.desc("start_time"), F.desc("created_at"), F.desc("price_id")]


def current_prices(price_raw: DataFrame) -> DataFrame:
    """The live version of an append-only raw table.

    A bar replaces the earlier bar with the same asset, date, source and
    granularity: the latest load wins, and inside a load the last input row.
    """
    return _newest(price_raw, S.PRICE_KEY, _current_order())


def live_prices(base: DataFrame, deltas: DataFrame) -> DataFrame:
    """Live bars of a base with one bar a key, and of loads it does not hold.

    Only the loads' bars, and those of the base that share a key with them, are ranked: a load that
    was folded early may be newer than one that is not. When the keys are few, Spark
    broadcasts them and the base is not shuffled.
    """
    newest = current_prices(deltas).select(*base.columns)
    keys = newest.select(*S.PRICE_KEY)
    rivals = base.join(keys, S.PRICE_KEY, "left_semi").select(*base.columns)
    others = base.join(keys, S.PRICE_KEY, "left_anti").select(*base.columns)
    return others.unionByName(current_prices(rivals.unionByName(newest)))


def build_gold(
    price_raw: DataFrame, asset: DataFrame, data_source: DataFrame, batch_meta: DataFrame
) -> DataFrame:
    """Daily bars of active assets from successful batches, newest batch first.

    ``price_raw`` holds current bars only (see :func:`current_prices`). The
    dimensions enter in two steps: ids decide which bars count before the
    shuffle, descriptive columns are joined to the surviving bars only, so the
    one wide exchange carries no repeated names.
    """
    best = _newest(_counting(price_raw, asset, data_source, batch_meta), ["asset_id", "price_date"], _gold_order())
    return best.join(_names(asset), "asset_id").select(*S.GOLD_COLUMNS)


def _counting(price_raw: DataFrame, asset: DataFrame, data_source: DataFrame, batch_meta: DataFrame) -> DataFrame:
    """The bars that may reach gold, with what ranks them."""
    active = asset.where("is_active").select("asset_id")
    good = batch_meta.where("status = 'SUCCESS'").select("batch_id", "start_time")
    sources = data_source.select("source_id", "source_name")
    return (
        price_raw.where("granularity = 'DAILY'")
        .join(good, "batch_id")
        .join(active, "asset_id", "left_semi")
        .join(sources, "source_id")
    )


def _names(asset: DataFrame) -> DataFrame:
    return asset.where("is_active").select(
        "asset_id", "symbol", "asset_type", "currency", "exchange", "company_name"
    )


def gold_history(
    price_raw: DataFrame, asset: DataFrame, data_source: DataFrame, batch_meta: DataFrame, first: int, last: int
) -> DataFrame:
    """Every row that gold has after one of the loads ``first`` to ``last``, each row once.

    A row is in gold after the loads from ``from_load`` up to, and without, ``until_load``; NULL
    is no end. So gold after load ``n`` is ``from_load <= n and (until_load is null or until_load > n)``, and
    equals :func:`build_gold` of the current bars without those of the loads after ``n``. Bars of other
    loads are there from the first on. ``batch_meta`` has the state after the last load.
    """
    own = F.col("load_seq").between(first, last)
    placed = price_raw.withColumn("_start", F.when(own, F.col("load_seq")).otherwise(F.lit(first)).cast("bigint"))
    # One shuffle serves all windows: each of their keys holds asset and day.
    dealt = placed.where("granularity = 'DAILY'").repartition("asset_id", "price_date")
    # A bar is current from its load on, until a bar that goes before it is there.
    ends = F.min("_start").over(
        Window.partitionBy(*S.PRICE_KEY).orderBy(*_current_order()).rowsBetween(Window.unboundedPreceding, -1)
    )
    current = dealt.withColumn("_end", ends).where("_end is null or _end > _start")

    bars = _counting(current, asset, data_source, batch_meta)
    day = Window.partitionBy("asset_id", "price_date")
    changes = F.array_sort(F.array_union(F.collect_set("_start").over(day), F.collect_set("_end").over(day)))
    known = bars.withColumn("_changes", changes)
    during = F.filter("_changes", lambda n: (n >= F.col("_start")) & (F.col("_end").isNull() | (n < F.col("_end"))))
    at = known.withColumn("from_load", F.explode(during))
    best = _newest(at, ["asset_id", "price_date", "from_load"], _gold_order())
    later = F.get(F.filter("_changes", lambda n: n > F.col("from_load")), F.lit(0))
    return best.withColumn("until_load", later).join(_names(asset), "asset_id").select(*S.GOLD_COLUMNS, "from_load", "until_load")
