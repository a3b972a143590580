"""Marts on top of gold: total return, asset and quality summaries, changes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse.plans.queries import in_years


def price_total_return(
    gold: DataFrame, corporate_action: DataFrame, dividend_cash: DataFrame, stock_split: DataFrame
) -> DataFrame:
    """Gold bars with the day's dividend and split factor.

    Actions are joined to their details first (small tables), then to gold on
    (asset, ex-date). Several actions on one day give several rows. The total
    return price is the adjusted close.
    """
    actions = corporate_action.select("action_id", "asset_id", "action_type", "ex_date")
    cash = dividend_cash.select("action_id", "dividend_amount")
    split = stock_split.select("action_id", "split_ratio_from", "split_ratio_to")
    detail = (
        actions.join(
            cash.withColumn("action_type", F.lit("DIVIDEND_CASH")), ["action_id", "action_type"], "left"
        )
        .join(
            split.withColumn("action_type", F.lit("STOCK_SPLIT")), ["action_id", "action_type"], "left"
        )
        .withColumnRenamed("ex_date", "price_date")
        .drop("action_id", "action_type")
    )
    bars = gold.select("asset_id", "symbol", "price_date", "close_price", "adj_close_price")
    factor = F.when(
        F.col("split_ratio_to").isNotNull(), F.col("split_ratio_to") / F.col("split_ratio_from")
    ).otherwise(F.lit(1.0))
    return bars.join(detail, ["asset_id", "price_date"], "left").select(
        "asset_id", "symbol", "price_date", "close_price", "adj_close_price",
        F.coalesce("dividend_amount", F.lit(0).cast("decimal(10,4)")).alias("dividend_amount"),
        factor.alias("split_factor"),
        F.col("adj_close_price").alias("total_return_price"),
    )


def asset_summary(asset: DataFrame, gold: DataFrame) -> DataFrame:
    """Trading statistics per active asset; assets without bars count zero days.

    Bars are reduced to one row per asset before the join, so the join sees two
    inputs of the size of the asset table whatever the number of bars.
    """
    close = F.col("close_price").cast("double")
    stats = gold.groupBy("asset_id").agg(
        F.count("price_date").alias("trading_days"),
        F.min("price_date").alias("first_date"),
        F.max("price_date").alias("last_date"),
        F.avg(close).alias("avg_price"),
        F.min("low_price").alias("min_price"),
        F.max("high_price").alias("max_price"),
        F.avg("volume").alias("avg_volume"),
        F.stddev_samp(close).alias("price_volatility"),
    )
    described = asset.where("is_active").select(
        "asset_id", "symbol", "asset_type", "currency", "exchange", "company_name"
    )
    return described.join(stats, "asset_id", "left").withColumn(
        "trading_days", F.coalesce("trading_days", F.lit(0).cast("bigint"))
    )


def data_quality_summary(batch_meta: DataFrame, data_source: DataFrame) -> DataFrame:
    """Batches by source and month, newest month first."""
    per_source = batch_meta.groupBy("source_id", F.date_trunc("month", "start_time").alias("month")).agg(
        F.count("*").alias("total_batches"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_batches"),
        F.count_if(F.col("status") == "FAILED").alias("failed_batches"),
        F.sum(F.col("quality_score").cast("double")).alias("score_sum"),
        F.count("quality_score").alias("scored"),
        F.sum("row_count").alias("row_sum"),
    )
    names = data_source.select("source_id", "source_name")
    return (
        per_source.join(names, "source_id")
        .groupBy("source_name", "month")
        .agg(
            F.sum("total_batches").alias("total_batches"),
            F.sum("successful_batches").alias("successful_batches"),
            F.sum("failed_batches").alias("failed_batches"),
            F.try_divide(F.sum("score_sum"), F.sum("scored")).alias("avg_quality_score"),
            F.sum("row_sum").alias("total_rows_processed"),
        )
        .orderBy(F.desc("month"), "source_name")
    )


def recent_price_changes(gold: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """Close-to-close changes in the last ``days`` days before ``as_of``.

    The window is cut first, so the first bar of an asset inside it has no
    predecessor and is left out. Gold holds one bar per asset and day, hence a
    window group never exceeds the number of days kept.
    """
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    by_asset = Window.partitionBy("asset_id").orderBy("price_date")
    kept = gold.where((F.col("price_date") >= start) & in_years(gold, start)).select(
        "asset_id", "symbol", "asset_type", "price_date", "close_price",
        F.lag("close_price").over(by_asset).alias("prev_close"),
    )
    change = F.col("close_price") - F.col("prev_close")
    return (
        kept.where("prev_close is not null")
        .select(
            "symbol", "asset_type", "price_date", "close_price", "prev_close",
            F.round(F.try_divide(change, F.col("prev_close")) * 100, 2).alias("pct_change"),
            change.alias("price_change"),
        )
        .orderBy(F.desc("price_date"), "symbol")
    )


def day_factors(
    corporate_action: DataFrame, dividend_cash: DataFrame, stock_split: DataFrame, dividend_stock: DataFrame
) -> DataFrame:
    """(asset_id, price_date, cash, shares): all actions of a day in one row.

    ``cash`` is what a share held before is paid, ``shares`` what it has become: splits and stock
    dividends of one day multiply, cash dividends add up.
    """
    actions = corporate_action.select("action_id", "asset_id", F.col("ex_date").alias("price_date"))
    cash = dividend_cash.select("action_id", F.col("dividend_amount").cast("double").alias("cash"), F.lit(1.0).alias("shares"))
    split = stock_split.select(
        "action_id", F.lit(0.0).alias("cash"),
        F.try_divide(F.col("split_ratio_to").cast("double"), F.col("split_ratio_from")).alias("shares"),
    )
    stock = dividend_stock.select("action_id", F.lit(0.0).alias("cash"), (1.0 + F.col("dividend_ratio").cast("double")).alias("shares"))
    detail = cash.unionByName(split).unionByName(stock).where("cash > 0 or (shares > 0 and shares <> 1)")
    return actions.join(detail, "action_id").groupBy("asset_id", "price_date").agg(
        F.sum("cash").alias("cash"), F.product("shares").alias("shares")
    )


def _ratio(value: Column, base: Column) -> Column:
    """``value / base`` of doubles where a ``base`` of 0 gives infinity, and NaN for 0 to 0."""
    of_zero = F.when(value > 0, F.lit(float("inf"))).when(value < 0, F.lit(float("-inf"))).when(value == 0, F.lit(float("nan")))
    return F.when(base == 0, of_zero).otherwise(F.try_divide(value, base))


def adjusted_prices(
    gold: DataFrame, corporate_action: DataFrame, dividend_cash: DataFrame, stock_split: DataFrame, dividend_stock: DataFrame
) -> DataFrame:
    """Gold bars adjusted back for later splits and dividends, and their total returns.

    ``adjust_factor`` is the product of the factors of all ex-dates after the bar: a split or stock
    dividend divides by the shares it makes, a cash dividend takes its part of the last close
    before it. ``adjusted_close`` is the close times that; ``total_return`` is its change
    against the bar before, NULL for an asset's first bar; ``wealth`` is what one unit put in at
    the first bar has become. A change from a close of 0 is infinite, from 0 to 0 NaN. Actions
    without an earlier bar, and dividends of the last close or more, change nothing.

    Actions are reduced to a row a day, and bars and ex-dates are merged in the order of
    days: a running last close, and a running product from the newest day backwards. So no bar
    is compared with a range of actions; an asset's window is bounded by its days.
    """
    bars = gold.select("asset_id", "symbol", "price_date", F.col("close_price").cast("double").alias("close"))
    days = day_factors(corporate_action, dividend_cash, stock_split, dividend_stock)
    merged = bars.unionByName(days, allowMissingColumns=True).groupBy("asset_id", "price_date").agg(
        F.max("symbol").alias("symbol"), F.max("close").alias("close"), F.max("cash").alias("cash"), F.max("shares").alias("shares")
    )
    forward = Window.partitionBy("asset_id").orderBy("price_date")
    backward = Window.partitionBy("asset_id").orderBy(F.desc("price_date"))
    last = F.last("close", ignorenulls=True).over(forward.rowsBetween(Window.unboundedPreceding, -1))
    paid = F.when(F.col("cash") < F.col("last_close"), 1.0 - F.col("cash") / F.col("last_close")).otherwise(1.0)
    factor = F.when(F.col("last_close").isNull(), 1.0).otherwise(paid / F.coalesce("shares", F.lit(1.0)))
    placed = merged.withColumn("last_close", last).withColumn("day_factor", factor).withColumn(
        "adjust_factor",
        F.coalesce(F.product("day_factor").over(backward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0)),
    ).where("close is not null")
    adjusted = placed.withColumn("adjusted_close", F.col("close") * F.col("adjust_factor"))
    first = F.first("adjusted_close").over(forward.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return adjusted.select(
        "asset_id", "symbol", "price_date", "close", "day_factor", "adjust_factor", "adjusted_close",
        (_ratio(F.col("adjusted_close"), F.lag("adjusted_close").over(forward)) - 1).alias("total_return"),
        _ratio(F.col("adjusted_close"), first).alias("wealth"),
    )
