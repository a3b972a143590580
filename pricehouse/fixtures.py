"""Warehouse tables derived from the tables at hand.

``events`` is read as a stream of price ticks: a user is an asset, an event
type is a data source, a day of one source is a batch. ``lineitem`` joined to
``supplier`` and ``nation`` gives a second, longer price history. Every table is
a lazy DataFrame over the whole input, so its work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_IDS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}


def _case(c: Column, pairs: dict, default=None) -> Column:
    out = None
    for key, value in pairs.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def _price(c: Column) -> Column:
    return c.cast("decimal(15,6)")


class Warehouse:
    """All warehouse tables of one input folder, each built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """An input table; its schema is looked up once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def ticks(self) -> DataFrame:
        source = _case(F.col("event_type"), SOURCE_IDS)
        day = F.to_date("ts")
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            day.alias("day"),
            "user_id",
            "event_type",
            "value",
            (F.col("user_id") + 1).cast("int").alias("asset_id"),
            source.alias("source_id"),
            (source * 1000000 + F.datediff(day, F.lit("1970-01-01").cast("date"))).cast("int").alias("batch_id"),
        )

    def data_source(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select("event_type").distinct().select(
            _case(kind, SOURCE_IDS).cast("int").alias("source_id"),
            F.upper(kind).alias("source_name"),
            _case(kind, {"click": "API", "view": "API", "error": "MANUAL"}, "FILE").alias("source_type"),
            F.concat(F.lit("https://prices.example/"), kind).alias("base_url"),
            kind.isin("click", "view").alias("api_key_required"),
            _case(kind, {"click": 60, "view": 1000}).cast("int").alias("rate_limit_per_minute"),
            (kind != "error").alias("is_active"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
        )

    @staticmethod
    def symbol(user_id: Column) -> Column:
        base = F.concat(F.lit("U"), F.lpad(user_id.cast("string"), 9, "0"))
        return F.when(user_id % 5 == 4, F.concat(base, F.lit("-USD"))).otherwise(base)

    @staticmethod
    def asset_type(user_id: Column) -> Column:
        return _case(user_id % 5, {3: "ETF", 4: "CRYPTO"}, "STOCK")

    def asset(self) -> DataFrame:
        u = F.col("user_id")
        exchange = _case(u % 7, {0: "NASDAQ", 1: "NASDAQ", 2: "NYSE", 3: "AMEX", 4: "TSX"})
        seen = self.table("events").groupBy("user_id").agg(
            F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
        )
        return seen.select(
            (u + 1).cast("int").alias("asset_id"),
            self.symbol(u).alias("symbol"),
            self.asset_type(u).alias("asset_type"),
            F.when(u % 7 == 4, F.lit("CAD")).otherwise(F.lit("USD")).alias("currency"),
            exchange.alias("exchange"),
            F.when(u % 4 != 0, F.concat(F.lit("Company "), u.cast("string"))).alias("company_name"),
            _case(u % 3, {0: "Technology", 1: "Energy"}).alias("sector"),
            F.lit(None).cast("string").alias("industry"),
            (u * 1000000).cast("bigint").alias("market_cap"),
            (u % 11 != 0).alias("is_active"),
            F.col("first_ts").cast("timestamp").alias("created_at"),
            F.col("last_ts").cast("timestamp").alias("updated_at"),
        )

    def _bars(self, ticks: DataFrame, keys: list[str]) -> DataFrame:
        """Open/high/low/close bars; partial aggregation before the shuffle."""
        first = F.min(F.struct("ts", "event_id", "value")).alias("first_tick")
        last = F.max(F.struct("ts", "event_id", "value")).alias("last_tick")
        return ticks.groupBy(*keys).agg(
            first, last,
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.count("*").alias("volume"),
            F.min("event_id").alias("price_id"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        )

    def price_raw(self) -> DataFrame:
        bars = self._bars(self.ticks(), ["asset_id", "source_id", "batch_id", "day"])
        adjusted = F.col("first_tick.value") * 0.5 + F.col("last_tick.value") * 0.5
        return bars.select(
            "price_id", "asset_id", "batch_id", "source_id",
            F.col("day").alias("price_date"),
            F.lit("DAILY").alias("granularity"),
            _price(F.col("first_tick.value")).alias("open_price"),
            _price(F.col("high")).alias("high_price"),
            _price(F.col("low")).alias("low_price"),
            _price(F.col("last_tick.value")).alias("close_price"),
            "volume",
            F.when(F.col("source_id") != 2, _price(adjusted)).alias("adj_close_price"),
            F.col("last_tick.ts").alias("created_at"),
        )

    def price_raw_intraday(self) -> DataFrame:
        ticks = self.ticks().withColumn("hour", F.date_trunc("hour", "ts"))
        bars = self._bars(ticks, ["asset_id", "source_id", "batch_id", "hour"])
        return bars.select(
            "price_id", "asset_id", "batch_id", "source_id",
            F.col("hour").alias("price_datetime"),
            F.lit("HOUR1").alias("granularity"),
            _price(F.col("first_tick.value")).alias("open_price"),
            _price(F.col("high")).alias("high_price"),
            _price(F.col("low")).alias("low_price"),
            _price(F.col("last_tick.value")).alias("close_price"),
            "volume",
            F.col("volume").cast("int").alias("trade_count"),
            _price(F.round(F.col("cents") / (F.col("volume") * 100.0), 6)).alias("vwap"),
            F.col("last_tick.ts").alias("created_at"),
        )

    def batch_meta(self) -> DataFrame:
        b = F.col("batch_id")
        status = _case(b % 10, {7: "FAILED", 3: "PARTIAL", 9: "RUNNING"}, "SUCCESS")
        days = self.ticks().groupBy("source_id", "batch_id", "event_type", "day").agg(
            F.min("ts").alias("start_time"),
            F.max("ts").alias("last_ts"),
            F.count("*").cast("int").alias("row_count"),
        )
        return days.select(
            "batch_id", "source_id",
            F.concat(F.upper("event_type"), F.lit("_"), F.date_format("day", "yyyyMMdd")).alias("batch_name"),
            F.concat(F.lit("/incoming/"), "event_type", F.lit("_"), F.col("day").cast("string"), F.lit(".csv")).alias("file_path"),
            (F.col("row_count") * 64).cast("bigint").alias("file_size_bytes"),
            "row_count", "start_time",
            F.when(status != "RUNNING", F.col("last_ts")).alias("end_time"),
            status.alias("status"),
            F.when(status == "FAILED", F.lit("load failed")).alias("error_message"),
            (F.lit(60) + b % 41).cast("decimal(5,2)").alias("quality_score"),
        )

    def corporate_action(self) -> DataFrame:
        kind = (
            F.when(F.col("event_type") == "signup", F.lit("DIVIDEND_CASH"))
            .when((F.col("event_type") == "error") & (F.col("value") > 100), F.lit("STOCK_SPLIT"))
            .when((F.col("event_type") == "purchase") & (F.col("value") > 200), F.lit("DIVIDEND_STOCK"))
        )
        return self.ticks().withColumn("action_type", kind).where("action_type is not null").select(
            F.col("event_id").cast("int").alias("action_id"),
            "asset_id", "action_type",
            F.col("day").alias("ex_date"),
            F.when(F.col("value") > 150, F.date_sub("day", 1)).otherwise(F.date_add("day", 2)).alias("record_date"),
            F.date_add("day", 30).alias("payment_date"),
            "source_id", "batch_id", "value",
        )

    def dividend_cash(self) -> DataFrame:
        return self.corporate_action().where("action_type = 'DIVIDEND_CASH'").select(
            "action_id",
            (F.round(F.col("value") * 100) / 10000).cast("decimal(10,4)").alias("dividend_amount"),
            F.lit("USD").alias("currency"),
        )

    def stock_split(self) -> DataFrame:
        return self.corporate_action().where("action_type = 'STOCK_SPLIT'").select(
            "action_id",
            (F.col("action_id") % 2 + 1).cast("int").alias("split_ratio_from"),
            (F.col("action_id") % 3 + 2).cast("int").alias("split_ratio_to"),
        )

    def dividend_stock(self) -> DataFrame:
        return self.corporate_action().where("action_type = 'DIVIDEND_STOCK'").select(
            "action_id",
            (F.round(F.col("value") * 100) / 100000).cast("decimal(8,6)").alias("dividend_ratio"),
        )

    def stage_raw_prices(self) -> DataFrame:
        """The daily bars as text, with defects keyed on ``price_id``."""
        k = F.col("price_id")
        bars = self.price_raw().join(
            self.data_source().select("source_id", "source_name"), "source_id"
        )

        def text(name: str) -> Column:
            return F.col(name).cast("decimal(15,2)").cast("string")

        swapped = k % 41 == 0
        user = F.col("asset_id").cast("bigint") - 1
        rows = bars.select(
            F.when(k % 61 != 0, self.symbol(user)).alias("symbol"),
            F.when(k % 29 == 0, F.lit("2024/13/45"))
            .when(k % 59 == 0, F.date_format("price_date", "M/d/yyyy"))
            .otherwise(F.col("price_date").cast("string")).alias("date_str"),
            F.when(k % 37 == 0, F.lit("N/A")).otherwise(text("open_price")).alias("open_str"),
            F.when(swapped, text("low_price")).otherwise(text("high_price")).alias("high_str"),
            F.when(swapped, text("high_price")).otherwise(text("low_price")).alias("low_str"),
            F.when(k % 31 == 0, F.lit("abc"))
            .when(k % 43 == 0, F.concat(F.lit("-"), text("close_price")))
            .when(k % 71 == 0, F.lit("1e2"))
            .when(k % 73 == 0, F.lit("inf"))
            .when(k % 79 == 0, F.lit("nan"))
            .when(k % 83 == 0, F.lit(""))
            .otherwise(text("close_price")).alias("close_str"),
            F.when(k % 47 == 0, F.lit("0")).when(k % 53 == 0, F.lit("x1"))
            .otherwise(F.concat(F.col("volume").cast("string"), F.lit(".7"))).alias("volume_str"),
            F.coalesce(text("adj_close_price"), F.lit("null")).alias("adj_close_str"),
            F.concat(F.lit("/incoming/"), F.col("source_name"), F.lit("_w"),
                     F.floor((F.dayofmonth("price_date") - 1) / 7).cast("string"), F.lit(".csv")).alias("source_file"),
            k.alias("_k"),
            F.explode(F.when(k % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
        )
        return rows.withColumn("row_number", F.col("_k") * 2 + F.col("_copy") + 1).drop("_k", "_copy")

    def exchange_lists(self) -> DataFrame:
        """(exchange, symbol) with overlaps: a list takes one kind of event or two, without a quarter of the users, so lists differ."""
        exchange = _case(
            F.col("event_type"),
            {"signup": "NYSE", "purchase": "NASDAQ", "view": "AMEX", "click": "TSX", "error": "TSX"},
        )
        symbol = self.symbol(F.col("user_id"))
        left_out = _case(F.col("event_type"), {"signup": 0, "purchase": 1, "view": 2, "click": 3, "error": 3})
        listed = self.table("events").where(F.col("user_id") % 4 != left_out)
        return listed.select(exchange.alias("exchange"), symbol.alias("symbol")).distinct()

    # --- longer history: suppliers as assets, line items as trades ----------

    def history_asset(self) -> DataFrame:
        nation = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("exchange")
        )
        return self.table("supplier").join(nation, "s_nationkey").select(
            (F.col("s_suppkey") + 1).cast("int").alias("asset_id"),
            F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("symbol"),
            F.lit("STOCK").alias("asset_type"),
            F.lit("USD").alias("currency"),
            "exchange",
            F.col("s_name").alias("company_name"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    def history_source(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.table("lineitem").select("l_returnflag").distinct().select(
            _case(flag, {"A": 1, "N": 2, "R": 3}).cast("int").alias("source_id"),
            F.concat(F.lit("FLAG_"), flag).alias("source_name"),
        )

    def _trades(self) -> DataFrame:
        source = _case(F.col("l_returnflag"), {"A": 1, "N": 2, "R": 3})
        day = F.to_date("l_shipdate")
        month = F.year(day) * 12 + F.month(day)
        return self.table("lineitem").select(
            (F.col("l_suppkey") + 1).cast("int").alias("asset_id"),
            source.cast("int").alias("source_id"),
            (source * 100000 + month).cast("int").alias("batch_id"),
            day.alias("price_date"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("trade_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
        )

    def history_price_raw(self) -> DataFrame:
        bars = self._trades().groupBy("asset_id", "source_id", "batch_id", "price_date").agg(
            F.min(F.struct("trade_id", "price")).alias("first_trade"),
            F.max(F.struct("trade_id", "price")).alias("last_trade"),
            F.max("price").alias("high"), F.min("price").alias("low"),
            F.sum(F.col("quantity").cast("bigint")).alias("volume"),
        )
        created = F.col("price_date").cast("timestamp")
        return bars.select(
            F.col("first_trade.trade_id").alias("price_id"),
            "asset_id", "batch_id", "source_id", "price_date",
            F.lit("DAILY").alias("granularity"),
            _price(F.col("first_trade.price")).alias("open_price"),
            _price(F.col("high")).alias("high_price"),
            _price(F.col("low")).alias("low_price"),
            _price(F.col("last_trade.price")).alias("close_price"),
            "volume",
            _price(F.col("last_trade.price")).alias("adj_close_price"),
            created.alias("created_at"),
        )

    def history_batch_meta(self) -> DataFrame:
        months = self._trades().groupBy("batch_id", "source_id").agg(
            F.min("price_date").alias("first_day"), F.count("*").cast("int").alias("row_count")
        )
        return months.select(
            "batch_id", "source_id", "row_count",
            F.col("first_day").cast("timestamp").alias("start_time"),
            _case(F.col("batch_id") % 10, {7: "FAILED"}, "SUCCESS").alias("status"),
        )
