"""Compaction, failing files, quotes, empty files, and prices adjusted for actions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gate.files import write_csv_files
from gate.plain import plain
from gate.query_checks import stage_of
from gate.query_loads import _EXTRA as LOAD_TABLES
from gate.query_loads import NOW, STAMP, _load, ticker_tasks
from gate.query_reads import ORACLES as READ_ORACLES
from gate.query_reads import gold_of
from gate.tables import oracle
from pricehouse import schemas as S
from pricehouse.fixtures import Warehouse
from pricehouse.operators import quality as Qc
from pricehouse.operators.distinct_bits import day_number, number_bits
from pricehouse.plans import marts as M
from pricehouse.plans import upkeep as U
from pricehouse.plans.gold import build_gold, current_prices
from pricehouse.plans.load import bulk_load
from pricehouse.plans.store import Store, publish, read_published, read_symbols, seed
from pricehouse.session import materialize, new_folder
from pricehouse.sources.csv_staging import stage_csv
from pricehouse.streaming.stream_load import stream_load


def _q(build):
    return lambda spark, folder: plain(build(Warehouse(spark, folder)))


# --- compaction -----------------------------------------------------------------------

_LOADS = 10


def _append_load(all_bars: DataFrame, store: Store, number: int) -> None:
    """Load ``number``: one part of the bars of the first days, at prices of its own."""
    bars = all_bars.where((F.col("price_id") % 10 <= number) & (F.dayofmonth("price_date") <= 3 * number))
    batch = store.spark.range(1).select(
        F.lit(number).alias("batch_id"), F.lit(STAMP).cast("timestamp").alias("start_time"),
        F.lit("RUNNING").alias("status"), F.lit(0).alias("event"),
    )
    store.log_batches(batch)
    store.append_raw(bars.withColumns({
        "batch_id": F.lit(number), "load_seq": F.lit(number).cast("bigint"),
        "close_price": (F.col("close_price") + number).cast("decimal(15,6)"), "row_number": F.col("price_id"),
    }).select(*store.read("price_raw").columns))
    if number != 5:  # whose run never ends
        store.log_batches(batch.select("batch_id", F.lit("SUCCESS").alias("status"), F.lit(STAMP).cast("timestamp").alias("end_time"), F.lit(1).alias("event")))


def _compacted(w: Warehouse) -> DataFrame:
    """Live bars after ten loads: ranked, from a base and later loads, and from the last base."""
    store = Store(w.spark, new_folder(w.spark, "house"))
    bars = materialize(w.price_raw(), "bars")  # every load takes a part of them
    for number in range(1, 8):
        _append_load(bars, store, number)
    store.compact()
    for number in range(8, _LOADS + 1):
        _append_load(bars, store, number)
    phases = [("ranked", current_prices(store.read("price_raw"))), ("base and loads", store.live())]
    store.compact()
    phases.append(("compacted", store.live()))
    columns = ["asset_id", "source_id", "price_date", "close_price", "load_seq", "batch_id"]
    named = [df.select(F.lit(phase).alias("phase"), *columns) for phase, df in phases]
    return reduce(DataFrame.unionByName, named)


# --- files ------------------------------------------------------------------------------


def _quoted_files(w: Warehouse) -> str:
    """A text file per source with every kind of quote; the last field of the file stays open."""
    root = new_folder(w.spark, "quotes")
    k = F.col("price_id")
    note = (
        F.when(k == F.col("last_id"), F.lit('"open')).when(k % 5 == 0, F.lit('5" x')).when(k % 5 == 1, F.lit('"a, ""b"" c"'))
        .when(k % 5 == 2, F.lit('"two\n\nlines"')).when(k % 5 == 3, F.lit("plain")).otherwise(F.lit('""'))
    )
    bars = w.price_raw().join(w.data_source().select("source_id", F.col("source_name").alias("file")), "source_id")
    ends = bars.groupBy("file").agg(F.min("price_id").alias("first_id"), F.max("price_id").alias("last_id"))
    line = F.concat_ws(",", F.col("price_date").cast("string"), note, F.col("close_price").cast("decimal(15,2)").cast("string"))
    head = F.when(k == F.col("first_id"), F.lit("Date,Note,Close\n")).otherwise(F.lit(""))
    rows = bars.join(ends, "file").select("file", k, F.concat(head, line).alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "price_id").select("file", "value").write.partitionBy("file").text(root)
    return root


def _staged_quotes(w: Warehouse) -> DataFrame:
    staged = stage_csv(w.spark, _quoted_files(w), "*.txt")
    return staged.select(F.regexp_extract("source_file", "file=([^/]*)/", 1).alias("file"), "row_number", "date_str", "close_str")


def _ticker_files(w: Warehouse) -> str:
    root = new_folder(w.spark, "tickers")
    bars = gold_of(w).select(
        "symbol", F.col("price_date").alias("Date"), F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
        F.col("low_price").alias("Low"),
        # one bar in seven has no close and is not loaded
        F.when(F.dayofyear("price_date") % 7 != 0, F.col("close_price")).alias("Close"), F.col("volume").alias("Volume"),
    ).repartition(ticker_tasks(w), "symbol").sortWithinPartitions("symbol", "Date")
    write_csv_files(bars, root, ["symbol"])
    return root


def _with_unreadable(w: Warehouse) -> DataFrame:
    """A bulk load of one file per ticker, among them one that is no compressed file as its name says."""
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    root = _ticker_files(w)
    where = w.spark._jvm.org.apache.hadoop.fs.Path(f"{root}/symbol=BROKEN/part-0.csv.gz")
    out = where.getFileSystem(w.spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(b"this is not gzip"))
    out.close()
    results = bulk_load(store, root, symbol=F.regexp_extract("source_file", "symbol=([^/]*)/", 1), pattern="*.csv*", min_score=70.0, now=NOW)
    batches = store.read("batch_meta").select(F.col("file_path").alias("of_file"), "status", F.col("error_message").isNotNull().alias("has_error"))
    left = store.read("quarantine").groupBy(F.col("source_file").alias("left_file")).agg(F.count("*").alias("quarantined"))
    joined = results.join(batches, F.col("source_file") == F.col("of_file"), "left").join(left, F.col("source_file") == F.col("left_file"), "left")
    return joined.select("symbol", "outcome", "records_loaded", "status", "has_error", F.coalesce("quarantined", F.lit(0)).alias("quarantined"))


def _load_quality(w: Warehouse) -> DataFrame:
    """The checks that a load has logged for its batches."""
    store, _ = _load(w)
    batches = store.read("batch_meta").select("batch_id", F.regexp_extract("file_path", "file=([^/]*)/", 1).alias("file"))
    return store.read("quality_log").join(batches, "batch_id").select("file", "check_name", "check_result", "score")


def _one_by_one(w: Warehouse) -> DataFrame:
    """Two files per exchange, one file a micro-batch: the first load must not hide the second file."""
    root = new_folder(w.spark, "exchanges")
    bars = gold_of(w).groupBy(F.coalesce("exchange", F.lit("NONE")).alias("exchange"), F.col("price_date").alias("Date")).agg(
        F.max("high_price").alias("High"), F.min("low_price").alias("Low"), F.max("open_price").alias("Open"),
        F.min("close_price").alias("Close"), F.sum("volume").alias("Volume"),
    ).withColumn("half", F.dayofmonth("Date") % 2)
    bars.repartition("half", "exchange").write.partitionBy("half", "exchange").csv(root, header=True)
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    stream_load(
        store, root + "/*/*", new_folder(w.spark, "stream"), refresh_batch=1,
        symbol=F.regexp_extract("source_file", "exchange=([^/]*)/", 1),
    ).awaitTermination()
    gold = read_published(w.spark, store.path("price_gold"))
    return gold.select("symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "volume")


# --- quality ----------------------------------------------------------------------------


def _all_files(w: Warehouse) -> DataFrame:
    """The files of the staged rows, and one without rows for each source."""
    none = w.data_source().select(F.concat(F.lit("/incoming/"), "source_name", F.lit("_empty.csv")).alias("source_file"))
    return stage_of(w).select("source_file").distinct().unionByName(none)


def _schemas(w: Warehouse) -> DataFrame:
    stage, files = stage_of(w), _all_files(w)
    short = stage.drop("volume_str", "open_str")
    return Qc.schema_errors(stage, files).withColumn("columns", F.lit("all")).unionByName(
        Qc.schema_errors(short, files).withColumn("columns", F.lit("six"))
    )


def _coverage(w: Warehouse) -> DataFrame:
    """Days and assets per source, from bitmaps that ten loads have kept, and of all sources."""
    store = Store(w.spark, new_folder(w.spark, "house"))
    for number in range(_LOADS):
        own = w.price_raw().where(F.col("price_id") % _LOADS == number).withColumn("load_seq", F.lit(number).cast("bigint"))
        store.log_bits(number_bits(own, {"day": day_number(F.col("price_date")), "asset": F.col("asset_id")}, ["load_seq", "source_id"]))
    return store.coverage(["source_id"]).unionByName(store.coverage().withColumn("source_id", F.lit(0)))


def _maintained(w: Warehouse) -> DataFrame:
    """The summary after batches came, one in ten failed later, and bars were replaced."""
    late = F.col("batch_id") % 10
    earlier = w.batch_meta().withColumn("status", F.when(late.isin(1, 2), F.lit("RUNNING")).when(late == 7, F.lit("SUCCESS")).otherwise(F.col("status")))
    before = build_gold(w.price_raw(), w.asset(), w.data_source(), earlier)
    after = gold_of(w)
    removed, added = U.changed_bars(before, after)
    stats = U.maintained_stats(U.asset_stats(before), removed, added, after)
    return U.summary_of(w.asset(), stats)


def _looked_up(w: Warehouse) -> DataFrame:
    """Bars of three tickers, from the published files that can hold them."""
    path = new_folder(w.spark, "gold")
    publish(w.spark, path, gold_of(w))
    tickers = ["U000000001", "U000000014-USD", "NONE"]
    return read_symbols(w.spark, path, tickers, 2024, 2024).select("symbol", "price_date", "close_price", "volume")


QUERIES = {
    # A11, G4, F1
    "coverage_by_loads": _q(_coverage),
    "asset_summary_maintained": _q(_maintained),
    "prices_looked_up": _q(_looked_up),
    # L4
    "compacted_prices": _q(_compacted),
    # I1, L5, I6, R1
    "stage_csv_quotes": _q(_staged_quotes),
    "load_with_unreadable_file": _q(_with_unreadable),
    "stream_load_one_by_one": _q(_one_by_one),
    # Q12
    "load_quality_log": _q(_load_quality),
    # Q1, Q8
    "validate_schema": _q(_schemas),
    "quality_report_empty_files": _q(lambda w: Qc.quality_report(stage_of(w), files=_all_files(w)).select(
        "source_file", "row_count", "quality_score", "duplicate_count", "duplicate_percentage", "extreme_values", "schema_valid", "schema_error")),
    # G3
    "adjusted_prices": _q(lambda w: M.adjusted_prices(
        gold_of(w), w.corporate_action(), w.dividend_cash(), w.stock_split(), w.dividend_stock())),
}

_EXTRA = {
    "all_files": """
SELECT DISTINCT source_file FROM stage UNION ALL SELECT '/incoming/' || source_name || '_empty.csv' FROM data_source""",
    "report_rows": """
SELECT *, count(*) OVER (PARTITION BY source_file, symbol, date_str) AS copies,
       lag(c) OVER (PARTITION BY source_file, symbol ORDER BY row_number) AS p,
       CASE WHEN symbol IS NULL THEN 1 ELSE 0 END + CASE WHEN date_str IS NULL THEN 1 ELSE 0 END
           + CASE WHEN close_str IS NULL THEN 1 ELSE 0 END AS missing,
       (date_str IS NULL OR d IS NOT NULL) AND (open_str IS NULL OR o IS NOT NULL) AND (high_str IS NULL OR h IS NOT NULL)
           AND (low_str IS NULL OR l IS NOT NULL) AND (close_str IS NULL OR c IS NOT NULL) AND (volume_str IS NULL OR v IS NOT NULL) AS valid,
       o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL AND NOT isnan(c) AS priced,
       COALESCE(h >= greatest(o, c) AND l <= least(o, c) AND h >= l AND o > 0 AND h > 0 AND l > 0 AND c > 0, false) AS consistent
FROM parsed""",
    "reports": """
SELECT source_file, count(*) AS row_count, count(CASE WHEN copies > 1 THEN 1 END) AS duplicate_count,
       count(CASE WHEN symbol IS NOT NULL AND CASE WHEN p = 0 THEN c <> 0 ELSE NOT isnan((c - p) / p) AND abs((c - p) / p * 100) > 50 END THEN 1 END) AS extreme_values,
       round_even(((count(*) * 3 - sum(missing)) / CAST(count(*) * 3 AS DOUBLE) * 100
         + count(CASE WHEN valid THEN 1 END) / CAST(count(*) AS DOUBLE) * 100
         + COALESCE(count(CASE WHEN priced AND consistent THEN 1 END) / CAST(nullif(count(CASE WHEN priced THEN 1 END), 0) AS DOUBLE) * 100, 0)
         + count(CASE WHEN copies = 1 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100) / 4, 2) AS quality_score
FROM report_rows GROUP BY source_file""",
}


def _o(kinds: str, sql: str) -> str:
    return oracle(kinds, sql, _EXTRA)


ORACLES = {
    "coverage_by_loads": _o("source_id:i trading_days:i earliest_date:d latest_date:d asset_count:i", """
SELECT source_id, count(DISTINCT price_date) AS trading_days, min(price_date) AS earliest_date, max(price_date) AS latest_date,
       count(DISTINCT asset_id) AS asset_count FROM price_raw GROUP BY source_id
UNION ALL SELECT 0, count(DISTINCT price_date), min(price_date), max(price_date), count(DISTINCT asset_id) FROM price_raw"""),
    "asset_summary_maintained": READ_ORACLES["asset_summary"],
    "prices_looked_up": _o("symbol:s price_date:d close_price:f volume:i", """
SELECT symbol, price_date, close_price, volume FROM price_gold WHERE symbol IN ('U000000001', 'U000000014-USD', 'NONE')"""),
    "compacted_prices": _o("phase:s asset_id:i source_id:i price_date:d close_price:f load_seq:i batch_id:i", f"""
SELECT phase, asset_id, source_id, price_date, new_close AS close_price, k AS load_seq, k AS batch_id
FROM (SELECT p.*, k, close_price + k AS new_close,
             row_number() OVER (PARTITION BY asset_id, price_date, source_id, granularity ORDER BY k DESC, price_id DESC) AS n
      FROM price_raw p, range(1, {_LOADS + 1}) t(k) WHERE price_id % 10 <= k AND day(price_date) <= 3 * k) x,
     (VALUES ('ranked'), ('base and loads'), ('compacted')) v(phase)
WHERE n = 1"""),
    "stage_csv_quotes": _o("file:s row_number:i date_str:s close_str:s", """
SELECT source_name AS "file", row_number() OVER (PARTITION BY source_name ORDER BY price_id) AS row_number,
       CAST(price_date AS VARCHAR) AS date_str,
       CASE WHEN price_id <> max(price_id) OVER (PARTITION BY source_name)
            THEN CAST(CAST(close_price AS DECIMAL(15,2)) AS VARCHAR) END AS close_str
FROM price_raw p JOIN data_source s ON p.source_id = s.source_id"""),
    "load_with_unreadable_file": _o("symbol:s outcome:s records_loaded:i status:s has_error:b quarantined:i", """
SELECT symbol, 'loaded' AS outcome, count(CASE WHEN dayofyear(price_date) % 7 <> 0 THEN 1 END) AS records_loaded,
       'SUCCESS' AS status, false AS has_error, count(CASE WHEN dayofyear(price_date) % 7 = 0 THEN 1 END) AS quarantined
FROM price_gold GROUP BY symbol
UNION ALL SELECT 'BROKEN', 'failed', 0, 'FAILED', true, 1"""),
    "load_quality_log": oracle("file:s check_name:s check_result:s score:f", """
SELECT source_file AS "file", check_name, CASE WHEN v >= 100 THEN 'PASS' WHEN v >= floor THEN 'WARN' ELSE 'FAIL' END AS check_result,
       CAST(v AS DECIMAL(5,2)) AS score
FROM file_scores, LATERAL (VALUES ('completeness', completeness, 95), ('validity', validity, 75), ('consistency', consistency, 75),
                                  ('uniqueness', uniqueness, 99)) t(check_name, v, floor)
WHERE quality_score >= 70""", LOAD_TABLES),
    "stream_load_one_by_one": _o("symbol:s price_date:d open_price:f high_price:f low_price:f close_price:f volume:i", """
SELECT COALESCE(exchange, 'NONE') AS symbol, price_date, max(open_price) AS open_price, max(high_price) AS high_price,
       min(low_price) AS low_price, min(close_price) AS close_price, sum(volume) AS volume
FROM price_gold GROUP BY 1, 2"""),
    "validate_schema": _o("source_file:s schema_error:s columns:s", f"""
SELECT f.source_file, CASE WHEN s.source_file IS NULL THEN 'DataFrame is empty' END AS schema_error, 'all' AS "columns"
FROM all_files f LEFT JOIN (SELECT DISTINCT source_file FROM stage) s ON f.source_file = s.source_file
UNION ALL SELECT source_file, 'Missing required columns: [''open_str'', ''volume_str'']', 'six' FROM all_files"""),
    "quality_report_empty_files": _o(
        "source_file:s row_count:i quality_score:f duplicate_count:i duplicate_percentage:f extreme_values:i schema_valid:b schema_error:s", """
SELECT f.source_file, COALESCE(row_count, 0) AS row_count, COALESCE(quality_score, 0) AS quality_score,
       COALESCE(duplicate_count, 0) AS duplicate_count,
       round(COALESCE(duplicate_count * CAST(100 AS DOUBLE) / row_count, 0), 6) AS duplicate_percentage,
       COALESCE(extreme_values, 0) AS extreme_values, r.source_file IS NOT NULL AS schema_valid,
       CASE WHEN r.source_file IS NULL THEN 'DataFrame is empty' END AS schema_error
FROM all_files f LEFT JOIN reports r ON f.source_file = r.source_file"""),
    "adjusted_prices": _o(
        "asset_id:i symbol:s price_date:d close:f day_factor:f adjust_factor:f adjusted_close:f total_return:f wealth:f", """
WITH RECURSIVE details AS (
    SELECT a.asset_id, a.ex_date AS d, COALESCE(CAST(c.dividend_amount AS DOUBLE), 0) AS cash,
           CASE WHEN s.action_id IS NOT NULL THEN CAST(s.split_ratio_to AS DOUBLE) / s.split_ratio_from
                WHEN k.action_id IS NOT NULL THEN 1 + CAST(k.dividend_ratio AS DOUBLE) ELSE 1 END AS shares
    FROM corporate_action a LEFT JOIN dividend_cash c ON a.action_id = c.action_id
    LEFT JOIN stock_split s ON a.action_id = s.action_id LEFT JOIN dividend_stock k ON a.action_id = k.action_id),
acts AS (SELECT asset_id, d, sum(cash) AS cash, product(shares) AS shares FROM details GROUP BY asset_id, d),
days AS (
    SELECT COALESCE(g.asset_id, x.asset_id) AS asset_id, COALESCE(g.price_date, x.d) AS d, g.symbol,
           CAST(g.close_price AS DOUBLE) AS close, COALESCE(cash, 0) AS cash, COALESCE(shares, 1) AS shares
    FROM price_gold g FULL JOIN acts x ON g.asset_id = x.asset_id AND g.price_date = x.d),
ord AS (
    SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY d DESC) AS i,
           last_value(close IGNORE NULLS) OVER (PARTITION BY asset_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lc
    FROM days),
fac AS (
    SELECT *, CASE WHEN lc IS NULL THEN 1 ELSE CASE WHEN cash < lc THEN 1 - cash / lc ELSE 1 END / shares END AS f FROM ord),
run AS (
    SELECT asset_id, i, CAST(1 AS DOUBLE) AS g, f FROM fac WHERE i = 1
    UNION ALL SELECT n.asset_id, n.i, r.g * r.f, n.f FROM run r JOIN fac n ON n.asset_id = r.asset_id AND n.i = r.i + 1),
adj AS (
    SELECT fac.asset_id, symbol, d AS price_date, close, fac.f AS day_factor, g AS adjust_factor, close * g AS adjusted_close
    FROM fac JOIN run ON fac.asset_id = run.asset_id AND fac.i = run.i WHERE close IS NOT NULL)
SELECT asset_id, symbol, price_date, round(close, 6) AS close, round(day_factor, 6) AS day_factor,
       round(adjust_factor, 6) AS adjust_factor, round(adjusted_close, 6) AS adjusted_close,
       round(adjusted_close / lag(adjusted_close) OVER w - 1, 6) AS total_return,
       round(adjusted_close / first_value(adjusted_close) OVER w, 6) AS wealth
FROM adj WINDOW w AS (PARTITION BY asset_id ORDER BY price_date)"""),
}
