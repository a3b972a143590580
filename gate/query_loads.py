"""Loading, upserts, files and streams.

Queries that need files write them from the given tables into the work folder
first, then run the library on those files.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from gate.files import write_csv_files
from gate.plain import plain
from gate.query_checks import stage_of
from gate.query_reads import gold_of
from gate.tables import oracle
from pricehouse import schemas as S
from pricehouse.fixtures import Warehouse
from pricehouse.functions import parsing as P
from pricehouse.operators import loading as L
from pricehouse.operators.numbering import number_rows
from pricehouse.plans import intraday as I
from pricehouse.plans.exchange_update import update_exchanges
from pricehouse.plans.gold import build_gold, current_prices
from pricehouse.plans.load import bulk_load, load, retry_failed, validate_only
from pricehouse.plans.store import Store, publish, read_published, refresh_all, seed
from pricehouse.plans import marts as M
from pricehouse.session import new_folder
from pricehouse.sources import lists as Li
from pricehouse.sources.csv_staging import list_files, stage_csv, standardize_columns
from pricehouse.streaming.stream_load import stream_load

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
STAMP = "2024-02-01 00:00:00"


def _q(build):
    return lambda spark, folder: plain(build(Warehouse(spark, folder)))


def _stamp():
    return F.lit(STAMP).cast("timestamp")


# --- halves: what the warehouse holds, and what arrives ----------------------------


def _held_assets(w):
    """Two thirds of the assets count as stored."""
    return w.asset().where("asset_id % 3 <> 0")


def _incoming_assets(w):
    """Assets of large ticks arrive, some with new descriptions."""
    big = w.ticks().where("value > 100").select("asset_id").distinct()
    named = w.asset().join(big, "asset_id", "left_semi")
    return named.select(
        "symbol", "asset_type", "currency",
        F.when(F.col("sector") == "Energy", F.concat(F.lit("Renamed "), "symbol")).alias("company_name"),
        F.when(F.col("sector").isNull(), F.lit("Other")).alias("sector"),
        F.when(F.col("exchange").isNull(), F.lit("OTC")).alias("exchange"),
    )


def _loads(w):
    """Two overlapping loads: the month up to the 20th, then from the 10th on."""
    raw = w.price_raw().withColumn("row_number", F.col("price_id"))
    first = raw.where("price_date <= date '2024-01-20'").withColumn("load_seq", F.lit(1))
    second = raw.where("price_date >= date '2024-01-10'").withColumns({
        "load_seq": F.lit(2),
        "close_price": F.col("high_price"),
        "created_at": _stamp(),
    })
    # within a load the last input row wins
    again = second.where("volume > 1").withColumns({
        "row_number": F.col("row_number") + 1, "close_price": F.col("low_price")
    })
    return first, second.unionByName(again)


def _files(w):
    """One price file per asset, named after its ticker."""
    return w.asset().select(
        F.concat(F.lit("/incoming/"), F.lower("symbol"), F.lit(".csv")).alias("source_file"),
        F.upper("symbol").alias("symbol"),
    )


def _results(w):
    """Per-batch outcomes of a load run."""
    outcome = {"SUCCESS": "loaded", "FAILED": "failed"}
    text = F.lit("skipped")
    for status, name in outcome.items():
        text = F.when(F.col("status") == status, F.lit(name)).otherwise(text)
    return w.batch_meta().select(
        F.col("file_path").alias("source_file"), F.split("batch_name", "_")[0].alias("symbol"),
        text.alias("outcome"), F.col("error_message").alias("message"),
        F.when(F.col("status") == "SUCCESS", F.col("row_count")).otherwise(0).cast("bigint").alias("records_loaded"),
        "quality_score",
    )


def _upserted(w):
    out = L.upsert_assets(_held_assets(w), _incoming_assets(w), _stamp())
    return out.select("symbol", "asset_type", "currency", "exchange", "company_name", "sector", "is_active", "updated_at")


def _assigned_ids(w):
    held = _held_assets(w)
    out = L.upsert_assets(held, _incoming_assets(w), _stamp())
    top = held.agg(F.max("asset_id")).scalar()
    new = out.where(F.col("asset_id") > top)
    return new.agg(
        F.count("*").alias("new_assets"), F.countDistinct("asset_id").alias("ids"),
        (F.min("asset_id") - F.max(top)).alias("first"), (F.max("asset_id") - F.max(top)).alias("last"),
    )


def _number_rows(w):
    rows = number_rows(w.ticks().select("event_id", "ts"), ["event_id"], "n", 10)
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("n").alias("numbers"), F.min("n").alias("first"), F.max("n").alias("last"))


def _made_batches(w):
    scores = _results(w).where("outcome = 'loaded'").select(
        "source_file", (F.col("records_loaded") * 64).alias("file_size_bytes"),
        F.col("records_loaded").alias("row_count"), "quality_score",
    )
    held = w.batch_meta().where("status = 'FAILED'")
    made = L.make_batches(held, scores, 3, _stamp())
    return made.select(
        "source_id", "batch_name", "file_path", "file_size_bytes", "row_count", "start_time", "status", "quality_score"
    )


def _finished(w):
    ended = w.batch_meta().where("status = 'RUNNING'").select(
        "batch_id",
        F.when(F.col("row_count") > 10, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"),
        F.when(F.col("row_count") <= 10, F.lit("too few rows")).alias("error_message"),
        F.when(F.col("row_count") > 10, F.col("row_count") - 1).alias("row_count"),
    )
    return L.finish_batches(w.batch_meta(), ended, _stamp()).select(
        "batch_id", "status", "end_time", "error_message", "row_count"
    )


# --- files ------------------------------------------------------------------------

_LAYOUTS = {
    "CLICK": {"Date": "date_str", "Open": "open_str", "High": "high_str", "Low": "low_str",
              "Close": "close_str", "Volume": "volume_str", "Symbol": "symbol", "Adj Close": "adj_close_str"},
    "VIEW": {"ticker": "symbol", "vol": "volume_str", "price": "close_str", "low": "low_str",
             "high": "high_str", "open": "open_str", "trade_date": "date_str", "note": "source_file"},
    "": {" SYMBOL": "symbol", "Timestamp ": "date_str", "close": "close_str", "open": "open_str",
         "low": "low_str", "high": "high_str", "adjclose": "adj_close_str"},
}


def _write_stage_files(w):
    """The staged rows as CSV files, one per source and week, in three layouts."""
    root = new_folder(w.spark, "csv")
    rows = w.stage_raw_prices().withColumn("file", F.regexp_extract("source_file", "([^/]*)[.]csv$", 1))
    named = [n for n in _LAYOUTS if n]
    for source, layout in _LAYOUTS.items():
        of = F.col("file").startswith(source + "_") if source else ~F.col("file").rlike("^(" + "|".join(named) + ")_")
        (
            rows.where(of).repartition("file").sortWithinPartitions("file", "row_number")
            .select("file", *[F.col(c).alias(title) for title, c in layout.items()])
            .write.mode("append").partitionBy("file").csv(root, header=True, emptyValue="")
        )
    return root


def _file_name():
    return F.regexp_extract("source_file", "file=([^/]*)/", 1)


def _staged(w):
    out = stage_csv(w.spark, _write_stage_files(w))
    return out.withColumn("source_file", _file_name())


def _load(w):
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    results = load(
        store, _write_stage_files(w), "MANUAL_CSV", several_symbols="rows", min_score=70.0, now=NOW
    )
    return store, results


def _loaded_files(w):
    _, results = _load(w)
    return results.select(_file_name().alias("file"), "outcome", "records_loaded", "quality_score")


def _loaded_gold(w):
    store, _ = _load(w)
    gold = read_published(w.spark, store.path("price_gold"))
    return gold.select("symbol", "asset_type", "price_date", "source_name")


#: Ticker files that one task writes: small files cost by their number, not by their bytes.
_FILES_PER_TASK = 128


def ticker_tasks(w, files_each=1):
    """Tasks for writing ``files_each`` files per ticker. A given number; Spark's own goes by bytes."""
    return 1 + w.asset().count() * files_each // _FILES_PER_TASK


def _write_gold_files(w):
    """Gold bars as one CSV file per ticker."""
    root = new_folder(w.spark, "tickers")
    bars = gold_of(w).repartition(ticker_tasks(w), "symbol").sortWithinPartitions("symbol", "price_date").select(
        "symbol", F.col("price_date").alias("Date"), F.col("open_price").alias("Open"),
        F.col("high_price").alias("High"), F.col("low_price").alias("Low"),
        F.col("close_price").alias("Close"), F.col("volume").alias("Volume"),
        F.col("adj_close_price").alias("Adj Close"),
    )
    write_csv_files(bars, root, ["symbol"])
    return root


def _folder_ticker():
    return F.regexp_extract("source_file", "symbol=([^/]*)/", 1)


_BARS = ["symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "volume", "adj_close_price"]


def _bulk(w):
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    folder = _write_gold_files(w)
    bulk_load(store, folder, symbol=_folder_ticker(), now=NOW)
    return store, folder


def _bulk_gold(w):
    store, _ = _bulk(w)
    return read_published(w.spark, store.path("price_gold")).select(*_BARS)


def _bulk_again(w):
    """A second run over the same folder skips every file."""
    store, folder = _bulk(w)
    again = bulk_load(store, folder, symbol=_folder_ticker())
    return L.load_summary(again)


def _retried(w):
    """Only listed tickers are loaded, the rest of the folder stays out."""
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    listed = w.exchange_lists().where("exchange = 'TSX'").select("symbol")
    retry_failed(store, _write_gold_files(w), listed, symbol=_folder_ticker(), now=NOW)
    return read_published(w.spark, store.path("price_gold")).groupBy("symbol").agg(F.count("*").alias("bars"))


def _streamed(w):
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    query = stream_load(
        store, _write_gold_files(w) + "/*", new_folder(w.spark, "stream"), refresh_batch=100,
        symbol=_folder_ticker(),
    )
    query.awaitTermination()
    return read_published(w.spark, store.path("price_gold")).select(*_BARS)


def _write_half_files(w):
    """Gold bars as two CSV files per ticker, odd and even days."""
    root = new_folder(w.spark, "halves")
    half = F.dayofmonth("price_date") % 2
    dealt = gold_of(w).withColumn("half", half).repartition(ticker_tasks(w, 2), "symbol", "half")
    bars = dealt.sortWithinPartitions("symbol", "half", "price_date").select(
        "half", "symbol", F.col("price_date").alias("Date"), F.col("open_price").alias("Open"),
        F.col("high_price").alias("High"), F.col("low_price").alias("Low"),
        F.col("close_price").alias("Close"), F.col("volume").alias("Volume"),
        F.col("adj_close_price").alias("Adj Close"),
    )
    write_csv_files(bars, root, ["half", "symbol"])
    return root


def _streamed_halves(w):
    """Both files of a ticker arrive in different micro-batches."""
    store = Store(w.spark, new_folder(w.spark, "house"))
    seed(store, NOW)
    query = stream_load(
        store, _write_half_files(w) + "/*/*", new_folder(w.spark, "stream"), refresh_batch=100,
        symbol=_folder_ticker(),
    )
    query.awaitTermination()
    return read_published(w.spark, store.path("price_gold")).select(*_BARS)


def _upserted_in_order(w):
    """Every tick sends its asset's description; the last given value of each column counts."""
    k = F.col("event_id")
    sent = w.ticks().join(w.asset().select("asset_id", "symbol", "asset_type"), "asset_id").select(
        "symbol", "asset_type", k.alias("sent"),
        F.when(k % 3 != 0, F.concat(F.lit("Name "), (k % 17).cast("string"))).alias("company_name"),
        F.when(k % 5 != 0, F.concat(F.lit("Sector "), (k % 13).cast("string"))).alias("sector"),
    )
    out = L.upsert_assets(_held_assets(w), sent, _stamp(), "sent")
    return out.select("symbol", "asset_type", "company_name", "sector")


def _exchange_files(w):
    root = new_folder(w.spark, "lists")
    paths = {}
    for exchange in S.EXCHANGE_PRIORITY:
        paths[exchange] = f"{root}/{exchange}"
        w.exchange_lists().where(F.col("exchange") == exchange).select(
            F.concat(F.lit(" "), F.lower("symbol")).alias("Symbol"), F.lit("a name").alias("Description")
        ).write.csv(paths[exchange], sep="\t", header=True, ignoreLeadingWhiteSpace=False)
    return paths


def _exchange_update(w, part):
    store = Store(w.spark, new_folder(w.spark, "house"))
    store.write("asset", w.asset())
    backup = new_folder(w.spark, "backup")
    stats, after = update_exchanges(store, _exchange_files(w), backup, NOW)
    if part == "stats":
        return stats
    if part == "after":
        return after
    return w.spark.read.csv(f"{backup}/*", header=True, schema="symbol STRING, exchange STRING")


def _symbol_list(w):
    path = new_folder(w.spark, "missing")
    Li.write_symbol_list(L.missing_symbols(_files(w), _held_assets(w)), path)
    return Li.read_symbol_list(w.spark, path)


def _errors(w):
    path = new_folder(w.spark, "errors")
    Li.write_load_errors(_results(w), path)
    return w.spark.read.json(path).select("source_file", "symbol", "message")


def _intraday(w):
    path = new_folder(w.spark, "intraday")
    I.write_intraday(w.price_raw_intraday(), path)
    return I.read_intraday(w.spark, path, "2024-01-10 06:00:00", "2024-01-20 18:00:00")


def _refreshed(w):
    path = new_folder(w.spark, "gold")
    publish(w.spark, path, gold_of(w).where("exchange is null"))
    publish(w.spark, path, gold_of(w))
    return read_published(w.spark, path).select(*_BARS, "price_year")


def _refresh_all(w):
    root = new_folder(w.spark, "marts")
    return refresh_all(w.spark, {
        "broken": (f"{root}/broken", lambda: w.asset().select(F.assert_true(F.col("asset_id") < 0))),
        "asset_summary": (f"{root}/summary", lambda: M.asset_summary(w.asset(), gold_of(w))),
        "data_quality_summary": (f"{root}/quality", lambda: M.data_quality_summary(w.batch_meta(), w.data_source())),
    }).select("mart", "refreshed")


def _validated(w):
    report = validate_only(w.spark, _write_stage_files(w))
    return report.select(_file_name().alias("file"), "row_count", "quality_score", "unique_symbols", "duplicate_count", "extreme_values", "passed")


def _listed_files(w):
    sizes = list_files(w.spark, _write_stage_files(w))
    return sizes.select(_file_name().alias("file"), (F.col("file_size_bytes") > 0).alias("has_size"), F.substring("symbol", 1, 5).alias("stem"))


def _standardized(w):
    titles = _LAYOUTS["VIEW"]
    rows = w.stage_raw_prices()
    odd = rows.select(*[F.col(c).alias(t) for t, c in titles.items()], "source_file", "row_number")
    return standardize_columns(odd)


QUERIES = {
    # I12
    "insert_if_absent": _q(lambda w: L.insert_if_absent(
        _held_assets(w).select("symbol", "asset_type", "currency"),
        _incoming_assets(w).select("symbol", "asset_type", F.lit("EUR").alias("currency")),
        ["symbol", "asset_type"])),
    # L1
    "upsert_assets": _q(_upserted),
    "upsert_assets_in_order": _q(_upserted_in_order),
    "assigned_ids": _q(_assigned_ids),
    "number_rows": _q(_number_rows),
    # L3, L5
    "make_batches": _q(_made_batches),
    "finish_batches": _q(_finished),
    # L4
    "upsert_prices": _q(lambda w: current_prices(L.upsert_prices(*_loads(w))).select(
        "asset_id", "source_id", "price_date", "close_price", "load_seq", "row_number")),
    "gold_after_upsert": _q(lambda w: build_gold(
        current_prices(L.upsert_prices(*_loads(w))), w.asset(), w.data_source(), w.batch_meta()
    ).select("asset_id", "price_date", "close_price", "source_name")),
    # J6, J7, J8, S1, A13, A12, L9
    "loaded_symbols": _q(lambda w: L.loaded_symbols(w.asset(), w.price_raw(), w.data_source(), "PURCHASE")),
    "skip_loaded": _q(lambda w: L.skip_loaded(_files(w), _held_assets(w))),
    "only_listed": _q(lambda w: L.only_listed(_files(w), w.exchange_lists().where("exchange = 'NYSE'"))),
    "missing_symbols": _q(lambda w: L.missing_symbols(_files(w), _held_assets(w))),
    "missing_report": _q(lambda w: L.missing_report(_files(w), _held_assets(w))),
    "load_summary": _q(lambda w: L.load_summary(_results(w), 20)),
    "plan_load": _q(lambda w: L.plan_load(_files(w), _held_assets(w), 20)),
    # I1-I4, I14, I6
    "stage_csv": _q(_staged),
    "standardize_columns": _q(_standardized),
    "list_files": _q(_listed_files),
    # L6, Q11
    "load_files": _q(_loaded_files),
    "load_files_gold": _q(_loaded_gold),
    "validate_only": _q(_validated),
    # L7, L8
    "bulk_load": _q(_bulk_gold),
    "bulk_load_again": _q(_bulk_again),
    "retry_failed": _q(_retried),
    # R1, R2
    "stream_load": _q(_streamed),
    "stream_load_two_files": _q(_streamed_halves),
    # I7, I10, L12
    "read_exchange_lists": _q(lambda w: Li.read_exchange_lists(w.spark, _exchange_files(w))),
    "update_exchanges": _q(lambda w: _exchange_update(w, "stats")),
    "update_exchanges_after": _q(lambda w: _exchange_update(w, "after")),
    "backup_exchanges": _q(lambda w: _exchange_update(w, "backup")),
    # I8, I9, I11
    "symbol_list": _q(_symbol_list),
    "load_errors": _q(_errors),
    # I13
    "intraday_range": _q(_intraday),
    # G1, G2
    "refresh_gold": _q(_refreshed),
    "refresh_all": _q(_refresh_all),
}

# --- oracles ------------------------------------------------------------------------

_EXTRA = {
    "held": "SELECT * FROM asset WHERE asset_id % 3 <> 0",
    "incoming": """
SELECT symbol, asset_type, currency,
       CASE WHEN sector = 'Energy' THEN 'Renamed ' || symbol END AS company_name,
       CASE WHEN sector IS NULL THEN 'Other' END AS sector,
       CASE WHEN exchange IS NULL THEN 'OTC' END AS exchange
FROM asset WHERE asset_id IN (SELECT asset_id FROM ticks WHERE value > 100)""",
    "files": "SELECT '/incoming/' || lower(symbol) || '.csv' AS source_file, symbol FROM asset",
    "load_rows": f"""
SELECT asset_id, source_id, batch_id, price_date, granularity, price_id, close_price, created_at, 1 AS load_seq, price_id AS row_number
FROM price_raw WHERE price_date <= DATE '2024-01-20'
UNION ALL
SELECT asset_id, source_id, batch_id, price_date, granularity, price_id, high_price, TIMESTAMP '{STAMP}', 2, price_id
FROM price_raw WHERE price_date >= DATE '2024-01-10'
UNION ALL
SELECT asset_id, source_id, batch_id, price_date, granularity, price_id, low_price, TIMESTAMP '{STAMP}', 2, price_id + 1
FROM price_raw WHERE price_date >= DATE '2024-01-10' AND volume > 1""",
    "live": """
SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY asset_id, price_date, source_id, granularity
        ORDER BY load_seq DESC, row_number DESC) AS n FROM load_rows) x WHERE n = 1""",
    "results": """
SELECT file_path AS source_file, split_part(batch_name, '_', 1) AS symbol,
       CASE status WHEN 'SUCCESS' THEN 'loaded' WHEN 'FAILED' THEN 'failed' ELSE 'skipped' END AS outcome,
       error_message AS message, CASE WHEN status = 'SUCCESS' THEN row_count ELSE 0 END AS records_loaded, quality_score
FROM batch_meta""",
    # What the three file layouts keep of the staged rows.
    "file_rows": """
SELECT symbol, date_str, open_str, high_str, low_str, close_str,
       CASE WHEN source_file LIKE '/incoming/CLICK%' OR source_file LIKE '/incoming/VIEW%' THEN volume_str END AS volume_str,
       CASE WHEN source_file NOT LIKE '/incoming/VIEW%' THEN adj_close_str END AS adj_close_str,
       regexp_extract(source_file, '([^/]*)\\.csv$', 1) AS source_file,
       row_number() OVER (PARTITION BY source_file ORDER BY row_number) AS row_number
FROM stage""",
    "file_parsed": """
SELECT *,
       CASE WHEN regexp_full_match(date_str, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
            THEN try_cast(date_str AS DATE) END AS d,
       try_cast(open_str AS DOUBLE) AS o, try_cast(high_str AS DOUBLE) AS h,
       try_cast(low_str AS DOUBLE) AS l, try_cast(close_str AS DOUBLE) AS c,
       try_cast(volume_str AS DOUBLE) AS v
FROM file_rows""",
    "file_flags": """
SELECT *,
       CASE WHEN symbol IS NULL THEN 1 ELSE 0 END + CASE WHEN date_str IS NULL THEN 1 ELSE 0 END
           + CASE WHEN close_str IS NULL THEN 1 ELSE 0 END AS missing,
       (date_str IS NULL OR d IS NOT NULL) AND (open_str IS NULL OR o IS NOT NULL)
           AND (high_str IS NULL OR h IS NOT NULL) AND (low_str IS NULL OR l IS NOT NULL)
           AND (close_str IS NULL OR c IS NOT NULL) AND (volume_str IS NULL OR v IS NOT NULL) AS valid,
       o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL AS priced,
       COALESCE(h >= greatest(o, c) AND l <= least(o, c) AND h >= l AND o > 0 AND h > 0 AND l > 0 AND c > 0, false) AS consistent,
       COALESCE(symbol IS NOT NULL AND d IS NOT NULL AND h >= greatest(o, c) AND l <= least(o, c) AND h >= l
           AND o > 0 AND h > 0 AND l > 0 AND c > 0 AND c < 1000000000, false) AS good,
       count(*) OVER (PARTITION BY source_file, symbol, date_str) AS copies
FROM file_parsed""",
    "file_scores": """
SELECT *, round_even((completeness + validity + consistency + uniqueness) / 4, 2) AS quality_score
FROM (
    SELECT source_file, count(*) AS row_count, count(CASE WHEN good THEN 1 END) AS accepted,
           count(DISTINCT symbol) AS unique_symbols, count(CASE WHEN copies > 1 THEN 1 END) AS duplicate_count,
           (count(*) * 3 - sum(missing)) / CAST(count(*) * 3 AS DOUBLE) * 100 AS completeness,
           count(CASE WHEN valid THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS validity,
           COALESCE(count(CASE WHEN priced AND consistent THEN 1 END)
               / CAST(nullif(count(CASE WHEN priced THEN 1 END), 0) AS DOUBLE) * 100, 0) AS consistency,
           count(CASE WHEN copies = 1 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS uniqueness
    FROM file_flags GROUP BY source_file) x""",
    "file_moves": """
SELECT source_file, count(*) AS n FROM (
    SELECT *, lag(c) OVER (PARTITION BY source_file, symbol ORDER BY row_number) AS p
    FROM file_parsed WHERE symbol IS NOT NULL) x
WHERE CASE WHEN p = 0 THEN c <> 0 ELSE NOT isnan((c - p) / p) AND abs((c - p) / p * 100) > 50 END GROUP BY source_file""",
}


def _o(kinds: str, sql: str) -> str:
    return oracle(kinds, sql, _EXTRA)


_BAR_KINDS = "symbol:s price_date:d open_price:f high_price:f low_price:f close_price:f volume:i adj_close_price:f"
_GOOD_GOLD = "SELECT * FROM price_gold WHERE low_price > 0"

ORACLES = {
    "insert_if_absent": _o("symbol:s asset_type:s currency:s", """
SELECT symbol, asset_type, currency FROM held
UNION ALL SELECT symbol, asset_type, 'EUR' FROM incoming WHERE symbol NOT IN (SELECT symbol FROM held)"""),
    "upsert_assets": _o(
        "symbol:s asset_type:s currency:s exchange:s company_name:s sector:s is_active:b updated_at:t", f"""
SELECT COALESCE(h.symbol, i.symbol) AS symbol, COALESCE(h.asset_type, i.asset_type) AS asset_type,
       COALESCE(h.currency, i.currency) AS currency, COALESCE(i.exchange, h.exchange) AS exchange,
       COALESCE(i.company_name, h.company_name) AS company_name, COALESCE(i.sector, h.sector) AS sector,
       COALESCE(h.is_active, true) AS is_active,
       CASE WHEN h.symbol IS NULL OR COALESCE(i.company_name, i.sector, i.exchange) IS NOT NULL
            THEN TIMESTAMP '{STAMP}' ELSE h.updated_at END AS updated_at
FROM held h FULL JOIN incoming i ON h.symbol = i.symbol AND h.asset_type = i.asset_type"""),
    "assigned_ids": _o("new_assets:i ids:i first:i last:i", """
SELECT count(*) AS new_assets, count(*) AS ids, CASE WHEN count(*) > 0 THEN 1 END AS "first",
       CASE WHEN count(*) > 0 THEN count(*) END AS "last"
FROM incoming WHERE symbol NOT IN (SELECT symbol FROM held)"""),
    "number_rows": _o("rows:i numbers:i first:i last:i", """
SELECT count(*) AS "rows", count(*) AS numbers, 11 AS "first", 10 + count(*) AS "last" FROM ticks"""),
    "make_batches": _o(
        "source_id:i batch_name:s file_path:s file_size_bytes:i row_count:i start_time:t status:s quality_score:f", rf"""
SELECT 3 AS source_id, regexp_extract(source_file, '([^/]*)\.csv$', 1) || '_20240201_000000' AS batch_name,
       source_file AS file_path, records_loaded * 64 AS file_size_bytes, records_loaded AS row_count,
       TIMESTAMP '{STAMP}' AS start_time, 'RUNNING' AS status, quality_score
FROM results WHERE outcome = 'loaded'"""),
    "finish_batches": _o("batch_id:i status:s end_time:t error_message:s row_count:i", f"""
SELECT batch_id,
       CASE WHEN status <> 'RUNNING' THEN status WHEN row_count > 10 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN status <> 'RUNNING' THEN end_time ELSE TIMESTAMP '{STAMP}' END AS end_time,
       CASE WHEN status <> 'RUNNING' THEN error_message WHEN row_count <= 10 THEN 'too few rows' END AS error_message,
       CASE WHEN status = 'RUNNING' AND row_count > 10 THEN row_count - 1 ELSE row_count END AS row_count
FROM batch_meta"""),
    "upsert_prices": _o("asset_id:i source_id:i price_date:d close_price:f load_seq:i row_number:i", "SELECT * FROM live"),
    "gold_after_upsert": _o("asset_id:i price_date:d close_price:f source_name:s", """
SELECT * FROM (
    SELECT p.asset_id, p.price_date, p.close_price, s.source_name,
           row_number() OVER (PARTITION BY p.asset_id, p.price_date
               ORDER BY b.start_time DESC, p.created_at DESC, p.price_id DESC) AS rn
    FROM live p JOIN asset a ON p.asset_id = a.asset_id JOIN data_source s ON p.source_id = s.source_id
    JOIN batch_meta b ON p.batch_id = b.batch_id WHERE a.is_active AND b.status = 'SUCCESS') x
WHERE rn = 1"""),
    "loaded_symbols": _o("symbol:s", """
SELECT DISTINCT a.symbol FROM asset a JOIN price_raw p ON a.asset_id = p.asset_id
JOIN data_source s ON p.source_id = s.source_id WHERE s.source_name = 'PURCHASE'"""),
    "skip_loaded": _o("symbol:s source_file:s", "SELECT * FROM files WHERE symbol NOT IN (SELECT symbol FROM held)"),
    "only_listed": _o("symbol:s source_file:s", """
SELECT * FROM files WHERE symbol IN (SELECT symbol FROM exchange_lists WHERE exchange = 'NYSE')"""),
    "missing_symbols": _o("symbol:s", """
SELECT DISTINCT symbol FROM files WHERE symbol NOT IN (SELECT symbol FROM held WHERE is_active)"""),
    "missing_report": _o("file_symbols:i loaded_symbols:i missing_symbols:i success_rate:f", """
SELECT *, round(loaded_symbols * 100.0 / file_symbols, 6) AS success_rate FROM (
    SELECT (SELECT count(DISTINCT symbol) FROM files) AS file_symbols,
           (SELECT count(DISTINCT symbol) FROM held WHERE is_active) AS loaded_symbols,
           (SELECT count(DISTINCT symbol) FROM files
            WHERE symbol NOT IN (SELECT symbol FROM held WHERE is_active)) AS missing_symbols) x"""),
    "load_summary": _o(
        "total_files:i successful_loads:i failed_loads:i skipped_files:i records_loaded:i gold_refreshes:i", """
SELECT count(*) AS total_files, count(CASE WHEN outcome = 'loaded' THEN 1 END) AS successful_loads,
       count(CASE WHEN outcome = 'failed' THEN 1 END) AS failed_loads,
       count(CASE WHEN outcome = 'skipped' THEN 1 END) AS skipped_files, sum(records_loaded) AS records_loaded,
       count(CASE WHEN outcome = 'loaded' THEN 1 END) // 20 + 1 AS gold_refreshes FROM results"""),
    "plan_load": _o("total_files:i to_process:i to_skip:i gold_refreshes:i", """
SELECT *, to_process // 20 + 1 AS gold_refreshes FROM (
    SELECT count(*) AS total_files, count(CASE WHEN h.symbol IS NULL THEN 1 END) AS to_process,
           count(h.symbol) AS to_skip
    FROM files f LEFT JOIN (SELECT DISTINCT symbol FROM held) h ON f.symbol = h.symbol) x"""),
    "stage_csv": _o(
        "symbol:s date_str:s open_str:s high_str:s low_str:s close_str:s volume_str:s adj_close_str:s "
        "source_file:s row_number:i", "SELECT * FROM file_rows"),
    "standardize_columns": _o(
        "symbol:s date_str:s open_str:s high_str:s low_str:s close_str:s volume_str:s adj_close_str:s "
        "source_file:s row_number:i", "SELECT * REPLACE (NULL AS adj_close_str) FROM raw_stage"),
    "list_files": _o("file:s has_size:b stem:s", """
SELECT DISTINCT source_file AS "file", true AS has_size, 'PART-' AS stem FROM file_rows"""),
    "load_files": _o("file:s outcome:s records_loaded:i quality_score:f", """
SELECT source_file AS "file", CASE WHEN quality_score >= 70 THEN 'loaded' ELSE 'failed' END AS outcome,
       CASE WHEN quality_score >= 70 THEN accepted ELSE 0 END AS records_loaded, quality_score
FROM file_scores"""),
    "load_files_gold": _o("symbol:s asset_type:s price_date:d source_name:s", """
SELECT DISTINCT f.symbol, 'STOCK' AS asset_type, f.d AS price_date, 'MANUAL_CSV' AS source_name
FROM file_flags f JOIN file_scores s ON f.source_file = s.source_file
WHERE f.good AND s.quality_score >= 70"""),
    "validate_only": _o(
        "file:s row_count:i quality_score:f unique_symbols:i duplicate_count:i extreme_values:i passed:b", """
SELECT s.source_file AS "file", s.row_count, s.quality_score, s.unique_symbols, s.duplicate_count,
       COALESCE(m.n, 0) AS extreme_values, s.quality_score >= 75 AS passed
FROM file_scores s LEFT JOIN file_moves m ON s.source_file = m.source_file"""),
    "bulk_load": _o(_BAR_KINDS, _GOOD_GOLD),
    "bulk_load_again": _o(
        "total_files:i successful_loads:i failed_loads:i skipped_files:i records_loaded:i gold_refreshes:i", """
SELECT count(DISTINCT symbol) AS total_files, 0 AS successful_loads, 0 AS failed_loads,
       count(DISTINCT symbol) AS skipped_files, 0 AS records_loaded, 0 AS gold_refreshes FROM price_gold"""),
    "retry_failed": _o("symbol:s bars:i", f"""
SELECT symbol, count(*) AS bars FROM ({_GOOD_GOLD}) g
WHERE symbol IN (SELECT symbol FROM exchange_lists WHERE exchange = 'TSX') GROUP BY symbol"""),
    "stream_load": _o(_BAR_KINDS, _GOOD_GOLD),
    "stream_load_two_files": _o(_BAR_KINDS, _GOOD_GOLD),
    "upsert_assets_in_order": _o("symbol:s asset_type:s company_name:s sector:s", """
SELECT a.symbol, a.asset_type,
       COALESCE(n.company_name, CASE WHEN a.asset_id % 3 <> 0 THEN a.company_name END) AS company_name,
       COALESCE(n.sector, CASE WHEN a.asset_id % 3 <> 0 THEN a.sector END) AS sector
FROM asset a LEFT JOIN (
    SELECT asset_id, 'Name ' || arg_max(event_id % 17, event_id) FILTER (event_id % 3 <> 0) AS company_name,
           'Sector ' || arg_max(event_id % 13, event_id) FILTER (event_id % 5 <> 0) AS sector
    FROM ticks GROUP BY asset_id) n ON a.asset_id = n.asset_id
WHERE a.asset_id % 3 <> 0 OR n.asset_id IS NOT NULL"""),
    "read_exchange_lists": _o("exchange:s symbol:s", "SELECT * FROM exchange_lists"),
    "update_exchanges": _o("total_symbols:i updated:i skipped:i stock_symbols:i coverage_pct:f", """
SELECT *, round(updated * 100.0 / stock_symbols, 6) AS coverage_pct FROM (
    SELECT count(m.symbol) AS total_symbols,
           count(CASE WHEN m.symbol IS NOT NULL AND (a.exchange IS NULL OR a.exchange <> m.exchange) THEN 1 END) AS updated,
           count(CASE WHEN a.exchange = m.exchange THEN 1 END) AS skipped, count(*) AS stock_symbols
    FROM asset a LEFT JOIN mapping m ON a.symbol = m.symbol
    WHERE a.asset_type = 'STOCK' AND a.is_active) x"""),
    "update_exchanges_after": _o("exchange:s symbol_count:i", """
SELECT COALESCE(m.exchange, a.exchange, 'NULL') AS exchange, count(*) AS symbol_count
FROM asset a LEFT JOIN mapping m ON a.symbol = m.symbol
WHERE a.asset_type = 'STOCK' AND a.is_active GROUP BY 1"""),
    "backup_exchanges": _o("symbol:s exchange:s", """
SELECT symbol, exchange FROM asset WHERE asset_type = 'STOCK' AND exchange IS NOT NULL"""),
    "symbol_list": _o("symbol:s", """
SELECT DISTINCT symbol FROM files WHERE symbol NOT IN (SELECT symbol FROM held WHERE is_active)"""),
    "load_errors": _o("source_file:s symbol:s message:s", "SELECT * FROM results WHERE outcome = 'failed'"),
    "intraday_range": _o(
        "price_id:i asset_id:i batch_id:i source_id:i price_datetime:t granularity:s open_price:f high_price:f "
        "low_price:f close_price:f volume:i trade_count:i vwap:f created_at:t price_month:s", """
SELECT *, strftime(price_datetime, '%Y_%m') AS price_month FROM price_raw_intraday
WHERE price_datetime >= TIMESTAMP '2024-01-10 06:00:00' AND price_datetime < TIMESTAMP '2024-01-20 18:00:00'"""),
    "refresh_gold": _o(_BAR_KINDS + " price_year:i", "SELECT *, year(price_date) AS price_year FROM price_gold"),
    "refresh_all": _o("mart:s refreshed:b", """
SELECT 'broken' AS mart, NOT EXISTS (SELECT 1 FROM asset) AS refreshed
UNION ALL SELECT 'asset_summary', true UNION ALL SELECT 'data_quality_summary', true"""),
}
