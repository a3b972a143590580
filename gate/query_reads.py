"""Gold, marts and the query surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from gate.plain import plain
from gate.tables import oracle
from pricehouse.fixtures import Warehouse
from pricehouse.plans import gold as G
from pricehouse.plans import marts as M
from pricehouse.plans import queries as Q

AS_OF = "2024-01-25"
TICKERS = ["u000000001", "U000000002", "U000000003", "U000000004-USD", "U000000007"]
IN_TICKERS = "symbol IN ('U000000001','U000000002','U000000003','U000000004-USD','U000000007')"
GOLD_KINDS = (
    "price_id:i asset_id:i symbol:s asset_type:s currency:s exchange:s company_name:s "
    "price_date:d open_price:f high_price:f low_price:f close_price:f volume:i "
    "adj_close_price:f source_name:s created_at:t"
)
PRICE_KINDS = (
    "symbol:s price_date:d open_price:f high_price:f low_price:f close_price:f volume:i "
    "adj_close_price:f asset_type:s currency:s exchange:s"
)
LATEST_KINDS = "symbol:s price_date:d close_price:f volume:i asset_type:s exchange:s"


def gold_of(w: Warehouse):
    return G.build_gold(w.price_raw(), w.asset(), w.data_source(), w.batch_meta())


def history_gold_of(w: Warehouse):
    return G.build_gold(
        w.history_price_raw(), w.history_asset(), w.history_source(), w.history_batch_meta()
    )


def _q(build):
    return lambda spark, folder: plain(build(Warehouse(spark, folder)))


QUERIES = {
    # W1, J1
    "build_gold": _q(gold_of),
    "build_gold_history": _q(history_gold_of),
    # G3, J2
    "price_total_return": _q(
        lambda w: M.price_total_return(gold_of(w), w.corporate_action(), w.dividend_cash(), w.stock_split())
    ),
    # A1, J3
    "asset_summary": _q(lambda w: M.asset_summary(w.asset(), gold_of(w))),
    "asset_summary_history": _q(lambda w: M.asset_summary(w.history_asset(), history_gold_of(w))),
    # A2, J4
    "data_quality_summary": _q(lambda w: M.data_quality_summary(w.batch_meta(), w.data_source())),
    # W2
    "recent_price_changes": _q(lambda w: M.recent_price_changes(gold_of(w), AS_OF, 14)),
    "recent_price_changes_history": _q(
        lambda w: M.recent_price_changes(history_gold_of(w), "2000-06-30", 365)
    ),
    # F1, T1
    "prices": _q(lambda w: Q.prices(gold_of(w), TICKERS, "2024-01-05", "2024-01-20")),
    "prices_no_tickers": _q(lambda w: Q.prices(gold_of(w), [], "2024-01-05", "2024-01-20")),
    # F2
    "total_return": _q(lambda w: Q.total_return(gold_of(w), "u000000001", "2024-01-01", "2024-01-31")),
    # F3
    "available_symbols": _q(lambda w: Q.available_symbols(w.asset())),
    "available_symbols_by_type": _q(lambda w: Q.available_symbols(w.asset(), "STOCK", "NASDAQ")),
    # F4, F5
    "asset_info": _q(lambda w: Q.asset_info(w.asset(), "u000000003")),
    "asset_info_typed": _q(lambda w: Q.asset_info(w.asset(), "U000000004-USD", "CRYPTO")),
    # F6, F7
    "active_sources": _q(lambda w: Q.active_sources(w.data_source())),
    "source_id": _q(
        lambda w: w.price_raw().where(F.col("source_id") == Q.source_id(w.data_source(), "PURCHASE"))
        .groupBy("source_id").agg(F.count("*").alias("bars"))
    ),
    "list_sources": _q(lambda w: Q.list_sources(w.data_source())),
    # F16
    "recent_batches": _q(lambda w: Q.recent_batches(w.batch_meta(), 20)),
    # W4, J5
    "latest_prices": _q(lambda w: Q.latest_prices(gold_of(w), limit=None)),
    "latest_prices_of": _q(lambda w: Q.latest_prices(gold_of(w), TICKERS, 100)),
    "latest_prices_by_asset": _q(lambda w: Q.latest_prices(gold_of(w), limit=None, by="asset_id")),
    "latest_prices_join": _q(lambda w: Q.latest_prices_join(gold_of(w))),
    "latest_prices_history": _q(lambda w: Q.latest_prices(history_gold_of(w), limit=None)),
    # T2
    "top_latest_by_exchange": _q(lambda w: Q.top_latest(gold_of(w), 10, exchange="NASDAQ")),
    "top_latest_by_symbol": _q(lambda w: Q.top_latest(gold_of(w), 10, symbol="U000000001")),
    # A3, T3
    "price_summary": _q(lambda w: Q.price_summary(gold_of(w), "u000000001", 14, AS_OF)),
    # A4
    "date_range": _q(lambda w: Q.date_range(gold_of(w))),
    "date_range_of": _q(lambda w: Q.date_range(gold_of(w), "u000000002")),
    # A6, A11
    "table_stats": _q(lambda w: Q.table_stats(gold_of(w))),
    "coverage": _q(lambda w: Q.coverage(gold_of(w))),
    # A7, J10
    "freshness": _q(lambda w: Q.freshness(w.price_raw(), gold_of(w), 24)),
    # A8, J10
    "warehouse_counts": _q(
        lambda w: Q.warehouse_counts(w.asset(), w.price_raw(), w.batch_meta(), gold_of(w))
    ),
    # J11
    "prices_by_asset_type": _q(lambda w: Q.prices_by_asset_type(gold_of(w), w.asset())),
}

_SUMMARY_KINDS = (
    "asset_id:i symbol:s asset_type:s currency:s exchange:s company_name:s trading_days:i "
    "first_date:d last_date:d avg_price:f min_price:f max_price:f avg_volume:f price_volatility:f"
)


def _summary(asset: str, gold: str) -> str:
    return oracle(_SUMMARY_KINDS, f"""
SELECT a.asset_id, a.symbol, a.asset_type, a.currency, a.exchange, a.company_name,
       count(g.price_date) AS trading_days, min(g.price_date) AS first_date, max(g.price_date) AS last_date,
       round(avg(CAST(g.close_price AS DOUBLE)), 6) AS avg_price,
       min(g.low_price) AS min_price, max(g.high_price) AS max_price,
       round(avg(g.volume), 6) AS avg_volume,
       round(stddev_samp(CAST(g.close_price AS DOUBLE)), 6) AS price_volatility
FROM {asset} a LEFT JOIN {gold} g ON a.asset_id = g.asset_id
WHERE a.is_active
GROUP BY a.asset_id, a.symbol, a.asset_type, a.currency, a.exchange, a.company_name""")


def _changes(gold: str, as_of: str, days: int) -> str:
    # pct in exact integer arithmetic: hundredths of a percent, half away from zero
    return oracle(
        "symbol:s asset_type:s price_date:d close_price:f prev_close:f pct_change:f price_change:f", f"""
SELECT symbol, asset_type, price_date, close_price, prev_close, close_price - prev_close AS price_change,
       CASE WHEN p <> 0 THEN
            CASE WHEN c >= p THEN 1 ELSE -1 END * ((abs(c - p) * 20000 + p) // (2 * p)) / CAST(100 AS DOUBLE)
       END AS pct_change
FROM (
    SELECT *, CAST(close_price * 100 AS BIGINT) AS c, CAST(prev_close * 100 AS BIGINT) AS p
    FROM (
        SELECT *, lag(close_price) OVER (PARTITION BY asset_id ORDER BY price_date) AS prev_close
        FROM {gold} WHERE price_date >= DATE '{as_of}' - INTERVAL {days} DAY) x
) y WHERE prev_close IS NOT NULL""")


def _latest(gold: str, where: str = "", by: str = "symbol", tail: str = "") -> str:
    return oracle(LATEST_KINDS, f"""
SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY price_date DESC, asset_id DESC) AS n
    FROM {gold} {where}) x
WHERE n = 1 {tail}""")


ORACLES = {
    "build_gold": oracle(GOLD_KINDS, "SELECT * FROM price_gold"),
    "build_gold_history": oracle(GOLD_KINDS, "SELECT * FROM history_gold"),
    "price_total_return": oracle(
        "asset_id:i symbol:s price_date:d close_price:f adj_close_price:f dividend_amount:f "
        "split_factor:f total_return_price:f", """
SELECT g.asset_id, g.symbol, g.price_date, g.close_price, g.adj_close_price,
       COALESCE(d.dividend_amount, 0) AS dividend_amount,
       CASE WHEN s.split_ratio_to IS NOT NULL
            THEN round(CAST(s.split_ratio_to AS DOUBLE) / s.split_ratio_from, 6) ELSE 1.0 END AS split_factor,
       g.adj_close_price AS total_return_price
FROM price_gold g
LEFT JOIN corporate_action c ON g.asset_id = c.asset_id AND g.price_date = c.ex_date
LEFT JOIN dividend_cash d ON c.action_id = d.action_id AND c.action_type = 'DIVIDEND_CASH'
LEFT JOIN stock_split s ON c.action_id = s.action_id AND c.action_type = 'STOCK_SPLIT'"""),
    "asset_summary": _summary("asset", "price_gold"),
    "asset_summary_history": _summary("history_asset", "history_gold"),
    "data_quality_summary": oracle(
        "source_name:s month:t total_batches:i successful_batches:i failed_batches:i "
        "avg_quality_score:f total_rows_processed:i", """
SELECT s.source_name, date_trunc('month', b.start_time)::TIMESTAMP AS month, count(*) AS total_batches,
       count(CASE WHEN b.status = 'SUCCESS' THEN 1 END) AS successful_batches,
       count(CASE WHEN b.status = 'FAILED' THEN 1 END) AS failed_batches,
       round(avg(CAST(b.quality_score AS DOUBLE)), 6) AS avg_quality_score,
       sum(b.row_count) AS total_rows_processed
FROM batch_meta b JOIN data_source s ON b.source_id = s.source_id
GROUP BY 1, 2"""),
    "recent_price_changes": _changes("price_gold", AS_OF, 14),
    "recent_price_changes_history": _changes("history_gold", "2000-06-30", 365),
    "prices": oracle(PRICE_KINDS, f"""
SELECT * FROM price_gold WHERE {IN_TICKERS}
AND price_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "prices_no_tickers": oracle(PRICE_KINDS, "SELECT * FROM price_gold WHERE false"),
    "total_return": oracle("price_date:d adj_close_price:f", """
SELECT * FROM price_gold WHERE symbol = 'U000000001'
AND price_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"""),
    "available_symbols": oracle("symbol:s", "SELECT DISTINCT symbol FROM asset WHERE is_active"),
    "available_symbols_by_type": oracle("symbol:s", """
SELECT DISTINCT symbol FROM asset WHERE is_active AND asset_type = 'STOCK' AND exchange = 'NASDAQ'"""),
    "asset_info": oracle(
        "asset_id:i symbol:s asset_type:s currency:s exchange:s company_name:s sector:s industry:s "
        "market_cap:i is_active:b created_at:t updated_at:t",
        "SELECT * FROM asset WHERE symbol = 'U000000003'"),
    "asset_info_typed": oracle(
        "asset_id:i symbol:s asset_type:s currency:s exchange:s company_name:s sector:s is_active:b",
        "SELECT * FROM asset WHERE symbol = 'U000000004-USD' AND asset_type = 'CRYPTO'"),
    "active_sources": oracle("source_name:s source_id:i", "SELECT * FROM data_source WHERE is_active"),
    "source_id": oracle("source_id:i bars:i", """
SELECT p.source_id, count(*) AS bars FROM price_raw p JOIN data_source s ON p.source_id = s.source_id
WHERE s.source_name = 'PURCHASE' AND s.is_active GROUP BY p.source_id"""),
    "list_sources": oracle(
        "source_name:s source_type:s is_active:b rate_limit_per_minute:i api_key_required:b",
        "SELECT * FROM data_source"),
    "recent_batches": oracle(
        "batch_name:s status:s quality_score:f row_count:i start_time:t",
        "SELECT * FROM batch_meta ORDER BY start_time DESC, batch_id DESC LIMIT 20"),
    "latest_prices": _latest("price_gold"),
    "latest_prices_of": _latest("price_gold", f"WHERE {IN_TICKERS}"),
    "latest_prices_by_asset": _latest("price_gold", by="asset_id"),
    "latest_prices_join": oracle(LATEST_KINDS, """
SELECT g.* FROM price_gold g
JOIN (SELECT symbol, max(price_date) AS latest FROM price_gold GROUP BY symbol) m
  ON g.symbol = m.symbol AND g.price_date = m.latest
ORDER BY g.symbol LIMIT 100"""),
    "latest_prices_history": _latest("history_gold"),
    "top_latest_by_exchange": oracle("symbol:s price_date:d close_price:f volume:i exchange:s", """
SELECT * FROM price_gold WHERE exchange = 'NASDAQ' ORDER BY price_date DESC, symbol LIMIT 10"""),
    "top_latest_by_symbol": oracle("symbol:s price_date:d close_price:f volume:i exchange:s", """
SELECT * FROM price_gold WHERE symbol = 'U000000001' ORDER BY price_date DESC, symbol LIMIT 10"""),
    "price_summary": oracle(
        "symbol:s trading_days:i min_price:f max_price:f avg_price:f price_volatility:f avg_volume:i "
        "start_date:d end_date:d latest_price:f analysis_days:i", f"""
SELECT 'U000000001' AS symbol, count(*) AS trading_days, min(low_price) AS min_price,
       max(high_price) AS max_price, round(avg(CAST(close_price AS DOUBLE)), 6) AS avg_price,
       round(stddev_samp(CAST(close_price AS DOUBLE)), 6) AS price_volatility,
       trunc(avg(volume)) AS avg_volume, min(price_date) AS start_date, max(price_date) AS end_date,
       (SELECT close_price FROM price_gold WHERE symbol = 'U000000001'
        ORDER BY price_date DESC LIMIT 1) AS latest_price, 14 AS analysis_days
FROM price_gold WHERE symbol = 'U000000001' AND price_date >= DATE '{AS_OF}' - INTERVAL 14 DAY"""),
    "date_range": oracle("min_date:d max_date:d", """
SELECT min(price_date) AS min_date, max(price_date) AS max_date FROM price_gold"""),
    "date_range_of": oracle("min_date:d max_date:d", """
SELECT min(price_date) AS min_date, max(price_date) AS max_date FROM price_gold WHERE symbol = 'U000000002'"""),
    "table_stats": oracle("row_count:i min_date:d max_date:d symbol_count:i", """
SELECT count(*) AS row_count, min(price_date) AS min_date, max(price_date) AS max_date,
       count(DISTINCT symbol) AS symbol_count FROM price_gold"""),
    "coverage": oracle("earliest_date:d latest_date:d trading_days:i", """
SELECT min(price_date) AS earliest_date, max(price_date) AS latest_date,
       count(DISTINCT price_date) AS trading_days FROM price_gold"""),
    "freshness": oracle("latest_raw:t latest_gold:t hours_behind:f is_fresh:b", """
SELECT *, hours_behind <= 24 AS is_fresh FROM (
    SELECT latest_raw, latest_gold,
           round((epoch_us(latest_raw) - epoch_us(latest_gold)) / CAST(3600000000 AS DOUBLE), 6) AS hours_behind
    FROM (SELECT max(created_at) AS latest_raw FROM price_raw) r,
         (SELECT max(created_at) AS latest_gold FROM price_gold) g) x"""),
    "warehouse_counts": oracle("asset_count:i price_count:i batch_count:i latest_date:d", """
SELECT (SELECT count(*) FROM asset) AS asset_count, (SELECT count(*) FROM price_raw) AS price_count,
       (SELECT count(*) FROM batch_meta) AS batch_count,
       (SELECT max(price_date) FROM price_gold) AS latest_date"""),
    "prices_by_asset_type": oracle("asset_type:s price_records:i", """
SELECT a.asset_type, count(*) AS price_records
FROM price_gold g JOIN asset a ON g.asset_id = a.asset_id GROUP BY a.asset_type"""),
}
