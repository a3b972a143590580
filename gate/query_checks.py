"""Quality, constraint, analytics, exchange and scalar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gate.plain import plain
from gate.query_reads import gold_of, history_gold_of
from gate.tables import oracle
from pricehouse import schemas as S
from pricehouse.fixtures import Warehouse
from pricehouse.functions import parsing as P
from pricehouse.functions import scalars as X
from pricehouse.operators import analytics as A
from pricehouse.operators import constraints as K
from pricehouse.operators import exchanges as E
from pricehouse.operators import quality as Qc
from pricehouse.sources.csv_staging import nullify_na

# A ticker per part size (1 to 50): the crypto tickers first, then some that are not.
_TICKERS = [*S.KNOWN_CRYPTO, "AAPL", "MSFT", "btc", "BTC-USD", "IBM", "", "SPY", "QQQ", "X", "GE", "T", "V"]
NEW_STAMP = "2024-02-01 00:00:00"


def _q(build):
    return lambda spark, folder: plain(build(Warehouse(spark, folder)))


def stage_of(w: Warehouse):
    return nullify_na(w.stage_raw_prices())


def _mapping(w: Warehouse):
    return E.priority_mapping(w.exchange_lists())


def _parsed(w: Warehouse):
    return stage_of(w).select(
        "source_file", "row_number", "symbol",
        P.iso_date("date_str").alias("iso_day"),
        P.parse_date("date_str").alias("any_day"),
        P.to_finite("close_str").alias("close_number"),
        P.to_price("close_str").alias("close_price"),
        P.to_volume("volume_str").alias("volume"),
        P.to_price("adj_close_str").alias("adj_close_price"),
        P.is_valid_symbol("symbol").alias("valid_symbol"),
        P.symbol_from_path("source_file").alias("path_symbol"),
        P.symbol_from_stem("source_file").alias("stem_symbol"),
    )


def _date_texts(w: Warehouse):
    """Order dates written in all accepted layouts, by order priority."""
    day = F.to_date("o_orderdate")
    layout = F.substring("o_orderpriority", 1, 1)
    text = (
        F.when(layout == "1", F.date_format(day, "M/d/yyyy"))
        .when(layout == "2", F.date_format(day, "dd/MM/yyyy"))
        .when(layout == "3", F.date_format(day, "yyyyMMdd"))
        .when(layout == "4", F.date_format(day, "MM-dd-yyyy"))
        .otherwise(F.date_format(day, "yyyy-M-d"))
    )
    return w.table("orders").select("o_orderkey", text.alias("text")).withColumn("day", P.parse_date("text"))


def _scalars(w: Warehouse):
    row = w.table("lineitem").join(
        w.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey"
    )
    ship, order = F.to_date("l_shipdate"), F.to_date("o_orderdate")
    return row.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        X.trading_days(order, ship).alias("trading_days"),
        X.safe_divide(F.col("l_extendedprice"), F.round(F.col("l_tax") * 100), -1.0).alias("ratio"),
        X.format_currency("l_extendedprice", F.when(F.col("l_returnflag") == "R", F.lit("CAD")).otherwise(F.lit("usd"))).alias("money"),
    )


def _date_rows(w: Warehouse, freq: str):
    spans = w.table("orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("first"),
        F.date_add(F.to_date("o_orderdate"), F.length("o_orderpriority") * 3 - 20).alias("last"),
    )
    return X.date_range_rows(spans, "first", "last", freq).select("o_orderkey", "day")


QUERIES = {
    # I2, I3, F8-F11, F13, I4, I5
    "nullify_na": _q(stage_of),
    "parse_stage": _q(_parsed),
    # F9
    "parse_date": _q(_date_texts),
    # F14
    "classify_asset": _q(
        lambda w: w.table("part").select(
            "p_partkey", P.classify_asset(F.get(F.array(*[F.lit(t) for t in _TICKERS]), F.col("p_size") - 1)).alias("asset_type")
        )
    ),
    # F12, L2
    "valid_ohlc": _q(lambda w: _prepared(w, True)),
    "rejected_rows": _q(lambda w: _prepared(w, False)),
    # X1, X3, X4
    "scalar_functions": _q(_scalars),
    # X2
    "date_range_rows_daily": _q(lambda w: _date_rows(w, "D")),
    "date_range_rows_weekly": _q(lambda w: _date_rows(w, "W")),
    "date_range_rows_monthly": _q(lambda w: _date_rows(w, "M")),
    # F15
    "is_market_hours": _q(
        lambda w: w.ticks().join(w.asset().select("asset_id", "exchange"), "asset_id").select(
            "event_id", X.is_market_hours("ts", "exchange").alias("open")
        )
    ),
    # Q2-Q6
    "score_quality": _q(lambda w: Qc.score_quality(stage_of(w), "source_file")),
    "score_quality_overall": _q(lambda w: Qc.score_quality(stage_of(w))),
    # Q7, W3
    "price_findings": _q(lambda w: Qc.price_findings(stage_of(w))),
    "extreme_moves": _q(lambda w: Qc.extreme_moves(stage_of(w), rows_per_chunk=500)),
    # Q8, Q11, Q1
    "quality_report": _q(lambda w: Qc.quality_report(stage_of(w))),
    # Q9
    "staging_issues": _q(lambda w: Qc.staging_issues(stage_of(w))),
    # A5
    "staging_summary": _q(lambda w: Qc.staging_summary(stage_of(w))),
    # Q10
    "quality_gate": _q(
        lambda w: Qc.quality_gate(Qc.score_quality(stage_of(w), "source_file"), 88.0).select(
            "source_file", "quality_score", "accepted"
        )
    ),
    # Q12
    "quality_log": _q(
        lambda w: Qc.quality_log(Qc.score_quality(stage_of(w), "source_file"), "source_file").select(
            "source_file", "check_name", "check_result", "score",
            F.col("details")["row_count"].alias("detail_rows"),
        )
    ),
    # W8
    "detect_duplicates": _q(lambda w: Qc.detect_duplicates(stage_of(w))),
    # W5, W6, W7
    "daily_returns": _q(lambda w: A.daily_returns(gold_of(w), ["asset_id"])),
    "daily_returns_history": _q(lambda w: A.daily_returns(history_gold_of(w), ["asset_id"])),
    "volatility": _q(lambda w: A.volatility(A.daily_returns(gold_of(w), ["asset_id"]), ["asset_id"])),
    "volatility_history": _q(
        lambda w: A.volatility(A.daily_returns(history_gold_of(w), ["asset_id"]), ["asset_id"], False)
    ),
    "detect_outliers": _q(
        lambda w: A.detect_outliers(
            gold_of(w).select("asset_id", "price_date", "close_price"), "close_price", ["asset_id"]
        )
    ),
    "detect_outliers_overall": _q(
        lambda w: A.detect_outliers(
            w.table("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", [], "iqr", 0.5
        )
    ),
    "detect_outliers_zscore": _q(
        lambda w: A.detect_outliers(
            gold_of(w).select("asset_id", "price_date", "close_price"), "close_price", ["asset_id"], "zscore", 2.0
        )
    ),
    # K1-K9
    "check_ohlc": _q(lambda w: K.check_ohlc(_stage_numbers(w)).select("source_file", "row_number")),
    "check_intraday": _q(
        lambda w: K.check_intraday(_stage_numbers(w).withColumn(
            "granularity", F.when(F.col("row_number") % 3 == 0, F.lit("DAILY")).otherwise(F.lit("MIN5"))
        )).select("source_file", "row_number")
    ),
    "check_action_dates": _q(lambda w: K.check_action_dates(w.corporate_action()).select("action_id", "ex_date", "record_date")),
    "check_positive": _q(lambda w: K.check_positive(w.dividend_cash().withColumn("net", F.col("dividend_amount") - 0.01), ["dividend_amount", "net"]).select("action_id", "dividend_amount")),
    "check_domain": _q(lambda w: K.check_domain(w.batch_meta(), "status", ["RUNNING", "SUCCESS"]).select("batch_id", "status")),
    "check_unique": _q(lambda w: K.check_unique(stage_of(w), ["symbol", "date_str"])),
    "check_unique_gold": _q(lambda w: K.check_unique(gold_of(w), ["asset_id", "price_date"])),
    "check_reference": _q(
        lambda w: K.check_reference(w.price_raw(), w.batch_meta().where("status <> 'FAILED'"), "batch_id").select("price_id", "batch_id")
    ),
    "check_not_null": _q(lambda w: K.check_not_null(stage_of(w), ["symbol", "open_str", "close_str"]).select("source_file", "row_number")),
    "check_limits": _q(lambda w: K.check_limits(stage_of(w), 13).select("source_file", "row_number")),
    # A10, S3
    "symbol_overlaps": _q(lambda w: E.symbol_overlaps(w.exchange_lists())),
    "overlap_histogram": _q(lambda w: E.overlap_histogram(w.exchange_lists())),
    "list_sizes": _q(lambda w: E.list_sizes(w.exchange_lists())),
    # L10
    "priority_mapping": _q(_mapping),
    # J9, S2
    "match_symbols": _q(lambda w: E.match_symbols(_mapping(w), w.asset())),
    "unmapped_symbols": _q(lambda w: E.unmapped_symbols(w.asset(), _mapping(w))),
    # L11, A14, A9
    "apply_exchanges": _q(
        lambda w: E.apply_exchanges(w.asset(), _mapping(w), F.lit(NEW_STAMP).cast("timestamp")).select(
            "asset_id", "symbol", "asset_type", "exchange", "updated_at"
        )
    ),
    "update_stats": _q(lambda w: E.update_stats(w.asset(), _mapping(w))),
    "exchange_distribution": _q(lambda w: E.exchange_distribution(w.asset())),
}


def _stage_numbers(w: Warehouse):
    names = {"open_price": "open_str", "high_price": "high_str", "low_price": "low_str", "close_price": "close_str"}
    typed = P.compute_once(stage_of(w), {n: P.to_price(c) for n, c in names.items()})
    return typed.select("source_file", "row_number", *names)


def _prepared(w: Warehouse, accepted: bool):
    from pricehouse.operators.loading import prepare_prices

    good, bad = prepare_prices(stage_of(w))
    if not accepted:
        return bad.select("source_file", "row_number")
    return good.select(
        "source_file", "row_number", "symbol", "price_date", "open_price", "high_price", "low_price",
        "close_price", "volume", "adj_close_price",
    )


# --- oracles ------------------------------------------------------------------

_STAGE_KINDS = (
    "symbol:s date_str:s open_str:s high_str:s low_str:s close_str:s volume_str:s adj_close_str:s "
    "source_file:s row_number:i"
)
_OHLC = "(h >= greatest(o, c) AND l <= least(o, c) AND h >= l AND o > 0 AND h > 0 AND l > 0 AND c > 0)"

# Per source file: the four scores from first principles.
_SCORES = {
    "flags": f"""
SELECT source_file, symbol, date_str,
       CASE WHEN symbol IS NULL THEN 1 ELSE 0 END + CASE WHEN date_str IS NULL THEN 1 ELSE 0 END
           + CASE WHEN close_str IS NULL THEN 1 ELSE 0 END AS missing,
       (date_str IS NULL OR d IS NOT NULL) AND (open_str IS NULL OR o IS NOT NULL)
           AND (high_str IS NULL OR h IS NOT NULL) AND (low_str IS NULL OR l IS NOT NULL)
           AND (close_str IS NULL OR c IS NOT NULL) AND (volume_str IS NULL OR v IS NOT NULL) AS valid,
       o IS NOT NULL AND h IS NOT NULL AND l IS NOT NULL AND c IS NOT NULL AS priced,
       COALESCE({_OHLC}, false) AS consistent,
       count(*) OVER (PARTITION BY source_file, symbol, date_str) AS copies,
       count(*) OVER (PARTITION BY symbol, date_str) AS copies_overall
FROM parsed""",
    "scores": """
SELECT *, round_even((completeness + validity + consistency + uniqueness) / 4, 2) AS quality_score
FROM (
    SELECT source_file, count(*) AS row_count,
           (count(*) * 3 - sum(missing)) / CAST(count(*) * 3 AS DOUBLE) * 100 AS completeness,
           count(CASE WHEN valid THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS validity,
           COALESCE(count(CASE WHEN priced AND consistent THEN 1 END)
               / CAST(nullif(count(CASE WHEN priced THEN 1 END), 0) AS DOUBLE) * 100, 0) AS consistency,
           count(CASE WHEN copies = 1 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS uniqueness
    FROM flags GROUP BY source_file) x""",
}
_MOVES = {
    "moves": """
SELECT * FROM (
    SELECT *, lag(c) OVER (PARTITION BY source_file, symbol ORDER BY row_number) AS p
    FROM parsed WHERE symbol IS NOT NULL) x
WHERE CASE WHEN p = 0 THEN c <> 0 ELSE NOT isnan((c - p) / p) AND abs((c - p) / p * 100) > 50 END""",
}
_SCORE_KINDS = "row_count:i completeness:f validity:f consistency:f uniqueness:f quality_score:f"
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("completeness", "validity", "consistency", "uniqueness"))


def _returns(gold: str) -> str:
    return f"""
SELECT asset_id, price_date,
       CASE WHEN p <> 0 THEN c / p - 1 ELSE CAST('inf' AS DOUBLE) END AS r FROM (
    SELECT asset_id, price_date, CAST(close_price AS DOUBLE) AS c,
           lag(CAST(close_price AS DOUBLE)) OVER (PARTITION BY asset_id ORDER BY price_date) AS p
    FROM {gold}) x
WHERE p <> 0 OR (p = 0 AND c <> 0)"""


def _volatility(gold: str, scale: str) -> str:
    return oracle("asset_id:i volatility:f", f"""
SELECT asset_id, round(CASE WHEN count(*) < 2 THEN 0 ELSE stddev_samp(r) * {scale} END, 6) AS volatility
FROM ({_returns(gold)}) z GROUP BY asset_id""")


def _steps(days: int) -> str:
    return oracle("o_orderkey:i day:d", f"""
SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS TIMESTAMP),
       CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(length(o_orderpriority) * 3 - 20 AS INTEGER)),
       INTERVAL {days} DAY)) AS DATE) AS day
FROM orders""")


_ACCEPTED = f"""
SELECT *, try_cast(o AS DECIMAL(15,6)) AS open_price, try_cast(h AS DECIMAL(15,6)) AS high_price,
       try_cast(l AS DECIMAL(15,6)) AS low_price, try_cast(c AS DECIMAL(15,6)) AS close_price,
       CAST(trunc(v) AS BIGINT) AS volume, try_cast(a AS DECIMAL(15,6)) AS adj_close_price, d AS price_date,
       COALESCE(symbol IS NOT NULL AND d IS NOT NULL AND {_OHLC} AND c < 1000000000, false) AS good
FROM parsed"""

ORACLES = {
    "nullify_na": oracle(_STAGE_KINDS, "SELECT * FROM stage"),
    "parse_stage": oracle(
        "source_file:s row_number:i symbol:s iso_day:d any_day:d close_number:f close_price:f volume:i "
        "adj_close_price:f valid_symbol:b path_symbol:s stem_symbol:s", r"""
SELECT source_file, row_number, symbol, d AS iso_day,
       COALESCE(d, CASE WHEN date_str LIKE '%/%/2024' THEN CAST(strptime(date_str, '%m/%d/%Y') AS DATE) END) AS any_day,
       c AS close_number, CASE WHEN c < 1000000000 THEN round(c, 6) END AS close_price,
       CAST(trunc(v) AS BIGINT) AS volume, a AS adj_close_price,
       symbol IS NOT NULL AND length(symbol) <= 10 AS valid_symbol,
       substr(split_part(regexp_extract(source_file, '([^/]*)\.csv$', 1), '_', 1), 1, 5) AS path_symbol,
       upper(regexp_extract(source_file, '([^/]*)\.csv$', 1)) AS stem_symbol
FROM parsed"""),
    "parse_date": oracle("o_orderkey:i text:s day:d", """
SELECT o_orderkey, text,
       CASE WHEN layout = '2' AND day(dt) <= 12 THEN make_date(year(dt), day(dt), month(dt)) ELSE dt END AS day
FROM (SELECT *, CASE layout WHEN '1' THEN month(dt) || '/' || day(dt) || '/' || year(dt)
                  WHEN '2' THEN strftime(dt, '%d/%m/%Y') WHEN '3' THEN strftime(dt, '%Y%m%d')
                  WHEN '4' THEN strftime(dt, '%m-%d-%Y')
                  ELSE year(dt) || '-' || month(dt) || '-' || day(dt) END AS text
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, substr(o_orderpriority, 1, 1) AS layout FROM orders) x) y"""),
    "classify_asset": oracle("p_partkey:i asset_type:s", f"""
SELECT p_partkey, CASE WHEN p_size <= {len(S.KNOWN_CRYPTO)} THEN 'CRYPTO' ELSE 'STOCK' END AS asset_type FROM part"""),
    "valid_ohlc": oracle(
        "source_file:s row_number:i symbol:s price_date:d open_price:f high_price:f low_price:f close_price:f "
        "volume:i adj_close_price:f", f"SELECT * FROM ({_ACCEPTED}) z WHERE good"),
    "rejected_rows": oracle("source_file:s row_number:i", f"SELECT * FROM ({_ACCEPTED}) z WHERE NOT good"),
    "scalar_functions": oracle(
        "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i trading_days:i ratio:f money:s", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN n <= 0 THEN 0 ELSE greatest(1, n * 5 // 7) END AS trading_days,
       CASE WHEN t = 0 THEN -1.0 ELSE round(l_extendedprice / t, 6) END AS ratio,
       CASE WHEN l_returnflag = 'R' THEN format('{:,.2f}', l_extendedprice) || ' CAD'
            ELSE '$' || format('{:,.2f}', l_extendedprice) END AS money
FROM (SELECT l.*, round(l_tax * 100) AS t,
             date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) + 1 AS n
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) x"""),
    "date_range_rows_daily": _steps(1),
    "date_range_rows_weekly": _steps(7),
    "date_range_rows_monthly": _steps(30),
    "is_market_hours": oracle("event_id:i open:b", """
SELECT t.event_id, CASE WHEN a.exchange IN ('NYSE', 'NASDAQ')
       THEN dayofweek(ts) BETWEEN 1 AND 5 AND hour(ts - INTERVAL 5 HOUR) BETWEEN 9 AND 16
       ELSE true END AS open
FROM ticks t JOIN asset a ON t.asset_id = a.asset_id"""),
    "score_quality": oracle(
        f"source_file:s {_SCORE_KINDS}", f"SELECT source_file, row_count, {_ROUNDED}, quality_score FROM scores", _SCORES),
    "score_quality_overall": oracle(_SCORE_KINDS, f"""
SELECT row_count, {_ROUNDED},
       round_even((completeness + validity + consistency + uniqueness) / 4, 2) AS quality_score
FROM (
    SELECT count(*) AS row_count,
           (count(*) * 3 - sum(missing)) / CAST(count(*) * 3 AS DOUBLE) * 100 AS completeness,
           count(CASE WHEN valid THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS validity,
           count(CASE WHEN priced AND consistent THEN 1 END)
               / CAST(count(CASE WHEN priced THEN 1 END) AS DOUBLE) * 100 AS consistency,
           count(CASE WHEN copies_overall = 1 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS uniqueness
    FROM flags) x""", _SCORES),
    "price_findings": oracle(
        "source_file:s row_number:i symbol:s date_str:s field:s value:s finding:s", """
SELECT source_file, row_number, symbol, date_str, 'open_str' AS field, open_str AS value, 'negative_prices' AS finding FROM parsed WHERE o < 0
UNION ALL SELECT source_file, row_number, symbol, date_str, 'high_str', high_str, 'negative_prices' FROM parsed WHERE h < 0
UNION ALL SELECT source_file, row_number, symbol, date_str, 'low_str', low_str, 'negative_prices' FROM parsed WHERE l < 0
UNION ALL SELECT source_file, row_number, symbol, date_str, 'close_str', close_str, 'negative_prices' FROM parsed WHERE c < 0
UNION ALL SELECT source_file, row_number, symbol, date_str, 'volume_str', volume_str, 'zero_volumes' FROM parsed WHERE v = 0
UNION ALL SELECT source_file, row_number, symbol, date_str, 'close_str', close_str, 'extreme_values' FROM moves""", _MOVES),
    "extreme_moves": oracle(_STAGE_KINDS, "SELECT * FROM moves", _MOVES),
    "quality_report": oracle(
        "source_file:s row_count:i column_count:i completeness:f validity:f consistency:f uniqueness:f "
        "duplicate_count:i negative_prices:i zero_volumes:i unique_symbols:i min_date:s max_date:s null_symbol:i "
        "null_date_str:i null_open_str:i null_high_str:i null_low_str:i null_close_str:i null_volume_str:i "
        "null_adj_close_str:i extreme_values:i quality_score:f schema_valid:b schema_error:s duplicate_percentage:f", f"""
SELECT s.source_file, s.row_count, 10 AS column_count,
       round(s.completeness, 6) AS completeness, round(s.validity, 6) AS validity,
       round(s.consistency, 6) AS consistency, round(s.uniqueness, 6) AS uniqueness, s.quality_score,
       f.duplicate_count, p.* EXCLUDE (source_file), COALESCE(m.n, 0) AS extreme_values, true AS schema_valid, NULL AS schema_error,
       round(f.duplicate_count / CAST(s.row_count AS DOUBLE) * 100, 6) AS duplicate_percentage
FROM scores s
JOIN (SELECT source_file, count(CASE WHEN copies > 1 THEN 1 END) AS duplicate_count FROM flags GROUP BY 1) f
  ON f.source_file = s.source_file
JOIN (SELECT source_file,
             count(CASE WHEN o < 0 THEN 1 END) + count(CASE WHEN h < 0 THEN 1 END)
               + count(CASE WHEN l < 0 THEN 1 END) + count(CASE WHEN c < 0 THEN 1 END) AS negative_prices,
             count(CASE WHEN v = 0 THEN 1 END) AS zero_volumes, count(DISTINCT symbol) AS unique_symbols,
             min(date_str) AS min_date, max(date_str) AS max_date,
             {', '.join(f'count(CASE WHEN {c} IS NULL THEN 1 END) AS null_{c}' for c in S.STAGE_COLUMNS)}
      FROM parsed GROUP BY 1) p ON p.source_file = s.source_file
LEFT JOIN (SELECT source_file, count(*) AS n FROM moves GROUP BY 1) m ON m.source_file = s.source_file""",
        {**_SCORES, **_MOVES}),
    "staging_issues": oracle("issue:s rows:i", r"""
SELECT issue, "rows" FROM (
    SELECT 'missing symbol' AS issue, count(*) AS "rows" FROM stage WHERE symbol IS NULL OR symbol = ''
    UNION ALL SELECT 'missing date', count(*) FROM stage WHERE date_str IS NULL OR date_str = ''
    UNION ALL SELECT 'missing close price', count(*) FROM stage WHERE close_str IS NULL OR close_str = ''
    UNION ALL SELECT 'invalid date format', count(*) FROM stage
        WHERE date_str <> '' AND NOT regexp_full_match(date_str, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
        AND NOT regexp_full_match(date_str, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
        AND NOT regexp_full_match(date_str, '[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}')
    UNION ALL SELECT 'invalid open_str', count(*) FROM stage WHERE open_str <> '' AND NOT regexp_full_match(open_str, '[0-9]*\.?[0-9]+')
    UNION ALL SELECT 'invalid high_str', count(*) FROM stage WHERE high_str <> '' AND NOT regexp_full_match(high_str, '[0-9]*\.?[0-9]+')
    UNION ALL SELECT 'invalid low_str', count(*) FROM stage WHERE low_str <> '' AND NOT regexp_full_match(low_str, '[0-9]*\.?[0-9]+')
    UNION ALL SELECT 'invalid close_str', count(*) FROM stage WHERE close_str <> '' AND NOT regexp_full_match(close_str, '[0-9]*\.?[0-9]+')
    UNION ALL SELECT 'duplicate symbol-date combinations', count(*) FROM (
        SELECT symbol, date_str FROM stage WHERE symbol IS NOT NULL AND date_str IS NOT NULL
        GROUP BY symbol, date_str HAVING count(*) > 1) k) x
WHERE "rows" > 0"""),
    "staging_summary": oracle("row_count:i symbol_count:i file_count:i min_date:s max_date:s", """
SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, count(DISTINCT source_file) AS file_count,
       min(date_str) AS min_date, max(date_str) AS max_date FROM stage"""),
    "quality_gate": oracle("source_file:s quality_score:f accepted:b", """
SELECT source_file, quality_score, quality_score >= 88 AS accepted FROM scores""", _SCORES),
    "quality_log": oracle("source_file:s check_name:s check_result:s score:f detail_rows:s", """
SELECT source_file, check_name, row_count AS detail_rows, round(v, 2) AS score,
       CASE WHEN v >= 100 THEN 'PASS' WHEN v >= lim THEN 'WARN' ELSE 'FAIL' END AS check_result
FROM (
    SELECT source_file, row_count, 'completeness' AS check_name, completeness AS v, 95 AS lim FROM scores
    UNION ALL SELECT source_file, row_count, 'validity', validity, 75 FROM scores
    UNION ALL SELECT source_file, row_count, 'consistency', consistency, 75 FROM scores
    UNION ALL SELECT source_file, row_count, 'uniqueness', uniqueness, 99 FROM scores) x""", _SCORES),
    "detect_duplicates": oracle(_STAGE_KINDS, """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY symbol, date_str) AS n FROM stage) x WHERE n > 1"""),
    "daily_returns": oracle("asset_id:i price_date:d daily_return:f", f"""
SELECT asset_id, price_date, round(r, 6) AS daily_return FROM ({_returns('price_gold')}) y"""),
    "daily_returns_history": oracle("asset_id:i price_date:d daily_return:f", f"""
SELECT asset_id, price_date, round(r, 6) AS daily_return FROM ({_returns('history_gold')}) y"""),
    "volatility": _volatility("price_gold", "sqrt(252)"),
    "volatility_history": _volatility("history_gold", "1"),
    "detect_outliers": oracle("asset_id:i price_date:d close_price:f is_outlier:b", """
SELECT g.asset_id, price_date, close_price,
       COALESCE(CAST(close_price AS DOUBLE) < q1 - (q3 - q1) * 1.5 OR CAST(close_price AS DOUBLE) > q3 + (q3 - q1) * 1.5, false) AS is_outlier
FROM price_gold g JOIN (
    SELECT asset_id, quantile_cont(CAST(close_price AS DOUBLE), 0.25) AS q1,
           quantile_cont(CAST(close_price AS DOUBLE), 0.75) AS q3 FROM price_gold GROUP BY asset_id) q
ON g.asset_id = q.asset_id"""),
    "detect_outliers_overall": oracle("o_orderkey:i o_totalprice:f is_outlier:b", """
SELECT o_orderkey, o_totalprice,
       o_totalprice < q1 - (q3 - q1) * 0.5 OR o_totalprice > q3 + (q3 - q1) * 0.5 AS is_outlier
FROM orders, (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders) q"""),
    "detect_outliers_zscore": oracle("asset_id:i price_date:d close_price:f is_outlier:b", """
SELECT g.asset_id, price_date, close_price, COALESCE(abs(close_price - m) > 2 * s, false) AS is_outlier
FROM price_gold g JOIN (
    SELECT asset_id, avg(CAST(close_price AS DOUBLE)) AS m, stddev_samp(CAST(close_price AS DOUBLE)) AS s
    FROM price_gold GROUP BY asset_id) q ON g.asset_id = q.asset_id"""),
    "check_ohlc": oracle("source_file:s row_number:i", """
SELECT * FROM parsed WHERE NOT COALESCE(
    h >= o AND h >= CASE WHEN c < 1e9 THEN c END AND l <= o AND l <= CASE WHEN c < 1e9 THEN c END
    AND h >= l AND o > 0 AND h > 0 AND l > 0 AND CASE WHEN c < 1e9 THEN c END > 0, true)"""),
    "check_intraday": oracle("source_file:s row_number:i", """
SELECT * FROM parsed WHERE NOT COALESCE(
    h >= o AND h >= CASE WHEN c < 1e9 THEN c END AND l <= o AND l <= CASE WHEN c < 1e9 THEN c END
    AND h >= l AND o > 0 AND h > 0 AND l > 0 AND CASE WHEN c < 1e9 THEN c END > 0 AND row_number % 3 <> 0, true)"""),
    "check_action_dates": oracle("action_id:i ex_date:d record_date:d", """
SELECT * FROM corporate_action WHERE record_date < ex_date OR payment_date < ex_date"""),
    "check_positive": oracle("action_id:i dividend_amount:f", """
SELECT * FROM dividend_cash WHERE dividend_amount <= 0 OR dividend_amount - 0.01 <= 0"""),
    "check_domain": oracle("batch_id:i status:s", "SELECT * FROM batch_meta WHERE status NOT IN ('RUNNING', 'SUCCESS')"),
    "check_unique": oracle("symbol:s date_str:s rows:i", """
SELECT symbol, date_str, count(*) AS "rows" FROM stage WHERE symbol IS NOT NULL AND date_str IS NOT NULL
GROUP BY symbol, date_str HAVING count(*) > 1"""),
    "check_unique_gold": oracle("asset_id:i price_date:d rows:i", """
SELECT asset_id, price_date, count(*) AS "rows" FROM price_gold GROUP BY asset_id, price_date HAVING count(*) > 1"""),
    "check_reference": oracle("price_id:i batch_id:i", """
SELECT * FROM price_raw WHERE batch_id NOT IN (SELECT batch_id FROM batch_meta WHERE status <> 'FAILED')"""),
    "check_not_null": oracle("source_file:s row_number:i", """
SELECT * FROM stage WHERE symbol IS NULL OR open_str IS NULL OR close_str IS NULL"""),
    "check_limits": oracle("source_file:s row_number:i", """
SELECT * FROM parsed WHERE length(symbol) > 13 OR length(date_str) > 13 OR length(volume_str) > 13 OR c >= 1e9"""),
    "symbol_overlaps": oracle("symbol:s exchanges:s exchange_count:i", """
SELECT symbol, string_agg(exchange, ',' ORDER BY exchange) AS exchanges, count(*) AS exchange_count
FROM exchange_lists GROUP BY symbol"""),
    "overlap_histogram": oracle("exchange_count:i symbols:i", """
SELECT exchange_count, count(*) AS symbols FROM (
    SELECT symbol, count(*) AS exchange_count FROM exchange_lists GROUP BY symbol) x GROUP BY exchange_count"""),
    "list_sizes": oracle("exchange:s symbols:i", "SELECT exchange, count(*) AS symbols FROM exchange_lists GROUP BY exchange"),
    "priority_mapping": oracle("symbol:s exchange:s", "SELECT * FROM mapping"),
    "match_symbols": oracle("symbol:s exchange:s side:s", """
SELECT COALESCE(m.symbol, a.symbol) AS symbol, m.exchange,
       CASE WHEN m.symbol IS NULL THEN 'stock_only' WHEN a.symbol IS NULL THEN 'mapping_only' ELSE 'matched' END AS side
FROM mapping m FULL JOIN (SELECT DISTINCT symbol FROM asset WHERE asset_type = 'STOCK' AND is_active) a
  ON m.symbol = a.symbol"""),
    "unmapped_symbols": oracle("symbol:s", """
SELECT DISTINCT symbol FROM asset WHERE asset_type = 'STOCK' AND is_active
AND symbol NOT IN (SELECT symbol FROM mapping)"""),
    "apply_exchanges": oracle("asset_id:i symbol:s asset_type:s exchange:s updated_at:t", f"""
SELECT a.asset_id, a.symbol, a.asset_type,
       CASE WHEN changed THEN m.exchange ELSE a.exchange END AS exchange,
       CASE WHEN changed THEN TIMESTAMP '{NEW_STAMP}' ELSE a.updated_at END AS updated_at
FROM (SELECT a.*, m.exchange AS mapped,
             COALESCE(a.asset_type = 'STOCK' AND m.exchange IS NOT NULL
                      AND (a.exchange IS NULL OR a.exchange <> m.exchange), false) AS changed
      FROM asset a LEFT JOIN mapping m ON a.symbol = m.symbol) a
LEFT JOIN mapping m ON a.symbol = m.symbol"""),
    "update_stats": oracle("total_symbols:i updated:i skipped:i stock_symbols:i coverage_pct:f", """
SELECT *, round(updated * 100.0 / stock_symbols, 6) AS coverage_pct FROM (
    SELECT count(m.symbol) AS total_symbols,
           count(CASE WHEN m.symbol IS NOT NULL AND (a.exchange IS NULL OR a.exchange <> m.exchange) THEN 1 END) AS updated,
           count(CASE WHEN a.exchange = m.exchange THEN 1 END) AS skipped, count(*) AS stock_symbols
    FROM asset a LEFT JOIN mapping m ON a.symbol = m.symbol
    WHERE a.asset_type = 'STOCK' AND a.is_active) x"""),
    "exchange_distribution": oracle("exchange:s symbol_count:i", """
SELECT COALESCE(exchange, 'NULL') AS exchange, count(*) AS symbol_count
FROM asset WHERE asset_type = 'STOCK' GROUP BY 1"""),
}
