"""The warehouse tables as DuckDB common table expressions.

Each entry mirrors one table of ``pricehouse.fixtures``; ``with_tables`` puts
the ones a query needs, and what they need in turn, in front of it.
"""

from __future__ import annotations

import re

_SOURCE = """CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
    WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END"""
_SYMBOL = """CASE WHEN {u} % 5 = 4 THEN 'U' || lpad(CAST({u} AS VARCHAR), 9, '0') || '-USD'
    ELSE 'U' || lpad(CAST({u} AS VARCHAR), 9, '0') END"""

TABLES = {
    "ticks": f"""
SELECT event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type, value,
       user_id + 1 AS asset_id, {_SOURCE} AS source_id,
       {_SOURCE} * 1000000 + date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS batch_id
FROM events""",
    "data_source": f"""
SELECT DISTINCT {_SOURCE} AS source_id, upper(event_type) AS source_name,
       CASE event_type WHEN 'click' THEN 'API' WHEN 'view' THEN 'API'
            WHEN 'error' THEN 'MANUAL' ELSE 'FILE' END AS source_type,
       'https://prices.example/' || event_type AS base_url,
       event_type IN ('click', 'view') AS api_key_required,
       CASE event_type WHEN 'click' THEN 60 WHEN 'view' THEN 1000 END AS rate_limit_per_minute,
       event_type <> 'error' AS is_active,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at
FROM events""",
    "asset": f"""
SELECT user_id + 1 AS asset_id,
       {_SYMBOL.format(u='user_id')} AS symbol,
       CASE user_id % 5 WHEN 3 THEN 'ETF' WHEN 4 THEN 'CRYPTO' ELSE 'STOCK' END AS asset_type,
       CASE WHEN user_id % 7 = 4 THEN 'CAD' ELSE 'USD' END AS currency,
       CASE user_id % 7 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NASDAQ' WHEN 2 THEN 'NYSE'
            WHEN 3 THEN 'AMEX' WHEN 4 THEN 'TSX' END AS exchange,
       CASE WHEN user_id % 4 <> 0 THEN 'Company ' || user_id END AS company_name,
       CASE user_id % 3 WHEN 0 THEN 'Technology' WHEN 1 THEN 'Energy' END AS sector,
       CAST(NULL AS VARCHAR) AS industry,
       user_id * 1000000 AS market_cap,
       user_id % 11 <> 0 AS is_active,
       min(ts) AS created_at, max(ts) AS updated_at
FROM events GROUP BY user_id""",
    "price_raw": """
SELECT min(event_id) AS price_id, asset_id, batch_id, source_id, day AS price_date,
       'DAILY' AS granularity,
       CAST(arg_min(value, row(ts, event_id)) AS DECIMAL(15,6)) AS open_price,
       CAST(max(value) AS DECIMAL(15,6)) AS high_price,
       CAST(min(value) AS DECIMAL(15,6)) AS low_price,
       CAST(arg_max(value, row(ts, event_id)) AS DECIMAL(15,6)) AS close_price,
       count(*) AS volume,
       CASE WHEN source_id <> 2 THEN
            CAST(arg_min(value, row(ts, event_id)) * 0.5 + arg_max(value, row(ts, event_id)) * 0.5
                 AS DECIMAL(15,6)) END AS adj_close_price,
       max(ts) AS created_at
FROM ticks GROUP BY asset_id, source_id, batch_id, day""",
    "price_raw_intraday": """
SELECT min(event_id) AS price_id, asset_id, batch_id, source_id,
       date_trunc('hour', ts) AS price_datetime, 'HOUR1' AS granularity,
       CAST(arg_min(value, row(ts, event_id)) AS DECIMAL(15,6)) AS open_price,
       CAST(max(value) AS DECIMAL(15,6)) AS high_price,
       CAST(min(value) AS DECIMAL(15,6)) AS low_price,
       CAST(arg_max(value, row(ts, event_id)) AS DECIMAL(15,6)) AS close_price,
       count(*) AS volume, count(*) AS trade_count,
       CAST(round(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE)
                  / (count(*) * CAST(100 AS DOUBLE)), 6) AS DECIMAL(15,6)) AS vwap,
       max(ts) AS created_at
FROM ticks GROUP BY asset_id, source_id, batch_id, date_trunc('hour', ts)""",
    "batch_meta": """
SELECT batch_id, source_id,
       upper(event_type) || '_' || strftime(day, '%Y%m%d') AS batch_name,
       '/incoming/' || event_type || '_' || CAST(day AS VARCHAR) || '.csv' AS file_path,
       count(*) * 64 AS file_size_bytes, count(*) AS row_count, min(ts) AS start_time,
       CASE WHEN batch_id % 10 <> 9 THEN max(ts) END AS end_time,
       CASE batch_id % 10 WHEN 7 THEN 'FAILED' WHEN 3 THEN 'PARTIAL' WHEN 9 THEN 'RUNNING'
            ELSE 'SUCCESS' END AS status,
       CASE WHEN batch_id % 10 = 7 THEN 'load failed' END AS error_message,
       CAST(60 + batch_id % 41 AS DECIMAL(5,2)) AS quality_score
FROM ticks GROUP BY source_id, batch_id, event_type, day""",
    "price_gold": """
SELECT price_id, asset_id, symbol, asset_type, currency, exchange, company_name, price_date,
       open_price, high_price, low_price, close_price, volume, adj_close_price, source_name,
       created_at
FROM (
    SELECT p.*, a.symbol, a.asset_type, a.currency, a.exchange, a.company_name, s.source_name,
           row_number() OVER (PARTITION BY p.asset_id, p.price_date
               ORDER BY b.start_time DESC, p.created_at DESC, p.price_id DESC) AS rn
    FROM price_raw p
    JOIN asset a ON p.asset_id = a.asset_id
    JOIN data_source s ON p.source_id = s.source_id
    JOIN batch_meta b ON p.batch_id = b.batch_id
    WHERE a.is_active AND b.status = 'SUCCESS' AND p.granularity = 'DAILY'
) ranked WHERE rn = 1""",
    "corporate_action": """
SELECT event_id AS action_id, asset_id, action_type, day AS ex_date,
       CASE WHEN value > 150 THEN day - INTERVAL 1 DAY ELSE day + INTERVAL 2 DAY END::DATE AS record_date,
       (day + INTERVAL 30 DAY)::DATE AS payment_date, source_id, batch_id, value
FROM (
    SELECT *, CASE WHEN event_type = 'signup' THEN 'DIVIDEND_CASH'
                   WHEN event_type = 'error' AND value > 100 THEN 'STOCK_SPLIT'
                   WHEN event_type = 'purchase' AND value > 200 THEN 'DIVIDEND_STOCK' END AS action_type
    FROM ticks) t
WHERE action_type IS NOT NULL""",
    "dividend_cash": """
SELECT action_id, CAST(round(value * 100) / 10000 AS DECIMAL(10,4)) AS dividend_amount
FROM corporate_action WHERE action_type = 'DIVIDEND_CASH'""",
    "stock_split": """
SELECT action_id, action_id % 2 + 1 AS split_ratio_from, action_id % 3 + 2 AS split_ratio_to
FROM corporate_action WHERE action_type = 'STOCK_SPLIT'""",
    "dividend_stock": """
SELECT action_id, CAST(round(value * 100) / 100000 AS DECIMAL(8,6)) AS dividend_ratio
FROM corporate_action WHERE action_type = 'DIVIDEND_STOCK'""",
    # As text, before missing-value tokens are cleared.
    "raw_stage": f"""
SELECT CASE WHEN k % 61 <> 0 THEN {_SYMBOL.format(u='(asset_id - 1)')} END AS symbol,
       CASE WHEN k % 29 = 0 THEN '2024/13/45'
            WHEN k % 59 = 0 THEN month(price_date) || '/' || day(price_date) || '/' || year(price_date)
            ELSE CAST(price_date AS VARCHAR) END AS date_str,
       CASE WHEN k % 37 = 0 THEN 'N/A' ELSE o END AS open_str,
       CASE WHEN k % 41 = 0 THEN l ELSE h END AS high_str,
       CASE WHEN k % 41 = 0 THEN h ELSE l END AS low_str,
       CASE WHEN k % 31 = 0 THEN 'abc' WHEN k % 43 = 0 THEN '-' || c WHEN k % 71 = 0 THEN '1e2'
            WHEN k % 73 = 0 THEN 'inf' WHEN k % 79 = 0 THEN 'nan' WHEN k % 83 = 0 THEN '' ELSE c
       END AS close_str,
       CASE WHEN k % 47 = 0 THEN '0' WHEN k % 53 = 0 THEN 'x1' ELSE volume || '.7' END AS volume_str,
       COALESCE(a, 'null') AS adj_close_str,
       '/incoming/' || source_name || '_w' || ((day(price_date) - 1) // 7) || '.csv' AS source_file,
       k * 2 + copy + 1 AS row_number
FROM (
    SELECT p.*, p.price_id AS k, s.source_name, u.copy,
           CAST(CAST(open_price AS DECIMAL(15,2)) AS VARCHAR) AS o,
           CAST(CAST(high_price AS DECIMAL(15,2)) AS VARCHAR) AS h,
           CAST(CAST(low_price AS DECIMAL(15,2)) AS VARCHAR) AS l,
           CAST(CAST(close_price AS DECIMAL(15,2)) AS VARCHAR) AS c,
           CAST(CAST(adj_close_price AS DECIMAL(15,2)) AS VARCHAR) AS a
    FROM price_raw p JOIN data_source s ON p.source_id = s.source_id
    JOIN (SELECT 0 AS copy UNION ALL SELECT 1) u ON u.copy = 0 OR p.price_id % 23 = 0
) t""",
    "stage": """
SELECT symbol, date_str, {n_open} AS open_str, {n_high} AS high_str, {n_low} AS low_str,
       {n_close} AS close_str, {n_volume} AS volume_str, {n_adj} AS adj_close_str,
       source_file, row_number
FROM raw_stage""".format(
        **{
            f"n_{c}": f"CASE WHEN {c2} NOT IN ('', 'N/A', 'nan', 'null') THEN {c2} END"
            for c, c2 in [("open", "open_str"), ("high", "high_str"), ("low", "low_str"),
                          ("close", "close_str"), ("volume", "volume_str"), ("adj", "adj_close_str")]
        }
    ),
    # Parsed staging rows. Only shapes the fixture holds need care here.
    "parsed": r"""
SELECT *,
       CASE WHEN regexp_full_match(date_str, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
            THEN try_cast(date_str AS DATE) END AS d,
       try_cast(open_str AS DOUBLE) AS o, try_cast(high_str AS DOUBLE) AS h,
       try_cast(low_str AS DOUBLE) AS l, try_cast(close_str AS DOUBLE) AS c,
       try_cast(volume_str AS DOUBLE) AS v, try_cast(adj_close_str AS DOUBLE) AS a
FROM stage""",
    "exchange_lists": f"""
SELECT DISTINCT CASE event_type WHEN 'signup' THEN 'NYSE' WHEN 'purchase' THEN 'NASDAQ'
       WHEN 'view' THEN 'AMEX' ELSE 'TSX' END AS exchange,
       {_SYMBOL.format(u='user_id')} AS symbol
FROM events WHERE user_id % 4 <> CASE event_type WHEN 'signup' THEN 0
    WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 ELSE 3 END""",
    "mapping": """
SELECT symbol, CASE min(CASE exchange WHEN 'NYSE' THEN 0 WHEN 'NASDAQ' THEN 1 WHEN 'AMEX' THEN 2
       ELSE 3 END) WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' WHEN 2 THEN 'AMEX' ELSE 'TSX' END AS exchange
FROM exchange_lists GROUP BY symbol""",
    "trades": """
SELECT l_suppkey + 1 AS asset_id,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS source_id,
       CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END * 100000
           + year(l_shipdate) * 12 + month(l_shipdate) AS batch_id,
       CAST(l_shipdate AS DATE) AS price_date, l_orderkey * 8 + l_linenumber AS trade_id,
       l_extendedprice AS price, l_quantity AS quantity
FROM lineitem""",
    "history_asset": """
SELECT s_suppkey + 1 AS asset_id, 'S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS symbol,
       'STOCK' AS asset_type, 'USD' AS currency, n_name AS exchange, s_name AS company_name,
       s_acctbal > 0 AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "history_price_raw": """
SELECT asset_id, source_id, batch_id, price_date, 'DAILY' AS granularity, price_id,
       CAST(f AS DECIMAL(15,6)) AS open_price, CAST(hi AS DECIMAL(15,6)) AS high_price,
       CAST(lo AS DECIMAL(15,6)) AS low_price, CAST(la AS DECIMAL(15,6)) AS close_price, volume,
       CAST(la AS DECIMAL(15,6)) AS adj_close_price, CAST(price_date AS TIMESTAMP) AS created_at
FROM (
    SELECT asset_id, source_id, batch_id, price_date, min(trade_id) AS price_id,
           arg_min(price, row(trade_id, price)) AS f, arg_max(price, row(trade_id, price)) AS la,
           max(price) AS hi, min(price) AS lo, sum(CAST(quantity AS BIGINT)) AS volume
    FROM trades GROUP BY asset_id, source_id, batch_id, price_date) b""",
    "history_batch_meta": """
SELECT batch_id, source_id, count(*) AS row_count,
       CAST(min(price_date) AS TIMESTAMP) AS start_time,
       CASE batch_id % 10 WHEN 7 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM trades GROUP BY batch_id, source_id""",
    "history_gold": """
SELECT price_id, asset_id, symbol, asset_type, currency, exchange, company_name, price_date,
       open_price, high_price, low_price, close_price, volume, adj_close_price, source_name,
       created_at
FROM (
    SELECT p.*, a.symbol, a.asset_type, a.currency, a.exchange, a.company_name,
           CASE p.source_id WHEN 1 THEN 'FLAG_A' WHEN 2 THEN 'FLAG_N' ELSE 'FLAG_R' END AS source_name,
           row_number() OVER (PARTITION BY p.asset_id, p.price_date
               ORDER BY b.start_time DESC, p.created_at DESC, p.price_id DESC) AS rn
    FROM history_price_raw p
    JOIN history_asset a ON p.asset_id = a.asset_id
    JOIN history_batch_meta b ON p.batch_id = b.batch_id
    WHERE a.is_active AND b.status = 'SUCCESS'
) ranked WHERE rn = 1""",
}


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """``sql`` preceded by the table expressions it refers to."""
    known = {**TABLES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for name in known:
            if name in seen or not re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                continue
            visit(known[name], seen + (name,))
            if name not in needed:
                needed.append(name)

    visit(sql, ())
    if not needed:
        return sql
    parts = ",\n".join(f"{name} AS ({known[name]})" for name in needed)
    return f"WITH {parts}\n{sql}"


_KINDS = {
    "s": "CAST({c} AS VARCHAR)",
    "i": "CAST({c} AS BIGINT)",
    "f": "CAST({c} AS DOUBLE)",
    "b": "{c}",
    "d": "CAST({c} AS VARCHAR)",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
}


def oracle(columns: str, sql: str, extra: dict[str, str] | None = None) -> str:
    """Wrap ``sql`` so that its columns have plain comparable types.

    ``columns`` lists ``name:kind``; the kind is s(tring), i(nteger), f(loat),
    b(oolean), d(ate as text) or t(imestamp as text).
    """
    picks = []
    for item in columns.split():
        name, kind = item.split(":")
        picks.append(f"{_KINDS[kind].format(c=name)} AS {name}")
    return with_tables(f"SELECT {', '.join(picks)}\nFROM ({sql.strip()}) q", extra)
