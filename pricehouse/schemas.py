"""Table layouts, domains and fixed values of the price warehouse."""

from __future__ import annotations

# --- table layouts (Spark DDL strings) --------------------------------------

ASSET = """
    asset_id INT, symbol STRING, asset_type STRING, currency STRING,
    exchange STRING, company_name STRING, sector STRING, industry STRING,
    market_cap BIGINT, is_active BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP
"""

DATA_SOURCE = """
    source_id INT, source_name STRING, source_type STRING, base_url STRING,
    api_key_required BOOLEAN, rate_limit_per_minute INT, is_active BOOLEAN,
    created_at TIMESTAMP
"""

BATCH_META = """
    batch_id INT, source_id INT, batch_name STRING, file_path STRING,
    file_size_bytes BIGINT, row_count INT, start_time TIMESTAMP,
    end_time TIMESTAMP, status STRING, error_message STRING,
    quality_score DECIMAL(5,2)
"""

PRICE_RAW = """
    price_id BIGINT, asset_id INT, batch_id INT, source_id INT,
    price_date DATE, granularity STRING, open_price DECIMAL(15,6),
    high_price DECIMAL(15,6), low_price DECIMAL(15,6),
    close_price DECIMAL(15,6), volume BIGINT, adj_close_price DECIMAL(15,6),
    created_at TIMESTAMP, load_seq BIGINT, row_number BIGINT
"""

#: Events of batches: 0 created, 1 ended. An event gives what it changes.
BATCH_LOG = BATCH_META + ", event INT"

#: What a load left out: records that do not parse, and whole files (no row number).
QUARANTINE = """
    load_seq BIGINT, source_file STRING, row_number BIGINT, reason STRING, symbol STRING,
    date_str STRING, open_str STRING, high_str STRING, low_str STRING, close_str STRING,
    volume_str STRING, adj_close_str STRING
"""

#: Checks of the batches of loads.
QUALITY_LOG = """
    batch_id INT, check_name STRING, check_result STRING, score DECIMAL(5,2), details MAP<STRING, STRING>, checked_at TIMESTAMP
"""

#: Days and assets that a load brought, as bitmaps.
COVERAGE_LOG = """
    load_seq BIGINT, source_id INT, kind STRING, bucket BIGINT, bits BINARY, least BIGINT, most BIGINT
"""

STAGE_COLUMNS = [
    "symbol", "date_str", "open_str", "high_str", "low_str",
    "close_str", "volume_str", "adj_close_str",
]
REQUIRED_STAGE_COLUMNS = [
    "symbol", "date_str", "open_str", "high_str", "low_str", "close_str",
    "volume_str",
]
PRICE_STRINGS = ["open_str", "high_str", "low_str", "close_str"]
PRICE_KEY = ["asset_id", "price_date", "source_id", "granularity"]

GOLD_COLUMNS = [
    "price_id", "asset_id", "symbol", "asset_type", "currency", "exchange",
    "company_name", "price_date", "open_price", "high_price", "low_price",
    "close_price", "volume", "adj_close_price", "source_name", "created_at",
]

# --- fixed values -------------------------------------------------------------
# Everything below must hold exactly these values for results to be right.

ASSET_TYPES = ["STOCK", "ETF", "CRYPTO", "INDEX", "BOND", "COMMODITY"]
GRANULARITIES = ["DAILY", "MIN1", "MIN5", "MIN15", "MIN30", "HOUR1", "HOUR4"]
INTRADAY_GRANULARITIES = ["MIN1", "MIN5", "MIN15", "MIN30", "HOUR1", "HOUR4"]
SOURCE_TYPES = ["API", "FILE", "MANUAL"]
BATCH_STATUSES = ["RUNNING", "SUCCESS", "FAILED", "PARTIAL"]
CHECK_RESULTS = ["PASS", "WARN", "FAIL"]
ACTION_TYPES = [
    "DIVIDEND_CASH", "DIVIDEND_STOCK", "STOCK_SPLIT", "STOCK_MERGER",
    "SPIN_OFF", "RIGHTS_ISSUE", "SPECIAL_DIVIDEND",
]

MIN_QUALITY_SCORE = 75.0
MAX_NULL_PCT = 5.0
MAX_DUPLICATE_PCT = 1.0
EXTREME_MOVE_PCT = 50.0
GOLD_REFRESH_FILES = 100
MAX_GOLD_AGE_HOURS = 24
TRADING_DAYS_PER_YEAR = 252
MAX_SYMBOL_LENGTH = 20

EXCHANGE_PRIORITY = ["NYSE", "NASDAQ", "AMEX", "TSX"]

# Accepted header names per staging column, first match wins.
COLUMN_ALIASES = {
    "date_str": ["date", "time", "timestamp", "trade_date"],
    "open_str": ["open"],
    "high_str": ["high"],
    "low_str": ["low"],
    "close_str": ["close", "price"],
    "adj_close_str": ["adj close", "adjclose", "adjusted close", "adj_close"],
    "volume_str": ["volume", "vol"],
    "symbol": ["symbol", "ticker"],
}

# Strings read as missing in price files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

KNOWN_CRYPTO = [
    "BTC", "ETH", "XRP", "LTC", "BCH", "ADA", "DOT", "LINK", "XLM",
    "USDC", "UNI", "DOGE", "WBTC", "AAVE", "ATOM", "SOL", "ETC",
    "FIL", "TRX", "XMR", "XTZ", "EOS", "MKR", "SNX", "COMP", "SUSHI",
    "YFI", "ZRX", "MANA", "STORJ", "FLR", "ALGO", "MATIC", "DAI",
    "ZEC", "BAT", "AVAX", "CELO",
]

# File-name patterns for a ticker, tried in order on the upper-cased stem.
SYMBOL_PATTERNS = ["^([A-Z]{1,5})", "([A-Z]{1,5})_", "([A-Z]{1,5})-", "([A-Z-]{1,10})"]
VALID_SYMBOL = "^[A-Z0-9-]{1,10}$"
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
ISO_DATE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
STAGE_DATES = [
    "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$",
    "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$",
]
STAGE_PRICE = r"^[0-9]*\.?[0-9]+$"

# (shape guard, Spark date pattern), tried in order.
DATE_FORMATS = [
    ("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    ("^[0-9]{8}$", "yyyyMMdd"),
    ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "M-d-yyyy"),
    ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "d-M-yyyy"),
]

# source_name, source_type, base_url, api_key_required, rate_limit_per_minute
SEED_SOURCES = [
    ("KAGGLE_UPLOAD", "FILE", None, False, None),
    ("MANUAL_CSV", "FILE", None, False, None),
    ("YAHOO_CSV_DOWNLOAD", "FILE", "https://finance.yahoo.com", False, None),
    ("YAHOO_FINANCE_API", "API", "https://query1.finance.yahoo.com", False, 2000),
    ("ALPHA_VANTAGE", "API", "https://www.alphavantage.co/query", True, 5),
    ("POLYGON_IO", "API", "https://api.polygon.io", True, 1000),
    ("FINNHUB", "API", "https://finnhub.io/api/v1", True, 60),
    ("IEX_CLOUD", "API", "https://cloud.iexapis.com/stable", True, 100),
    ("BINANCE_API", "API", "https://api.binance.com", False, 1200),
    ("COINBASE_API", "API", "https://api.exchange.coinbase.com", False, 10),
    ("CRYPTOCOMPARE", "API", "https://min-api.cryptocompare.com", True, 100),
    ("MANUAL_ENTRY", "MANUAL", None, False, None),
]

# symbol, asset_type, currency, exchange, company_name, sector
SEED_ASSETS = [
    ("AAPL", "STOCK", "USD", "NASDAQ", "Apple Inc.", "Technology"),
    ("MSFT", "STOCK", "USD", "NASDAQ", "Microsoft Corporation", "Technology"),
    ("GOOGL", "STOCK", "USD", "NASDAQ", "Alphabet Inc.", "Technology"),
    ("AMZN", "STOCK", "USD", "NASDAQ", "Amazon.com Inc.", "Consumer Discretionary"),
    ("TSLA", "STOCK", "USD", "NASDAQ", "Tesla Inc.", "Consumer Discretionary"),
    ("META", "STOCK", "USD", "NASDAQ", "Meta Platforms Inc.", "Technology"),
    ("NVDA", "STOCK", "USD", "NASDAQ", "NVIDIA Corporation", "Technology"),
    ("SPY", "ETF", "USD", "NYSE", "SPDR S&P 500 ETF Trust", "Equity"),
    ("QQQ", "ETF", "USD", "NASDAQ", "Invesco QQQ Trust", "Equity"),
    ("VTI", "ETF", "USD", "NYSE", "Vanguard Total Stock Market ETF", "Equity"),
    ("IWM", "ETF", "USD", "NYSE", "iShares Russell 2000 ETF", "Equity"),
    ("BTC-USD", "CRYPTO", "USD", "CRYPTO", "Bitcoin", "Cryptocurrency"),
    ("ETH-USD", "CRYPTO", "USD", "CRYPTO", "Ethereum", "Cryptocurrency"),
    ("ADA-USD", "CRYPTO", "USD", "CRYPTO", "Cardano", "Cryptocurrency"),
    ("SOL-USD", "CRYPTO", "USD", "CRYPTO", "Solana", "Cryptocurrency"),
]
