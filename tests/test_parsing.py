from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricehouse.functions import parsing as P
from pricehouse.functions import scalars as X


def apply(spark, values, expression, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


TEXTS = ["1", " 2.5 ", "-3.", ".5", "1e3", "+4", "abc", "", "1d", "1f", "0x1p3", "inf", "-Infinity", "nan", "1 2", "--1", None]


def python_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def test_numbers_parse_as_python_floats(spark):
    got = apply(spark, TEXTS, P.to_number)
    want = [python_float(t) for t in TEXTS]
    assert [repr(x) for x in got] == [repr(x) for x in want]


def test_finite_price_and_volume(spark):
    assert apply(spark, ["nan", "inf", "1.0000005", "1e9", "12"], P.to_price)[0] is None
    assert [str(x) for x in apply(spark, ["inf", "1.0000005", "1e9", "12"], P.to_price)] == ["None", "1.000001", "None", "12.000000"]
    assert apply(spark, ["7.9", "-7.9", "x", "inf", None], P.to_volume) == [7, -7, None, None, None]


def test_iso_date_is_strict(spark):
    values = ["2024-01-05", "2024-1-5", "2024-001-05", "2024-13-01", "2024/01/05", "24-01-05", "2024-02-30", None]
    assert apply(spark, values, P.iso_date) == [date(2024, 1, 5), date(2024, 1, 5), None, None, None, None, None, None]


def test_parse_date_tries_layouts_in_order(spark):
    values = ["2024-01-05", "01/02/2024", "13/02/2024", "20240105", "01-02-2024", "25-12-2024", "5.1.2024", ""]
    assert apply(spark, values, P.parse_date) == [
        date(2024, 1, 5), date(2024, 1, 2), date(2024, 2, 13), date(2024, 1, 5), date(2024, 1, 2), date(2024, 12, 25), None, None]


def test_symbols(spark):
    assert apply(spark, ["aapl", "BTC-USD", "ABCDEFGHIJK", "A B", "", None], P.is_valid_symbol) == [True, True, False, False, False, False]
    paths = ["/d/AAPL_2024.csv", "/d/btc-usd.csv", "/d/googling.csv", "/d/12-ab_3.csv", "/d/123.csv", "/d/7x.data.csv"]
    assert apply(spark, paths, P.symbol_from_path) == ["AAPL", "BTC", "GOOGL", "AB", "UNKNOWN", "X"]
    assert apply(spark, ["/d/brk.b.csv", "/d/eth-usd.csv"], lambda c: P.symbol_from_stem(c, True)) == ["BRK.B", "ETH"]
    assert apply(spark, ["BTC", "AAPL", None], P.classify_asset) == ["CRYPTO", "STOCK", "STOCK"]


def test_na_tokens_match_pandas(spark):
    values = ["", "NA", "NaN", "n/a", "null", "None", "<NA>", "#N/A", "nil", "0", "Null", "NAN"]
    frame = pd.read_csv(pd.io.common.StringIO("v,w\n" + "".join(f"{v},x\n" for v in values)), dtype=str)
    want = [None if pd.isna(v) else v for v in frame["v"]]
    assert apply(spark, values, P.nullify_token) == want


def test_trading_days_and_steps(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 1, 2), date(2024, 1, 1))],
        "a DATE, b DATE")
    assert [r[0] for r in df.select(X.trading_days("a", "b")).collect()] == [1, 22, 0]
    for freq, step in (("D", 1), ("W", 7), ("M", 30)):
        got = [r[0] for r in df.select(F.size(X.date_steps("a", "b", freq))).collect()]
        assert got == [1, 30 // step + 1, 0]
    with pytest.raises(ValueError):
        X.date_steps("a", "b", "Y")


def test_divide_and_format(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0)], "a DOUBLE, b DOUBLE")
    assert [r[0] for r in df.select(X.safe_divide("a", "b", 9.0)).collect()] == [0.25, 9.0, None]
    money = spark.createDataFrame([(1234567.891, "usd"), (-5.0, "EUR")], "a DOUBLE, c STRING")
    assert [r[0] for r in money.select(X.format_currency("a", "c")).collect()] == ["$1,234,567.89", "-5.00 EUR"]


def test_market_hours(spark):
    rows = [
        (datetime(2024, 1, 5, 14, 0), "NYSE", True),     # Friday 9:00 New York
        (datetime(2024, 1, 5, 13, 59), "NASDAQ", False),
        (datetime(2024, 1, 5, 21, 59), "NYSE", True),    # 16:59
        (datetime(2024, 7, 5, 13, 0), "NYSE", True),     # summer time
        (datetime(2024, 1, 6, 15, 0), "NYSE", False),    # Saturday
        (datetime(2024, 1, 6, 3, 0), "CRYPTO", True),
        (datetime(2024, 1, 6, 3, 0), None, True),
    ]
    df = spark.createDataFrame([(r[0].isoformat(sep=" "), r[1], r[2]) for r in rows], "t STRING, e STRING, want BOOLEAN")
    got = df.select(X.is_market_hours(F.col("t").cast("timestamp"), "e").alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)
