"""Calendar, market-hours and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse.functions.parsing import _col

STEP_DAYS = {"D": 1, "W": 7, "M": 30}


def trading_days(start: Column | str, end: Column | str) -> Column:
    """Rough trading-day count, five of seven days and at least one."""
    days = F.datediff(_col(end), _col(start)) + 1
    return F.when(days <= 0, F.lit(0)).otherwise(
        F.greatest(F.lit(1), F.floor(days * 5 / 7).cast("int"))
    )


def date_steps(start: Column | str, end: Column | str, freq: str = "D") -> Column:
    """Array of dates from ``start`` to ``end``; a month counts 30 days."""
    if freq not in STEP_DAYS:
        raise ValueError(f"Unsupported frequency: {freq}")
    start, end = _col(start), _col(end)
    step = F.expr(f"interval {STEP_DAYS[freq]} days")
    return F.when(start <= end, F.sequence(start, end, step)).otherwise(
        F.array().cast("array<date>")
    )


def date_range_rows(df: DataFrame, start: str, end: str, freq: str = "D") -> DataFrame:
    """One output row per input row and date step, in column ``day``."""
    return df.withColumn("day", F.explode(date_steps(start, end, freq)))


def safe_divide(a: Column | str, b: Column | str, default: float = 0.0) -> Column:
    """``a / b`` as double, ``default`` where ``b`` is zero."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.when(b == 0, F.lit(float(default))).otherwise(F.try_divide(a, b))


def format_currency(amount: Column | str, currency: Column | str) -> Column:
    """``$1,234.50`` for US dollars, ``1,234.50 CAD`` for others."""
    amount, currency = _col(amount), _col(currency)
    text = F.format_number(amount, 2)
    return F.when(F.upper(currency) == "USD", F.concat(F.lit("$"), text)).otherwise(
        F.concat(text, F.lit(" "), currency)
    )


def is_market_hours(ts: Column | str, exchange: Column | str) -> Column:
    """Weekdays, 9 to 16 o'clock New York, for NYSE and NASDAQ; else always open.

    The weekday is taken in the session time zone, the hour in New York.
    """
    ts, exchange = _col(ts), _col(exchange)
    weekday = F.dayofweek(ts) - 1
    new_york = F.convert_timezone(None, F.lit("America/New_York"), ts.cast("timestamp_ntz"))
    listed = F.coalesce(exchange.isin("NYSE", "NASDAQ"), F.lit(False))
    return F.when(listed, weekday.between(1, 5) & F.hour(new_york).between(9, 16)).otherwise(
        F.lit(True)
    )
