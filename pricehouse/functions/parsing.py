"""Parsing and classification of text columns, as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse import schemas as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A filter on an ordinary computed column is pushed below the projection with
    its expression copied into every use; for costly parsing that multiplies the
    work. Columns that come out of a generator stay put.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def nullify_token(c: Column | str) -> Column:
    """NULL where the text is one of the missing-value tokens."""
    c = _col(c)
    return F.when(~c.isin(S.NA_TOKENS), c)


def iso_date(c: Column | str) -> Column:
    """``yyyy-M-d`` text as a date, anything else as NULL."""
    c = _col(c)
    return F.when(c.rlike(S.ISO_DATE) & (c >= "0001"), c.try_cast("date"))


def parse_date(c: Column | str) -> Column:
    """Text in any accepted layout as a date; month-first wins over day-first."""
    c = _col(c)
    return F.coalesce(
        *[F.when(c.rlike(shape), F.try_to_date(c, fmt)) for shape, fmt in S.DATE_FORMATS]
    )


def to_number(c: Column | str) -> Column:
    """Text as a double; text that is not a number becomes NULL.

    The cast alone takes ``1d`` or ``0x1p3``; texts with such letters have their
    shape checked, the usual ones are spared the pattern.
    """
    c = _col(c)
    letters = reduce(lambda a, b: a | b, [F.contains(c, F.lit(x)) for x in "dDfFxX"])
    return F.when(~letters | c.rlike(S.NUMBER), c.try_cast("double"))


def to_finite(c: Column | str) -> Column:
    """As :func:`to_number`, with NaN turned into NULL."""
    return F.nanvl(to_number(c), F.lit(None).cast("double"))


def to_price(c: Column | str) -> Column:
    """Text as decimal(15,6); NaN, infinities and overflow become NULL."""
    return to_finite(c).try_cast("decimal(15,6)")


def to_volume(c: Column | str) -> Column:
    """Text as a whole number, cut towards zero; unparsable text becomes NULL."""
    return to_finite(c).try_cast("bigint")


def is_valid_symbol(c: Column | str) -> Column:
    """1-10 letters, digits or dashes, in any case; NULL is not valid."""
    return F.coalesce(F.upper(_col(c)).rlike(S.VALID_SYMBOL), F.lit(False))


def classify_asset(c: Column | str) -> Column:
    return F.when(_col(c).isin(S.KNOWN_CRYPTO), F.lit("CRYPTO")).otherwise(F.lit("STOCK"))


def file_stem(name: Column | str) -> Column:
    """File name without its last extension (and without folders)."""
    base = F.regexp_extract(_col(name), "([^/]*)$", 1)
    return F.when(
        base.rlike(r"^.+\.[^.]*$"), F.regexp_extract(base, r"^(.+)\.[^.]*$", 1)
    ).otherwise(base)


def symbol_from_path(path: Column | str) -> Column:
    """Ticker guessed from a file name; ``UNKNOWN`` when no letter is found."""
    stem = F.upper(file_stem(path))
    tries = [F.nullif(F.regexp_extract(stem, p, 1), F.lit("")) for p in S.SYMBOL_PATTERNS]
    rest = F.nullif(F.regexp_replace(stem, "[^A-Z-]", ""), F.lit(""))
    return F.coalesce(*tries, rest, F.lit("UNKNOWN"))


def symbol_from_stem(path: Column | str, strip_usd: bool = False) -> Column:
    """Upper-cased file stem as ticker, for one-ticker-per-file folders."""
    stem = F.upper(file_stem(path))
    return F.replace(stem, F.lit("-USD"), F.lit("")) if strip_usd else stem


def is_consistent_ohlc(o: Column, h: Column, lo: Column, c: Column) -> Column:
    """High covers, low undercuts, all positive. NaN or NULL gives NULL or false."""
    positive = reduce(lambda a, b: a & b, [x > 0 for x in (o, h, lo, c)])
    return (h >= F.greatest(o, c)) & (lo <= F.least(o, c)) & (h >= lo) & positive
