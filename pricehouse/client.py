"""The read interface of one warehouse: queries bound to its tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from pricehouse.plans import marts as M
from pricehouse.plans import queries as Q
from pricehouse.plans.store import Store


class PriceClient:
    """Queries over the published tables of a store; every result is a DataFrame."""

    def __init__(self, store: Store):
        self.store = store

    @property
    def gold(self) -> DataFrame:
        return self.store.read("price_gold")

    @property
    def asset(self) -> DataFrame:
        return self.store.read("asset")

    def prices(self, tickers: Sequence[str], start: date | str, end: date | str) -> DataFrame:
        if str(end) < str(start):
            raise ValueError("the end lies before the start")
        return Q.prices(self._bars_of(tickers, start, end), tickers, start, end)

    def total_return(self, ticker: str, start: date | str, end: date | str) -> DataFrame:
        return Q.total_return(self._bars_of([ticker], start, end), ticker, start, end)

    def _bars_of(self, tickers: Sequence[str], start: date | str, end: date | str) -> DataFrame:
        """Gold from the files that can hold the tickers."""
        return self.store.gold_of([t.upper() for t in tickers], int(str(start)[:4]), int(str(end)[:4]))

    def available_symbols(self, asset_type: str | None = None, exchange: str | None = None) -> DataFrame:
        return Q.available_symbols(self.asset, asset_type, exchange)

    def asset_info(self, symbol: str, asset_type: str | None = None) -> DataFrame:
        return Q.asset_info(self.asset, symbol, asset_type)

    def latest_prices(self, symbols: Sequence[str] | None = None, limit: int = 100) -> DataFrame:
        return Q.latest_prices_join(self.gold, symbols, limit)

    def price_summary(self, symbol: str, days: int = 30, as_of: date | str | None = None) -> DataFrame:
        return Q.price_summary(self.gold, symbol, days, as_of)

    def date_range(self, symbol: str | None = None) -> DataFrame:
        return Q.date_range(self.gold, symbol)

    def health(self) -> DataFrame:
        read = self.store.read
        return Q.warehouse_counts(read("asset"), read("price_raw"), read("batch_meta"), self.gold)

    def status(self) -> DataFrame:
        return Q.table_stats(self.gold)

    def freshness(self, max_age_hours: float = 24) -> DataFrame:
        return Q.freshness(self.store.read("price_raw"), self.gold, max_age_hours)

    def asset_summary(self) -> DataFrame:
        return M.asset_summary(self.asset, self.gold)

    def data_quality_summary(self) -> DataFrame:
        return M.data_quality_summary(self.store.read("batch_meta"), self.store.read("data_source"))

    def recent_price_changes(self, as_of: date | str, days: int = 30) -> DataFrame:
        return M.recent_price_changes(self.gold, as_of, days)

    def sources(self) -> DataFrame:
        return Q.list_sources(self.store.read("data_source"))

    def recent_batches(self, n: int = 20) -> DataFrame:
        return Q.recent_batches(self.store.read("batch_meta"), n)
