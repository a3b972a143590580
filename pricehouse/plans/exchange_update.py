"""The exchange update: lists, mapping, backup, update, verification."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricehouse.operators import exchanges as E
from pricehouse.plans.store import Store
from pricehouse.session import materialize
from pricehouse.sources.lists import backup_exchanges, read_exchange_lists


def update_exchanges(
    store: Store, paths: dict[str, str], backup_folder: str, now: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bring the exchanges of stored stocks in line with the lists.

    Returns update statistics and the distribution afterwards. The old
    assignment is saved first, in a timestamped folder.
    """
    moment = now or datetime.now(timezone.utc)
    base = store.version("asset")
    asset = store.read("asset")
    mapping = materialize(E.priority_mapping(read_exchange_lists(store.spark, paths)), "mapping")
    if mapping.isEmpty():
        raise ValueError("the exchange lists hold no symbol")
    valid = E.match_symbols(mapping, asset).where("side = 'matched'").select("symbol", "exchange")
    if valid.isEmpty():
        raise ValueError("no listed symbol is a stored stock")
    backup_exchanges(asset, f"{backup_folder}/exchange_backup_{moment:%Y%m%d_%H%M%S}")
    stats = materialize(E.update_stats(asset, mapping), "stats")
    store.write("asset", E.apply_exchanges(asset, valid, F.lit(moment)), base)
    return stats, E.exchange_distribution(store.read("asset"), active_only=True)
