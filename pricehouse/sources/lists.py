"""Symbol lists, exchange lists and small reports."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse import schemas as S

_LOG = logging.getLogger(__name__)


def read_exchange_list(spark: SparkSession, exchange: str, path: str) -> DataFrame:
    """(exchange, symbol) from one tab-separated list with a header.

    Only the first column counts: trimmed, upper case, at most 20 characters.
    Texts such as ``NA`` are tickers here, not missing values.
    """
    table = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    symbol = F.upper(F.trim(F.col(f"`{table.columns[0]}`")))
    return (
        table.select(F.lit(exchange).alias("exchange"), symbol.alias("symbol"))
        .where((F.length("symbol") > 0) & (F.length("symbol") <= S.MAX_SYMBOL_LENGTH))
        .distinct()
    )


def read_exchange_lists(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All lists together; a symbol appears once per exchange.

    A list that cannot be read is logged and counts as empty.
    """
    parts = [spark.createDataFrame([], "exchange STRING, symbol STRING")]
    for exchange, path in paths.items():
        try:
            parts.append(read_exchange_list(spark, exchange, path))
        except (AnalysisException, IndexError) as problem:  # no such path, or no column in it
            _LOG.error("list of %s left out: %s", exchange, problem)
    return reduce(DataFrame.unionByName, parts)


def read_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """One symbol per line; blank lines are dropped, repeats removed."""
    return spark.read.text(path).select(F.trim("value").alias("symbol")).where("symbol <> ''").distinct()


def write_symbol_list(symbols: DataFrame, path: str) -> None:
    """Sorted symbols as text lines; part files are in sort order."""
    symbols.select("symbol").distinct().orderBy("symbol").write.text(path)


def backup_exchanges(asset: DataFrame, path: str) -> None:
    """Current exchange of every stock that has one, as CSV."""
    asset.where("asset_type = 'STOCK' and exchange is not null").select("symbol", "exchange").write.csv(
        path, header=True
    )


def write_load_errors(results: DataFrame, path: str) -> None:
    """Failed files of a load run as JSON lines."""
    results.where("outcome = 'failed'").write.json(path)
