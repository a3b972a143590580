"""From staged text to warehouse rows: preparing, upserting, batch lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.functions import parsing as P
from pricehouse.operators.numbering import number_rows


def parse_prices(stage: DataFrame) -> DataFrame:
    """Add typed columns and ``accepted`` to staged rows, in one projection.

    A row is accepted when symbol, ISO date and four prices parse and the prices
    obey the OHLC rule. Bad volumes and adjusted closes only become NULL.
    """
    typed = P.compute_once(stage, {
        "price_date": P.iso_date("date_str"),
        "open_price": P.to_price("open_str"),
        "high_price": P.to_price("high_str"),
        "low_price": P.to_price("low_str"),
        "close_price": P.to_price("close_str"),
        "volume": P.to_volume("volume_str"),
        "adj_close_price": P.to_price("adj_close_str"),
    })
    ordered = P.is_consistent_ohlc(*[F.col(f"{n}_price") for n in ("open", "high", "low", "close")])
    good = F.col("symbol").isNotNull() & F.col("price_date").isNotNull() & ordered
    return typed.withColumn("accepted", F.coalesce(good, F.lit(False)))


def prepare_prices(stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted typed rows, and rejected rows as staged."""
    parsed = parse_prices(stage)
    good = parsed.where("accepted").drop("accepted", *[c for c in S.STAGE_COLUMNS if c != "symbol"])
    return good, parsed.where("not accepted").select(*stage.columns)


def rejected_rows(stage: DataFrame) -> DataFrame:
    """Staged rows that are not accepted, with the first reason."""
    reason = (
        F.when(F.col("symbol").isNull(), F.lit("no symbol"))
        .when(F.col("price_date").isNull(), F.lit("no ISO date"))
        .otherwise(F.lit("prices missing or against the OHLC rule"))
    )
    return parse_prices(stage).where("not accepted").select(*stage.columns, reason.alias("reason"))


# --- dimensions -----------------------------------------------------------------


def insert_if_absent(dim: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` plus those ``rows`` whose key it lacks."""
    new = rows.dropDuplicates(list(keys)).join(dim.select(*keys), list(keys), "left_anti")
    return dim.unionByName(new, allowMissingColumns=True)


def add_with_ids(dim: DataFrame, new: DataFrame, id_column: str, keys: Sequence[str]) -> DataFrame:
    """``new`` rows numbered on from the highest id of ``dim``."""
    highest = dim.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    numbered = number_rows(new.drop(id_column), keys, "_n")
    next_id = (highest + F.col("_n")).cast(dim.schema[id_column].dataType)
    return numbered.withColumn(id_column, next_id).drop("_n")


def upsert_assets(
    asset: DataFrame, incoming: DataFrame, now: Column | None = None, order: str | None = None
) -> DataFrame:
    """Insert unknown (symbol, type) pairs; fill known ones with given values.

    Incoming company name, sector and exchange replace the stored ones where
    they are not NULL; ``updated_at`` moves when at least one is given. Of a pair
    that comes several times, the last value given in ``order`` counts for each
    column; without an order column, rows rank by their values.
    """
    stamp = now if now is not None else F.current_timestamp()
    key = ["symbol", "asset_type"]
    given = ["company_name", "sector", "exchange"]
    rows = incoming
    for name in [*given, "currency"]:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    place = F.struct(*([order] if order else []), *given, "currency")
    rows = rows.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_{c}") for c in [*given, "currency"]]
    )

    known = asset.join(rows, key, "left")
    touched = F.coalesce(*[F.col(f"_{c}") for c in given]).isNotNull()
    updated = known.select(
        *[
            F.coalesce(f"_{c}", c).alias(c) if c in given
            else F.when(touched, stamp).otherwise(F.col(c)).alias(c) if c == "updated_at"
            else F.col(c)
            for c in asset.columns
        ]
    )
    new = rows.join(asset.select(*key), key, "left_anti").select(
        *key,
        F.coalesce("_currency", F.lit("USD")).alias("currency"),
        *[F.col(f"_{c}").alias(c) for c in given],
        F.lit(True).alias("is_active"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )
    added = add_with_ids(asset, new, "asset_id", key)
    return updated.unionByName(added, allowMissingColumns=True).select(*asset.columns)


# --- facts ----------------------------------------------------------------------


def price_id() -> Column:
    """Repeatable tie-break id of a loaded bar; the natural key is its identity."""
    return F.xxhash64("asset_id", "price_date", "source_id", "granularity", "batch_id", "row_number")


def upsert_prices(raw: DataFrame, incoming: DataFrame) -> DataFrame:
    """``raw`` with ``incoming`` appended; ``current_prices`` resolves repeats.

    The raw table only grows. Incoming rows carry a higher ``load_seq``, so for
    every key the newest load and within it the last input row is the live one.
    """
    return raw.unionByName(incoming, allowMissingColumns=True)


# --- batches ----------------------------------------------------------------------


def make_batches(
    batch_meta: DataFrame, files: DataFrame, source_id: int, stamp: Column | None = None, first: int | None = None
) -> DataFrame:
    """New RUNNING batch rows, one per scored file, numbered from ``first`` or on from the table.

    ``files`` gives source_file, file_size_bytes, row_count and quality_score.
    """
    started = stamp if stamp is not None else F.current_timestamp()
    stem = P.file_stem("source_file")
    rows = files.select(
        F.lit(source_id).cast("int").alias("source_id"),
        F.concat(stem, F.lit("_"), F.date_format(started, "yyyyMMdd_HHmmss")).alias("batch_name"),
        F.col("source_file").alias("file_path"),
        F.col("file_size_bytes").cast("bigint").alias("file_size_bytes"),
        F.col("row_count").cast("int").alias("row_count"),
        started.alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("quality_score").cast("decimal(5,2)").alias("quality_score"),
    )
    if first is not None:
        numbered = number_rows(rows, ["file_path"], "batch_id", first - 1)
        return numbered.withColumn("batch_id", F.col("batch_id").cast("int")).select(*batch_meta.columns)
    return add_with_ids(batch_meta, rows, "batch_id", ["file_path"]).select(*batch_meta.columns)


def batch_events(results: DataFrame, now: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Events that end batches: ``results`` gives batch_id, status, error_message and row_count; ``keep`` its columns to keep."""
    stamp = now if now is not None else F.current_timestamp()
    return results.select(
        *keep, "batch_id", "status", "error_message", F.col("row_count").cast("int").alias("row_count"),
        stamp.alias("end_time"), F.lit(1).alias("event"),
    )


def current_batches(log: DataFrame) -> DataFrame:
    """One row per batch from its events: the last state, and of other columns the last given value.

    The latest event is that with the highest number and, among those, the latest end. An
    aggregate that combines before the shuffle; a batch has two or three events.
    """
    order = F.struct("event", "end_time")
    state = ["status", "end_time", "error_message"]
    others = [c for c in log.columns if c not in ("batch_id", "event", *state)]
    reduced = log.groupBy("batch_id").agg(
        F.max_by(F.struct(*state), order).alias("_state"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in others],
    )
    return reduced.withColumns({c: F.col(f"_state.{c}") for c in state}).select(*[c for c in log.columns if c != "event"])


def finish_batches(batch_meta: DataFrame, results: DataFrame, now: Column | None = None) -> DataFrame:
    """Set status, end time and error of the batches in ``results``.

    ``results``: batch_id, status, error_message, row_count; a NULL row count
    keeps the stored one.
    """
    stamp = now if now is not None else F.current_timestamp()
    news = results.select(
        "batch_id", F.col("status").alias("_status"), F.col("error_message").alias("_error"),
        F.col("row_count").alias("_rows"),
    )
    done = F.col("_status").isNotNull()
    return batch_meta.join(news, "batch_id", "left").select(
        *[
            {
                "status": F.coalesce("_status", "status").alias("status"),
                "end_time": F.when(done, stamp).otherwise(F.col("end_time")).alias("end_time"),
                "error_message": F.when(done, F.col("_error")).otherwise(F.col("error_message")).alias("error_message"),
                "row_count": F.coalesce("_rows", "row_count").cast("int").alias("row_count"),
            }.get(c, F.col(c))
            for c in batch_meta.columns
        ]
    )


# --- which files to load ------------------------------------------------------------


def loaded_symbols(
    asset: DataFrame, price_raw: DataFrame, data_source: DataFrame, source: str
) -> DataFrame:
    """Distinct symbols with at least one bar from ``source``.

    Raw bars shrink to distinct asset ids before meeting the asset table.
    """
    ids = data_source.where(F.col("source_name") == source).select("source_id")
    held = price_raw.select("asset_id", "source_id").join(ids, "source_id", "left_semi")
    return (
        asset.join(held.select("asset_id").distinct(), "asset_id", "left_semi").select("symbol").distinct()
    )


def skip_loaded(files: DataFrame, loaded: DataFrame) -> DataFrame:
    return files.join(loaded.select("symbol"), "symbol", "left_anti")


def only_listed(files: DataFrame, symbols: DataFrame) -> DataFrame:
    return files.join(symbols.select("symbol"), "symbol", "left_semi")


def missing_symbols(files: DataFrame, asset: DataFrame) -> DataFrame:
    """File symbols without an active asset."""
    active = asset.where("is_active").select("symbol")
    return files.select("symbol").distinct().join(active, "symbol", "left_anti")


def missing_report(files: DataFrame, asset: DataFrame) -> DataFrame:
    """File symbols, loaded symbols, missing symbols and success rate.

    All active symbols count as loaded, so the rate may exceed 100.
    """
    sides = (
        files.select("symbol", F.lit(1).alias("f"), F.lit(0).alias("a"))
        .unionByName(asset.where("is_active").select("symbol", F.lit(0).alias("f"), F.lit(1).alias("a")))
        .groupBy("symbol")
        .agg(F.max("f").alias("f"), F.max("a").alias("a"))
    )
    return sides.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("file_symbols"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("loaded_symbols"),
        F.count_if((F.col("f") == 1) & (F.col("a") == 0)).alias("missing_symbols"),
    ).withColumn("success_rate", F.try_divide(F.col("loaded_symbols") * 100.0, F.col("file_symbols")))


def load_summary(results: DataFrame, refresh_every: int | None = None) -> DataFrame:
    """Totals of a load run from its per-file results.

    ``results``: outcome in loaded / failed / skipped, records_loaded. A bulk load
    refreshes gold once if it loads anything; with ``refresh_every``, a run that
    refreshes after so many loads and at its end is reported.
    """
    n = F.col("successful_loads")
    refreshes = F.floor(n / refresh_every) + 1 if refresh_every else F.least(n, F.lit(1)).cast("bigint")
    loaded = F.col("outcome") == "loaded"
    return results.agg(
        F.count("*").alias("total_files"),
        F.count_if(loaded).alias("successful_loads"),
        F.count_if(F.col("outcome") == "failed").alias("failed_loads"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped_files"),
        F.coalesce(F.sum("records_loaded"), F.lit(0)).alias("records_loaded"),
    ).withColumn("gold_refreshes", refreshes)


def plan_load(
    files: DataFrame, loaded: DataFrame, refresh_every: int = S.GOLD_REFRESH_FILES
) -> DataFrame:
    """What a run would do: files to process and to skip, gold refreshes."""
    known = loaded.select("symbol").distinct().withColumn("_known", F.lit(True))
    return (
        files.join(known, "symbol", "left")
        .agg(
            F.count("*").alias("total_files"),
            F.count_if(F.col("_known").isNull()).alias("to_process"),
            F.count_if(F.col("_known").isNotNull()).alias("to_skip"),
        )
        .withColumn("gold_refreshes", F.floor(F.col("to_process") / refresh_every) + 1)
    )
