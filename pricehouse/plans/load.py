"""Loading price files: stage, score, gate, register, append, publish."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.functions import parsing as P
from pricehouse.operators import loading as L
from pricehouse.operators import quality as Q
from pricehouse.operators.distinct_bits import day_number, number_bits
from pricehouse.plans.queries import source_id
from pricehouse.plans.store import MovedOn, Store
from pricehouse.session import materialize
from pricehouse.sources.csv_staging import ONE_SLASH, list_files, many_small_files, one_slash, stage_csv

RESULT_COLUMNS = ["source_file", "symbol", "outcome", "message", "records_loaded", "quality_score"]


def validate_only(spark: SparkSession, paths: Sequence[str] | str, pattern: str = "*.csv") -> DataFrame:
    """Quality report per file with ``passed``; nothing is loaded.

    A file without rows, or one that cannot be read, has a row with score 0, ``schema_valid``
    false and ``schema_error``.
    """
    unreadable: list[tuple[str, str]] = []
    stage = stage_csv(spark, paths, pattern, unreadable)
    files = list_files(spark, paths, pattern).select("source_file")
    report = Q.quality_report(stage, files=files)
    bad = spark.createDataFrame(unreadable, "bad_file STRING, message STRING")
    report = report.join(bad, F.col("source_file") == F.col("bad_file"), "left").withColumn(
        "schema_error", F.coalesce("message", "schema_error")
    ).drop("bad_file", "message")
    return report.withColumn("passed", F.col("schema_valid") & (F.col("quality_score") >= S.MIN_QUALITY_SCORE))


def load(
    store: Store,
    paths: Sequence[str] | str,
    source: str = "MANUAL_CSV",
    symbol: str | Column | None = None,
    asset_type: str | Column = "STOCK",
    exchange: str | None = None,
    company_name: str | None = None,
    sector: str | None = None,
    min_score: float = S.MIN_QUALITY_SCORE,
    several_symbols: str = "error",
    dry_run: bool = False,
    refresh: bool = True,
    pattern: str = "*.csv",
    now: datetime | None = None,
    groups: Sequence[Sequence[str]] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Load price files into the warehouse; one result row per file.

    ``symbol`` is a fixed ticker, an expression over ``source_file``, or None to
    take it from the rows. Rows of one file may then carry several symbols only
    with ``several_symbols="rows"``; by default such a file fails. Files scoring
    under ``min_score`` fail, rows that do not parse go to the quarantine table. A file
    that cannot be read fails alone, with a FAILED batch of its own. A batch turns
    SUCCESS after its rows are written, and only then do its rows reach gold, so
    a run that dies halfway leaves nothing visible.

    The run has a number of its own, which names its folders in the raw table, and takes its
    batch ids from a sequence, so runs at one time do not meet.

    ``groups`` deals the paths out in order: each group has a number of its own, so its bars replace
    those of groups before it, and its batches turn SUCCESS and gold is refreshed group by
    group, as if each were a run. All are read, scored and written by the same jobs.
    ``files`` is the list of ``paths`` (see ``list_files``), if it is there already.
    """
    spark = store.spark
    stamp = F.lit(now or datetime.now(timezone.utc))
    listed = files if files is not None else list_files(spark, paths, pattern)
    files = _in_groups(listed, groups).select("source_file", "file_size_bytes", "part")
    unreadable: list[tuple[str, str]] = []
    stage = stage_csv(spark, paths, pattern, unreadable)
    bad = spark.createDataFrame(unreadable, "bad_file STRING, problem STRING")

    scores = Q.score_files(stage)
    if isinstance(symbol, str):
        chosen = F.lit(symbol)
    elif symbol is not None:
        chosen = symbol
    else:
        chosen = F.col("file_symbol")
    own_rows = symbol is None and several_symbols == "rows"
    several = (F.col("symbol_count") > 1) if symbol is None and not own_rows else F.lit(False)
    message = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("quality_score").isNull(), F.lit("the file has no rows"))
        .when(F.col("quality_score") < min_score, F.lit("its quality score is too low"))
        .when(several, F.lit("it holds several symbols"))
        .when(chosen.isNull(), F.lit("it names no symbol"))
    )
    judged = files.join(scores, "source_file", "left").join(bad, F.col("source_file") == F.col("bad_file"), "left").select(
        "source_file", "file_size_bytes", "part", "row_count", "quality_score", *Q.SCORES,
        chosen.alias("symbol"), message.alias("message"), F.col("problem").isNotNull().alias("unreadable"),
    )
    judged = materialize(judged, "judged")
    accepted = judged.where("message is null")
    if dry_run:
        return judged.select(
            "source_file", "symbol",
            F.when(F.col("message").isNull(), F.lit("valid")).otherwise(F.lit("failed")).alias("outcome"),
            "message", F.lit(0).cast("bigint").alias("records_loaded"), "quality_score",
        )

    kind = F.lit(asset_type) if isinstance(asset_type, str) else asset_type
    sid = source_id(store.read("data_source"), source)
    count_groups = len(groups) if groups else 1
    sequence = store.reserve("load", count_groups)
    last = sequence + count_groups - 1
    load_seq = (F.lit(sequence) + F.col("part")).cast("bigint").alias("load_seq")
    rows = stage.join(accepted.select("source_file", F.col("symbol").alias("_symbol")), "source_file")
    rows = rows.withColumn("symbol", F.col("symbol") if own_rows else F.col("_symbol")).drop("_symbol")
    good, rejected = L.prepare_prices(rows)
    # The symbols are few and used several times.
    symbols = materialize(good.select("symbol").distinct(), "symbols") if own_rows else accepted.select("symbol").distinct()
    wanted = symbols.select(
        "symbol", kind.alias("asset_type"), F.lit(exchange).alias("exchange"),
        F.lit(company_name).alias("company_name"), F.lit(sector).alias("sector"),
    )
    renamed = _upsert_assets(store, wanted, stamp, any(x is not None for x in (exchange, company_name, sector)))

    registered = judged.where("message is null or unreadable").select(
        "source_file", "file_size_bytes", "row_count", "quality_score"
    )
    count = registered.count()
    known = store.read("batch_meta")
    first = store.reserve("batch", count, 1 + (known.agg(F.max("batch_id")).first()[0] or 0)) if count else 1
    # Written first: ids are then fixed facts, and name the batches of this run.
    new = materialize(L.make_batches(known.limit(0), registered, sid, stamp, first), "new-batches")
    store.log_batches(new.withColumn("event", F.lit(0)))
    named = new.select("batch_id", F.col("file_path").alias("source_file"))
    if groups:
        named = named.join(judged.select("source_file", load_seq), "source_file")
    else:
        named = named.withColumn("load_seq", F.lit(sequence).cast("bigint"))
    # The scores of the one pass that judged the files; staged rows are not read for the log.
    scored = judged.where("row_count > 0").join(named, "source_file")
    store.log_quality(Q.quality_log(scored, "batch_id").withColumn("checked_at", stamp))
    nothing = F.lit(None).cast("bigint").alias("row_count")
    if unreadable:
        lost = named.join(bad, F.col("source_file") == F.col("bad_file"))
        store.log_batches(L.batch_events(
            lost.select("batch_id", F.lit("FAILED").alias("status"), F.col("problem").alias("error_message"), nothing), stamp
        ))
    running = named.join(bad, F.col("source_file") == F.col("bad_file"), "left_anti")

    assets = store.read("asset").select("asset_id", "symbol", "asset_type")
    bars = (
        good.withColumn("asset_type", kind)
        .join(assets, ["symbol", "asset_type"])
        .join(running, "source_file")
        .withColumns({
            "source_id": F.lit(sid).cast("int"),
            "granularity": F.lit("DAILY"),
            "created_at": stamp,
        })
        .withColumn("price_id", L.price_id())
    )
    raw_columns = store.read("price_raw").columns
    try:
        store.append_raw(bars.select(*raw_columns), count_groups)
    except Exception as problem:
        failed = running.select(
            "batch_id", F.lit("FAILED").alias("status"), F.lit(str(problem)).alias("error_message"), nothing
        )
        store.log_batches(L.batch_events(failed, stamp))
        raise

    # A load has folders of its own in the raw table; no other is opened.
    written = store.read("price_raw").where(F.col("load_seq").between(sequence, last))
    loaded = written.groupBy("batch_id").agg(F.count("*").alias("n"))
    results = materialize(running.join(loaded, "batch_id", "left").select(
        "batch_id", "source_file", "load_seq", F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.coalesce("n", F.lit(0)).alias("row_count"),
    ), "loaded-batches")
    touched = defaultdict(list)
    if refresh:
        for r in written.select("load_seq", F.year("price_date").alias("year")).distinct().collect():
            touched[r["load_seq"]].append(r["year"])
    filled = {r[0] for r in results.select("load_seq").distinct().collect()} if groups else set()
    numbers = sorted(filled | {last})
    # All refreshes of several groups are worked out by one job; the last one writes its years as a whole again.
    history = prepared = None
    if len(numbers) > 1:
        events = L.batch_events(results, stamp, ["load_seq"])
        prepared = store.prepare_events(events)
    every = sorted({year for number in numbers for year in touched[number]})
    if refresh and len(numbers) > 2:
        history = store.gold_history(results, numbers[0], last, None if renamed or not store.gold_years() else every)
    for number in numbers:
        if prepared is None:
            store.log_batches(L.batch_events(results.where(F.col("load_seq") == number), stamp))
        else:
            store.log_prepared(prepared, number)
        if number == last:
            covered = number_bits(written, {"day": day_number(F.col("price_date")), "asset": F.col("asset_id")}, ["load_seq", "source_id"])
            store.log_bits(covered)
            loads = judged.select("source_file", load_seq) if groups else None
            _quarantine(store, sequence, rows, accepted, results, bad if unreadable else None, loads)
        if refresh:
            years = None if renamed or not store.gold_years() else touched[number]
            if history is not None and number == last:
                years = None if years is None else every
                store.refresh_gold(years, pending=(number + 1, last))
            else:
                store.refresh_gold(years, pending=(number + 1, last), history=history)
            renamed = False

    done = results.select(F.col("source_file").alias("done_file"), F.col("row_count").alias("_n"))
    outcome = judged.join(done, F.col("source_file") == F.col("done_file"), "left").select(
        "source_file", "symbol",
        F.when(F.col("message").isNull(), F.lit("loaded")).otherwise(F.lit("failed")).alias("outcome"),
        F.coalesce("message", F.lit("loaded")).alias("message"),
        F.coalesce("_n", F.lit(0)).alias("records_loaded"),
        "quality_score",
    )
    return materialize(outcome, "results")


def _in_groups(files: DataFrame, groups: Sequence[Sequence[str]] | None) -> DataFrame:
    """Listed files with ``part``, the place of their group; 0 for all without groups."""
    if not groups:
        return files.withColumn("part", F.lit(0))
    pairs = [(one_slash(path), n) for n, group in enumerate(groups) for path in group]
    dealt = files.sparkSession.createDataFrame(pairs, "of_path STRING, part INT")
    path = F.regexp_replace("path", *ONE_SLASH)
    return files.join(dealt, path == F.col("of_path")).drop("of_path")


def _upsert_assets(store: Store, wanted: DataFrame, stamp: Column, describes: bool, tries: int = 5) -> bool:
    """Add unknown assets, fill in descriptions; whether gold's columns of a stored asset changed.

    If another run has written the assets since they were read, they are read again. A run
    that brings nothing new writes nothing.
    """
    # Gold repeats these columns, so a known asset that gets new ones touches all its years.
    described = ["symbol", "asset_type", "currency", "exchange", "company_name", "is_active"]
    key = ["symbol", "asset_type"]
    for left in range(tries, 0, -1):
        base = store.version("asset")
        before = store.read("asset")
        if not describes and wanted.join(before.select(*key), key, "left_anti").isEmpty():
            return False
        try:
            store.write("asset", L.upsert_assets(before, wanted, stamp), base)
        except MovedOn:
            if left == 1:
                raise
            continue
        kept = before.select("asset_id", *described).exceptAll(store.read("asset").select("asset_id", *described))
        return describes and not kept.isEmpty()
    return False


def _quarantine(
    store: Store, sequence: int, rows: DataFrame, accepted: DataFrame, results: DataFrame, bad: DataFrame | None,
    numbers: DataFrame | None = None,
) -> None:
    """Keep what the run left out: records of accepted files that do not parse, unreadable files.

    ``numbers`` has the load of each file, if there are several.
    """
    staged = accepted.agg(F.sum("row_count")).first()[0] or 0
    loaded = results.agg(F.sum("row_count")).first()[0] or 0
    parts = []
    if staged != loaded:
        parts.append(L.rejected_rows(rows))
    if bad is not None:
        parts.append(bad.select(F.col("bad_file").alias("source_file"), F.col("problem").alias("reason")))
    for part in parts:
        if numbers is None:
            part = part.withColumn("load_seq", F.lit(sequence).cast("bigint"))
        else:
            part = part.join(numbers, "source_file", "left")
        missing = {c: F.lit(None).cast(t) for c, t in store.read("quarantine").dtypes if c not in part.columns}
        store.quarantine(part.withColumns(missing))


def symbols_held(store: Store, source: str) -> DataFrame:
    """Symbols with at least one bar from ``source`` in a successful batch."""
    complete = store.read("batch_meta").where("status = 'SUCCESS'").select("batch_id")
    raw = store.read("price_raw").join(complete, "batch_id", "left_semi")
    return L.loaded_symbols(store.read("asset"), raw, store.read("data_source"), source)


def bulk_load(
    store: Store,
    folder: str | Sequence[str],
    source: str = "YAHOO_FINANCE_API",
    skip_existing: bool = True,
    strip_usd: bool = False,
    only: DataFrame | None = None,
    loaded: DataFrame | None = None,
    asset_type: str | Column = "STOCK",
    symbol: Column | None = None,
    pattern: str = "*.csv",
    **options,
) -> DataFrame:
    """Load a folder of one-ticker files named after their ticker.

    ``symbol`` replaces the file stem as ticker, for other folder layouts.

    Files whose ticker already has bars from ``source`` (or is in ``loaded``)
    are skipped. All remaining files go through one job and one gold refresh.
    """
    spark = store.spark
    ticker = symbol if symbol is not None else P.symbol_from_stem("source_file", strip_usd)
    # Written once: each scan of a list of files opens all of them.
    with many_small_files(spark):
        files = materialize(list_files(spark, folder, pattern).withColumn("symbol", ticker), "files-found")
    if only is not None:
        files = L.only_listed(files, only)
    if skip_existing:
        if loaded is None:
            loaded = symbols_held(store, source)
        todo = L.skip_loaded(files, loaded)
    else:
        todo = files
    found = materialize(todo.select("path", "source_file", "file_size_bytes"), "files-to-load")
    unchanged = only is None and found.count() == files.count()
    if unchanged:
        paths = [folder] if isinstance(folder, str) else list(folder)  # nothing is skipped
    else:
        # The reader needs the paths; its own file index holds the same list.
        paths = [r["path"] for r in found.select("path").collect()]
    skipped = files.join(found.select("source_file"), "source_file", "left_anti").select(
        "source_file", "symbol", F.lit("skipped").alias("outcome"), F.lit("its ticker is held already").alias("message"),
        F.lit(0).cast("bigint").alias("records_loaded"), F.lit(None).cast("double").alias("quality_score"),
    )
    skipped = materialize(skipped, "skipped")
    if not paths or found.isEmpty():
        return skipped
    results = load(
        store, paths, source, symbol=ticker, asset_type=asset_type, pattern=pattern, files=found, **options
    )
    return results.select(*RESULT_COLUMNS).unionByName(skipped)


def load_folder(store: Store, folder: str, source: str = "MANUAL_CSV", **options) -> DataFrame:
    """Load every file of a folder, telling crypto tickers by name."""
    return bulk_load(
        store, folder, source, skip_existing=False, strip_usd=True,
        asset_type=P.classify_asset("symbol"), **options,
    )


def retry_failed(store: Store, folder: str, symbols: DataFrame, source: str = "YAHOO_FINANCE_API", **options) -> DataFrame:
    """Load again the files whose ticker is listed and has no active asset yet."""
    active = store.read("asset").where("is_active").select("symbol")
    return bulk_load(store, folder, source, only=symbols, loaded=active, **options)
