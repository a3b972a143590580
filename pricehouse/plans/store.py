"""Warehouse tables on shared storage.

Replaceable tables (dimensions, gold, marts) are published as snapshots: the rows go to
a folder of their own, and a numbered commit file that names it makes it the current
version (see :mod:`pricehouse.plans.commits`), so readers always see a complete version and a
writer that read an older one is refused. A price table may replace some years only; its
commit names the folder of each year. Versions that a run publishes one after another may share a
history (see :class:`History`): a year is then the history's rows as of a load.

Raw bars only grow: each load appends folders of its own. Compaction folds finished loads
into a base table, one bar a key; the live bars are the base and the loads it has not folded.
Batches are a log of events, so a load writes its own rows and none of earlier ones.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from pricehouse import schemas as S
from pricehouse.operators import loading as L
from pricehouse.operators.distinct_bits import coverage_of
from pricehouse.plans.commits import Commits, reserve
from pricehouse.plans.gold import build_gold, current_prices, gold_history, live_prices

SCHEMAS = {
    "asset": S.ASSET,
    "data_source": S.DATA_SOURCE,
    "batch_meta": S.BATCH_META,
    "price_raw": S.PRICE_RAW,
}


#: Tables that loads only add to.
APPENDED = {"quarantine": S.QUARANTINE, "quality_log": S.QUALITY_LOG}

#: Stored bytes that one task of a price table should write about.
TASK_BYTES = 128 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under ``path``, 0 if there is none; one metadata call."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


class MovedOn(RuntimeError):
    """Another writer published a table after it was read."""


def publish(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    about_bytes: int | None = None,
    years: Sequence[int] | None = None,
    base: int | None = None,
    facts: dict | None = None,
    exclusive: bool = False,
) -> int:
    """Write ``rows`` as the new version of the table at ``path``; returns its number.

    Price tables are split by year and clustered by symbol (or asset) and date, so a ticker or
    date predicate skips most files and row groups. With ``about_bytes``, their
    size when stored, ranges are cut to that size; otherwise Spark evens out the
    partitions by what it measures. With ``years``, ``rows`` replace those years and
    the new version takes the folders of all others from the one before. ``facts`` are kept
    with the version.

    With ``base``, the number of the version that was read, :class:`MovedOn` is raised if another
    version was published since; if ``years`` are replaced, only if it replaced one of them, or
    with ``exclusive``.
    """
    commits = Commits(spark, path)
    seen = commits.latest() if base is None else base
    created = datetime.now(timezone.utc)
    folder = f"{path}/versions/version={created:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    mine: dict[str, str] = {}
    if "price_date" in rows.columns and {"symbol", "asset_id"} & set(rows.columns):
        order = ["price_year", "symbol" if "symbol" in rows.columns else "asset_id", "price_date"]
        typed = rows.withColumn("price_year", F.year("price_date"))
        if about_bytes is None:
            dealt = typed.hint("rebalance", *order[:2])
        else:
            dealt = typed.repartitionByRange(1 + about_bytes // TASK_BYTES, *order)
        writer = dealt.sortWithinPartitions(*order).write.partitionBy("price_year")
        if "symbol" in rows.columns:
            writer = writer.option("parquet.bloom.filter.enabled#symbol", "true")
        writer.parquet(folder)
        columns = typed.schema.json()
        if "symbol" in rows.columns:
            _list_files(spark, folder, typed.schema)
        mine = {name.split("=")[1]: f"{folder}/{name}" for name in _folders(spark, folder)}
    else:
        rows.hint("rebalance").write.parquet(folder)  # few files of even size
        columns = rows.schema.json()
    before, number = commits.read(seen), seen
    while True:
        now = commits.read(number)
        parts = mine
        if years is not None:
            own = {str(y) for y in years}
            held, was = [(c or {}).get("years", {}) for c in (now, before)]
            if any(held.get(y) != was.get(y) for y in own):
                raise MovedOn(f"{path}: years that were to be replaced have newer versions")
            parts = {**{y: f for y, f in held.items() if y not in own}, **mine}
        content = {"folder": folder, "created_at": created.isoformat(), "years": parts, "columns": columns, "facts": facts or {}}
        if commits.add(number + 1, content):
            return number + 1
        if base is not None and (years is None or exclusive):
            raise MovedOn(f"{path} has a newer version than the one that was read")
        number = commits.latest()


@dataclass
class History:
    """The rows that gold has after each of a run's loads, in one folder by load and year (see ``gold_history``).

    ``base`` is the version that the next one must follow; ``years`` has the first load of each year.
    """

    folder: str
    columns: str
    years: dict[int, int]
    base: int


def publish_history(spark: SparkSession, path: str, history: History, load: int, years: Sequence[int] | None) -> bool:
    """Make the history's rows as of ``load`` those of all or some ``years``; no row is written.

    False if another writer has published a version since the history's last one.
    """
    commits = Commits(spark, path)
    held = (commits.read(history.base) or {}).get("years", {}) if years is not None else {}
    own = set(history.years) if years is None else set(years)
    parts = {y: f for y, f in held.items() if int(y) not in own}
    for year in sorted(own):
        if history.years.get(year, load + 1) <= load:
            parts[str(year)] = {"history": history.folder, "as_of": load}
    created = datetime.now(timezone.utc).isoformat()
    content = {"folder": history.folder, "created_at": created, "years": parts, "columns": history.columns, "facts": {}}
    if commits.latest() != history.base or not commits.add(history.base + 1, content):
        return False
    history.base += 1
    return True


def _as_of(load: int) -> Column:
    return (F.col("from_load") <= load) & (F.col("until_load").isNull() | (F.col("until_load") > load))


def _with_loads(schema: StructType) -> StructType:
    return StructType(list(schema.fields)).add("until_load", LongType()).add("from_load", LongType())


def _manifest(folder: str) -> str:
    """Where the list of the files under a version's folder lies."""
    return folder.replace("/versions/version=", "/files/version=")


def _list_files(spark: SparkSession, folder: str, schema: StructType) -> None:
    """Write the first and last symbol of each file of a version, by year; of a history's files also the load."""
    load = ["from_load"] if "from_load" in schema.fieldNames() else []
    stored = spark.read.schema(schema).parquet(folder).select("symbol", "price_year", *load, F.col("_metadata.file_path").alias("file"))
    files = stored.groupBy("price_year", *load, "file").agg(F.min("symbol").alias("first"), F.max("symbol").alias("last"))
    files.repartition("price_year").write.partitionBy("price_year").parquet(_manifest(folder))


def read_symbols(
    spark: SparkSession, path: str, symbols: Sequence[str], first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """The published bars of a few symbols, from the files that can hold them only.

    Files are clustered by symbol and the list of a version has the range of each, so a ticker is in one
    file a year, or in neighbours if it fills several. Only their names come to the driver.
    """
    pointer = _pointer(spark, path)
    if pointer is None:
        raise ValueError(f"nothing published at {path}")
    schema = StructType.fromJson(json.loads(pointer["columns"]))
    years = {y: f for y, f in pointer["years"].items() if (first_year or int(y)) <= int(y) <= (last_year or int(y))}
    folders, histories = _apart(years)
    parts = []
    wanted = F.lit(False)
    for symbol in symbols:
        wanted = wanted | F.lit(symbol).between(F.col("first"), F.col("last"))
    if folders and symbols:
        listed = spark.read.schema("file STRING, first STRING, last STRING").parquet(*[_manifest(f) for f in folders])
        names = [r["file"] for r in listed.where(wanted).select("file").collect()]
        if names:
            parts.append(spark.read.schema(schema).option("basePath", f"{path}/versions").parquet(*names))
    for (folder, load), own in histories.items() if symbols else ():
        listed = spark.read.schema("file STRING, first STRING, last STRING, from_load BIGINT").parquet(*[f"{_manifest(folder)}/price_year={y}" for y in own])
        names = [r["file"] for r in listed.where(wanted & (F.col("from_load") <= load)).select("file").collect()]
        if names:
            parts.append(spark.read.schema(_with_loads(schema)).option("basePath", folder).parquet(*names).where(_as_of(load)))
    if not parts:
        return spark.createDataFrame([], schema)
    stored = reduce(DataFrame.unionByName, [p.select(*schema.fieldNames()) for p in parts])
    return stored.where(F.col("symbol").isin(list(symbols)))


def _apart(years: dict) -> tuple[list[str], dict[tuple[str, int], list[int]]]:
    """The folders of years, and the years of each history and load."""
    histories = defaultdict(list)
    for year, place in years.items():
        if not isinstance(place, str):
            histories[place["history"], place["as_of"]].append(int(year))
    return [f for f in years.values() if isinstance(f, str)], histories


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The partition folders right under ``path``: one for each year."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted(f.getPath().getName() for f in listed if f.isDirectory() and "=" in f.getPath().getName())


def not_written(problem: AnalysisException) -> bool:
    """Whether a read failed only because nothing was written there yet."""
    return problem.getCondition() == "PATH_NOT_FOUND"


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the newest published version, 0 when there is none."""
    return Commits(spark, path).latest()


def _pointer(spark: SparkSession, path: str) -> dict | None:
    commits = Commits(spark, path)
    return commits.read(commits.latest())


def _read(spark: SparkSession, path: str, pointer: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(pointer["columns"]))
    if "price_year" not in schema.fieldNames():
        return spark.read.schema(schema).parquet(pointer["folder"])
    if not pointer["years"]:
        return spark.createDataFrame([], schema)
    folders, histories = _apart(pointer["years"])
    parts = []
    if folders:
        parts.append(spark.read.schema(schema).option("basePath", f"{path}/versions").parquet(*folders))
    for (folder, load), years in histories.items():
        kept = spark.read.schema(_with_loads(schema)).parquet(folder)
        parts.append(kept.where(F.col("price_year").isin(years) & _as_of(load)))
    # without the version, which is a folder too
    return reduce(DataFrame.unionByName, [p.select(*schema.fieldNames()) for p in parts])


def read_published(spark: SparkSession, path: str) -> DataFrame:
    pointer = _pointer(spark, path)
    if pointer is None:
        raise ValueError(f"nothing published at {path}")
    return _read(spark, path, pointer)


def refresh_all(spark: SparkSession, builders: dict[str, tuple[str, Callable[[], DataFrame]]]) -> DataFrame:
    """Publish several marts; a failing one is reported and the rest go on.

    ``builders`` maps a mart name to (path, function returning its rows).
    """
    outcomes = []
    for name, (path, build) in builders.items():
        try:
            publish(spark, path, build())
            outcomes.append((name, True, None))
        except Exception as problem:  # one mart must not stop the others
            outcomes.append((name, False, str(problem)))
    return spark.createDataFrame(outcomes, "mart STRING, refreshed BOOLEAN, error STRING")


class Store:
    """The warehouse under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """A table; a dimension or raw table not written yet is empty.

        Published price tables keep ``price_year``, which lets queries with a date
        range skip whole years.
        """
        if name == "price_raw":
            return self._raw().drop("price_year")
        if name == "batch_meta":
            return self._batches()
        if name in APPENDED:
            return self._appended(name, StructType.fromDDL(APPENDED[name]))
        pointer = _pointer(self.spark, self.path(name))
        if pointer is None and name in SCHEMAS:
            return self.spark.createDataFrame([], SCHEMAS[name])
        if pointer is None:
            raise ValueError(f"no table {name} under {self.root}")
        return _read(self.spark, self.path(name), pointer)

    def _appended(self, name: str, schema: StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as problem:
            if not not_written(problem):
                raise
            return self.spark.createDataFrame([], schema)

    def _raw(self) -> DataFrame:
        return self._appended("price_raw", StructType.fromDDL(S.PRICE_RAW).add("price_year", IntegerType()))

    def _batches(self) -> DataFrame:
        """Batches as the published table and the log of later events have them."""
        log = self._appended("batch_log", StructType.fromDDL(S.BATCH_LOG))
        pointer = _pointer(self.spark, self.path("batch_meta"))
        if pointer is not None:
            held = _read(self.spark, self.path("batch_meta"), pointer)
            log = log.unionByName(held.withColumn("event", F.lit(-1)), allowMissingColumns=True)
        return L.current_batches(log)

    def version(self, name: str) -> int:
        """What :meth:`write` takes as ``base``: the version to be read now, 0 before the first."""
        return current_version(self.spark, self.path(name))

    def write(self, name: str, rows: DataFrame, base: int | None = None) -> None:
        publish(self.spark, self.path(name), rows, base=base)

    def reserve(self, name: str, count: int, first: int = 1) -> int:
        """The first of ``count`` numbers of a sequence that no other run gets."""
        return reserve(self.spark, self.path(f"numbers/{name}"), count, first)

    def log_batches(self, events: DataFrame) -> None:
        """Add batch events (see ``operators.loading.batch_events``); no earlier row is rewritten."""
        columns = [f.name for f in StructType.fromDDL(S.BATCH_LOG) if f.name in events.columns]
        events.select(*columns).hint("coalesce", 1).write.mode("append").parquet(self.path("batch_log"))

    def prepare_events(self, events: DataFrame) -> str:
        """Write batch events of several loads by ``load_seq``, not yet in the log; returns their folder."""
        columns = [f.name for f in StructType.fromDDL(S.BATCH_LOG) if f.name in events.columns]
        folder = f"{self.path('batch_events')}/{uuid.uuid4().hex}"
        dealt = events.select("load_seq", *columns).hint("rebalance", "load_seq")
        dealt.sortWithinPartitions("load_seq").write.partitionBy("load_seq").parquet(folder)
        return folder

    def log_prepared(self, folder: str, load: int) -> None:
        """Add the prepared events of a load to the log: its files change their folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        log, where = path(self.path("batch_log")), path(f"{folder}/load_seq={load}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for file in files.listStatus(where) if files.exists(where) else ():
            # A task gives its files of all loads one name.
            if not files.rename(file.getPath(), path(log, f"load-{load}-{file.getPath().getName()}")):
                raise OSError(f"{file.getPath()} could not be added to the batch log")

    def quarantine(self, rows: DataFrame) -> None:
        """Add records and files that were not loaded, with the reason."""
        rows.select(*[f.name for f in StructType.fromDDL(S.QUARANTINE)]).write.mode("append").parquet(self.path("quarantine"))

    def append_raw(self, rows: DataFrame, loads: int = 1) -> None:
        """Add bars of one or several loads to the raw table, split by load and year of the bar."""
        typed = rows.withColumn("price_year", F.year("price_date"))
        # One shuffle by year and asset (or load) keeps file counts low; a year, asset or load
        # that dominates is split by the adaptive partition rebalancing.
        typed.hint("rebalance", *(["price_year", "asset_id"] if loads == 1 else ["load_seq", "price_year"])).write.mode("append").partitionBy(
            "load_seq", "price_year"
        ).parquet(self.path("price_raw"))

    def folded(self) -> list[tuple[int, int]]:
        """Loads that the base holds, as ranges (first, last)."""
        pointer = _pointer(self.spark, self.path("price_base"))
        return [tuple(r) for r in pointer["facts"]["folded"]] if pointer else []

    def live(self, years: Sequence[int] | None = None, pending: tuple[int, int] | None = None) -> DataFrame:
        """The live bars: those of the base, and of the loads that it has not folded.

        Loads and years are folders, so a folded load is not opened, and its replaced bars not read.
        ``pending``, first and last number of loads that are left out: a run's own that still go on.
        """
        pointer = _pointer(self.spark, self.path("price_base"))
        raw = self._raw()
        if pending is not None and pending[0] <= pending[1]:
            raw = raw.where(~F.col("load_seq").between(*pending))
        wanted = None if years is None else [int(y) for y in years]
        if wanted is not None:
            raw = raw.where(F.col("price_year").isin(wanted))
        if pointer is None:
            return current_prices(raw).drop("price_year")
        base = _read(self.spark, self.path("price_base"), pointer)
        if wanted is not None:
            base = base.where(F.col("price_year").isin(wanted))
        for first, last in pointer["facts"]["folded"]:
            raw = raw.where(~F.col("load_seq").between(first, last))
        return live_prices(base.drop("price_year"), raw.drop("price_year"))

    def compact(self, tries: int = 5) -> list[int]:
        """Fold finished loads into the base; returns the years that were written anew.

        Only the years of the folded bars are written, the base keeps its folders of all
        others. Loads with a batch that has not ended stay as they are. Raw folders are left for the
        storage's own expiry rules.
        """
        for left in range(tries, 0, -1):
            # The log is listed before the bars: what has ended by then has all its bars there.
            ended = self.read("batch_meta").where("status <> 'RUNNING'").select("batch_id")
            base = self.version("price_base")
            folded = self.folded()
            raw = self._raw()
            for first, last in folded:
                raw = raw.where(~F.col("load_seq").between(first, last))
            # One row for each load that is not folded yet, and of each the years.
            open_loads = raw.join(ended, "batch_id", "left_anti").select("load_seq").distinct()
            loads = raw.groupBy("load_seq").agg(F.collect_set("price_year").alias("years"))
            found = loads.join(open_loads, "load_seq", "left_anti").collect()
            if not found:
                return []
            numbers = sorted(r["load_seq"] for r in found)
            years = sorted({int(y) for r in found for y in r["years"]})
            added = raw.where(F.col("load_seq").isin(numbers) & F.col("price_year").isin(years)).drop("price_year")
            pointer = _pointer(self.spark, self.path("price_base"))
            if pointer is not None:
                held = _read(self.spark, self.path("price_base"), pointer).where(F.col("price_year").isin(years))
                rows = live_prices(held.drop("price_year"), added)
            else:
                rows = current_prices(added)
            facts = {"folded": _ranges([*folded, *[(n, n) for n in numbers]])}
            try:
                # A compaction elsewhere changes what is folded, so any newer version counts.
                publish(self.spark, self.path("price_base"), rows, None, years, base, facts, exclusive=True)
                return years
            except MovedOn:
                if left == 1:
                    raise
        return []

    def gold(self, years: Sequence[int] | None = None, pending: tuple[int, int] | None = None) -> DataFrame:
        """Gold computed from the stored tables (not the published version)."""
        return build_gold(self.live(years, pending), self.read("asset"), self.read("data_source"), self.read("batch_meta"))

    def gold_history(self, ended: DataFrame, first: int, last: int, years: Sequence[int] | None = None) -> History:
        """Write gold as it is after each of the loads ``first`` to ``last``, all or some years; none is published.

        ``ended``: the results that end the batches of these loads (see ``operators.loading.finish_batches``).
        """
        base = self.version("price_gold")
        raw = self._raw()
        pointer = _pointer(self.spark, self.path("price_base"))
        for start, end in pointer["facts"]["folded"] if pointer else ():
            raw = raw.where(~F.col("load_seq").between(start, end))
        if pointer is not None:
            raw = raw.unionByName(_read(self.spark, self.path("price_base"), pointer))
        if years is not None:
            raw = raw.where(F.col("price_year").isin([int(y) for y in years]))
        batches = L.finish_batches(self.read("batch_meta"), ended)
        rows = gold_history(raw.drop("price_year"), self.read("asset"), self.read("data_source"), batches, first, last)
        typed = rows.withColumn("price_year", F.year("price_date"))
        created = datetime.now(timezone.utc)
        folder = f"{self.path('price_gold')}/versions/version={created:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        dealt = typed.hint("rebalance", "from_load", "price_year").sortWithinPartitions("from_load", "price_year", "symbol", "price_date")
        dealt.write.partitionBy("from_load", "price_year").parquet(folder)
        schema = typed.drop("from_load", "until_load").schema
        _list_files(self.spark, folder, _with_loads(schema))
        found = self.spark.read.schema("from_load BIGINT, price_year INT").parquet(_manifest(folder))
        firsts = found.groupBy("price_year").agg(F.min("from_load").alias("load")).collect()
        return History(folder, schema.json(), {r["price_year"]: r["load"] for r in firsts}, base)

    def refresh_gold(
        self, years: Sequence[int] | None = None, tries: int = 5, pending: tuple[int, int] | None = None,
        history: History | None = None,
    ) -> None:
        """Replace the published gold table, or those years of it; readers keep the old one meanwhile.

        If another run has replaced it, or one of those years, since the bars were read, they
        are read again. ``pending``: see :meth:`live`; with ``history``, the gold of the last load before those is
        in it and is published as it is, unless another run has published since.
        """
        if history is not None and publish_history(self.spark, self.path("price_gold"), history, pending[0] - 1, years):
            return
        for left in range(tries, 0, -1):
            base = self.version("price_gold")
            # Gold is about as large as the raw bars it is picked from, or smaller.
            size = stored_bytes(self.spark, self.path("price_raw"))
            if years is not None:
                shares = max(1, len(self.gold_years()))
                size = size * min(1.0, len(years) / shares)
            try:
                publish(self.spark, self.path("price_gold"), self.gold(years, pending), int(size), years, base)
                return
            except MovedOn:
                if left == 1:
                    raise

    def gold_of(self, symbols: Sequence[str], first_year: int | None = None, last_year: int | None = None) -> DataFrame:
        """The published bars of a few symbols (see :func:`read_symbols`)."""
        return read_symbols(self.spark, self.path("price_gold"), symbols, first_year, last_year)

    def log_quality(self, checks: DataFrame) -> None:
        """Keep the checks of a load's batches."""
        checks.select(*[f.name for f in StructType.fromDDL(S.QUALITY_LOG)]).hint("coalesce", 1).write.mode("append").parquet(self.path("quality_log"))

    def log_bits(self, bits: DataFrame) -> None:
        """Keep what a load covers (see ``operators.distinct_bits``)."""
        bits.hint("coalesce", 1).write.mode("append").parquet(self.path("coverage_log"))

    def coverage(self, by: Sequence[str] = ()) -> DataFrame:
        """Distinct days and assets, first and last day of all bars of successful batches, ``by`` source_id or in all."""
        return coverage_of(self._appended("coverage_log", StructType.fromDDL(S.COVERAGE_LOG)), by)

    def gold_years(self) -> list[int]:
        pointer = _pointer(self.spark, self.path("price_gold"))
        return [int(y) for y in pointer["years"]] if pointer else []


def _ranges(parts: Sequence[tuple[int, int]]) -> list[list[int]]:
    """Sorted ranges of whole numbers, joined where they touch."""
    out: list[list[int]] = []
    for first, last in sorted(parts):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def seed(store: Store, now: datetime | None = None) -> None:
    """Insert the standard data sources and sample assets that are missing."""
    spark = store.spark
    stamp = F.lit(now or datetime.now(timezone.utc))
    bases = {name: store.version(name) for name in ("data_source", "asset")}
    known = store.read("data_source")
    rows = spark.createDataFrame(
        S.SEED_SOURCES,
        "source_name STRING, source_type STRING, base_url STRING, api_key_required BOOLEAN, rate_limit_per_minute INT",
    ).withColumns({"is_active": F.lit(True), "created_at": stamp})
    new = rows.join(known.select("source_name"), "source_name", "left_anti")
    store.write("data_source", known.unionByName(L.add_with_ids(known, new, "source_id", ["source_name"]), True), bases["data_source"])

    held = store.read("asset")
    assets = spark.createDataFrame(
        S.SEED_ASSETS,
        "symbol STRING, asset_type STRING, currency STRING, exchange STRING, company_name STRING, sector STRING",
    ).withColumns({"is_active": F.lit(True), "created_at": stamp, "updated_at": stamp})
    key = ["symbol", "asset_type"]
    fresh = assets.join(held.select(*key), key, "left_anti")
    store.write("asset", held.unionByName(L.add_with_ids(held, fresh, "asset_id", key), True), bases["asset"])
