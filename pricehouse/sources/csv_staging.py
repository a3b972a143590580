"""Price CSV files as staged text rows.

All files of a load are read in one job, whatever their headers. Lines are
written once to the shared work folder together with their position; header
lines, column order and row numbers follow from that table, so neither a huge
file nor a folder of a million small ones is handled as a unit. What comes of them is
parsed and written once.

Quotes are taken as CSV readers take them: a quote opens a field only at the field's
start, two quotes inside it are one, and what follows the closing quote up to the next
separator belongs to the field. Anywhere else a quote is text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.functions import parsing as P
from pricehouse.session import materialize

STAGED = [*S.STAGE_COLUMNS, "source_file", "row_number"]


#: A path has one slash after the scheme when folders are listed and up to three when files are read.
ONE_SLASH = ("^([^:/]+):/+", "$1:/")


def one_slash(path: str) -> str:
    """What ``ONE_SLASH`` makes of a path."""
    return re.sub(ONE_SLASH[0], r"\1:/", path)


_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_OPEN_COST = "spark.sql.files.openCostInBytes"
#: A small file counts as so many bytes when files are dealt to tasks, so a task opens up to 512 of them.
_SMALL_FILE_BYTES = 256 << 10


def small_file_settings(spark: SparkSession) -> dict[str, str]:
    """Folders are listed in a few tasks a core, and tasks open more files.

    Spark's own settings make a task for each listed folder and for 32 files, whose start costs more than its work.
    """
    return {_LISTING_TASKS: str(4 * spark.sparkContext.defaultParallelism), _OPEN_COST: str(_SMALL_FILE_BYTES)}


@contextmanager
def many_small_files(spark: SparkSession):
    """While files are listed and read: see :func:`small_file_settings`."""
    settings = small_file_settings(spark)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def list_files(spark: SparkSession, folder: str | Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """Path, name, size and ticker of each file, without reading contents."""
    paths = [folder] if isinstance(folder, str) else list(folder)
    with many_small_files(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
    ).withColumn("symbol", P.symbol_from_stem("source_file"))


def nullify_na(df: DataFrame) -> DataFrame:
    """Missing-value tokens in staging columns become NULL."""
    return df.withColumns({c: P.nullify_token(c) for c in S.STAGE_COLUMNS if c in df.columns})


def standardize_columns(df: DataFrame, source_file: str = "source_file") -> DataFrame:
    """Map a frame's own column names to the staging columns.

    Names are compared trimmed and in lower case, the first known alias wins,
    absent columns are NULL and an absent symbol comes from the file name.
    """
    names = {}
    for c in df.columns:
        names.setdefault(c.strip().lower(), c)
    picks = []
    for target in S.STAGE_COLUMNS:
        found = [names[a] for a in S.COLUMN_ALIASES[target] if a in names]
        if found:
            c = F.col(f"`{found[0]}`").cast("string")
        elif target == "symbol" and source_file in df.columns:
            c = P.symbol_from_path(source_file)
        else:
            c = F.lit(None).cast("string")
        picks.append(c.alias(target))
    extras = [c for c in ("source_file", "row_number") if c in df.columns]
    return df.select(*picks, *extras)


#: Unreadable files named by their own error before the rest are looked for in one pass.
_NAMED_FAILURES = 3


def read_lines(spark: SparkSession, paths: Sequence[str], pattern: str = "*.csv", without: Sequence[str] = ()) -> DataFrame:
    """Non-blank lines with file, split offset, split number and reading position."""
    # The position is assigned after the filter, so it has no gaps in a split.
    return _all_lines(spark, paths, pattern, without).where(F.trim("value") != "").withColumn(
        "position", F.monotonically_increasing_id()
    )


def _all_lines(spark: SparkSession, paths: Sequence[str], pattern: str, without: Sequence[str] = ()) -> DataFrame:
    """``without``: files to leave out; Spark drops them when it lists the folder."""
    with many_small_files(spark):
        text = spark.read.option("pathGlobFilter", pattern).text(list(paths))
    read = text.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    for file in without:
        read = read.where(F.regexp_replace("source_file", *ONE_SLASH) != one_slash(file))
    return read.withColumn("split", _split_number(F.col("source_file"), F.col("block")))


def _split_number(source_file: Column, block: Column) -> Column:
    """A long in place of path and offset, so that lines meet their split's facts by a number."""
    return F.xxhash64(source_file, block).alias("split")


def _closes(text: Column) -> Column:
    """Whether a text inside quotes ends its quoted part."""
    return F.contains(F.replace(text, F.lit('""'), F.lit("")), F.lit('"'))


def ends_open(line: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted field, if it starts inside one or not."""
    def after(is_open: Column, part: Column) -> Column:
        opened = part.startswith('"') & ~_closes(F.substring(part, 2, 1 << 30))
        return F.when(is_open, ~_closes(part)).otherwise(opened)

    whole = F.when(line.startswith("\ufeff"), F.substring(line, 2, 1 << 30)).otherwise(line)
    walked = F.aggregate(F.split(whole, ","), F.lit(inside), after)
    return F.when(F.contains(line, F.lit('"')), walked).otherwise(F.lit(inside))


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _flipped(value: Column, times: Column) -> Column:
    return value != _odd(times)


def with_state(lines: DataFrame) -> DataFrame:
    """Adds ``begins`` (the line starts a record), and ``closed`` (its file ends outside quotes).

    A line either sets the state (inside quotes or not), keeps it or flips it. So the state at
    a line follows from the last one that set it and the number of flips since: a running
    sum and a last value within a split, and the same over the splits of a file.
    """
    marked = P.compute_once(lines, {"from_out": ends_open(F.col("value"), False), "from_in": ends_open(F.col("value"), True)})
    inside = Window.partitionBy("split").orderBy("position")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum((F.col("from_out") & ~F.col("from_in")).cast("bigint")).over(upto)
    counted = marked.withColumn("flips", flips)
    setter = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("to"), "flips"))
    known = counted.withColumn("setter", F.last(setter, ignorenulls=True).over(upto))

    ends = known.groupBy("source_file", "block", "split").agg(F.max_by(F.struct("setter", "flips"), "position").alias("end"))
    since = F.col("end.flips") - F.coalesce("end.setter.flips", F.lit(0))
    by_file = Window.partitionBy("source_file").orderBy("block")
    upto_file = by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.select(
        "source_file", "block", "split", F.col("end.setter").isNotNull().alias("sets"),
        F.coalesce(_flipped(F.col("end.setter.to"), since), F.lit(False)).alias("to"), since.alias("since"),
    ).withColumn("file_flips", F.sum(F.when(F.col("sets"), 0).otherwise(F.col("since"))).over(upto_file))
    last = F.last(F.when(F.col("sets"), F.struct("to", F.col("file_flips").alias("at"))), ignorenulls=True).over(upto_file)
    state = _flipped(F.coalesce(F.col("last.to"), F.lit(False)), F.col("file_flips") - F.coalesce("last.at", F.lit(0)))
    ends = ends.withColumn("last", last).withColumn("after", state)
    splits = ends.select(
        F.col("split").alias("of_split"), F.coalesce(F.lag("after").over(by_file), F.lit(False)).alias("starts_in"),
        F.last("after").over(by_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("ends_in"),
    )
    joined = known.join(splits, F.col("split") == F.col("of_split"))
    after = F.when(
        F.col("setter").isNotNull(), _flipped(F.col("setter.to"), F.col("flips") - F.col("setter.flips"))
    ).otherwise(_flipped(F.col("starts_in"), F.col("flips")))
    before = F.coalesce(F.lag("after").over(inside), F.col("starts_in"))
    return joined.withColumn("after", after).withColumn("begins", ~before).withColumn("closed", ~F.col("ends_in")).select(
        *lines.columns, "begins", "closed"
    )


def join_quoted_lines(lines: DataFrame) -> DataFrame:
    """Records in place of lines, where a quoted field holds line breaks.

    ``lines`` are all lines, blank ones too, of files with such fields. A record that is still
    open at its file's end falls back to its lines, so one stray quote costs no rows. A
    record that runs into the next split is known there by its starting line.
    """
    inside = Window.partitionBy("split").orderBy("position")
    begun = F.struct("block", "position")
    tagged = with_state(lines).withColumn("own", F.last(F.when(F.col("begins"), begun), ignorenulls=True).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("source_file")
    carried = tagged.groupBy("source_file", "block", "split").agg(
        F.max(F.when(F.col("begins"), begun)).alias("newest")
    ).select(
        F.col("split").alias("of_split"), F.last("newest", ignorenulls=True).over(earlier).alias("carried"),
        F.max("newest").over(every).alias("final"),
    )
    placed = tagged.join(carried, F.col("split") == F.col("of_split")).withColumn("start", F.coalesce("own", "carried"))
    # Structs of block and position are ordered as the lines of the file are.
    placed = placed.withColumn("start", F.when(~F.col("closed") & (F.col("start") == F.col("final")), begun).otherwise(F.col("start")))
    parts = F.array_sort(F.collect_list(F.struct("block", "position", "value")))
    records = placed.groupBy("source_file", "start").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value")
    ).where(F.trim("value") != "")
    number = F.row_number().over(Window.partitionBy("source_file", "start.block").orderBy("start.position"))
    return records.select(
        "value", "source_file", F.col("start.block").alias("block"), _split_number(F.col("source_file"), F.col("start.block")),
        number.cast("bigint").alias("position"),
    )


def _with_fields(df: DataFrame, line: Column, width: int, name: str) -> DataFrame:
    """Add ``name``: the fields of a CSV line as an array; the line is parsed once."""
    fields = [f"c{i}" for i in range(width)]
    parsed = P.compute_once(df, {"_parsed": F.from_csv(line, ", ".join(f"{f} STRING" for f in fields), {"escape": '"'})})
    return P.compute_once(parsed, {name: F.array(*[F.col(f"_parsed.{f}") for f in fields])}).drop("_parsed")


#: Header lines that one task parses.
_HEADERS_PER_TASK = 2048


def stage_lines(lines: DataFrame) -> DataFrame:
    """Staged rows from a written table of lines (see :func:`read_lines`)."""
    splits = lines.groupBy("split", "source_file", "block").agg(
        F.min("position").alias("first"), F.count("*").alias("lines"), F.min_by("value", "position").alias("value")
    )
    by_file = Window.partitionBy("source_file").orderBy("block")
    splits = materialize(splits.withColumn("before", F.coalesce(F.sum("lines").over(
        by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "split-starts")

    # The first line of the first split of a file is its header.
    headers = splits.where("before = 0").select(F.col("source_file").alias("header_file"), "value")
    width, files = headers.agg(F.max(F.size(F.split("value", ","))), F.count("*")).first()
    if width is None:
        empty = ", ".join(f"{c} STRING" for c in [*S.STAGE_COLUMNS, "source_file"])
        return lines.sparkSession.createDataFrame([], f"{empty}, row_number BIGINT")

    def index_of(target: str) -> Column:
        places = [F.nullif(F.array_position("titles", a), F.lit(0)) for a in S.COLUMN_ALIASES[target]]
        return (F.coalesce(*places) - 1).cast("int").alias(f"i_{target}")

    # A given number of tasks: Spark's own goes by bytes, and a header has few.
    dealt = headers.repartition(1 + files // _HEADERS_PER_TASK, "header_file")
    titled = _with_fields(dealt, F.regexp_replace("value", "^\ufeff", ""), width, "_titles")
    titled = P.compute_once(titled, {"titles": F.transform("_titles", lambda t: F.lower(F.trim(t)))})
    layout = titled.select("header_file", *[index_of(c) for c in S.STAGE_COLUMNS])
    # The ticker in a file's name is worked out here, for each file and not for each line.
    layout = P.compute_once(layout, {
        "file_symbol": F.when(F.col("i_symbol").isNull(), P.symbol_from_path("header_file"))
    })
    lookup = splits.join(layout, F.col("source_file") == F.col("header_file")).select(
        F.col("split").alias("of_split"), F.col("source_file").alias("file"), "first", "before",
        "file_symbol", *[f"i_{c}" for c in S.STAGE_COLUMNS],
    )
    lookup = materialize(lookup, "splits")  # one row per split
    numbers = lookup.agg(F.count("*").alias("rows"), F.countDistinct("of_split").alias("known")).first()
    if numbers["rows"] != numbers["known"]:
        raise ValueError("two splits share a number; load the files in two parts")

    rows = lines.select("value", "split", "position").join(lookup, F.col("split") == F.col("of_split")).withColumn(
        "row_number", F.col("before") + F.col("position") - F.col("first")
    )
    cells = _with_fields(rows.where("row_number > 0"), F.col("value"), width, "cells")
    picked = P.compute_once(cells, {f"v_{c}": F.get("cells", F.col(f"i_{c}")) for c in S.STAGE_COLUMNS})
    values = {c: P.nullify_token(f"v_{c}") for c in S.STAGE_COLUMNS}
    values["symbol"] = F.when(F.col("i_symbol").isNull(), F.col("file_symbol")).otherwise(values["symbol"])
    return picked.select(
        *[values[c].alias(c) for c in S.STAGE_COLUMNS],
        F.col("file").alias("source_file"),
        F.col("row_number").cast("bigint").alias("row_number"),
    )


def _failed_file(problem: Exception) -> tuple[str, str] | None:
    """The file that could not be read, and why, from an error of Spark's."""
    said = str(problem)
    found = re.search(r"Encountered error while reading file (\S+?)\.?(?: SQLSTATE|\s|$)", said)
    if not found:
        return None
    causes = [c for c in re.findall(r"Caused by: ([^\n]+)", said) if "FAILED_READ_FILE" not in c and "SparkException" not in c]
    return re.sub("^file:/+", "file:/", found[1]), causes[-1] if causes else "it cannot be read"


def readable_lines(
    spark: SparkSession, paths: Sequence[str], pattern: str = "*.csv"
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The written lines of all files that can be read, and (file, message) of the others.

    The first few failures cost a repeated read each and bring their own message. If there
    are more, one tolerant pass finds all files that give no line though they hold bytes.
    """
    bad: dict[str, str] = {}
    while True:
        try:
            with many_small_files(spark):
                return materialize(read_lines(spark, paths, pattern, list(bad)), "lines"), sorted(bad.items())
        except (PySparkException, Py4JJavaError) as problem:
            found = _failed_file(problem)
            if found is None or found[0] in bad:
                raise
            bad[found[0]] = found[1]
        if len(bad) == _NAMED_FAILURES:
            files = list_files(spark, paths, pattern).where("file_size_bytes > 0").select("source_file")
            tolerant = spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).text(list(paths))
            read = tolerant.select(F.col("_metadata.file_path").alias("read_file")).distinct()
            silent = files.join(read, F.col("source_file") == F.col("read_file"), "left_anti")
            for row in silent.toLocalIterator():
                bad.setdefault(row["source_file"], "it cannot be read")


def stage_csv(
    spark: SparkSession, paths: Sequence[str] | str, pattern: str = "*.csv", unreadable: list | None = None
) -> DataFrame:
    """CSV files as text rows with ``source_file`` and 1-based ``row_number``, written once.

    ``paths`` are files, folders or globs; only names matching ``pattern`` count. A file
    without data rows gives none. Quoted fields may hold line breaks; files in which a line
    ends inside quotes are put together from their lines first. A file that cannot be read
    is an error, or with ``unreadable`` is left out and added to that list as (file, message).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if unreadable is None:
        with many_small_files(spark):
            lines, bad = materialize(read_lines(spark, paths, pattern), "lines"), []
    else:
        lines, bad = readable_lines(spark, paths, pattern)
        unreadable += bad
    opens = ends_open(F.col("value"), False)
    broken = materialize(lines.where(opens).select("source_file").distinct(), "broken-files")
    if not broken.isEmpty():
        again = _all_lines(spark, paths, pattern, [f for f, _ in bad]).withColumn("position", F.monotonically_increasing_id())
        records = join_quoted_lines(again.join(broken, "source_file", "left_semi"))
        whole = lines.join(broken, "source_file", "left_anti")
        lines = whole.select("value", "source_file", "block", "split", "position").unionByName(materialize(records, "records"))
    return materialize(stage_lines(lines), "staged")
