"""Quality scores, findings and reports for staged price rows.

Every score is an aggregate, so one job scores any number of files: rows are
first reduced per (file, symbol, date), which spreads even a single huge file
over all tasks, and those partial results are then added up per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse import schemas as S
from pricehouse.functions import parsing as P
from pricehouse.operators.carry import previous_value
from pricehouse.operators.joins import null_safe_join

KEY = ["symbol", "date_str"]

#: The parts of a score.
SCORES = ("completeness", "validity", "consistency", "uniqueness")

#: Rows of a file that one task looks back over.
CHUNK_ROWS = 1_000_000


#: What the schema check says of rows that are not there.
NO_ROWS = "DataFrame is empty"


def missing_columns(columns: Sequence[str]) -> str | None:
    """What the schema check says of required staging columns that are not there."""
    missing = [c for c in S.REQUIRED_STAGE_COLUMNS if c not in columns]
    return f"Missing required columns: {missing}" if missing else None


def validate_schema(df: DataFrame) -> None:
    """Raise when a required staging column is missing or there is no row."""
    problem = missing_columns(df.columns) or (NO_ROWS if df.isEmpty() else None)
    if problem:
        raise ValueError(problem)


def schema_errors(df: DataFrame, groups: DataFrame, by: str = "source_file") -> DataFrame:
    """The schema check of each of ``groups`` (a column ``by``): ``schema_error``, NULL where it holds."""
    missing = missing_columns(df.columns)
    if missing:
        return groups.select(by).distinct().withColumn("schema_error", F.lit(missing))
    held = df.groupBy(F.col(by).alias("_held")).agg(F.count("*").alias("_rows"))
    joined = groups.select(by).distinct().join(held, F.col(by) == F.col("_held"), "left")
    return joined.select(by, F.when(F.col("_rows").isNull(), F.lit(NO_ROWS)).alias("schema_error"))


def detect_duplicates(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All rows whose key occurs more than once; NULL keys equal each other.

    Keys are counted with map-side combining and joined back, so rows of a very
    frequent key are never sorted in one task.
    """
    keys = list(keys) or KEY
    if any(c not in df.columns for c in keys):
        return df.limit(0)
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return null_safe_join(df, repeated, keys, "left_semi")


def _present(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def row_checks(df: DataFrame) -> DataFrame:
    """Add per-row flags used by the scores."""
    names = [*S.PRICE_STRINGS, "volume_str"]
    parsed = P.compute_once(df, {
        "_date": P.iso_date(_present(df, "date_str")),
        **{f"_n_{c}": P.to_number(_present(df, c)) for c in names},
    })
    valid = _present(df, "date_str").isNull() | F.col("_date").isNotNull()
    for c in names:
        valid = valid & (_present(df, c).isNull() | F.col(f"_n_{c}").isNotNull())
    finite = [F.nanvl(f"_n_{c}", F.lit(None).cast("double")) for c in S.PRICE_STRINGS]
    priced = F.lit(True)
    for number in finite:
        priced = priced & number.isNotNull()
    empty = [F.when(_present(df, n).isNull(), 1).otherwise(0) for n in ("symbol", "date_str", "close_str")]
    negatives = [F.when(number < 0, 1).otherwise(0) for number in finite]
    return parsed.select(
        *df.columns,
        (empty[0] + empty[1] + empty[2]).alias("_missing"),
        F.when(valid, 1).otherwise(0).alias("_valid"),
        F.when(priced, 1).otherwise(0).alias("_priced"),
        F.when(priced & P.is_consistent_ohlc(*finite), 1).otherwise(0).alias("_consistent"),
        (negatives[0] + negatives[1] + negatives[2] + negatives[3]).alias("_negative"),
        F.when(F.col("_n_volume_str") == 0, 1).otherwise(0).alias("_zero"),
    )


def _partial(df: DataFrame, by: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    keys = [c for c in KEY if c not in by]
    with_keys = df.select("*", *[F.lit(None).cast("string").alias(c) for c in KEY if c not in df.columns])
    return row_checks(with_keys).groupBy(*by, *keys).agg(
        F.count("*").alias("_rows"),
        F.sum("_missing").alias("_missing"),
        F.sum("_valid").alias("_valid"),
        F.sum("_priced").alias("_priced"),
        F.sum("_consistent").alias("_consistent"),
        *extra,
    ).withColumn("_repeated", F.when(F.col("_rows") > 1, F.col("_rows")).otherwise(0))


def _score_columns() -> dict[str, Column]:
    rows = F.sum("_rows")
    share = {
        "completeness": F.try_divide(rows * 3 - F.sum("_missing"), rows * 3),
        "validity": F.try_divide(F.sum("_valid"), rows),
        "consistency": F.try_divide(F.sum("_consistent"), F.sum("_priced")),
        "uniqueness": F.try_divide(rows - F.sum("_repeated"), rows),
    }
    return {name: F.coalesce(part * 100, F.lit(0.0)) for name, part in share.items()}


def score_quality(df: DataFrame, by: Sequence[str] | str | None = None) -> DataFrame:
    """Scores 0-100 per group (all rows when ``by`` is None), and their mean.

    completeness: filled symbol, date and close cells; validity: rows that parse;
    consistency: rows with four prices that obey the OHLC rule; uniqueness: rows
    outside duplicate (symbol, date) groups. Without rows everything is 0.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    scores = _score_columns()
    out = _partial(df, by).groupBy(*by).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        *[c.alias(n) for n, c in scores.items()],
    )
    return out.withColumn("quality_score", _total())


def score_files(stage: DataFrame) -> DataFrame:
    """Scores per file together with its symbols, from one scan.

    ``symbol_count`` counts NULL as a symbol; ``file_symbol`` is the only symbol
    of a file that has one.
    """
    sums = ["_rows", "_missing", "_valid", "_priced", "_consistent", "_repeated"]
    per_symbol = _partial(stage, ["source_file"]).groupBy("source_file", "symbol").agg(
        *[F.sum(c).alias(c) for c in sums]
    )
    scores = _score_columns()
    return (
        per_symbol.groupBy("source_file")
        .agg(
            F.sum("_rows").alias("row_count"),
            *[c.alias(n) for n, c in scores.items()],
            F.count("*").alias("symbol_count"),
            F.max("symbol").alias("file_symbol"),
        )
        .withColumn("quality_score", _total())
    )


def _total() -> Column:
    parts = F.col("completeness") + F.col("validity") + F.col("consistency") + F.col("uniqueness")
    return F.bround(parts / 4, 2)


def extreme_moves(
    stage: DataFrame, threshold: float = S.EXTREME_MOVE_PCT, rows_per_chunk: int = CHUNK_ROWS
) -> DataFrame:
    """Rows whose close moves more than ``threshold`` percent from the row before.

    The row before is the previous row of the symbol in the same file. A move
    away from zero counts; zero to zero, unknown closes and moves that are no
    number (from one infinite close to another, say) do not.
    """
    rows = P.compute_once(stage.where("symbol is not null"), {"_close": P.to_finite("close_str")})
    seen = previous_value(
        rows, ["source_file", "symbol"], ["row_number"], "_close",
        F.floor((F.col("row_number") - 1) / rows_per_chunk), "_prev",
    )
    prev, now = F.col("_prev"), F.col("_close")
    pct = (now - prev) / F.when(prev != 0, prev) * 100
    extreme = F.when(prev == 0, now != 0).otherwise((F.abs(pct) > threshold) & ~F.isnan(pct))
    return seen.where(extreme).select(*stage.columns)


def price_findings(stage: DataFrame) -> DataFrame:
    """Findings in long form: negative prices, extreme moves, zero volumes.

    A row with two negative prices yields two findings, one per column.
    """
    head = ["source_file", "row_number", "symbol", "date_str"]
    columns = [F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in S.PRICE_STRINGS]
    checked = [F.struct(F.lit("volume_str").alias("field"), F.col("volume_str").alias("value")), *columns]
    cells = stage.select(*head, F.explode(F.array(*checked)).alias("cell")).select(*head, "cell.field", "cell.value")
    number = P.to_finite("value")
    is_volume = F.col("field") == "volume_str"
    plain = cells.withColumn(
        "finding",
        F.when(is_volume & (number == 0), F.lit("zero_volumes")).when(~is_volume & (number < 0), F.lit("negative_prices")),
    ).where("finding is not null")
    moves = extreme_moves(stage).select(
        *head, F.lit("close_str").alias("field"), F.col("close_str").alias("value"), F.lit("extreme_values").alias("finding")
    )
    return plain.unionByName(moves)


def quality_report(stage: DataFrame, by: str = "source_file", files: DataFrame | None = None) -> DataFrame:
    """One report row per file: scores, counts, findings, missing cells and the schema check.

    ``files`` (a column ``by``) names files that may have no row; these have a report too, with
    all scores and counts 0 and ``schema_valid`` false.
    """
    columns = [c for c in stage.columns if c not in (by, "row_number")]
    extra = [
        F.sum("_negative").alias("_negative"),
        F.sum("_zero").alias("_zero"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns if c not in KEY],
    ]
    partial = _partial(stage, [by], extra)
    scores = _score_columns()
    null_counts = [
        F.sum(F.when(F.col(c).isNull(), F.col("_rows")).otherwise(0) if c in KEY else F.col(f"_null_{c}")).alias(f"null_{c}")
        for c in columns
    ]
    summed = partial.groupBy(by).agg(
        F.sum("_rows").alias("row_count"),
        F.lit(len(stage.columns)).alias("column_count"),
        *[c.alias(n) for n, c in scores.items()],
        F.sum("_repeated").alias("duplicate_count"),
        F.sum("_negative").alias("negative_prices"),
        F.sum("_zero").alias("zero_volumes"),
        F.countDistinct("symbol").alias("unique_symbols"),
        F.min("date_str").alias("min_date"),
        F.max("date_str").alias("max_date"),
        *null_counts,
    )
    moves = extreme_moves(stage).groupBy(by).agg(F.count("*").alias("extreme_values"))
    if files is not None:
        named = files.select(F.col(by).alias("_file")).distinct()
        summed = named.join(summed, F.col("_file") == F.col(by), "full").withColumn(by, F.coalesce(by, "_file")).drop("_file")
        # What has no row counts nothing, but the first and last date stay unknown.
        summed = summed.fillna(0).withColumn("column_count", F.lit(len(stage.columns)))
    missing = missing_columns(stage.columns)
    error = F.lit(missing) if missing else F.when(F.col("row_count") == 0, F.lit(NO_ROWS))
    return (
        summed.join(moves, by, "left")
        .withColumn("extreme_values", F.coalesce("extreme_values", F.lit(0)))
        .withColumn("quality_score", _total())
        .withColumn("schema_error", error.cast("string"))
        .withColumn("schema_valid", F.col("schema_error").isNull())
        .withColumn("duplicate_percentage", F.coalesce(F.try_divide(F.col("duplicate_count") * 100.0, F.col("row_count")), F.lit(0.0)))
    )


def quality_gate(scores: DataFrame, min_score: float = S.MIN_QUALITY_SCORE) -> DataFrame:
    """Add ``accepted``: the score reaches the threshold."""
    return scores.withColumn("accepted", F.coalesce(F.col("quality_score") >= min_score, F.lit(False)))


def quality_log(scores: DataFrame, batch: str) -> DataFrame:
    """One PASS / WARN / FAIL row per batch and check.

    PASS means nothing was found. WARN stays within the tolerated share of
    missing cells (completeness) or repeated rows (uniqueness), or above the
    acceptance score (other checks). The rest is FAIL.
    """
    checks = {
        "completeness": 100 - S.MAX_NULL_PCT,
        "validity": S.MIN_QUALITY_SCORE,
        "consistency": S.MIN_QUALITY_SCORE,
        "uniqueness": 100 - S.MAX_DUPLICATE_PCT,
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.when(F.col(name) >= 100, F.lit("PASS")).when(F.col(name) >= floor, F.lit("WARN"))
                .otherwise(F.lit("FAIL")).alias("check_result"),
                F.col(name).cast("decimal(5,2)").alias("score"),
                F.create_map(
                    F.lit("row_count"), F.col("row_count").cast("string"), F.lit("warn_from"), F.lit(str(floor))
                ).alias("details"),
            )
            for name, floor in checks.items()
        ]
    )
    return scores.select(F.col(batch), F.explode(rows).alias("c")).select(batch, "c.*")


def staging_summary(stage: DataFrame) -> DataFrame:
    """Rows, symbols, files and the range of date texts, in one pass."""
    return stage.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("symbol").alias("symbol_count"),
        F.countDistinct("source_file").alias("file_count"),
        F.min("date_str").alias("min_date"),
        F.max("date_str").alias("max_date"),
    )


def staging_issues(stage: DataFrame) -> DataFrame:
    """Issue counts in long form (``issue``, ``rows``); only issues that occur."""

    def given(name: str) -> Column:
        return F.col(name).isNotNull() & (F.col(name) != "")

    def absent(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    bad_date = given("date_str")
    for shape in S.STAGE_DATES:
        bad_date = bad_date & ~F.col("date_str").rlike(shape)
    counters = {
        "missing symbol": absent("symbol"),
        "missing date": absent("date_str"),
        "missing close price": absent("close_str"),
        "invalid date format": bad_date,
        **{f"invalid {c}": given(c) & ~F.col(c).rlike(S.STAGE_PRICE) for c in S.PRICE_STRINGS},
    }
    keyed = stage.groupBy("symbol", "date_str").agg(
        F.count("*").alias("_rows"),
        *[F.count_if(test).alias(name) for name, test in counters.items()],
    )
    repeated = F.col("symbol").isNotNull() & F.col("date_str").isNotNull() & (F.col("_rows") > 1)
    totals = keyed.agg(
        *[F.coalesce(F.sum(F.col(f"`{name}`")), F.lit(0)).alias(name) for name in counters],
        F.count_if(repeated).alias("duplicate symbol-date combinations"),
    )
    names = [*counters, "duplicate symbol-date combinations"]
    rows = F.array(*[F.struct(F.lit(n).alias("issue"), F.col(f"`{n}`").alias("rows")) for n in names])
    return totals.select(F.explode(rows).alias("i")).select("i.*").where(F.col("rows") > 0)
