import math
import random

import pandas as pd
import pytest

from pricehouse.operators import constraints as K
from pricehouse.operators import quality as Q
from pricehouse.operators.loading import prepare_prices


def good(n, symbol="AAPL"):
    return [(symbol, f"2024-01-{i + 1:02d}", f"{100 + i}", f"{102 + i}", f"{99 + i}", f"{101 + i}", "1000") for i in range(n)]


def one(df):
    return df.first().asDict()


def test_perfect_rows_score_100(stage_rows):
    assert one(Q.score_quality(stage_rows(good(5))))["quality_score"] == 100.0


def test_poor_rows_score_by_the_formula(stage_rows):
    rows = [
        ("AAPL", "2024-01-01", "100", "102", "99", "101", "1000"),
        (None, "invalid-date", "abc", "102", "99", "101", "1000"),
        ("AAPL", "2024-01-01", "100", "102", "99", "101", "1000"),
    ]
    got = one(Q.score_quality(stage_rows(rows)))
    assert got["quality_score"] == 72.22
    assert round(got["completeness"], 4) == 88.8889 and got["consistency"] == 100.0


def test_no_rows_score_zero_and_fail_the_schema(spark, stage_rows):
    empty = stage_rows(good(1)).limit(0)
    assert one(Q.score_quality(empty))["quality_score"] == 0.0
    with pytest.raises(ValueError, match="empty"):
        Q.validate_schema(empty)
    with pytest.raises(ValueError, match="Missing required columns"):
        Q.validate_schema(spark.range(1))
    Q.validate_schema(stage_rows(good(1)))


def test_duplicates_keep_all_and_match_nulls(stage_rows):
    rows = good(2) + good(1) + [(None, None, *good(1)[0][2:])] * 2
    assert Q.detect_duplicates(stage_rows(rows)).count() == 4
    assert Q.detect_duplicates(stage_rows(rows), ["nope"]).count() == 0


def test_findings(stage_rows):
    rows = [
        ("A", "d1", "-1", "-2", "1", "10", "0"),
        ("A", "d2", "1", "1", "1", "15.1", "x"),
        ("A", "d3", "1", "1", "1", "0", "0.0"),
        ("A", "d4", "1", "1", "1", "0", "5"),
        ("A", "d5", "1", "1", "1", "3", "5"),
        (None, "d6", "1", "1", "1", "900", "5"),
        ("A", "d7", "1", "1", "1", "nan", "5"),
        ("A", "d8", "1", "1", "1", "900", "5"),
    ]
    found = {(r["finding"], r["date_str"], r["field"]) for r in Q.price_findings(stage_rows(rows)).collect()}
    assert found == {
        ("negative_prices", "d1", "open_str"), ("negative_prices", "d1", "high_str"),
        ("zero_volumes", "d1", "volume_str"), ("zero_volumes", "d3", "volume_str"),
        ("extreme_values", "d2", "close_str"), ("extreme_values", "d3", "close_str"), ("extreme_values", "d5", "close_str"),
    }


def test_moves_that_are_no_number_are_not_extreme(stage_rows):
    closes = ["1", "inf", "5", "5.1", "inf", "inf", "nan", "6"]
    rows = [("A", f"2024-01-{i:02d}", "1", "1", "1", c, "1") for i, c in enumerate(closes, 1)]
    finite = [float(c) for c in closes]
    want = {
        i + 1 for i in range(1, len(finite))
        if abs((finite[i] - finite[i - 1]) / finite[i - 1] * 100) > 50  # false for NaN
    }
    assert {r["row_number"] for r in Q.extreme_moves(stage_rows(rows)).collect()} == want


def test_report_and_log(stage_rows):
    rows = good(3) + good(1)
    report = one(Q.quality_report(stage_rows(rows)))
    assert (report["row_count"], report["duplicate_count"], report["duplicate_percentage"]) == (4, 2, 50.0)
    assert (report["unique_symbols"], report["min_date"], report["max_date"]) == (1, "2024-01-01", "2024-01-03")
    assert report["null_adj_close_str"] == 4 and report["null_symbol"] == 0 and report["schema_valid"]
    log = {r["check_name"]: r["check_result"] for r in Q.quality_log(Q.score_quality(stage_rows(rows), "source_file"), "source_file").collect()}
    assert log == {"completeness": "PASS", "validity": "PASS", "consistency": "PASS", "uniqueness": "FAIL"}


def python_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def pandas_score(rows):
    """A small independent model of the four scores."""
    frame = pd.DataFrame(rows, columns=["s", "d", "o", "h", "l", "c", "v"])
    n = len(frame)
    filled = frame[["s", "d", "c"]].notna().sum().sum() / (3 * n)
    valid = 0
    for r in rows:
        ok = r[1] is None or pd.notna(pd.to_datetime(r[1], format="%Y-%m-%d", errors="coerce"))
        valid += ok and all(x is None or python_float(x) is not None for x in r[2:])
    numbers = frame[list("ohlc")].map(lambda x: python_float(x) if x is not None else None).astype(float).dropna()
    fine = (
        (numbers.h >= numbers[["o", "c"]].max(axis=1)) & (numbers.l <= numbers[["o", "c"]].min(axis=1))
        & (numbers.h >= numbers.l) & (numbers > 0).all(axis=1)
    )
    consistent = fine.mean() if len(numbers) else 0.0
    unique = 1 - frame.duplicated(["s", "d"], keep=False).mean()
    return [filled * 100, valid / n * 100, consistent * 100, unique * 100]


def test_scores_equal_a_pandas_model_on_random_rows(stage_rows):
    rng = random.Random(7)
    numbers = ["1", "2.5", "-3", "abc", None, "inf", "nan", "1e2", "0"]
    dates = ["2024-01-01", "2024-1-2", "2024-02-30", "01/02/2024", None]
    for _ in range(4):
        rows = [
            (rng.choice(["A", "B", None]), rng.choice(dates), *[rng.choice(numbers) for _ in range(4)], rng.choice(numbers))
            for _ in range(60)
        ]
        got = one(Q.score_quality(stage_rows(rows)))
        names = ["completeness", "validity", "consistency", "uniqueness"]
        assert all(math.isclose(got[n], w, abs_tol=1e-9) for n, w in zip(names, pandas_score(rows)))


def test_prepare_splits_rows_and_keeps_bad_optionals(stage_rows):
    rows = good(2) + [
        ("A", "2024-01-09", "5", "4", "3", "4", "1"),
        ("A", "2024-01-09", "nan", "4", "3", "4", "1"),
        ("A", "2024-01-09", "4", "inf", "3", "4", "1"),
        ("A", "01/09/2024", "4", "4", "3", "4", "1"),
        ("A", "2024-01-10", "4", "4", "3", "4", "x"),
    ]
    stage = stage_rows(rows)
    accepted, rejected = prepare_prices(stage)
    assert accepted.count() == 3 and rejected.count() == 4
    assert accepted.count() + rejected.count() == stage.count()
    assert accepted.where("row_number = 7").first()["volume"] is None
    assert K.check_ohlc(accepted).count() == 0


def test_staging_issues(stage_rows):
    rows = [
        ("A", "2024-01-01", "1", "2", "1", "1", "1"), ("A", "2024-01-01", "1e5", "5.", "-1", ".5", "1"),
        ("", "1/2/2024", "1", "1", "1", None, "1"), ("B", "2024.1.1", "x", "1", "1", "1", "1"),
    ]
    got = {r["issue"]: r["rows"] for r in Q.staging_issues(stage_rows(rows)).collect()}
    assert got == {
        "missing symbol": 1, "missing close price": 1, "invalid date format": 1, "invalid open_str": 2,
        "invalid high_str": 1, "invalid low_str": 1, "duplicate symbol-date combinations": 1}


def test_constraint_rules_pass_on_null(spark):
    df = spark.createDataFrame([(1, None), (2, "X"), (3, "A")], "i INT, kind STRING")
    assert [r["i"] for r in K.check_domain(df, "kind", ["A"]).collect()] == [2]
    assert K.check_unique(df.union(df).union(df.where("kind is null")), ["kind"]).count() == 2
    parent = spark.createDataFrame([("A",)], "kind STRING")
    assert [r["i"] for r in K.check_reference(df, parent, "kind").collect()] == [2]
    assert [r["i"] for r in K.check_not_null(df, ["kind"]).collect()] == [1]
    assert [r["i"] for r in K.check_positive(df.withColumn("v", df.i - 2), ["v"]).orderBy("i").collect()] == [1, 2]
