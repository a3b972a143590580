"""Kept statistics, bitmaps and file lists against plain versions."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricehouse.operators.distinct_bits import coverage_of, day_number, distinct_counts, number_bits
from pricehouse.plans import marts, upkeep
from pricehouse.plans.store import _pointer, publish, read_published, read_symbols

GOLD = (
    "price_id BIGINT, asset_id INT, symbol STRING, asset_type STRING, currency STRING, exchange STRING, company_name STRING, price_date DATE, "
    "open_price DECIMAL(15,6), high_price DECIMAL(15,6), low_price DECIMAL(15,6), close_price DECIMAL(15,6), volume BIGINT"
)


def gold(spark, bars):
    rows = []
    for (asset, day), (close, volume) in sorted(bars.items()):
        price = Decimal(close)
        rows.append((1, asset, f"S{asset:03d}", "STOCK", "USD", None, None, date(2023, 12, 1) + timedelta(day), price, price + 2, price - 1, price, volume))
    return spark.createDataFrame(rows, GOLD)


@pytest.mark.parametrize("seed", range(3))
def test_kept_statistics_equal_the_full_build(spark, seed):
    rng = random.Random(seed)
    asset = spark.createDataFrame([(a, f"S{a:03d}", "STOCK", "USD", None, None, a != 4) for a in range(9)],
                                  "asset_id INT, symbol STRING, asset_type STRING, currency STRING, exchange STRING, company_name STRING, is_active BOOLEAN")
    bars = {(a, d): (rng.randint(2, 40), rng.choice([None, rng.randrange(99)])) for a in range(7) for d in range(12) if rng.random() < 0.8}
    before = gold(spark, bars)
    stats = upkeep.asset_stats(before)
    for _ in range(2):
        for key in rng.sample(sorted(bars), 14):
            if rng.random() < 0.5:
                del bars[key]
            else:
                bars[key] = (rng.randint(1, 60), 5)
        bars.update({(rng.randrange(9), rng.randrange(30)): (rng.randint(1, 60), None) for _ in range(6)})
        for d in range(40):
            bars.pop((2, d), None)  # an asset that loses all its bars
        after = gold(spark, bars)
        stats = upkeep.maintained_stats(stats, *upkeep.changed_bars(before, after), after)
        before = after
    shown = {r["asset_id"]: r for r in upkeep.summary_of(asset, stats).collect()}
    full = {r["asset_id"]: r for r in marts.asset_summary(asset, after).collect()}
    assert shown.keys() == full.keys() and 4 not in full
    for a, wanted in full.items():
        for name, value in wanted.asDict().items():
            got = shown[a][name]
            assert got == (pytest.approx(value, rel=1e-9, abs=1e-9) if isinstance(value, float) else value), (a, name)


def test_bits_of_loads_count_once(spark):
    rows = [(1, date(2024, 1, 1)), (1, date(1969, 12, 30)), (2, date(2024, 1, 1)), (40_000, date(2060, 1, 1)), (None, None), (2, date(2024, 1, 1))]
    df = spark.createDataFrame([(i % 2, *r) for i, r in enumerate(rows)], "load INT, asset INT, day DATE")
    kinds = {"day": day_number(F.col("day")), "asset": F.col("asset")}
    bits = [number_bits(df.where(F.col("load") == n), kinds) for n in (0, 1, 1)]
    merged = bits[0].unionByName(bits[1]).unionByName(bits[2])
    assert {r["kind"]: (r["numbers"], r["least"], r["most"]) for r in distinct_counts(merged).collect()} == {
        "day": (3, -2, 32872), "asset": (3, 1, 40_000)}
    assert tuple(coverage_of(merged).first()) == (3, date(1969, 12, 30), date(2060, 1, 1), 3)
    assert distinct_counts(number_bits(df.limit(0), kinds)).count() == 0


def test_a_ticker_is_read_from_one_file_a_year(spark, tmp_path):
    bars = {(a, d): (10, 1) for a in range(60) for d in range(0, 60, 3)}  # December and January
    path = str(tmp_path / "gold")
    publish(spark, path, gold(spark, bars), about_bytes=20 * (128 << 20))  # cut as if it were large
    stored = read_published(spark, path)
    assert len(stored.inputFiles()) > 10
    one = read_symbols(spark, path, ["S007"])
    assert len(one.inputFiles()) <= 4 and one.count() == 20 and {r["symbol"] for r in one.select("symbol").collect()} == {"S007"}
    assert len(read_symbols(spark, path, ["S007"], 2024, 2024).inputFiles()) <= 2
    assert read_symbols(spark, path, ["S007"], 2024, 2024).where("year(price_date) <> 2024").isEmpty()
    assert read_symbols(spark, path, ["ZZZ", "A"]).count() == 0 and read_symbols(spark, path, []).count() == 0
    assert read_symbols(spark, path, ["S007", "S059"]).count() == 40
    changed = gold(spark, {(7, 45): (99, 1), (8, 45): (98, 1)})
    publish(spark, path, changed, years=[2024], base=1)
    assert set(_pointer(spark, path)["years"]) == {"2023", "2024"}
    assert read_symbols(spark, path, ["S007"]).where("year(price_date) = 2024").count() == 1
    publish(spark, str(tmp_path / "none"), changed.limit(0))
    assert read_symbols(spark, str(tmp_path / "none"), ["S007"]).count() == 0 and read_published(spark, str(tmp_path / "none")).count() == 0


def test_adjusted_prices_around_a_close_of_zero(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    bars = [(1, "A", date(2024, 1, d), c) for d, c in ((1, 0.0), (2, 0.0), (3, 8.0), (4, 4.0))]
    gold = table(bars, "asset_id INT, symbol STRING, price_date DATE, close_price DOUBLE")
    actions = table([(1, 1, date(2024, 1, 4))], "action_id INT, asset_id INT, ex_date DATE")
    cash = table([], "action_id INT, dividend_amount DOUBLE")
    split = table([(1, 2, 1)], "action_id INT, split_ratio_to INT, split_ratio_from INT")
    stock = table([], "action_id INT, dividend_ratio DOUBLE")
    rows = marts.adjusted_prices(gold, actions, cash, split, stock).orderBy("price_date").collect()
    assert [r["adjusted_close"] for r in rows] == [0.0, 0.0, 4.0, 4.0]
    first, still, up, split_day = [r["total_return"] for r in rows]
    assert first is None and still != still and up == float("inf") and split_day == 0.0
