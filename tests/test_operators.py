import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricehouse.operators import analytics as A
from pricehouse.operators.carry import previous_value
from pricehouse.operators.numbering import number_rows
from pricehouse.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; values repeat and some are missing."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({
        "g": np.where(rng.random(6000) < 0.6, "hot", rng.choice(["a", "b", "c"], 6000)),
        "n": np.arange(6000),
        "v": np.round(rng.lognormal(3, 2, 6000), 2),
    })
    frame.loc[rng.random(6000) < 0.1, "v"] = np.nan
    df = spark.createDataFrame(frame).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    df = df.unionByName(spark.createDataFrame([(None, 1, 5.0), (None, 2, 6.0), ("one", 1, 7.0)], "g STRING, n BIGINT, v DOUBLE"))
    return df.cache()


@pytest.mark.parametrize("skip_nulls", [False, True])
def test_previous_value_equals_a_plain_window(skewed, skip_nulls):
    w = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    plain = F.last("v", ignorenulls=True).over(w) if skip_nulls else F.lag("v").over(Window.partitionBy("g").orderBy("n"))
    cut = previous_value(skewed, ["g"], ["n"], "v", F.floor(F.col("n") / 37), "p", skip_nulls)
    assert cut.count() == skewed.count()
    want = skewed.withColumn("p", plain)
    assert want.exceptAll(cut.select(want.columns)).isEmpty() and cut.select(want.columns).exceptAll(want).isEmpty()


def test_quantiles_equal_numpy(skewed):
    probs = {"low": 0.25, "mid": 0.5, "high": 0.75, "top": 1.0, "zero": 0.0}
    got = {r["g"]: r for r in exact_quantiles(skewed, ["g"], "v", probs).collect()}
    frame = skewed.toPandas()
    for g, part in frame.groupby("g", dropna=False):
        row = got[None if pd.isna(g) else g]
        for name, q in probs.items():
            assert np.isclose(row[name], part["v"].quantile(q), rtol=1e-12), (g, name)


def test_ungrouped_quantiles(skewed):
    rows = exact_quantiles(skewed, [], "v", {"q": 0.3}).collect()
    assert len(rows) == 1 and np.isclose(rows[0]["q"], skewed.toPandas()["v"].quantile(0.3))
    assert exact_quantiles(skewed.where("v < 0"), [], "v", {"q": 0.3}).count() == 0


@pytest.mark.parametrize("values", [
    [1e-10, 1.1e-10, 1.2e-10, 1.3e-10, 9e-10], [1.0] + [float("inf")] * 4, [1.0, 2.0, 3.0, float("nan"), 90.0],
    [float("nan")] * 3, [0.1, 0.2, 0.3, 0.4, 0.5, 5.0],
])
def test_outliers_near_the_edges_equal_pandas(spark, values):
    column = pd.Series(values)
    q1, q3 = column.quantile(0.25), column.quantile(0.75)
    want = ((column < q1 - 1.5 * (q3 - q1)) | (column > q3 + 1.5 * (q3 - q1))).tolist()
    df = spark.createDataFrame([(i, v, "g") for i, v in enumerate(values)], "i INT, v DOUBLE, g STRING")
    for by in ([], ["g"]):
        assert [r["is_outlier"] for r in A.detect_outliers(df, "v", by).orderBy("i").collect()] == want


def test_ungrouped_outliers_equal_pandas(skewed):
    frame = skewed.toPandas()
    q1, q3 = frame["v"].quantile(0.25), frame["v"].quantile(0.75)
    want = ((frame["v"] < q1 - 1.5 * (q3 - q1)) | (frame["v"] > q3 + 1.5 * (q3 - q1))).sum()
    flagged = A.detect_outliers(skewed, "v")
    assert flagged.count() == len(frame) and flagged.where("is_outlier").count() == want
    z = ((frame["v"] - frame["v"].mean()) / frame["v"].std()).abs()
    assert A.detect_outliers(skewed, "v", method="zscore", threshold=3.0).where("is_outlier").count() == (z > 3).sum()
    with pytest.raises(ValueError):
        A.detect_outliers(skewed, "v", method="other")


def test_returns_and_volatility_equal_pandas(spark):
    series = {
        "plain": [100.0, 110.0, 99.0, 105.0], "gap": [None, 100.0, None, 120.0, None], "zero": [1.0, 0.0, 0.0, 5.0],
        "single": [3.0], "pair": [2.0, 3.0],
    }
    days = pd.date_range("2024-01-30", periods=5).date
    rows = [(k, days[i], v) for k, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "asset STRING, price_date DATE, close_price DOUBLE")
    got = A.daily_returns(df, ["asset"])
    out = {k: [r["daily_return"] for r in got.where(F.col("asset") == k).orderBy("price_date").collect()] for k in series}
    for k, vs in series.items():
        want = list(pd.Series(vs, dtype=float).ffill().pct_change(fill_method=None).dropna())
        assert np.allclose(out[k], want, equal_nan=True), k
    vol = {r["asset"]: r["volatility"] for r in A.volatility(got.where("asset <> 'zero'"), ["asset"]).collect()}
    assert np.isclose(vol["plain"], pd.Series([0.1, -0.1, 105 / 99 - 1]).std() * 252 ** 0.5)
    assert vol["pair"] == 0.0 and "single" not in vol


def test_numbers_are_consecutive_and_repeatable(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("k", F.concat(F.lit("k"), F.col("id")))
    first = number_rows(df, ["k"], "n", 100)
    stats = first.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(stats) == (101, 5100, 5000)
    again = number_rows(df.repartition(3), ["k"], "n", 100)
    assert first.select("k", "n").exceptAll(again.select("k", "n")).isEmpty()


@pytest.mark.parametrize("options", [{}, {"limit": 4}, {"limit": 40, "margin": -0.02}])
def test_quantiles_equal_numpy_for_every_bracket(spark, options):
    """Brackets of any size, and brackets that miss their rank, end in the exact quantile."""
    import numpy as np

    from pricehouse.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(8)
    values = {"a": rng.normal(size=6000), "b": np.repeat(rng.normal(size=3), 900), "c": rng.normal(size=1), None: np.arange(300.0), "d": np.array([np.inf, -np.inf, 0.0, 1.0])}
    rows = [(g, float(x)) for g, xs in values.items() for x in xs] + [("e", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "top": 1.0, "least": 0.0}
    got = {r["g"]: [r[n] for n in probs] for r in exact_quantiles(df, ["g"], "x", probs, **options).collect()}
    assert set(got) == set(values)
    for g, xs in values.items():
        if g != "d":
            assert got[g] == pytest.approx(np.quantile(xs, list(probs.values())).tolist(), abs=1e-12)
    assert got["d"][1] == 0.5 and got["d"][3] == float("inf")
    every = np.concatenate([xs for g, xs in values.items() if g != "d"])
    one = exact_quantiles(df.where("g is null or g <> 'd'"), [], "x", probs, **options).collect()
    assert len(one) == 1 and [one[0][n] for n in probs] == pytest.approx(np.quantile(every, list(probs.values())).tolist(), abs=1e-12)
    assert exact_quantiles(df.where("g = 'e'"), [], "x", probs, **options).count() == 0
