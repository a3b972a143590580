"""Exact group quantiles: a sketch brackets each, values inside the bracket are counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse.operators.joins import null_safe_join
from pricehouse.session import materialize

#: Size of a sketch; its ranks are off by some 0.45 %, and a bracket is three times as wide either way.
SKETCH, MARGIN = 1000, 0.0135

#: Groups that are their own bracket: margins of less than some values prove nothing.
SMALL = 4096

#: Distinct values of a group that one task puts in order.
LIMIT = 1 << 18

#: Parts that a larger bracket is cut into.
_PARTS = 256


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], limit: int = LIMIT, margin: float = MARGIN
) -> DataFrame:
    """One row per group with linearly interpolated quantiles, one column each.

    A first pass over the values builds a mergeable sketch per group, with map-side combining, that
    brackets every wanted rank. A second pass counts how many values lie below a bracket, and
    counts each value inside it; those counts are exact and written. A bracket that missed its rank
    is noticed by them and replaced by the whole group. One that holds more than ``limit``
    distinct values is cut by a sketch of these until it holds fewer, so no task grows with a
    group. NULL and NaN values are left out; a group of nothing else has no row.
    """
    by, names = list(by), list(probs)
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(*by, number.alias("_v"))
    stats = rows.groupBy(*by).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.kll_sketch_agg_double("_v", SKETCH).alias("_s")
    ).where("_n > 0")

    def ranked(name: str, whole: bool) -> Column:
        rank = F.lit(float(probs[name])) * (F.col("_n") - 1)
        first = F.floor(rank)
        second = F.least(first + 1, F.col("_n") - 1)
        low, high = (
            F.kll_sketch_get_quantile_double("_s", F.lit(min(1.0, max(0.0, probs[name] + wide)))) for wide in (-margin, margin)
        )
        whole = F.lit(whole) | (F.col("_n") < SMALL)
        return F.struct(
            F.lit(name).alias("name"), first.alias("first"), second.alias("second"), (rank - first).alias("share"),
            F.when(whole, F.col("_low")).otherwise(low).alias("low"), F.when(whole, F.col("_high")).otherwise(high).alias("high"),
        )

    known = materialize(
        stats.select(*by, *[F.array(*[ranked(n, whole) for n in names]).alias(c) for c, whole in (("_near", False), ("_all", True))]),
        "quantile-brackets",
    )
    group = [*by, "name"]

    def counted(brackets: DataFrame) -> DataFrame:
        met = null_safe_join(rows, brackets, by, "inner").select(*by, "_v", F.explode("_b").alias("b"))
        place = F.when(F.col("_v") >= F.col("b.low"), F.col("_v")).alias("place")
        kept = met.where(F.col("_v") <= F.col("b.high")).select(*by, "b.name", "b.first", "b.second", "b.share", place)
        counts = kept.groupBy(*group, "first", "second", "share", "place").agg(F.count("*").alias("c"))
        return materialize(counts, "quantile-counts")

    def sums(counts: DataFrame) -> DataFrame:
        return counts.groupBy(*group, "first", "second", "share").agg(
            F.sum(F.when(F.col("place").isNull(), F.col("c")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("place").isNotNull(), F.col("c")).otherwise(0)).alias("inside"),
            F.count("place").alias("places"),
        )

    counts = counted(known.select(*by, F.col("_near").alias("_b")))
    held = materialize(sums(counts), "quantile-sums")
    missed = held.where("below > first or second >= below + inside").select(*by).distinct()
    if not missed.isEmpty():
        good = null_safe_join(counts, missed, by, "left_anti") if by else counts.limit(0)
        again = null_safe_join(known, missed, by, "left_semi") if by else known
        counts = good.unionByName(counted(again.select(*by, F.col("_all").alias("_b"))))
        held = materialize(sums(counts), "quantile-sums")
    return _finished(counts, held, by, names, limit)


def _finished(counts: DataFrame, held: DataFrame, by: list[str], names: list[str], limit: int) -> DataFrame:
    """Quantiles from counts of values (place NULL: below the bracket)."""
    group = [*by, "name"]
    facts = ["first", "second", "share"]
    while not held.where(F.col("places") > limit).isEmpty():
        counts = materialize(_narrowed(counts, held, group, limit), "quantile-counts")
        held = materialize(
            counts.groupBy(*group, *facts).agg(
                F.sum(F.when(F.col("place").isNull(), F.col("c")).otherwise(0)).alias("below"), F.count("place").alias("places")
            ), "quantile-sums",
        )
    below = held.select(*group, "below")
    inside = null_safe_join(counts.where("place is not null"), below, group, "inner")
    end = F.col("below") + F.sum("c").over(Window.partitionBy(*group).orderBy("place"))
    placed = inside.withColumn("end", end)
    found = placed.groupBy(*group).agg(
        F.min(F.when(F.col("end") > F.col("first"), F.col("place"))).alias("low"),
        F.min(F.when(F.col("end") > F.col("second"), F.col("place"))).alias("high"), F.max("share").alias("share"),
    )
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("share"))
    # an ungrouped aggregate gives a row even for no input
    out = found.groupBy(*by).agg(F.count("*").alias("_hits"), *[F.max(F.when(F.col("name") == n, between)).alias(n) for n in names])
    return out.where("_hits > 0").drop("_hits")


def _narrowed(counts: DataFrame, held: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Brackets of many values cut to the parts that hold a wanted rank; all before is below."""
    large = held.where(F.col("places") > limit).select(*group)
    small = null_safe_join(counts, large, group, "left_anti")
    rest = null_safe_join(counts, large, group, "left_semi")
    cuts = rest.where("place is not null").groupBy(*group).agg(F.kll_sketch_agg_double("place", SKETCH).alias("_s")).select(
        *group, F.array(*[F.kll_sketch_get_quantile_double("_s", F.lit(i / _PARTS)) for i in range(1, _PARTS)]).alias("cuts")
    )
    part = F.when(F.col("place").isNull(), F.lit(-1)).otherwise(F.size(F.filter("cuts", lambda x: x < F.col("place"))))
    parted = null_safe_join(rest, cuts, group, "inner").withColumn("part", part).drop("cuts")
    ends = parted.groupBy(*group, "part").agg(F.sum("c").alias("in_part"))
    end = F.sum("in_part").over(Window.partitionBy(*group).orderBy("part"))
    ends = ends.withColumn("part_end", end).select(*group, "part", "in_part", "part_end")
    placed = null_safe_join(parted, ends, [*group, "part"], "inner")
    after = F.col("part_end") - F.col("in_part") > F.col("second")
    before = F.col("part_end") <= F.col("first")
    kept = placed.where(~after).withColumn("place", F.when(~before, F.col("place")))
    summed = kept.groupBy(*group, "first", "second", "share", "place").agg(F.sum("c").alias("c"))
    return small.select(*summed.columns).unionByName(summed)
