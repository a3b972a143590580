"""Ordered look-back that does not gather a whole group into one task.

A plain ``lag`` sorts all rows of a group in one task, and a file or symbol may hold
a large part of all rows. Groups are therefore cut into chunks along their order;
every chunk is summarised to its last value, the summaries (one row per chunk) are
carried forward, and the look-back then runs inside the chunks. The result equals
the plain window over the group, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous_value(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    value: str,
    chunk: Column,
    name: str,
    skip_nulls: bool = False,
) -> DataFrame:
    """Add ``name``: ``value`` of the preceding row of the group.

    ``chunk`` must not decrease along ``order_by``. With ``skip_nulls`` the
    nearest preceding value that is not NULL is taken.
    """
    by, order_by = list(by), list(order_by)
    boxed = F.struct(F.col(value).alias("value"))
    if skip_nulls:
        boxed = F.when(F.col(value).isNotNull(), boxed)
    cut = df.withColumn("_chunk", chunk).withColumn("_box", boxed)

    # A seed row per chunk brings in the last value of the chunks before it.
    position = F.when(F.col("_box").isNotNull(), F.struct(*order_by))
    last = cut.groupBy(*by, "_chunk").agg(F.max_by("_box", position).alias("_last"))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    seeds = last.select(
        *by, "_chunk",
        F.last("_last", ignorenulls=True).over(earlier).alias("_box"),
        F.lit(True).alias("_seed"),
    ).where("_box is not null")

    rows = cut.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    before = (
        Window.partitionBy(*by, "_chunk")
        .orderBy(F.desc("_seed"), *order_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = F.last("_box", ignorenulls=True).over(before)
    return rows.withColumn(name, found["value"]).where("not _seed").drop("_chunk", "_box", "_seed")
