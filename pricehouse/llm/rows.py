"""Keys of whole rows, and one row kept of each group.

A row is named by its doc_id and a digest of all its columns: rows that share a doc_id
or have none stay apart, and only rows equal in every column are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse.llm.text import column


def row_key(docs: DataFrame) -> Column:
    """128 bits of digest of all columns; NULLs and column borders count."""
    said = [column(c).cast("string") for c in docs.columns]
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in said])))


def keep_least(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the least row key; same columns.

    ``nodes`` (key, doc_id, component) has a row for every row of ``docs``. Row keys are
    ordered by doc_id, none last, then by digest. Only components of several rows are
    joined; texts are shuffled only where rows are equal in every column.
    """
    # The name is the component's own, so that tables derived from each other can be joined.
    least = (
        nodes.groupBy(F.col("component").alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("group", F.col("best.key").alias("best"))
    )
    several = nodes.join(least, F.col("component") == F.col("group")).groupBy("key", "best").agg(F.count("*").alias("n"))
    listed = several.select(F.col("key").alias("listed_key"), (F.col("key") == F.col("best")).alias("first"), "n")
    out = listed.filter("NOT first OR n > 1")
    whole = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), row_key(docs).alias("key"))
    single = whole.join(out, F.col("key") == F.col("listed_key"), "left_anti").select("row.*")
    repeated = whole.join(listed.filter("first AND n > 1"), F.col("key") == F.col("listed_key"), "left_semi")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return single.unionByName(repeated.withColumn("nth", nth).filter("nth = 1").select("row.*"))
