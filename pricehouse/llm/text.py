"""What the text operators share: the definition of a word, input checks, group sizes."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """All words of a text in order; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def column(name: str) -> Column:
    """A column by its name, whatever letters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable, unlike a column of an earlier projection, is never
    replaced by its expression again.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def let_workers_import(spark: SparkSession) -> None:
    """Put the folder of this package on the workers' module path.

    Workers started from another folder find the package so where they share the
    driver's disk; elsewhere it is shipped like any Python package (``--py-files``).
    """
    folder = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; whatever else a table carries cannot clash later."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[column(c) for c in columns])


def slices(batch, column: str, most: int = 8 << 20):
    """Cut an Arrow batch so that each part has about ``most`` bytes in a text column.

    A single longer text is a part of its own: texts are never cut.
    """
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype("int64")) // most
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for i, j in zip(starts, starts[1:]):
        yield batch.slice(i, j - i)
