"""Key joins in which NULL matches NULL.

No side is hinted: Spark broadcasts a side whose measured size is small and
otherwise sorts and merges, splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``other`` on ``keys``; its key columns do not appear in the result."""
    keys = list(keys)
    renamed = other.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in other.columns])
    condition = F.lit(True)
    for c in keys:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    if not keys:
        renamed = F.broadcast(renamed)  # the one row of an ungrouped aggregate
    return df.join(renamed, condition, how).drop(*[f"_k_{c}" for c in keys])
