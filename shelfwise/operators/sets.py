"""Set operations. UNION deduplicates with a hash aggregate over all columns
(partial on the map side); UNION ALL is a plain concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def tagged(df: DataFrame, tag_col: str, tag: str) -> DataFrame:
    """Add a literal tag column (branch label of a UNION)."""
    return df.withColumn(tag_col, F.lit(tag))


def typed_null(name: str, dtype: str = "string"):
    """``NULL AS name`` with a type, so union branches line up."""
    return F.lit(None).cast(dtype).alias(name)
