"""Sorts, limits and top-k. ``orderBy().limit(k)`` plans as
TakeOrderedAndProject: each task keeps its own top k, the driver merges
k x tasks rows. Sorts always end with a key so ties are deterministic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k(df: DataFrame, order_cols, k: int) -> DataFrame:
    return df.orderBy(*[_c(c) for c in order_cols]).limit(k)


def sort(df: DataFrame, order_cols) -> DataFrame:
    return df.orderBy(*[_c(c) for c in order_cols])


def top_and_bottom(df: DataFrame, value_col: str, key_cols, k: int, tag_col: str,
                   top_tag: str, bottom_tag: str) -> DataFrame:
    """UNION of the k largest and the k smallest rows by ``value_col``, each
    tagged; ties at each cut are broken by ``key_cols``."""
    keys = [F.col(c).asc() for c in key_cols]
    top = df.orderBy(F.col(value_col).desc(), *keys).limit(k).withColumn(tag_col, F.lit(top_tag))
    bottom = (df.orderBy(F.col(value_col).asc(), *keys).limit(k)
                .withColumn(tag_col, F.lit(bottom_tag)))
    return top.unionByName(bottom).distinct()
