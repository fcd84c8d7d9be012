"""Aggregation operators: partial (map-side) + final hash aggregation,
scalar subqueries for totals and thresholds (executed once, no cross join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.exprs import pct


def total_count(df: DataFrame) -> Column:
    """Uncorrelated scalar subquery ``(SELECT COUNT(*) FROM df)``."""
    return df.select(F.count(F.lit(1))).scalar()


def scalar(df: DataFrame, agg: Column) -> Column:
    """Uncorrelated scalar subquery ``(SELECT agg FROM df)``."""
    return df.select(agg).scalar()


def rollup_with_total(df: DataFrame, col: str, aggs, total_flag: str = "is_total") -> DataFrame:
    """GROUP BY col WITH ROLLUP. A real NULL group and the grand total both
    show NULL in ``col``; ``total_flag`` tells them apart."""
    return df.rollup(col).agg(*aggs, F.grouping(col).cast("boolean").alias(total_flag))


def relational_division(df: DataFrame, group_cols, item_col: str, required: DataFrame,
                        required_col: str, count_name: str = "items") -> DataFrame:
    """Groups that hold every item of ``required`` (HAVING COUNT(DISTINCT
    item) = (SELECT COUNT(*) FROM required)). Items outside the required set
    are dropped first by a semi join, so extras never inflate the count."""
    req = required.select(F.col(required_col).alias("_rd_k")).distinct()
    need = req.select(F.count(F.lit(1))).scalar()
    held = df.join(req, df[item_col] == req["_rd_k"], "left_semi")
    return (held.groupBy(*group_cols).agg(F.countDistinct(item_col).alias(count_name))
                .where(F.col(count_name) == need))


def above_scalar(df: DataFrame, col: str, threshold: Column, strict: bool = True) -> DataFrame:
    """WHERE col > (scalar subquery)."""
    return df.where(F.col(col) > threshold if strict else F.col(col) >= threshold)
