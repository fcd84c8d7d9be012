"""Mergeable sketches beside the exact reports: distinct counts that are kept
per day and merged into any longer period, and percentile ranks without a
sort of the whole table.

Both are partial aggregates (one sketch a task and group leaves the map side),
so a hot day or value costs what any other does.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a distinct sketch's buckets, and its relative standard error there
LG_K = 14
HLL_ERROR = 1.04 / 2 ** (LG_K / 2)
#: size parameter of a quantile sketch: its ranks are off by at most KLL_ERROR (99 % of the time)
KLL_K = 4000
KLL_ERROR = 2.3 / KLL_K ** 0.9


def daily_distinct(df: DataFrame, day: Column, keys: list[str], ids: dict[str, str], lg_k: int = LG_K) -> DataFrame:
    """One row per day and ``keys`` with the number of rows and, for each
    column of ``ids``, a sketch of its distinct values (named by the key of
    ``ids``). NULL ids are not counted, as in COUNT(DISTINCT). Written once a
    day, it is never made again from the rows."""
    sketches = [F.hll_sketch_agg(c, F.lit(lg_k)).alias(name) for name, c in ids.items()]
    return df.groupBy(day.alias("day"), *keys).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def merged_distinct(daily: DataFrame, period: Column, keys: list[str], names: list[str]) -> DataFrame:
    """Rows and estimated distinct counts per ``period`` (an expression over
    ``day``) and ``keys``, from the sketches of ``daily_distinct`` alone.
    Relative standard error: ``HLL_ERROR`` (0.8 %)."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    return daily.groupBy(period.alias("period"), *keys).agg(F.sum("rows").alias("rows"), *merged)


def percent_rank_sketch(df: DataFrame, value: str, name: str = "pct", k: int = KLL_K, steps: int = 1000) -> DataFrame:
    """``df`` with ``name``: the approximate PERCENT_RANK (0 to 1) of the whole
    number ``value``, off by at most ``KLL_ERROR`` + 1 / ``steps``. NULL stays
    NULL, and NULLs count in no rank.

    One pass builds a quantile sketch; its ``steps`` cut points (all that
    reaches the driver) and their ranks place the rows in a second pass, with
    no exchange of the rows. A value held by many rows is a cut point of its
    own, so its rank is its own."""
    spark = df.sparkSession
    sketch = df.agg(F.kll_sketch_agg_bigint(F.col(value), F.lit(k)).alias("s"))
    grid = F.lit([i / steps for i in range(steps + 1)])
    got = sketch.select(F.kll_sketch_get_n_bigint("s").alias("n"), F.col("s")).select(
        "n", "s", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("s", grid)).alias("cuts")).first()
    n = got["n"] or 0
    if n < 2:
        return df.withColumn(name, F.when(F.col(value).isNotNull(), F.lit(0.0)))
    cuts = sorted(set(got["cuts"]))
    # PERCENT_RANK counts the rows below x: at a cut those up to x - 1, behind it at least those up to the cut
    at_cuts = F.lit([x for c in cuts for x in (c - 1, c)]).cast("array<bigint>")
    got_ranks = spark.createDataFrame([(bytes(got["s"]),)], "s binary").select(F.kll_sketch_get_rank_bigint("s", at_cuts)).first()[0]
    below, upto = (F.array(*(F.lit(float(r)) for r in got_ranks[i::2])) for i in (0, 1))
    values = F.lit(cuts).cast("array<bigint>")
    splits = [float("-inf"), *(float(c) for c in cuts), float("inf")]
    at = Bucketizer(splits=splits, inputCol="value_at", outputCol="cut_at", handleInvalid="keep").transform(df.withColumn("value_at", F.col(value).cast("double")))
    i = F.col("cut_at").cast("int") - 1
    rank = F.coalesce(F.when(F.get(values, i) == F.col(value), F.get(below, i)).otherwise(F.get(upto, i)), F.lit(0.0))
    return at.withColumn(name, F.when(F.col(value).isNotNull(), F.least(F.lit(1.0), rank * n / (n - 1)))).drop("value_at", "cut_at")
