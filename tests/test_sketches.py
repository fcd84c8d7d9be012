"""Sketches against the exact reports."""

import os
import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import sketches as K


def test_months_from_stored_days(spark):
    """Months merged from written daily sketches are within 2 % of the exact
    distinct counts, whether days share ids or not; the rows are not read."""
    rng = random.Random(31)
    rows = [(f"2024-{m:02d}-{d:02d}", rng.choice("ab"), rng.randint(0, 40_000) if m == 1 else d * 1000 + rng.randint(0, 900) if m == 2 else 7)
            for m in (1, 2, 3) for d in range(1, 29) for _ in range(900)] + [("2024-03-01", "a", None)] * 50
    df = spark.createDataFrame(rows, "day string, kind string, member long").withColumn("day", F.to_date("day"))
    path = os.path.join(tempfile.mkdtemp(prefix="sketch-"), "daily")
    K.daily_distinct(df, F.col("day"), ["kind"], {"members": "member"}).write.partitionBy("day").parquet(path)
    month = F.trunc("day", "month")
    got = {(r["period"], r["kind"]): r for r in K.merged_distinct(spark.read.parquet(path), month, ["kind"], ["members"]).collect()}
    want = df.groupBy(month.alias("period"), "kind").agg(F.countDistinct("member").alias("members"), F.count(F.lit(1)).alias("rows")).collect()
    assert len(want) == len(got) == 6
    for w in want:
        g = got[w["period"], w["kind"]]
        assert g["rows"] == w["rows"] and abs(g["members"] - w["members"]) <= 0.02 * w["members"]


@pytest.mark.parametrize("values", ["spread", "ties", "hot", "two"])
def test_percent_rank_within_its_bound(spark, values):
    made = {"spread": F.xxhash64("id") % 10_000_000, "ties": F.xxhash64("id") % 37, "hot": F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.xxhash64("id") % 1000),
            "two": F.col("id") % 2}[values]
    df = spark.range(60_000, numPartitions=5).withColumn("v", made)
    exact = F.percent_rank().over(Window.orderBy("v"))
    out = K.percent_rank_sketch(df, "v").withColumn("off", F.abs(F.col("pct") - exact))
    assert out.agg(F.max("off")).first()[0] <= K.KLL_ERROR + 1 / 1000
    plan = K.percent_rank_sketch(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_percent_rank_of_few_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5), (4, 9), (5, -(2 ** 60))], "id long, v long")
    got = {r["id"]: r["pct"] for r in K.percent_rank_sketch(df, "v").collect()}
    assert got[2] is None and got[5] == 0.0 and abs(got[1] - 1 / 3) < 0.01 and got[1] == got[3] and abs(got[4] - 1) < 0.01
    assert [r["pct"] for r in K.percent_rank_sketch(df.where("id = 1"), "v").collect()] == [0.0]
    assert K.percent_rank_sketch(df.where("id = 2"), "v").collect()[0]["pct"] is None
    assert K.percent_rank_sketch(df.where("id > 9"), "v").collect() == []
