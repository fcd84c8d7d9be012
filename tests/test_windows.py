"""Scale forms of windows equal Spark's plain windows, including a key
that holds a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    # group 0 holds a third of all rows; values with many ties
    return spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") * 13 % 97).alias("v"))


def _same(a, b):
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_global_ranks(skewed):
    w = Window.orderBy(F.desc("v"))
    plain = skewed.select("id", "g", "v", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"),
                          F.percent_rank().over(w).alias("p"))
    _same(plain, W.global_ranks(skewed, "v", ascending=False, rank="r", dense_rank="d", percent_rank="p"))


def test_bounded_forms_equal(skewed):
    a = W.global_ranks(skewed, "v", ascending=False, rank="r", dense_rank="d", percent_rank="p")
    b = W.global_ranks(skewed, "v", ascending=False, rank="r", dense_rank="d", percent_rank="p", bounded_keys=True)
    _same(a, b)
    _same(W.running_total(skewed, "v", "id", "rt", ["g"]), W.running_total(skewed, "v", "id", "rt", ["g"], True))


def test_positions_and_lag(skewed):
    w = Window.partitionBy("g").orderBy("v", "id")
    _same(skewed.withColumn("pos", F.row_number().over(w)), W.with_position(skewed, ["v", "id"], ["g"]))
    _same(W.lag_columns(skewed, ["g"], ["v", "id"], ["v"], method="window"),
          W.lag_columns(skewed, ["g"], ["v", "id"], ["v"]))


def test_running_and_moving(skewed):
    w = Window.partitionBy("g").orderBy("v")
    _same(skewed.withColumn("rt", F.sum("id").over(w)), W.running_total(skewed, "v", "id", "rt", ["g"]))
    _same(skewed.withColumn("rt", F.sum("id").over(Window.orderBy("v"))), W.running_total(skewed, "v", "id", "rt"))
    wr = Window.orderBy("id").rowsBetween(-6, 0)
    _same(skewed.withColumn("ma", F.avg("v").over(wr)), W.moving_average_rows(skewed, ["id"], "v", 6, "ma"))


def test_first_per_group_and_top_n(skewed):
    w = Window.partitionBy("g").orderBy(F.desc("v"), F.desc("id"))
    plain = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("g", "v", "id")
    _same(plain, W.first_per_group(skewed, ["g"], ["v", "id"], ["v", "id"]))
    top = W.top_n_within(skewed, ["g"], [F.desc("v")], 2, name="rk")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_single_partition_window(skewed):
    plan = W.global_ranks(skewed, "v", rank="r")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan or "BroadcastExchange" in plan
    plan = skewed.select(F.rank().over(Window.orderBy("v")))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan  # what the plain form does


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    from shelfwise.operators.joins import not_in
    assert sorted(r.k for r in not_in(left, "k", spark.createDataFrame([(2,)], "k int"), "k").collect()) == [1]
    assert not_in(left, "k", spark.createDataFrame([(2,), (None,)], "k int"), "k").count() == 0
    assert not_in(left, "k", spark.createDataFrame([], "k int"), "k").count() == 3


@pytest.mark.parametrize("seed", [11, 12])
def test_scale_forms_with_nulls(spark, seed):
    import random
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        g = None if rnd.random() < 0.1 else (0 if rnd.random() < 0.35 else rnd.randint(1, 12))
        v = None if rnd.random() < 0.1 else rnd.randint(0, 20)
        rows.append((i, g, v, rnd.randint(-5, 50)))
    df = spark.createDataFrame(rows, "id long, g int, v int, x int")
    for asc in (True, False):
        o = F.col("v").asc() if asc else F.col("v").desc()
        w = Window.orderBy(o)
        plain = df.select("id", "g", "v", "x", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"),
                          F.percent_rank().over(w).alias("p"))
        _same(plain, W.global_ranks(df, "v", ascending=asc, rank="r", dense_rank="d", percent_rank="p"))
    wg = Window.partitionBy("g").orderBy("v")
    _same(df.withColumn("rt", F.sum("x").over(wg)), W.running_total(df, "v", "x", "rt", ["g"]))
    wp = Window.partitionBy("g").orderBy("v", "id")
    _same(df.withColumn("pos", F.row_number().over(wp)), W.with_position(df, ["v", "id"], ["g"]))
    _same(df.withColumn("prev_x", F.lag("x").over(wp)), W.lag_columns(df, ["g"], ["v", "id"], ["x"]))


@pytest.fixture(scope="module")
def million(spark):
    """1.2 M rows with a payload column; one group holds a third of them."""
    df = spark.range(1_200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("g"),
        (F.xxhash64("id") % 1000).alias("v"), F.col("id"), F.concat(F.lit("payload"), F.col("id")).alias("payload"))
    return df


@pytest.mark.parametrize("partitions,coalesce", [(8, True), (64, False)])
def test_positions_of_a_million_rows_with_payload(spark, million, partitions, coalesce):
    """Larger than any range sample, with readers that need different columns."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(coalesce).lower())
    try:
        w = Window.partitionBy("g").orderBy("v", "id")
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

        def digest(df, *cols):
            r = df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64("id", c).cast("decimal(38,0)")) for c in (*cols, "payload")]).first()
            return tuple(r)
        plain = million.select("*", F.row_number().over(w).cast("long").alias("pos"), F.lag("v").over(w).alias("prev_v"), F.sum("v").over(run).alias("v_cum"))
        expect = plain.agg(F.count(F.lit(1))).first()[0]
        assert expect == 1_200_000
        assert digest(W.with_position(million, ["v", "id"], ["g"]), "pos") == digest(plain, "pos")
        assert digest(W.lag_columns(million, ["g"], ["v", "id"], ["v"]), "prev_v") == digest(plain, "prev_v")
        assert digest(W.cumulative_sums(million, ["v", "id"], ["v"], ["g"]), "v_cum") == digest(plain, "v_cum")
        pos = W.with_position(million, ["id"], name="pos")
        assert pos.where("pos <> id + 1").count() == 0 and pos.count() == 1_200_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
