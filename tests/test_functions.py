"""Column functions and their SQL forms."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import exprs as X


def test_late_days_and_fines(spark):
    d = dt.date(2024, 6, 15)
    df = spark.createDataFrame([(d, d + dt.timedelta(days=16)), (d, d - dt.timedelta(days=3)), (d, None)],
                               "due date, ret date")
    r = df.select(X.late_days("due", "ret").alias("n"), X.fine_amount(X.days_late("due", "ret")).alias("f")).collect()
    assert [(x.n, None if x.f is None else str(x.f)) for x in r] == [(16, "4.00"), (0, None), (None, None)]
    X.register_sql_functions(spark)
    df.createOrReplaceTempView("due_ret")
    got = [x.n for x in spark.sql("SELECT calculate_fine_days(due, ret) AS n FROM due_ret").collect()]
    assert got == [16, 0, None]


def test_exact_rounding(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (-1, 8), (5, 0), (3, 7), (107, 4000)], "a long, b long")
    r = [x.p for x in df.select(X.pct_exact("a", "b").alias("p")).collect()]
    assert r == [33.33, 66.67, 12.5, -12.5, None, 42.86, 2.68]
    assert [x.r for x in df.select(X.round_ratio("a", "b").alias("r")).collect()][:4] == [0.33, 0.67, 0.13, -0.13]


def test_position_and_names(spark):
    df = spark.createDataFrame([("poor", "Ann", None), ("fair", "Bo", "Li"), ("good", None, "X"), (None, "A", "B")],
                               "c string, f string, l string")
    r = df.select(X.position_in("c", "poor", "fair").alias("p"), X.full_name("f", "l").alias("n")).collect()
    assert [(x.p, x.n) for x in r] == [(1, None), (2, "Bo Li"), (0, None), (None, "A B")]


def test_collation_opt_in(spark):
    df = spark.createDataFrame([("García",), ("garcia",), ("Garcia",), ("Garza",)], "n string")
    assert df.where(X.same_text("n", "GARCIA")).count() == 3
    assert df.where(F.col("n") == "garcia").count() == 1


def test_member_report_table_functions(spark, lib, as_of):
    """Each function equals the report's result set, for one member and for
    all by lateral joins, which plan as joins without Python."""
    from shelfwise.functions.reports import register_member_report
    from shelfwise.operators import jobs
    register_member_report(spark, lib, as_of)
    want = jobs.member_report(lib["members"].select("member_id"), lib, as_of)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    for name, key in (("member_profile", "profile"), ("member_current_loans", "current_loans"), ("member_unpaid", "unpaid"), ("member_events", "events")):
        every = spark.sql(f"SELECT m.member_id, x.* FROM shelfwise_members m, LATERAL {name}(m.member_id) x")
        assert rows(every) == rows(want[key])
        plan = every._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Python" not in plan and "Cartesian" not in plan or name == "member_profile"
        one = rows(want[key])[0][0]
        assert rows(spark.sql(f"SELECT * FROM {name}({one})")) == [r[1:] for r in rows(want[key]) if r[0] == one]
    assert rows(spark.sql("SELECT * FROM member_unpaid(-5)")) == [(None,)]
