"""Data-quality rules, appends and the layout writer."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import quality
from shelfwise.sources import append, layout


def test_clean_fixture_passes_declared_rules(lib):
    for name in schemas.TABLE_ORDER:
        for rule, df in quality.check_table(lib, name).items():
            assert df.count() == 0, (name, rule)


def test_violated_rules_are_those_with_violations(spark, lib):
    bad = lib["members"].limit(3).selectExpr("member_id", "repeat(first_name, 30) as first_name", "cast(null as string) as last_name", "'x@y' as email",
                                             "phone", "address", "join_date", "'gold' as membership_type", "status")
    for tables, name in (({**lib, "members": bad}, "members"), (lib, "members"), (lib, "fines")):
        want = {rule for rule, df in quality.check_table(tables, name).items() if not df.isEmpty()}
        assert set(quality.violated(tables, name)) == want
    assert want == set()


def test_rules_find_violations(spark):
    s = "member_id int, email string, status string, first_name string"
    m = spark.createDataFrame([(1, "a@x", "active", "A"), (1, "b@x", "gone", None), (None, "a@x", None, "C"),
                               (3, None, "active", "D"), (4, None, "active", "E" * 60)], s)
    pk = {(r.member_id, r.reason) for r in quality.check_pk(m, ["member_id"]).collect()}
    assert pk == {(1, "duplicate"), (None, "null key")}
    assert [r.email for r in quality.check_unique(m, ["email"]).collect()] == ["a@x"]  # NULLs never collide
    assert quality.check_not_null(m, ["email", "first_name"]).count() == 3
    assert quality.check_not_null(m, ["email", "first_name"], summary=True).first().asDict() == \
        {"email": 2, "first_name": 1}
    assert [r.status for r in quality.check_values(m, "status", ["active"]).collect()] == ["gone"]
    assert quality.check_length(m, "first_name", 50).count() == 1
    fines = spark.createDataFrame([(1, -1.0), (2, None), (3, 2.0)], "fine_id int, fine_amount double")
    assert [r.fine_id for r in quality.check_expr(fines, "fine_amount >= 0").collect()] == [1]
    loans = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "loan_id int, member_id int")
    assert [r.loan_id for r in quality.check_fk(loans, "member_id", m, "member_id").collect()] == [2]


DAY = dt.date(2024, 6, 15)


def test_defaults_ids_and_rules_of_an_append(spark, tmp_path, lib):
    rows = spark.createDataFrame([("Zed", "Lopez", "zed@example.org", "555-1", "1 Oak", "premium")],
                                 "first_name string, last_name string, email string, phone string, address string, "
                                 "membership_type string")
    path = str(tmp_path / "members")
    lib["members"].write.parquet(path)
    n = lib["members"].count()
    written, bad = append.append_rows(rows, "members", path, DAY, existing=lib["members"])
    assert not bad
    r = written.first()
    assert (r.member_id, r.status, r.join_date, r.membership_type) == (n + 1, "active", DAY, "premium")
    assert spark.read.parquet(path).count() == n + 1
    dup = spark.createDataFrame([(n + 1, "Amy", "Z", "zed@example.org")], "member_id int, first_name string, "
                                "last_name string, email string")
    _, bad = append.append_rows(dup, "members", path, DAY, existing=spark.read.parquet(path))
    assert "pk" in bad and "unique_email" in bad
    assert spark.read.parquet(path).count() == n + 1


def test_orphans_are_refused(spark, tmp_path, lib):
    path = str(tmp_path / "regs")
    rows = spark.createDataFrame([(999, 1), (1, 999), (1, 40)], "event_id int, member_id int")
    with pytest.raises(ValueError, match="missing"):
        append.append_rows(rows, "event_registrations", path, DAY)
    _, bad = append.append_rows(rows, "event_registrations", path, DAY, parents=lib, order_cols=["event_id", "member_id"])
    assert {k: v.count() for k, v in bad.items()} == {"fk_event_id": 1, "fk_member_id": 1}
    assert not os.path.exists(path)
    new, bad = append.append_rows(rows.where("event_id = 1 and member_id = 40"), "event_registrations", path, DAY, parents=lib)
    assert not bad and tuple(new.first()) == (1, 1, 40, DAY) and spark.read.parquet(path).count() == 1


def test_append_from_conforms(spark, tmp_path):
    path = str(tmp_path / "fines")
    rows = spark.createDataFrame([("3.5", 7, 4, "overdue")], "fine_amount string, loan_id long, fine_id long, fine_reason string")
    append.append_from(rows, "fines", path)
    back = spark.read.parquet(path)
    assert back.columns == schemas.SCHEMAS["fines"].names and back.schema["fine_amount"].dataType == schemas.SCHEMAS["fines"]["fine_amount"].dataType
    assert tuple(back.first())[:2] == (4, 7) and back.first().paid is None


def test_defaults_never_read_the_clock(spark):
    log = append.apply_defaults(spark.createDataFrame([(1,)], "log_id int"), "audit_log", DAY)
    assert log.first().changed_at == dt.datetime(2024, 6, 15) and log.first().changed_by == "SYSTEM"


def test_assign_ids_dense(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    ids = append.assign_ids(df, ["k"], "new_id", start=100)
    r = ids.agg(F.min("new_id"), F.max("new_id"), F.countDistinct("new_id")).first()
    assert tuple(r) == (100, 5099, 5000)
    assert ids.where(F.col("new_id") != F.col("k") + 100).count() == 0


def test_layout_writer(spark, tmp_path, lib):
    p = str(tmp_path / "loans")
    layout.write_layout(lib["loans"], p, partition_by=["status"], bucket_by=["member_id"], sort_by=["due_date"])
    assert sorted(n for n in os.listdir(p) if n.startswith("status=")) == \
        ["status=active", "status=lost", "status=returned"]
    back = spark.read.parquet(p)
    q = back.where((F.col("status") == "active") & (F.col("due_date") < F.lit(dt.date(2001, 8, 2))))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan and "PushedFilters: [IsNotNull(due_date)" in plan
    assert q.count() == lib["loans"].where("status = 'active' and due_date < date'2001-08-02'").count() > 0


def test_sorted_files_let_a_range_filter_skip_rows(spark, tmp_path):
    """Files sorted by the filtered column: the scan reads few row groups."""
    p = str(tmp_path / "sorted")
    df = spark.range(400_000).select((F.xxhash64("id") % 1000).alias("k"), F.col("id"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    layout.write_layout(df.repartitionByRange(8, "k"), p, sort_by=["k"])
    q = spark.read.parquet(p).where("k > 900")
    want = df.where("k > 900").count()
    plan = q._jdf.queryExecution().executedPlan()
    rows = q.agg(F.count(F.lit(1)))
    assert rows.first()[0] == want
    scans = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan.toString() and "GreaterThan(k,900)" in scans
    import pyarrow.parquet as pq
    stats = [pq.ParquetFile(os.path.join(p, f)).metadata.row_group(0).column(0).statistics for f in os.listdir(p) if f.endswith(".parquet")]
    assert sum(s.max > 900 for s in stats) <= 2 < len(stats)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        layout.write_layout(spark.range(5), bucket_by=["id"], table="no_buckets")
    for name in ("bucketed_a", "bucketed_b"):
        layout.write_layout(spark.range(1000), str(tmp_path / name), bucket_by=["id"], sort_by=["id"], buckets=4, table=name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bucketed_a").join(spark.table("bucketed_b"), "id")
        assert j.count() == 1000
        assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"drop table {name}")
