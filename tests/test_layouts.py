"""Registered reports on tables stored as folders of part files, changed
inputs within a session, and the derived library's keys."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfwise.operators import quality
from shelfwise.plans import derived
from shelfwise.sources.tables import load_driver_tables

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
KEYS = {"authors": "author_id", "members": "member_id", "books": "book_id", "book_copies": "copy_id", "loans": "loan_id", "fines": "fine_id",
        "events": "event_id", "event_registrations": "registration_id"}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("parts"))
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").repartition(3).write.parquet(os.path.join(base, f"{t}.parquet"))
    return base


@pytest.mark.parametrize("name", ["overdue", "daily_activity_stream", "gaps", "allocate", "lib_overdue_loans", "lib_loan_gaps", "lib_never_borrowed",
                                  "lib_all_book_clubs", "job_append_fines"])
def test_folders_give_the_same_as_single_files(spark, folders, name):
    q = E.queries()[name]
    a, b = q(spark, folders), q(spark, SF)
    assert sorted(a.collect(), key=repr) == sorted(b.select(*a.columns).collect(), key=repr)
    assert b.count() > 0


def test_a_changed_input_is_noticed(spark, tmp_path):
    base = str(tmp_path)
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    n = derived.library_from_driver(spark, base)["books"].count()
    one = spark.read.parquet(f"{SF}/part.parquet").limit(1).selectExpr("p_partkey + 1000000 as p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    one.write.mode("append").parquet(f"{base}/part.parquet")
    assert load_driver_tables(spark, base).part.count() == n + 1
    assert derived.library_from_driver(spark, base)["books"].count() == n + 1


def test_derived_keys_are_unique_with_large_supplier_keys(spark, tmp_path):
    base = str(tmp_path)
    for t in TABLES:
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "lineitem":  # pairs that a stride of 10,000 would confuse: (1, 10005) and (2, 5)
            df = df.selectExpr("l_orderkey", "l_partkey", "case when l_partkey % 2 = 1 then l_suppkey + 10000 else l_suppkey end as l_suppkey",
                               *[c for c in df.columns if c not in ("l_orderkey", "l_partkey", "l_suppkey")])
        if t == "supplier":
            more = df.selectExpr("s_suppkey + 10000 as s_suppkey", *[c for c in df.columns if c != "s_suppkey"])
            df = df.unionByName(more)
        df.write.parquet(f"{base}/{t}.parquet")
    lib = derived.library_from_driver(spark, base)
    for name, key in KEYS.items():
        assert quality.check_pk(lib[name], [key]).isEmpty(), name
    pairs = spark.read.parquet(f"{base}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().count()
    assert lib["book_copies"].count() == pairs


def test_due_date_filter_reaches_the_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = E.queries()["overdue_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    last = dt.date(2001, 8, 2) - dt.timedelta(days=14)
    assert f"LessThan(o_orderdate,{last}" in plan


def test_checkpoint_folder_is_required_off_local_mode(spark, monkeypatch):
    from shelfwise import session

    class Context:
        applicationId, master = "another-app", "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda *a: None)

    class Session:
        sparkContext, conf = Context, Conf
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session)


def _groups_hit(path, col, low, high):
    """(files whose rows may lie in [low, high] by the Parquet statistics, all
    files)."""
    import glob

    import pyarrow.parquet as pq
    hit = files = 0
    for f in glob.glob(f"{path}/*.parquet"):
        m = pq.ParquetFile(f).metadata
        i = m.schema.to_arrow_schema().names.index(col)
        files += 1
        hit += any(m.row_group(g).column(i).statistics.min <= high and m.row_group(g).column(i).statistics.max >= low for g in range(m.num_row_groups))
    return hit, files


def test_z_order_skips_row_groups_by_either_key(spark):
    """Two keys, one of them skewed: a narrow range of either alone touches a
    small share of the files, which a sort by both does for the first only."""
    import tempfile

    from shelfwise.sources.layout import write_layout, write_z_order
    df = spark.range(60_000).select((F.abs(F.xxhash64("id")) % 5000).alias("event_id"),
                                    F.pow(F.abs(F.xxhash64("id", F.lit(1))) % 1000, F.lit(2)).cast("long").alias("member_id"), F.col("id"))
    z, linear = tempfile.mkdtemp(prefix="z-"), tempfile.mkdtemp(prefix="sorted-")
    write_z_order(df, z, ["event_id", "member_id"], 64, bloom=("id",))
    write_layout(df.repartitionByRange(64, "event_id", "member_id"), linear, sort_by=("event_id", "member_id"))
    for col, low, high in (("event_id", 1000, 1050), ("member_id", 250_000, 252_000)):
        hit, files = _groups_hit(z, col, low, high)
        assert files >= 60 and hit <= 0.3 * files
    hit, files = _groups_hit(linear, "member_id", 250_000, 252_000)
    assert hit > 0.9 * files
    back = spark.read.parquet(z)
    assert sorted(back.columns) == sorted(df.columns) and back.exceptAll(df).count() == 0 and back.count() == 60_000
    # the bloom filter answers an id that no row has
    import glob
    name = sorted(glob.glob(f"{z}/*.parquet"))[0]
    with open(name, "rb") as f:
        size = len(f.read())
    write_z_order(df, linear, ["event_id", "member_id"], 64)
    assert size > os.path.getsize(sorted(glob.glob(f"{linear}/*.parquet"))[0])


def test_z_order_of_nulls_dates_and_hot_pairs(spark):
    import datetime as dt
    import tempfile

    import pytest

    from shelfwise.sources.layout import write_z_order, z_value
    rows = [(None, None, "x")] * 5 + [(7, dt.date(2024, 1, 1), "hot")] * 3000 + [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i), "y") for i in range(50)]
    df = spark.createDataFrame(rows, "k long, d date, s string")
    path = tempfile.mkdtemp(prefix="z-")
    write_z_order(df, path, ["k", "d"], 8)
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    most = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 1500  # the hot pair does not fill one file
    assert {r.z_value for r in z_value(df, ["k", "d"]).where("k is null").collect()} == {0}
    assert z_value(df.where("s = 'none'"), ["k", "d"]).collect() == []
    with pytest.raises(ValueError):
        z_value(df, ["s"])
