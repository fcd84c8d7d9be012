"""Plans and layouts that keep the work of large tables in bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import jobs, windows
from shelfwise.plans import catalogue
from shelfwise.sources import append, keyindex


@pytest.fixture
def no_auto_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    yield
    spark.conf.unset(name)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sparse_ids_take_no_bitmap_each(spark, monkeypatch):
    monkeypatch.setattr(jobs, "BROADCAST_BUCKETS", 4)
    assert "_id" not in jobs._id_bitmap(spark.range(60_000)).columns
    sparse = spark.range(10).select((F.col("id") * (1 << 32)).alias("x")).unionByName(spark.createDataFrame([(None,), (0,)], "x long"))
    ids = jobs._id_bitmap(sparse)
    assert ids.columns == ["_id"] and ids.count() == 10
    asked = spark.createDataFrame([(0,), (1,), (9 << 32,), (None,)], "x long")
    assert {r.x: r.f for r in jobs._flagged(asked, "x", ids, "f").collect()} == {0: True, 1: False, 9 << 32: True, None: False}


def test_index_is_laid_out_by_rows(spark, monkeypatch):
    laid = []
    monkeypatch.setattr(keyindex, "create_index", lambda table, path, key, expected, parts: laid.append((expected, parts)))
    monkeypatch.setattr(append, "conform", lambda df, table: df)
    for n in (10, 3_000_000):
        append.index_keys(spark.range(n), "event_registrations", "nowhere")
    assert set(laid) == {(1 << 20, 8), (6_000_000, 23)}


def _feed_tables(spark, n_events):
    day = dt.date(2020, 1, 1)
    d = lambda i: day + dt.timedelta(days=i)
    return {
        "members": spark.createDataFrame([(i, "active") for i in range(5)], "member_id long, status string"),
        "books": spark.createDataFrame([(i, f"t{i}") for i in range(4)], "book_id long, title string"),
        "book_copies": spark.createDataFrame([(i, i % 4) for i in range(8)], "copy_id long, book_id long"),
        "loans": spark.createDataFrame([(i, i % 6, i % 9, d(i)) for i in range(40)] + [(90, 1, 1, None), (91, 1, 1, d(70))],
                                       "loan_id long, member_id long, copy_id long, loan_date date"),
        "events": spark.createDataFrame([(i, f"e{i}", d(50 + i // 3)) for i in range(n_events)] + [(99, "none", None)], "event_id long, event_name string, event_date date"),
        "event_registrations": spark.createDataFrame([(i, i % 7, i % 20, d(49 + i % 9)) for i in range(40)],
                                                     "registration_id long, member_id long, event_id long, registration_date date")}


@pytest.mark.parametrize("n_events", [0, 9, 20])
def test_feed_joins_what_can_be_in_it(spark, no_auto_broadcast, n_events):
    t, k = _feed_tables(spark, n_events), 10
    got = catalogue.activity_feed(t, k=k)
    assert "SortMergeJoin" not in _plan(got)
    c = {name: [r.asDict() for r in df.collect()] for name, df in t.items()}
    events, copies, books = ({r[key]: r for r in c[name]} for name, key in (("events", "event_id"), ("book_copies", "copy_id"), ("books", "book_id")))
    rows = [("Event", r["event_date"], r["event_name"]) for r in c["events"]]
    rows += [("Loan", r["loan_date"], books[copies[r["copy_id"]]["book_id"]]["title"]) for r in c["loans"] if r["member_id"] < 5 and r["copy_id"] in copies]
    rows += [("Registration", r["registration_date"], events[r["event_id"]]["event_name"]) for r in c["event_registrations"]
             if r["member_id"] < 5 and r["event_id"] in events]
    rows.sort(key=lambda r: (-(r[1].toordinal() if r[1] else 0), r[0], r[2]))
    assert [tuple(r) for r in got.collect()] == rows[:k]


def test_partitions_follow_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert windows.partitions_for(spark.range(1000), 10) == 100
    assert windows.partitions_for(spark.range(10), 10) == least


def test_availability_is_dealt_by_rows(spark, lib, monkeypatch):
    monkeypatch.setattr(windows, "partitions_for", lambda df: 37)
    assert _plan(catalogue.book_availability(lib)).count("hashpartitioning(copy_id") >= 2
    assert "37" in _plan(catalogue.book_availability(lib))


def test_recommendations_shuffle_no_candidates(spark, no_auto_broadcast):
    bought = spark.range(600).select((F.col("id") % 40).alias("member_id"), (F.col("id") * 7 % 90).alias("item_id"))
    items = spark.range(90).select(F.col("id").alias("item_id"), F.concat(F.lit("g"), (F.col("id") % 4).cast("string")).alias("genre"),
                                   F.concat(F.lit("t"), (F.col("id") % 13).cast("string")).alias("title"))
    few = jobs.recommend(bought, items, per_member=3)
    assert _plan(few).count("SortMergeJoin") <= 1
    full = {}
    for r in jobs.recommend(bought, items, per_member=None).collect():
        full.setdefault(r.member_id, []).append((r.title, r.item_id))
    got = {}
    for r in few.collect():
        got.setdefault(r.member_id, []).append((r.title, r.item_id))
    assert {m: sorted(v) for m, v in got.items()} == {m: sorted(v)[:3] for m, v in full.items()}
