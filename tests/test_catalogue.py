"""Catalogue reports on the generated library, each against its own SQL in
DuckDB over the same rows, and some properties worked out in Python."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import jobs
from shelfwise.plans import catalogue as C
from shelfwise.plans import library_reports as R
from tools.oracle_check import rows

#: reports that may be empty on this library
MAY_BE_EMPTY = {"lib_upcoming_events"}


@pytest.fixture(scope="module")
def duck(lib):
    con = duckdb.connect()
    for name, df in lib.items():
        arrow = df.toArrow()
        con.register("lib_events" if name == "events" else name, arrow)
    return con


@pytest.mark.parametrize("name", sorted(R.PARTS))
def test_report_equals_its_sql(lib, duck, name):
    report, sql = R.PARTS[name]
    got = rows(report(lib).toPandas())
    want = rows(duck.sql(f"{'WITH ' + sql.ctes if sql.ctes.strip() else ''} {sql.select}").df())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1] or name in MAY_BE_EMPTY


def test_every_catalogue_entry_is_registered(lib, as_of):
    named = {fn.__name__ for fn in C.CATALOGUE.values()}
    assert {n.removeprefix("lib_") for n in R.REPORTS} == named


def test_recommendations_exact_candidates(lib):
    bought = lib["loans"].join(lib["book_copies"], "copy_id").select("member_id", F.col("book_id").alias("item_id"))
    items = lib["books"].select(F.col("book_id").alias("item_id"), "genre", "title")
    full = jobs.recommend(bought, items, per_member=None)
    top = full.withColumn("rn", F.row_number().over(Window.partitionBy("member_id").orderBy("title", "item_id"))) \
        .where("rn <= 5").drop("rn")
    got = jobs.recommend(bought, items, per_member=5)
    assert full.count() > top.count() > 0
    assert sorted(top.collect()) == sorted(got.select(*top.columns).collect())


def test_correlated_equals_joins(lib, as_of):
    a = C.book_totals_correlated(lib, as_of)
    b = C.book_totals_joins(lib, as_of)
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_loan_gaps_first_is_null(lib, as_of):
    r = C.loan_gaps(lib, as_of).collect()
    firsts = [x for x in r if x.previous_loan_date is None]
    assert len(firsts) == len({x.member_id for x in r}) and all(x.days_gap is None for x in firsts)


def test_overdue_scan_pushes_filters(lib, as_of, spark, tmp_path):
    from shelfwise.sources import load_library, save_library
    save_library(lib, str(tmp_path))
    t = load_library(spark, str(tmp_path))
    plan = C.overdue_scan(t, as_of)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,active)" in plan and "LessThan(due_date,2001-08-02)" in plan
