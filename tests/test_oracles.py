"""Every registered driver-table report against its DuckDB SQL on the
smallest driver tables (the driver repeats this at sf0.01)."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.startswith("op")))
def test_report_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = con.sql(E.oracle_sql()[name]).df()
    assert rows(s) == rows(d)


def test_every_report_has_an_oracle():
    own = {n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n)}  # corpus operators: tested by brute force
    assert own == {n for n in E.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "c_name", "n_name", "o_orderdate", "due_date", "days_overdue"]
