"""The member report's result sets as SQL table functions.

``member_profile``, ``member_current_loans``, ``member_unpaid`` and
``member_events`` take a member id: ``SELECT * FROM member_unpaid(7)``, or for
many members ``FROM members m, LATERAL member_unpaid(m.member_id)``, which
Catalyst turns into joins. ``calculate_fine_days(due, returned)`` is a scalar
function. All are temporary SQL functions: no Python runs in them, and their
bodies are optimised with the query around them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from shelfwise.functions.exprs import register_sql_functions

_PREFIX = "shelfwise_"
#: name: (columns returned, body; {id} stands for the argument, {t} for the views' prefix, {as_of} for the date)
_TABLES = {
    "member_profile": (
        "first_name STRING, last_name STRING, email STRING, membership_type STRING, status STRING",
        "SELECT first_name, last_name, email, membership_type, status FROM {t}members WHERE member_id = {id}"),
    "member_current_loans": (
        "title STRING, loan_date DATE, due_date DATE",
        "SELECT b.title, l.loan_date, l.due_date FROM {t}loans l JOIN {t}book_copies c ON c.copy_id = l.copy_id "
        "JOIN {t}books b ON b.book_id = c.book_id WHERE l.member_id = {id} AND l.status = 'active'"),
    # one row, NULL without unpaid fines
    "member_unpaid": (
        "total_unpaid DECIMAL(20,2)",
        "SELECT CAST(sum(f.fine_amount) AS DECIMAL(20,2)) FROM {t}fines f JOIN {t}loans l ON l.loan_id = f.loan_id "
        "WHERE l.member_id = {id} AND NOT f.paid"),
    "member_events": (
        "event_name STRING, event_date DATE",
        "SELECT e.event_name, e.event_date FROM {t}event_registrations r JOIN {t}events e ON e.event_id = r.event_id "
        "WHERE r.member_id = {id} AND e.event_date >= DATE '{as_of}'"),
}


def register_member_report(spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.date) -> list[str]:
    """Register the functions over ``tables`` (as temporary views with the
    prefix ``shelfwise_``) for the session; a later call replaces them.
    Returns their names."""
    for name in ("members", "loans", "book_copies", "books", "fines", "event_registrations", "events"):
        tables[name].createOrReplaceTempView(f"{_PREFIX}{name}")
    register_sql_functions(spark)
    for name, (columns, body) in _TABLES.items():
        text = body.format(id=f"{name}.of_member", t=_PREFIX, as_of=as_of)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(of_member BIGINT) RETURNS TABLE({columns}) RETURN {text}")
    return ["calculate_fine_days", *_TABLES]
