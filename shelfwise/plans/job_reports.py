"""The data-change jobs, guards and validated appends registered over the
library derived from the driver tables, each with its own DuckDB SQL.

Requests come from the event log: 'purchase' asks for a copy of book ``k``,
'view' returns loan ``k``. Every job reads whole tables. Dates are returned
as midnight TIMESTAMP and money as DOUBLE, as both engines compare them.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.reports import register_member_report
from shelfwise.operators import jobs, quality
from shelfwise.plans.derived import library_from_driver, with_library
from shelfwise.plans.library_reports import AS_OF, _aligned
from shelfwise.session import checkpoint_dir, materialize
from shelfwise.sources import append, layout, versions
from shelfwise.sources.tables import load_driver_tables

A = "DATE '2001-08-02'"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _key():
    return F.get_json_object("props", "$.k").cast("long")


def _events(spark, sf_dir, kind: str, key: str) -> DataFrame:
    e = load_driver_tables(spark, sf_dir).events.where(F.col("event_type") == kind)
    return e.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("member_id"), _key().alias(key))


def _suspended(t) -> DataFrame:
    return t["members"].where("status = 'suspended'").select("member_id")


# ---------------------------------------------------------------- returns
def _returned(spark, sf_dir):
    t = library_from_driver(spark, sf_dir)
    req = _events(spark, sf_dir, "view", "loan_id").drop("member_id")
    return t, jobs.apply_returns(req, t["loans"], AS_OF)


def job_returns_loans(spark, sf_dir):
    """All loans after the batch of returns."""
    _, (_, loans, _) = _returned(spark, sf_dir)
    return _aligned(loans)


def job_returns_fines(spark, sf_dir):
    """The fines that the batch's active -> returned transitions charge."""
    _, (_, _, fines) = _returned(spark, sf_dir)
    return _aligned(fines.drop("payment_date"))


_RETURNED = f"""asked AS (SELECT DISTINCT {_K} AS loan_id FROM events WHERE event_type = 'view'),
done AS (SELECT loan_id FROM loans SEMI JOIN asked USING (loan_id) WHERE status = 'active')"""


# ---------------------------------------------------------------- admission
def job_admission(spark, sf_dir):
    """Purchases as new loan rows: default due date, then the member guard."""
    t = library_from_driver(spark, sf_dir)
    new = _events(spark, sf_dir, "purchase", "copy_id").withColumn("loan_date", F.lit(AS_OF)).withColumn("due_date", F.lit(None).cast("date"))
    out = jobs.split_admissible(jobs.fill_due_date(new), t["members"])
    return _aligned(out.select("request_id", "member_id", "due_date", "rejection"))


def job_checkout(spark, sf_dir):
    """Guard, copy allocation, loan and audit row per purchase: the outcome of
    each request with the id of its new loan, if any."""
    t = library_from_driver(spark, sf_dir)
    out, new, audit = jobs.checkout_and_log(_events(spark, sf_dir, "purchase", "book_id"), t["book_copies"], t["loans"], t["members"], AS_OF)
    logged = new.join(audit, F.col("loan_id") == F.col("record_id")).select("request_id", "loan_id", "description")
    return out.join(logged, "request_id", "left").select(
        "request_id", "member_id", "book_id", F.col("copy_id").cast("double").alias("copy_id"), "accepted", "outcome",
        F.col("loan_id").cast("double").alias("loan_id"), "description")


def job_checkout_quota(spark, sf_dir):
    """Guard, quota of 12 active loans and copy allocation in one batch:
    each purchase's outcome, served in order of request."""
    t = library_from_driver(spark, sf_dir)
    out = jobs.checkout_within_quota(_events(spark, sf_dir, "purchase", "book_id"), t["book_copies"], t["loans"], t["members"], AS_OF, max_active=12)
    return out.select("request_id", "member_id", "book_id", F.col("copy_id").cast("double").alias("copy_id"), "accepted", "outcome")


# ---------------------------------------------------------------- updates, audit
def _late_members(t) -> DataFrame:
    late = t["loans"].where((F.col("status") == "active") & (F.col("due_date") < F.lit(AS_OF))).select("member_id").distinct()
    return late.withColumn("status", F.lit("suspended"))


def job_update_members(spark, sf_dir):
    """Keyed update: members with an overdue loan are suspended."""
    t = library_from_driver(spark, sf_dir)
    return jobs.apply_update(t["members"], _late_members(t), "member_id").select("member_id", "last_name", "status")


def job_update_versions(spark, sf_dir):
    """Two keyed updates of a versioned members table: members with an
    overdue loan are suspended, then those who never borrowed expire. The
    last version, with each member's status in the version before."""
    t = library_from_driver(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), "versions", f"members_{uuid.uuid4().hex[:12]}")
    versions.create_versioned(t["members"].select("member_id", "last_name", "status"), path, "member_id", 32)
    second = versions.update_version(spark, path, _late_members(t))
    idle = t["members"].join(t["loans"], "member_id", "left_anti").select("member_id", F.lit("expired").alias("status"))
    versions.update_version(spark, path, idle)
    before = versions.read_version(spark, path, second).select("member_id", F.col("status").alias("status_before"))
    return versions.read_version(spark, path).join(before, "member_id").select("member_id", "last_name", "status_before", "status")


def job_audit_members(spark, sf_dir):
    """Audit rows of that update."""
    t = library_from_driver(spark, sf_dir)
    new = jobs.apply_update(t["members"], _late_members(t), "member_id")
    rows = jobs.audit_changes(t["members"], new, "member_id", ["first_name", "last_name", "status"], dt.datetime(2001, 8, 2, 9))
    return rows.withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))


# ---------------------------------------------------------------- deletes
def job_delete_guard(spark, sf_dir):
    """Which books may be deleted: none with an active loan."""
    t = library_from_driver(spark, sf_dir)
    return jobs.guard_book_delete(t["books"], t["book_copies"], t["loans"])


def _unmentioned(spark, sf_dir, t) -> DataFrame:
    said = load_driver_tables(spark, sf_dir).events.select(_key().alias("book_id"))
    return t["books"].select("book_id").join(said, "book_id", "left_anti")


def job_cascade_copies(spark, sf_dir):
    """Copies left after deleting the books that no event mentions."""
    t = library_from_driver(spark, sf_dir)
    left, _ = jobs.cascade_delete(t, "books", _unmentioned(spark, sf_dir, t))
    return left["book_copies"].select("copy_id", "book_id", "condition")


def job_cascade_violations(spark, sf_dir):
    """Loans that forbid that deletion."""
    t = library_from_driver(spark, sf_dir)
    return jobs.cascade_delete(t, "books", _unmentioned(spark, sf_dir, t))[1]


# ---------------------------------------------------------------- money
def _payments(t) -> DataFrame:
    mine = t["loans"].join(_suspended(t), "member_id", "left_semi").select("loan_id")
    return t["fines"].where(~F.col("paid")).join(mine, "loan_id", "left_semi").select("fine_id")


def job_settle_members(spark, sf_dir):
    """Members after all unpaid fines of suspended members are settled."""
    t = library_from_driver(spark, sf_dir)
    _, members, _ = jobs.settle_fines(_payments(t), t["fines"], t["loans"], t["members"], AS_OF)
    return members.select("member_id", "last_name", "status")


def job_settle_fines(spark, sf_dir):
    """Fines after that settlement."""
    t = library_from_driver(spark, sf_dir)
    fines, _, _ = jobs.settle_fines(_payments(t), t["fines"], t["loans"], t["members"], AS_OF)
    return _aligned(fines)


def job_batch_return(spark, sf_dir):
    """New fines of returning everything that suspended members hold."""
    t = library_from_driver(spark, sf_dir)
    _, fines, _ = jobs.batch_return(_suspended(t), t["loans"], t["fines"], AS_OF)
    return _aligned(fines.drop("payment_date"))


def job_member_report(spark, sf_dir):
    """The member report's result sets for all suspended members, as one
    table: set name, member, a text and an amount."""
    t = library_from_driver(spark, sf_dir)
    r = jobs.member_report(_suspended(t), t, AS_OF)
    none = F.lit(None)
    parts = [r["profile"].select(F.lit("profile").alias("part"), "member_id", F.col("email").alias("what"), none.cast("double").alias("amount")),
             r["current_loans"].select(F.lit("loan").alias("part"), "member_id", F.col("title").alias("what"), none.cast("double").alias("amount")),
             r["unpaid"].select(F.lit("unpaid").alias("part"), "member_id", none.cast("string").alias("what"), F.col("total_unpaid").cast("double").alias("amount")),
             r["events"].select(F.lit("event").alias("part"), "member_id", F.col("event_name").alias("what"), none.cast("double").alias("amount"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- appends and rules
def layout_registrations(spark, sf_dir):
    """Registrations written in Z-order of (event_id, member_id) with a bloom
    filter on the event, and active members appended by an insert-from-select:
    the registrations of one member range by those members, read back."""
    t = library_from_driver(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/layouts/{uuid.uuid4().hex}"
    layout.write_z_order(t["event_registrations"].select("event_id", "member_id"), f"{path}/registrations", ["event_id", "member_id"], 16, bloom=("event_id",))
    append.append_from(t["members"].where(F.col("status") == "active").select("member_id", "last_name", "status"), "members", f"{path}/members")
    m = spark.read.parquet(f"{path}/members").select(F.col("member_id").cast("long").alias("member_id"), "last_name")
    return spark.read.parquet(f"{path}/registrations").where(F.col("member_id").between(20, 70)).join(m, "member_id").select("event_id", "member_id", "last_name")


def sql_member_loans(spark, sf_dir):
    """The report's table functions and the fine-days function called from
    SQL: each member's current loans with the days late, and the member's
    unpaid total."""
    t = library_from_driver(spark, sf_dir)
    register_member_report(spark, t, AS_OF)
    return spark.sql(f"""
SELECT m.member_id, p.last_name, l.title, CAST(l.due_date AS TIMESTAMP_NTZ) AS due_date,
       CAST(calculate_fine_days(l.due_date, DATE '{AS_OF}') AS BIGINT) AS days_late, CAST(u.total_unpaid AS DOUBLE) AS total_unpaid
FROM shelfwise_members m, LATERAL member_profile(m.member_id) p, LATERAL member_current_loans(m.member_id) l, LATERAL member_unpaid(m.member_id) u""")


def job_append_fines(spark, sf_dir):
    """A validated append: a fine for every loan returned late without one,
    with ids after the current maximum and the declared defaults; the rows
    are read back from where they were appended."""
    t = library_from_driver(spark, sf_dir)
    days = F.datediff("return_date", "due_date")
    late = t["loans"].where((F.col("status") == "returned") & (days > 0)).join(t["fines"].select("loan_id"), "loan_id", "left_anti")
    rows = late.select("loan_id", jobs.fine_amount(days).alias("fine_amount"), F.lit("overdue").alias("fine_reason"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/appends/fines-{uuid.uuid4().hex}"
    _, bad = append.append_rows(rows, "fines", path, AS_OF, parents={"loans": t["loans"]}, existing=t["fines"], order_cols=["loan_id"])
    if bad:
        raise ValueError(f"rules failed: {sorted(bad)}")
    back = spark.read.parquet(path)
    return back.select(F.col("fine_id").cast("long").alias("fine_id"), F.col("loan_id").cast("long").alias("loan_id"),
                       F.col("fine_amount").cast("double").alias("fine_amount"), "fine_reason", "paid")


def job_append_indexed(spark, sf_dir):
    """Registrations appended through key indexes, without reading the table
    again: each registered member's next member is asked to the same event.
    Of each pair: whether it was taken, and, once the free pairs are appended
    and a second time asked for, that all are."""
    t = library_from_driver(spark, sf_dir)
    held = t["event_registrations"]
    index = f"{checkpoint_dir(spark).rstrip('/')}/appends/index-{uuid.uuid4().hex}"
    append.index_keys(held, "event_registrations", index)
    key = ["event_id", "member_id"]
    asked = held.select("event_id", (F.col("member_id") + 1).alias("member_id")).distinct().join(t["members"].select("member_id"), "member_id", "left_semi")
    asked = materialize(asked.select(*key))
    taken = materialize(append.taken_keys(asked, index, key))
    free = asked.join(taken, key, "left_anti").withColumn("registration_date", F.lit(AS_OF))
    _, bad = append.append_rows(free, "event_registrations", f"{index}-rows", AS_OF, parents=t, index=index, order_cols=key)
    if bad:
        raise ValueError(f"rules failed: {sorted(bad)}")
    again = append.taken_keys(asked, index, key)
    new = spark.read.schema(schemas.SCHEMAS["event_registrations"]).parquet(f"{index}-rows")
    out = asked.join(taken.withColumn("was", F.lit(True)), key, "left").join(again.withColumn("now", F.lit(True)), key, "left").join(new, key, "left")
    return out.select(*[F.col(k).cast("long").alias(k) for k in key], F.col("was").isNotNull().alias("was_taken"), F.col("now").isNotNull().alias("is_taken"),
                      F.col("registration_id").cast("double").alias("registration_id"))


def dq_unique(spark, sf_dir):
    """Values of a UNIQUE rule on part names that occur more than once."""
    return quality.check_unique(load_driver_tables(spark, sf_dir).part, ["p_name"]).select("p_name", F.col("row_count").cast("long").alias("row_count"))


def dq_length(spark, sf_dir):
    """Part names over the declared length."""
    return quality.check_length(load_driver_tables(spark, sf_dir).part, "p_name", 10).select("p_partkey", "p_name")


QUERIES = {f.__name__: f for f in (
    job_returns_loans, job_returns_fines, job_admission, job_checkout, job_checkout_quota, job_update_members, job_update_versions, job_audit_members, job_delete_guard,
    job_cascade_copies, job_cascade_violations, job_settle_members, job_settle_fines, job_batch_return, job_member_report,
    job_append_fines, job_append_indexed, layout_registrations, sql_member_loans, dq_unique, dq_length)}

_LATE = f"late AS (SELECT DISTINCT member_id, TRUE AS late FROM loans WHERE status = 'active' AND due_date < {A})"
_BARRED = "barred AS (SELECT member_id FROM members WHERE status = 'suspended')"
_GONE = f"gone AS (SELECT book_id FROM books ANTI JOIN (SELECT {_K} AS book_id FROM events) USING (book_id))"
_PAID_NOW = f"""{_BARRED},
paid_now AS (SELECT fine_id, TRUE AS now FROM fines JOIN loans USING (loan_id) SEMI JOIN barred USING (member_id) WHERE NOT paid)"""
_TS = "CAST({0} AS TIMESTAMP) AS {0}"

SQL = {
    "job_returns_loans": with_library(_RETURNED, f"""
SELECT loan_id, member_id, copy_id, {_TS.format('loan_date')}, {_TS.format('due_date')},
       CAST(CASE WHEN d.loan_id IS NULL THEN return_date ELSE {A} END AS TIMESTAMP) AS return_date,
       CASE WHEN d.loan_id IS NULL THEN status ELSE 'returned' END AS status
FROM loans l LEFT JOIN done d USING (loan_id)"""),
    "job_returns_fines": with_library(_RETURNED, f"""
SELECT loan_id, ({A} - due_date) * 0.25::DOUBLE AS fine_amount, 'overdue' AS fine_reason, FALSE AS paid
FROM loans SEMI JOIN done USING (loan_id) WHERE due_date < {A}"""),
    "job_admission": with_library("", f"""
SELECT event_id AS request_id, user_id AS member_id, CAST({A} + 14 AS TIMESTAMP) AS due_date,
       CASE WHEN m.member_id IS NULL THEN 'Unknown member' WHEN m.status <> 'active' THEN 'Cannot create loan: Member is not active' END AS rejection
FROM events LEFT JOIN members m ON m.member_id = user_id WHERE events.event_type = 'purchase'"""),
    "job_checkout": with_library(f"""
req AS (SELECT event_id AS request_id, user_id AS member_id, {_K} AS book_id, status FROM events
        LEFT JOIN (SELECT member_id AS user_id, status FROM members) USING (user_id) WHERE event_type = 'purchase'),
queue AS (SELECT request_id, book_id, ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY request_id) AS n FROM req WHERE status = 'active'),
free AS (SELECT book_id, copy_id, ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY copy_id) AS n
         FROM book_copies ANTI JOIN (FROM loans WHERE status = 'active') USING (copy_id)),
given AS (SELECT request_id, copy_id, ROW_NUMBER() OVER (ORDER BY request_id) + (SELECT MAX(loan_id) FROM loans) AS loan_id
          FROM queue JOIN free USING (book_id, n))""", """
SELECT request_id, member_id, book_id, CAST(copy_id AS DOUBLE) AS copy_id, copy_id IS NOT NULL AS accepted,
       CASE WHEN status IS NULL THEN 'Unknown member' WHEN status <> 'active' THEN 'Cannot create loan: Member is not active'
            WHEN copy_id IS NULL THEN 'No free copy' END AS outcome,
       CAST(loan_id AS DOUBLE) AS loan_id, CASE WHEN loan_id IS NOT NULL THEN 'Book checked out' END AS description
FROM req LEFT JOIN given USING (request_id)"""),
    "job_checkout_quota": with_library(f"""
asked AS (SELECT event_id AS request_id, user_id AS member_id, {_K} AS book_id, status FROM events
          LEFT JOIN (SELECT member_id AS user_id, status FROM members) USING (user_id) WHERE event_type = 'purchase'),
have AS (SELECT member_id, COUNT(*) AS n FROM loans WHERE status = 'active' GROUP BY member_id),
free AS (SELECT book_id, copy_id, ROW_NUMBER() OVER (PARTITION BY book_id ORDER BY copy_id) AS k
         FROM book_copies ANTI JOIN (FROM loans WHERE status = 'active') USING (copy_id)),
room AS (SELECT book_id, COUNT(*) AS copies FROM free GROUP BY book_id),
queue AS (SELECT ROW_NUMBER() OVER (ORDER BY request_id) AS i, a.*, coalesce(n, 0) AS had, coalesce(copies, 0) AS copies
          FROM asked a LEFT JOIN have USING (member_id) LEFT JOIN room USING (book_id) WHERE status = 'active'),
served AS (
  SELECT 0::BIGINT AS i, 0::BIGINT AS request_id, 0::BIGINT AS k, '' AS why, [{{'m': -1::BIGINT, 'b': -1::BIGINT}}] AS got
  UNION ALL
  SELECT i, request_id, CASE WHEN quota THEN 0 WHEN none_left THEN 0 ELSE taken + 1 END,
         CASE WHEN quota THEN 'Too many active loans' WHEN none_left THEN 'No free copy' ELSE '' END,
         CASE WHEN quota OR none_left THEN got ELSE list_append(got, {{'m': member_id, 'b': book_id}}) END
  FROM (SELECT *, taken >= copies AS none_left FROM (
    SELECT q.i, q.request_id, q.member_id, q.book_id, q.copies, s.got,
           q.had + len(list_filter(s.got, lambda x: x.m = q.member_id)) >= 12 AS quota,
           len(list_filter(s.got, lambda x: x.b = q.book_id)) AS taken
    FROM served s JOIN queue q ON q.i = s.i + 1)))""", f"""
SELECT a.request_id, a.member_id, a.book_id, CAST(f.copy_id AS DOUBLE) AS copy_id, f.copy_id IS NOT NULL AS accepted,
       CASE WHEN a.status IS NULL THEN 'Unknown member' WHEN a.status <> 'active' THEN 'Cannot create loan: Member is not active'
            WHEN f.copy_id IS NULL THEN s.why ELSE 'Book checked out successfully. Due on ' || strftime({A} + 14, '%Y-%m-%d') END AS outcome
FROM asked a LEFT JOIN served s USING (request_id) LEFT JOIN free f ON f.book_id = a.book_id AND f.k = s.k""").replace("WITH", "WITH RECURSIVE", 1),
    "job_update_members": with_library(_LATE, """
SELECT member_id, last_name, CASE WHEN late THEN 'suspended' ELSE status END AS status FROM members LEFT JOIN late USING (member_id)"""),
    "layout_registrations": with_library("", """
SELECT event_id, member_id, last_name FROM event_registrations JOIN members USING (member_id) WHERE status = 'active' AND member_id BETWEEN 20 AND 70"""),
    "sql_member_loans": with_library("""
owed AS (SELECT member_id, CAST(SUM(fine_amount) AS DOUBLE) AS total_unpaid FROM fines JOIN loans USING (loan_id) WHERE NOT paid GROUP BY member_id)""", f"""
SELECT l.member_id, m.last_name, b.title, CAST(l.due_date AS TIMESTAMP) AS due_date, greatest(0, {A} - l.due_date)::BIGINT AS days_late, total_unpaid
FROM loans l JOIN members m USING (member_id) JOIN book_copies c USING (copy_id) JOIN books b USING (book_id) LEFT JOIN owed o ON o.member_id = l.member_id
WHERE l.status = 'active'"""),
    "job_update_versions": with_library(f"{_LATE},\nidle AS (SELECT member_id, TRUE AS idle FROM members ANTI JOIN loans USING (member_id)),\n"
                                        "stood AS (SELECT *, CASE WHEN late THEN 'suspended' ELSE status END AS status_before FROM members LEFT JOIN late USING (member_id))", """
SELECT member_id, last_name, status_before, CASE WHEN idle THEN 'expired' ELSE status_before END AS status FROM stood LEFT JOIN idle USING (member_id)"""),
    "job_audit_members": with_library(_LATE, """
SELECT 'members' AS table_name, 'UPDATE' AS action, member_id AS record_id, TIMESTAMP '2001-08-02 09:00:00' AS changed_at,
       'SYSTEM' AS changed_by, format('Member {} {} updated. Status: {} -> suspended', first_name, last_name, status) AS description
FROM members JOIN late USING (member_id) WHERE status <> 'suspended'"""),
    "job_delete_guard": with_library("""
busy AS (SELECT DISTINCT book_id, TRUE AS busy FROM loans JOIN book_copies USING (copy_id) WHERE status = 'active')""", """
SELECT book_id, busy IS NULL AS allowed, CASE WHEN busy THEN 'Cannot delete book: Active loans exist' END AS reason
FROM books LEFT JOIN busy USING (book_id)"""),
    "job_cascade_copies": with_library(_GONE, """
SELECT copy_id, book_id, condition FROM book_copies ANTI JOIN gone USING (book_id)"""),
    "job_cascade_violations": with_library(_GONE, """
SELECT 'loans' AS table_name, 'copy_id' AS "column", loan_id AS row_id
FROM loans SEMI JOIN (SELECT copy_id FROM book_copies SEMI JOIN gone USING (book_id)) c USING (copy_id)"""),
    "job_settle_members": with_library(_PAID_NOW, """
SELECT member_id, last_name, CASE WHEN member_id IN (SELECT member_id FROM paid_now JOIN fines USING (fine_id) JOIN loans USING (loan_id))
                                  THEN 'active' ELSE status END AS status FROM members"""),
    "job_settle_fines": with_library(_PAID_NOW, f"""
SELECT fine_id, loan_id, CAST(fine_amount AS DOUBLE) AS fine_amount, fine_reason, paid OR COALESCE(now, FALSE) AS paid,
       CAST(CASE WHEN now THEN {A} ELSE payment_date END AS TIMESTAMP) AS payment_date
FROM fines LEFT JOIN paid_now USING (fine_id)"""),
    "job_batch_return": with_library(f"""{_BARRED},
after AS (SELECT loan_id, due_date, CASE WHEN status = 'active' THEN {A} ELSE return_date END AS back
          FROM loans SEMI JOIN barred USING (member_id) WHERE status <> 'lost')""", f"""
SELECT loan_id, CAST(greatest({A} - due_date, 0) * 0.25 AS DOUBLE) AS fine_amount, 'overdue' AS fine_reason, FALSE AS paid
FROM after ANTI JOIN fines USING (loan_id) WHERE back > due_date"""),
    "job_member_report": with_library(f"""{_BARRED},
owed AS (SELECT member_id, SUM(fine_amount) AS amount FROM fines JOIN loans USING (loan_id) WHERE NOT paid GROUP BY ALL)""", f"""
SELECT 'profile' AS part, member_id, email AS what, CAST(NULL AS DOUBLE) AS amount FROM members SEMI JOIN barred USING (member_id)
UNION ALL SELECT 'loan', member_id, title, NULL FROM loans SEMI JOIN barred USING (member_id) JOIN book_copies USING (copy_id)
          JOIN books USING (book_id) WHERE status = 'active'
UNION ALL SELECT 'unpaid', member_id, NULL, CAST(amount AS DOUBLE) FROM barred LEFT JOIN owed USING (member_id)
UNION ALL SELECT 'event', member_id, event_name, NULL FROM event_registrations SEMI JOIN barred USING (member_id)
          JOIN lib_events USING (event_id) WHERE event_date >= {A}"""),
    "job_append_fines": with_library("""
late AS (SELECT loan_id, return_date - due_date AS days FROM loans ANTI JOIN fines USING (loan_id) WHERE status = 'returned' AND return_date > due_date)""", """
SELECT ROW_NUMBER() OVER (ORDER BY loan_id) + (SELECT MAX(fine_id) FROM fines) AS fine_id, loan_id, CAST(days * 0.25 AS DOUBLE) AS fine_amount,
       'overdue' AS fine_reason, FALSE AS paid FROM late"""),
    "job_append_indexed": with_library("""
asked AS (SELECT DISTINCT event_id, member_id + 1 AS member_id FROM event_registrations WHERE member_id + 1 IN (SELECT member_id FROM members)),
free AS (SELECT event_id, member_id, ROW_NUMBER() OVER (ORDER BY event_id, member_id) + (SELECT MAX(registration_id) FROM event_registrations) AS id
         FROM asked ANTI JOIN event_registrations USING (event_id, member_id))""", """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(member_id AS BIGINT) AS member_id, id IS NULL AS was_taken, TRUE AS is_taken, CAST(id AS DOUBLE) AS registration_id
FROM asked LEFT JOIN free USING (event_id, member_id)"""),
    "dq_unique": "SELECT p_name, COUNT(*) AS row_count FROM part GROUP BY p_name HAVING COUNT(*) > 1",
    "dq_length": "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10",
}
