"""The lending reports re-expressed on the driver's TPC-H-like tables.

Mapping: members -> customer (segment = membership type, negative balance =
suspended); loans -> orders (open status 'O' = active loan, due date =
order date + 14 days) or lineitem; copies -> parts; unpaid fines -> open
lineitems (``l_linestatus = 'O'``); events/registrations -> events.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables. Output columns use the source types: integers as BIGINT,
money summed as exact decimals and returned as DOUBLE, dates as the
tables' timestamps (midnight) so both engines hash them the same way.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions.exprs import late_days, pct_exact, position_in, round_ratio
from shelfwise.operators import aggs, jobs, joins, quality, sets, sketches, topk, windows
from shelfwise.sources.tables import load_driver_tables

# The reference date of each driver table family.
AS_OF = dt.date(2001, 8, 2)
AS_OF_EVENTS = dt.date(2024, 1, 31)
LOAN_DAYS = 14


def _d(c) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def _ts(c: Column) -> Column:
    """DATE -> midnight TIMESTAMP_NTZ (the driver tables' date type)."""
    return c.cast("timestamp_ntz")


def _money(c) -> Column:
    """Prices carry two decimals: as DECIMAL(18,2) for exact comparisons."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def _cents(c) -> Column:
    """Price in integer cents (exact for two-decimal prices). Sums stay in
    64-bit integer arithmetic inside codegen, where a DECIMAL(28,2) sum
    would take the BigDecimal path."""
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("long")


def _from_cents(c) -> Column:
    """Cents back to a money DOUBLE (exact integer / 100, one rounding)."""
    return (F.col(c) if isinstance(c, str) else c).cast("double") / F.lit(100.0)


def _due(c="o_orderdate") -> Column:
    return F.date_add(_d(c), LOAN_DAYS)


def _overdue() -> Column:
    """Due date before ``AS_OF``, written on the bare column so that the
    filter reaches the Parquet scan."""
    last = dt.datetime.combine(AS_OF - dt.timedelta(days=LOAN_DAYS), dt.time())
    return F.col("o_orderdate") < F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz")


def _t(spark, sf_dir):
    return load_driver_tables(spark, sf_dir)


# ---------------------------------------------------------------- filters
def overdue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders past due (strictly before the as-of date) with customer
    and nation, and days overdue."""
    t = _t(spark, sf_dir)
    o = t.orders.where((F.col("o_orderstatus") == "O") & _overdue())
    j = (o.join(t.customer, o.o_custkey == t.customer.c_custkey)
          .join(t.nation, F.col("c_nationkey") == t.nation.n_nationkey))
    return j.select("o_orderkey", "c_name", "n_name", "o_orderdate",
                    _ts(_due()).alias("due_date"),
                    F.datediff(F.lit(AS_OF), _due()).cast("long").alias("days_overdue"))


def overdue_scan(spark, sf_dir):
    """SELECT * of open orders past due: the pushdown target."""
    t = _t(spark, sf_dir)
    return t.orders.where((F.col("o_orderstatus") == "O") & _overdue())


def recent(spark, sf_dir):
    """Orders placed in the last 180 days (inclusive)."""
    t = _t(spark, sf_dir)
    return (t.orders.where(_d("o_orderdate") >= F.date_sub(F.lit(AS_OF), 180))
             .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))


def between(spark, sf_dir):
    """Events dated from the as-of date minus 30 days to the as-of date,
    both ends inclusive."""
    t = _t(spark, sf_dir)
    d = _d("ts")
    return (t.events.where(d.between(F.date_sub(F.lit(AS_OF_EVENTS), 30), F.lit(AS_OF_EVENTS)))
             .select("event_id", "event_type", "ts", "user_id"))


def custom_order(spark, sf_dir):
    """Urgent and high orders with their position in an explicit value
    order."""
    t = _t(spark, sf_dir)
    vals = ("1-URGENT", "2-HIGH")
    return (t.orders.where(F.col("o_orderpriority").isin(*vals))
             .select("o_orderkey", "o_orderpriority", "o_orderdate",
                     position_in("o_orderpriority", *vals).cast("long").alias("priority_pos")))


def top_amounts(spark, sf_dir):
    """Ten largest open orders with customer (ties broken by order key)."""
    t = _t(spark, sf_dir)
    o = t.orders.where(F.col("o_orderstatus") == "O")
    j = o.join(t.customer, o.o_custkey == t.customer.c_custkey)
    return topk.top_k(j.select("c_name", "o_orderkey", "o_totalprice", "o_orderdate"),
                      [F.desc("o_totalprice"), "o_orderkey"], 10)


# ---------------------------------------------------------------- aggregates
def segment_share(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = t.customer
    total = aggs.total_count(c)
    return (c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("member_count"))
             .withColumn("percentage", pct_exact(F.col("member_count"), total)))


def status_rollup(spark, sf_dir):
    t = _t(spark, sf_dir)
    r = aggs.rollup_with_total(
        t.orders, "o_orderstatus",
        [_from_cents(F.sum(_cents("o_totalprice"))).alias("total_amount"),
         F.count(F.lit(1)).alias("order_count")])
    return r


def top_types(spark, sf_dir):
    t = _t(spark, sf_dir)
    g = t.part.groupBy("p_type").agg(F.countDistinct("p_partkey").alias("titles"),
                                     F.sum("p_size").cast("long").alias("copies"))
    return topk.top_k(g, [F.desc("copies"), "p_type"], 5)


def gap_by_segment(spark, sf_dir):
    """Mean days from order to shipment of returned lines per segment."""
    t = _t(spark, sf_dir)
    li = t.lineitem.where(F.col("l_returnflag") == "R")
    j = (li.join(t.orders, li.l_orderkey == t.orders.o_orderkey)
           .join(t.customer, F.col("o_custkey") == t.customer.c_custkey))
    days = F.datediff(_d("l_shipdate"), _d("o_orderdate"))
    g = j.groupBy("c_mktsegment").agg(F.sum(days).alias("_s"), F.count(F.lit(1)).alias("loans_count"))
    return g.select("c_mktsegment", round_ratio(F.col("_s"), F.col("loans_count")).alias("avg_days"),
                    "loans_count")


def _event_keys(t):
    """Part keys that the event log mentions (``props.k``)."""
    return t.events.select(_event_key().alias("k")).where("k is not null")


def _event_key():
    return F.get_json_object("props", "$.k").cast("long")


def unsold_parts(spark, sf_dir):
    """Parts that no event mentions (LEFT JOIN .. IS NULL)."""
    t = _t(spark, sf_dir)
    return joins.anti_join(t.part, _event_keys(t), "p_partkey", "k") \
        .select("p_partkey", "p_name", "p_type")


def unsold_parts_not_in(spark, sf_dir):
    """Same set written as NOT IN, with SQL's NULL rules."""
    t = _t(spark, sf_dir)
    return joins.not_in(t.part, "p_partkey", _event_keys(t), "k") \
        .select("p_partkey", "p_name", "p_type")


def unsold_parts_not_exists(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.part.join(_event_keys(t), F.col("p_partkey") == F.col("k"), "left_anti") \
        .select("p_partkey", "p_name", "p_type")


def customer_activity(spark, sf_dir):
    """Per customer: rows of orders joined with their open lines (flag in the
    ON clause), open orders, open amount; top 10 by row count."""
    t = _t(spark, sf_dir)
    o = t.customer.join(t.orders, t.customer.c_custkey == t.orders.o_custkey)
    lines = t.lineitem.where(F.col("l_linestatus") == "O")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    g = (j.groupBy("c_custkey", "c_name")
          .agg(F.count(F.lit(1)).alias("total_loans"),
               F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("long").alias("active_loans"),
               _from_cents(F.coalesce(F.sum(_cents("l_extendedprice")), F.lit(0))).alias("unpaid_fines"))
          .where(F.col("total_loans") > 0))
    return topk.top_k(g, [F.desc("total_loans"), "c_custkey"], 10)


def monthly(spark, sf_dir):
    """Lines of orders placed in the last six calendar months: count and
    distinct customers and parts per month; newest six months."""
    t = _t(spark, sf_dir)
    o = t.orders.where(_d("o_orderdate") >= F.add_months(F.lit(AS_OF), -6))
    j = o.join(t.lineitem, o.o_orderkey == t.lineitem.l_orderkey)
    g = (j.groupBy(F.year("o_orderdate").cast("long").alias("year"),
                   F.month("o_orderdate").cast("long").alias("month"))
          .agg(F.count(F.lit(1)).alias("total_loans"),
               F.countDistinct("o_custkey").alias("unique_borrowers"),
               F.countDistinct("l_partkey").alias("unique_books")))
    return topk.top_k(g, [F.desc("year"), F.desc("month")], 6)


def fill_rate(spark, sf_dir):
    """Lines per part against the part size as capacity."""
    t = _t(spark, sf_dir)
    sold = t.lineitem.groupBy("l_partkey").agg(F.count("l_orderkey").alias("n"))
    g = t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        "p_partkey", "p_name", "p_size", F.coalesce("n", F.lit(0)).alias("registrations"))
    return g.withColumn("capacity_percentage", pct_exact(F.col("registrations"), F.col("p_size")))


# ---------------------------------------------------------------- joins
def star_chain(spark, sf_dir):
    """Order revenue (lines aggregated to the order first) through the
    customer -> nation -> region chain; newest 20 orders."""
    t = _t(spark, sf_dir)
    place = (t.customer.join(t.nation, F.col("c_nationkey") == t.nation.n_nationkey)
              .join(t.region, F.col("n_regionkey") == t.region.r_regionkey)
              .select("c_custkey", "c_name", "n_name", "r_name"))
    sold = (t.orders.join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
             .join(place.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi"))
    # the 20 orders are known before any line is summed
    newest = topk.top_k(sold.select("o_orderkey", "o_custkey", "o_orderdate"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 20)
    rev = (t.lineitem.join(F.broadcast(newest.select("o_orderkey")), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("l_orderkey").agg(_from_cents(F.sum(_cents("l_extendedprice"))).alias("revenue")))
    j = newest.join(rev, F.col("o_orderkey") == F.col("l_orderkey")).join(place, F.col("o_custkey") == F.col("c_custkey"))
    out = j.select("o_orderkey", "c_name", "n_name", "r_name", "o_orderdate", "revenue")
    return topk.top_k(out, [F.desc("o_orderdate"), F.desc("o_orderkey")], 20)


def on_loan(spark, sf_dir):
    """Open orders with days until due (negative = overdue)."""
    t = _t(spark, sf_dir)
    o = t.orders.where(F.col("o_orderstatus") == "O")
    j = (o.join(t.customer, o.o_custkey == t.customer.c_custkey)
          .join(t.nation, F.col("c_nationkey") == t.nation.n_nationkey))
    return j.select("o_orderkey", "c_name", "n_name", "o_orderdate", _ts(_due()).alias("due_date"),
                    F.datediff(_due(), F.lit(AS_OF)).cast("long").alias("days_until_due"))


def availability(spark, sf_dir):
    """Per part: distinct orders, distinct open orders and the difference
    (parts with no lines kept). The (part, order) pairs are deduplicated
    once and flagged, so both distinct counts are plain counts: no Expand
    of the line rows per distinct aggregate."""
    t = _t(spark, sf_dir)
    pairs = t.lineitem.select("l_partkey", "l_orderkey").distinct()
    opened = t.orders.where(F.col("o_orderstatus") == "O").select("o_orderkey")
    flagged = pairs.join(opened, pairs.l_orderkey == opened.o_orderkey, "left")
    per = flagged.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("total_copies"), F.count("o_orderkey").alias("copies_on_loan"))
    j = t.part.select("p_partkey", "p_name").join(per, "p_partkey", "left")
    total = F.coalesce("total_copies", F.lit(0))
    onloan = F.coalesce("copies_on_loan", F.lit(0))
    return j.select("p_partkey", "p_name", total.alias("total_copies"), onloan.alias("copies_on_loan"),
                    (total - onloan).alias("available_copies"))


def loans_per_part(spark, sf_dir):
    """Lines per part with open-order lines, for parts sold at least once."""
    t = _t(spark, sf_dir)
    j = t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey) \
        .join(t.part, F.col("l_partkey") == t.part.p_partkey)
    return j.groupBy("p_partkey", "p_name").agg(F.count(F.lit(1)).alias("loan_count"))


def _part_loan_totals(t):
    j = t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
    return j.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.count(F.when(F.col("o_orderstatus") == "O", 1)).alias("active_loans"))


def totals_correlated(spark, sf_dir):
    """Correlated COUNT subqueries per part, decorrelated into one grouped
    aggregate + left join; empty groups give 0."""
    t = _t(spark, sf_dir)
    tot = _part_loan_totals(t)
    j = t.part.join(tot, "p_partkey", "left")
    return j.select("p_partkey", "p_name",
                    F.coalesce("total_loans", F.lit(0)).alias("total_loans"),
                    F.coalesce("active_loans", F.lit(0)).alias("active_loans"))


def totals_joins(spark, sf_dir):
    """The same totals by left joins and conditional sums."""
    t = _t(spark, sf_dir)
    lo = t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
    j = t.part.join(lo, t.part.p_partkey == lo.l_partkey, "left")
    return j.groupBy("p_partkey", "p_name").agg(
        F.count("l_orderkey").alias("total_loans"),
        F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).cast("long").alias("active_loans"))


def active_per_customer(spark, sf_dir):
    """Open orders per customer (the EXPLAIN target)."""
    t = _t(spark, sf_dir)
    o = t.orders.where(F.col("o_orderstatus") == "O")
    j = t.customer.join(o, t.customer.c_custkey == o.o_custkey)
    return j.groupBy("c_custkey", "c_name").agg(F.count(F.lit(1)).alias("loan_count"))


def same_nation(spark, sf_dir):
    """Suppliers that share a nation with another supplier, with the group
    size (linear form of the same-address self-join)."""
    t = _t(spark, sf_dir)
    return joins.shared_key_members(t.supplier.select("s_suppkey", "s_name", "s_nationkey"),
                                    "s_nationkey", "s_suppkey")


def attendance(spark, sf_dir):
    """Events after the mid-month date with the acting customer."""
    t = _t(spark, sf_dir)
    e = t.events.where(_d("ts") > F.lit(dt.date(2024, 1, 15)))
    j = e.join(t.customer, e.user_id == t.customer.c_custkey)
    return j.select("event_id", "event_type", "ts", "c_custkey", "c_name")


def author_popularity(spark, sf_dir):
    """Per nation: distinct suppliers, lines supplied, lines per supplier."""
    t = _t(spark, sf_dir)
    s = t.nation.join(t.supplier, t.nation.n_nationkey == t.supplier.s_nationkey)
    j = s.join(t.lineitem.select("l_suppkey", "l_orderkey"), F.col("s_suppkey") == F.col("l_suppkey"), "left")
    g = (j.groupBy("n_nationkey", "n_name")
          .agg(F.countDistinct("s_suppkey").alias("book_count"),
               F.count("l_orderkey").alias("total_loans"))
          .where(F.col("total_loans") > 0)
          .withColumn("avg_loans_per_book", round_ratio(F.col("total_loans"), F.col("book_count"))))
    return topk.top_k(g, [F.desc("total_loans"), "n_nationkey"], 10)


def never_ordered(spark, sf_dir):
    """Customers who ordered nothing through the event log (anti join)."""
    t = _t(spark, sf_dir)
    bought = t.events.where(F.col("event_type") == "purchase").select("user_id")
    return joins.anti_join(t.customer, bought, "c_custkey", "user_id") \
        .select("c_custkey", "c_name", "c_mktsegment")


# ---------------------------------------------------------------- subqueries
def above_average(spark, sf_dir):
    """Customers with more orders than the mean per ordering customer."""
    t = _t(spark, sf_dir)
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_loans"))
    mean = aggs.scalar(per, F.avg("total_loans"))
    j = per.where(F.col("total_loans") > mean).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("c_custkey", "c_name", "total_loans", mean.alias("average_loans"))


def above_average_debt(spark, sf_dir):
    """Customers whose open-line total exceeds the mean of single lines."""
    t = _t(spark, sf_dir)
    lines = t.lineitem.where(F.col("l_linestatus") == "O")
    j = t.orders.join(lines, t.orders.o_orderkey == lines.l_orderkey)
    per = j.groupBy("o_custkey").agg(F.sum(_cents("l_extendedprice")).alias("_tot"),
                                     F.count(F.lit(1)).alias("fine_count"))
    mean = aggs.scalar(t.lineitem, F.avg(_cents("l_extendedprice")))
    out = per.where(F.col("_tot") > mean).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return out.select("c_custkey", "c_name", _from_cents("_tot").alias("total_fines"), "fine_count")


def summary_cte(spark, sf_dir):
    """Customer summary from three aggregates over orders and events; NULL
    counts for customers without any."""
    t = _t(spark, sf_dir)
    o = t.orders
    total = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_loans"))
    lines = t.lineitem.where(F.col("l_linestatus") == "O")
    unpaid = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
               .groupBy("o_custkey")
               .agg(_from_cents(F.coalesce(F.sum(_cents("l_extendedprice")), F.lit(0))).alias("total_fines")))
    active = (t.events.groupBy(F.col("user_id").alias("o_custkey"))
               .agg(F.count(F.lit(1)).alias("active_loans_count")))
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    for df in (total, unpaid, active):
        c = c.join(df.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    # counts that can be NULL are carried as DOUBLE: both engines then hand
    # the same column type to pandas (a nullable BIGINT becomes Int64 in one
    # and float64 in the other); the values are unchanged
    return c.select("c_custkey", "c_name", F.col("total_loans").cast("double").alias("total_loans"),
                    F.col("active_loans_count").cast("double").alias("active_loans_count"), "total_fines",
                    "c_mktsegment")


def all_priorities(spark, sf_dir):
    """Customers with orders in every priority (relational division)."""
    t = _t(spark, sf_dir)
    prios = t.orders.select("o_orderpriority").distinct()
    div = aggs.relational_division(t.orders, ["o_custkey"], "o_orderpriority", prios,
                                   "o_orderpriority", "events_attended")
    return div.join(t.customer, F.col("o_custkey") == F.col("c_custkey")) \
        .select("c_custkey", "c_name", "events_attended")


# Fee per category (the membership fee schedule re-aimed at
# return flags).
_FEES = (("R", 20), ("A", 50), ("N", 10))


def revenue_full_outer(spark, sf_dir):
    """Monthly revenue: finished-order value by order month
    full-outer-joined with weighted line fees by ship month; newest twelve
    months."""
    t = _t(spark, sf_dir)
    fr = (t.orders.where(F.col("o_orderstatus") == "F")
           .groupBy(F.year("o_orderdate").cast("long").alias("year"),
                    F.month("o_orderdate").cast("long").alias("month"))
           .agg(F.sum(_cents("o_totalprice")).alias("total_fines")))
    fee = None
    for flag, amount in _FEES:
        fee = (F.when(F.col("l_returnflag") == flag, F.lit(amount)) if fee is None
               else fee.when(F.col("l_returnflag") == flag, F.lit(amount)))
    fee = fee.otherwise(F.lit(0))
    mr = (t.lineitem.groupBy(F.year("l_shipdate").cast("long").alias("year"),
                    F.month("l_shipdate").cast("long").alias("month"))
           .agg(F.sum(fee).cast("long").alias("total_membership")))
    j = joins.full_outer_coalesce(fr, mr, ["year", "month"])
    fines = F.coalesce(F.col("total_fines"), F.lit(0))
    mem = F.coalesce(F.col("total_membership"), F.lit(0))
    out = j.select("year", "month", _from_cents(fines).alias("fine_revenue"),
                   mem.alias("membership_revenue"),
                   _from_cents(fines + mem * 100).alias("total_revenue"))
    return topk.top_k(out, [F.desc_nulls_last("year"), F.desc_nulls_last("month")], 12)


def latest_order(spark, sf_dir):
    """Latest order date and order per customer (ties: highest key), for
    customers with orders."""
    t = _t(spark, sf_dir)
    last = windows.first_per_group(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                   ["o_orderdate", "o_orderkey"], latest=True)
    j = last.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("c_custkey", "c_name", F.col("o_orderdate").alias("most_recent_loan_date"),
                    F.col("o_orderkey").alias("latest_orderkey"))


def recommend(spark, sf_dir):
    """For each customer's favourite part type(s) by lines bought, parts of
    that type the customer never bought; first five by customer, name, part.
    See ``jobs.recommend`` for the bounded exact candidate scheme."""
    t = _t(spark, sf_dir)
    bought = (t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
                .select(F.col("o_custkey").alias("member_id"), F.col("l_partkey").alias("item_id")))
    items = t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_type").alias("genre"),
                          F.col("p_name").alias("title"))
    rec = jobs.recommend(bought, items, per_member=5)
    rec = topk.top_k(rec, ["member_id", "title", "item_id"], 5)
    return rec.join(t.customer, F.col("member_id") == F.col("c_custkey")) \
        .select("c_custkey", "c_name", F.col("genre").alias("p_type"), F.col("title").alias("p_name"),
                F.col("item_id").alias("p_partkey"))


# ---------------------------------------------------------------- set operations
def people(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_mktsegment").alias("detail"), F.lit("Member").alias("type"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          sets.typed_null("detail"), F.lit("Author").alias("type"))
    return sets.union_all(c, s)  # tags and keys differ: nothing to deduplicate


def touched_customers(spark, sf_dir):
    """Customers with an open order or an event, each once (UNION)."""
    t = _t(spark, sf_dir)
    a = t.orders.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("c_custkey"))
    return sets.union_distinct(a, t.events.select(F.col("user_id").alias("c_custkey")))


def feed(spark, sf_dir):
    """Orders, events and shipments as one activity feed; newest 50."""
    t = _t(spark, sf_dir)
    a = t.orders.select(F.lit("Loan").alias("activity_type"), F.col("o_orderdate").alias("activity_date"),
                        F.col("o_orderpriority").alias("description"), F.col("o_orderkey").alias("ref_id"))
    b = t.events.select(F.lit("Event").alias("activity_type"), F.col("ts").alias("activity_date"),
                        F.col("event_type").alias("description"), F.col("event_id").alias("ref_id"))
    c = t.lineitem.select(F.lit("Registration").alias("activity_type"), F.col("l_shipdate").alias("activity_date"),
                          F.col("l_returnflag").alias("description"), F.col("l_orderkey").alias("ref_id"))
    u = sets.union_all(a, b, c)
    return topk.top_k(u, [F.desc("activity_date"), "activity_type", "ref_id", "description"], 50)


def status_union(spark, sf_dir):
    """Per part: lines of orders not open ('Available') and lines of open
    orders ('On Loan'), one tagged row per non-empty side. One pass: lines are
    flagged by their order, counted per part and flag, then named."""
    t = _t(spark, sf_dir)
    opened = t.orders.where(F.col("o_orderstatus") == "O").select("o_orderkey")
    n = (t.lineitem.select("l_partkey", "l_orderkey").where("l_orderkey is not null")
          .join(opened, F.col("l_orderkey") == F.col("o_orderkey"), "left")
          .groupBy("l_partkey", F.when(F.col("o_orderkey").isNull(), "Available").otherwise("On Loan").alias("status"))
          .agg(F.count(F.lit(1)).alias("count")))
    return n.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "p_name", "status", "count")


def issues(spark, sf_dir):
    """Customers with overdue open orders, open lines, or a negative
    balance, one tagged row per issue."""
    t = _t(spark, sf_dir)
    c = t.customer
    od = t.orders.where((F.col("o_orderstatus") == "O") & _overdue())
    a = (c.join(od, c.c_custkey == od.o_custkey).groupBy("c_custkey", "c_name")
          .agg(F.count(F.lit(1)).alias("issue_count")).withColumn("issue", F.lit("Overdue")))
    ol = t.orders.join(t.lineitem.where(F.col("l_linestatus") == "O"),
                       F.col("o_orderkey") == F.col("l_orderkey"))
    b = (c.join(ol, c.c_custkey == ol.o_custkey).groupBy("c_custkey", "c_name")
          .agg(F.count(F.lit(1)).alias("issue_count")).withColumn("issue", F.lit("Unpaid Fines")))
    s = (c.where(F.col("c_acctbal") < 0).select("c_custkey", "c_name")
          .withColumn("issue_count", F.lit(1).cast("long")).withColumn("issue", F.lit("Suspended")))
    cols = ["c_custkey", "c_name", "issue", "issue_count"]
    return sets.union_all(a.select(*cols), b.select(*cols), s.select(*cols))  # tagged, one row per key


def top_bottom(spark, sf_dir):
    """Ten most and ten least sold parts (parts never sold are not in either
    list: inner joins)."""
    t = _t(spark, sf_dir)
    sold = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("loan_count"))
    counts = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "p_name", "loan_count")
    return topk.top_and_bottom(counts, "loan_count", ["p_partkey"], 10, "category", "Popular", "Unpopular")


# ---------------------------------------------------------------- windows
def rank_customers(spark, sf_dir):
    """RANK and DENSE_RANK of customers by order count, over all customers
    with orders (histogram scale form, no single-partition window)."""
    t = _t(spark, sf_dir)
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total_loans"))
    # distinct order counts are at most sqrt(2 * orders): bounded histogram
    r = windows.global_ranks(per, "total_loans", ascending=False, rank="rank_num",
                             dense_rank="dense_rank_num", bounded_keys=True)
    j = r.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("c_custkey", "c_name", "total_loans", F.col("rank_num").cast("long").alias("rank_num"),
                    F.col("dense_rank_num").cast("long").alias("dense_rank_num"))


def running_total(spark, sf_dir):
    """Running total of finished-order value by order date (peers on one
    date share the total)."""
    t = _t(spark, sf_dir)
    f = t.orders.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_orderdate", "o_totalprice", _cents("o_totalprice").alias("_m"))
    r = windows.running_total(f, "o_orderdate", "_m", "_rt", bounded_keys=True)  # one key per day
    return r.select("o_orderkey", "o_orderdate", "o_totalprice", _from_cents("_rt").alias("running_total"))


def top3_per_type(spark, sf_dir):
    """Parts ranked by lines sold within their type; RANK <= 3 keeps ties."""
    t = _t(spark, sf_dir)
    j = t.part.join(t.lineitem.select("l_partkey", "l_orderkey"),
                    t.part.p_partkey == F.col("l_partkey"), "left")
    per = j.groupBy("p_partkey", "p_type", "p_name").agg(F.count("l_orderkey").alias("loans"))
    r = windows.top_n_within(per, ["p_type"], [F.desc("loans")], 3, name="genre_rank")
    return r.select("p_type", "p_partkey", "p_name", "loans", F.col("genre_rank").cast("long").alias("genre_rank"))


def monthly_delta(spark, sf_dir):
    """Orders per customer per month with the previous active month's count
    and the change (previous row, gaps not filled)."""
    t = _t(spark, sf_dir)
    m = (t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("year"),
                          F.month("o_orderdate").cast("long").alias("month"))
           .agg(F.count(F.lit(1)).alias("loans_this_month")))
    # a customer has at most one row per calendar month here, so no group
    # can grow with the data: the plain partitioned window is safe
    l = windows.lag_columns(m, ["o_custkey"], ["year", "month"], ["loans_this_month"], prefix="prev_",
                            method="window")
    # nullable counts as DOUBLE (see summary_cte)
    return l.select("o_custkey", "year", "month", "loans_this_month",
                    F.col("prev_loans_this_month").cast("double").alias("previous_month_loans"),
                    (F.col("loans_this_month") - F.col("prev_loans_this_month")).cast("double").alias("change"))


def next_event(spark, sf_dir):
    """Each user's first event at or after mid-month (ties: lowest id)."""
    t = _t(spark, sf_dir)
    e = t.events.where(_d("ts") >= F.lit(dt.date(2024, 1, 15)))
    first = windows.first_per_group(e, ["user_id"], ["ts", "event_id"], ["event_type", "ts", "event_id"],
                                    latest=False)
    return first.select("user_id", F.col("event_type").alias("next_event_name"),
                        F.col("ts").alias("event_date"), "event_id")


def moving_avg(spark, sf_dir):
    """Orders per day with a 7-row moving average; newest 30 days."""
    t = _t(spark, sf_dir)
    daily = t.orders.groupBy(_d("o_orderdate").alias("loan_day")).agg(
        F.count("o_orderkey").alias("loans_that_day"))
    # one row per calendar day: bounded by the calendar, not by the data,
    # so the plain ROWS window over the daily table is safe here
    w = Window.orderBy("loan_day").rowsBetween(-6, 0)
    ma = daily.withColumn("seven_day_moving_avg", F.avg("loans_that_day").over(w))
    ma = topk.top_k(ma, [F.desc("loan_day")], 30)
    return ma.select(_ts(F.col("loan_day")).alias("loan_day"), "loans_that_day", "seven_day_moving_avg")


def moving_avg_calendar(spark, sf_dir):
    """Lines shipped per day with the mean over the last 7 calendar days
    (RANGE frame: days without shipments are absent, not zero), over all
    lines; each day contributes to the next 7 calendar days."""
    t = _t(spark, sf_dir)
    daily = t.lineitem.groupBy(_d("l_shipdate").alias("ship_day")).agg(F.count(F.lit(1)).alias("lines"))
    ma = windows.moving_average_range(daily, "ship_day", "lines", 6, "seven_day_avg")
    return ma.select(_ts(F.col("ship_day")).alias("ship_day"), "lines", "seven_day_avg")


def dense_ids(spark, sf_dir):
    """Dense order numbers 1..n by (order date, key) without a global
    single-task ROW_NUMBER (range partitions + per-partition offsets)."""
    from shelfwise.sources.append import assign_ids
    t = _t(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderdate")
    return assign_ids(o, ["o_orderdate", "o_orderkey"], "seq_id", start=1)


def active_customers(spark, sf_dir):
    """Customers in good standing (non-negative balance), by name."""
    t = _t(spark, sf_dir)
    c = t.customer.where(F.col("c_acctbal") >= 0)
    return topk.sort(c.select("c_custkey", "c_name", "c_mktsegment"), ["c_name", "c_custkey"])


def percentile(spark, sf_dir):
    """Percent rank (x100, 2 decimals) of open line amounts, with buyer."""
    t = _t(spark, sf_dir)
    li = t.lineitem.where(F.col("l_linestatus") == "O").select("l_orderkey", "l_linenumber", "l_extendedprice")
    r = windows.global_ranks(li, "l_extendedprice", ascending=True, rank="_r")
    n = aggs.total_count(li)
    pctl = F.when(n > 1, pct_exact(F.col("_r") - 1, n - 1)).otherwise(F.lit(0.0))
    j = r.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")) \
         .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return j.select("c_name", "l_orderkey", "l_linenumber", "l_extendedprice",
                    pctl.alias("percentile_rank_pct"))


def percentile_sketch(spark, sf_dir):
    """Percent rank of open line amounts from a mergeable quantile sketch:
    per line status whether every line's rank lies within the sketch's bound
    of its exact rank, with the lines checked."""
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    near = sketches.percent_rank_sketch(li, "cents")
    exact = windows.global_ranks(near, "cents", ascending=True, rank="_r")
    off = F.abs(F.col("pct") - (F.col("_r") - 1) / (aggs.total_count(li) - 1))
    bound = sketches.KLL_ERROR + 1 / 1000
    return exact.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("lines"), F.max(off <= bound).alias("within_bound"), F.min(off <= bound).alias("all_within_bound"))


def monthly_sketches(spark, sf_dir):
    """Distinct customers per month of order, merged from daily sketches that
    are written once: the exact number, and whether the estimate is within
    2 % of it."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    t = _t(spark, sf_dir)
    orders = t.orders.select("o_custkey", _d("o_orderdate").alias("day"))
    path = os.path.join(checkpoint_dir(spark), "sketches", f"daily_{uuid.uuid4().hex[:12]}")
    sketches.daily_distinct(orders, F.col("day"), [], {"customers": "o_custkey"}).write.parquet(path)
    month = F.trunc("day", "month")
    merged = sketches.merged_distinct(spark.read.parquet(path), month, [], ["customers"]).withColumnRenamed("customers", "estimate")
    exact = orders.groupBy(month.alias("period")).agg(F.countDistinct("o_custkey").alias("customers"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= F.col("customers") * 0.02
    return merged.join(exact, "period").select(F.col("period").cast("timestamp_ntz").alias("month"), F.col("rows").alias("orders"), "customers", near.alias("within_2_pct"))


def gaps(spark, sf_dir):
    """Days between consecutive orders of each customer (first -> NULL)."""
    t = _t(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    l = windows.lag_columns(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderdate"], prefix="prev_")
    return l.select("o_custkey", "o_orderkey", "o_orderdate",
                    F.col("prev_o_orderdate").alias("previous_loan_date"),
                    F.datediff(_d("o_orderdate"), _d("prev_o_orderdate")).cast("double").alias("days_gap"))


def late_days_q(spark, sf_dir):
    """The late-days function over lines of open orders: days from due
    date (order + 14) to shipment, never negative."""
    t = _t(spark, sf_dir)
    o = t.orders.where(F.col("o_orderstatus") == "O")
    j = t.lineitem.join(o, t.lineitem.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    late_days(_due(), _d("l_shipdate")).cast("long").alias("days_overdue"))


def daily_activity(spark, sf_dir):
    """Events per day and type with tumbling one-day windows (batch form of
    the streaming job)."""
    t = _t(spark, sf_dir)
    g = t.events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w"), "event_type") \
        .agg(F.count(F.lit(1)).alias("events"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("day"), "event_type", "events")


def _table_stream(spark, sf_dir, name, schema):
    """A table as a file stream: its folder of part files, or, when it is a
    single file, the folder around it with only that file taken."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    reader = spark.readStream.schema(schema)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def daily_activity_stream(spark, sf_dir):
    """The same counts produced by the Structured Streaming job: the events
    table is read as a file stream, windows are emitted in append mode once
    the 1-day watermark passes them (the newest windows stay open), and the
    emitted rows are returned. Checkpoint state lives under the session's
    checkpoint folder."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import daily_activity as stream_counts
    t = _t(spark, sf_dir)
    stream = _table_stream(spark, sf_dir, "events", t.events.schema)
    run = os.path.join(checkpoint_dir(spark), "streams", f"daily_activity_{uuid.uuid4().hex[:12]}")
    # file sink in the shared folder: emitted windows never pass through the driver
    q = (stream_counts(stream).writeStream.format("parquet").outputMode("append")
         .option("path", os.path.join(run, "out")).option("checkpointLocation", os.path.join(run, "state"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema("day timestamp, event_type string, events bigint").parquet(os.path.join(run, "out"))
    return out.select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "events")


#: lateness that spans the tables' dates, for files that arrive in no time order
_SPAN = "10000 days"


def _end_of_stream(spark, source, schema):
    """A last file whose only row (no key) moves the watermark past all
    others, so that everything held is released."""
    row = [dt.datetime(2100, 1, 1) if f.name == "event_time" else None for f in schema]
    spark.createDataFrame([tuple(row)], schema).write.mode("append").parquet(source)


def _run_stream(df, run):
    """Run a stream of the files that are there into a Parquet folder and
    read it."""
    import os

    from shelfwise.streaming.ordered import state_store
    with state_store(df.sparkSession):
        q = (df.writeStream.format("parquet").outputMode("append").option("path", os.path.join(run, "out"))
             .option("checkpointLocation", os.path.join(run, "state")).trigger(availableNow=True).start())
        q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(os.path.join(run, "out"))


def fines_stream(spark, sf_dir):
    """The fines job run over loan status events derived from the tables: an order opens
    an 'active' loan at its order time; a finished order is 'returned' 12
    hours after its last shipment. A return after the due date (order + 14
    days) charges 0.25 per late day; a 'returned' event dated before the
    loan's 'active' event charges nothing. The files arrive in no time order,
    so the lateness spans them all; a last file ends the stream. Events, state
    and output live under the session's checkpoint folder."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import LOAN_STATUS_SCHEMA, fines_from_status_events
    t = _t(spark, sf_dir)
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last"))
    o = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"))
    due = _due()
    opened = o.select(F.col("o_orderkey").alias("loan_id"), F.lit("active").alias("status"), due.alias("due_date"),
                      F.lit(None).cast("date").alias("return_date"),
                      F.col("o_orderdate").cast("timestamp").alias("event_time"))
    returned = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("loan_id"), F.lit("returned").alias("status"), due.alias("due_date"),
        _d("_last").alias("return_date"),
        (F.col("_last").cast("timestamp") + F.expr("INTERVAL 12 HOURS")).alias("event_time"))
    run = os.path.join(checkpoint_dir(spark), "streams", f"fines_{uuid.uuid4().hex[:12]}")
    opened.unionByName(returned).write.parquet(os.path.join(run, "source"))
    stream = spark.readStream.schema(LOAN_STATUS_SCHEMA).parquet(os.path.join(run, "source"))
    _end_of_stream(spark, os.path.join(run, "source"), LOAN_STATUS_SCHEMA)
    out = _run_stream(fines_from_status_events(stream, _SPAN), run)
    return out.select("loan_id", F.col("fine_amount").cast("double").alias("fine_amount"), "fine_reason", "paid")


def audit_stream(spark, sf_dir):
    """The audit job (per-member previous row in state) run as a stream
    over two member snapshots derived from the tables: at 2001-01-01 each
    customer is 'suspended' with a negative balance, else 'active'; at the
    as-of date one with no order since 2001-01-01 is 'expired'. Each member
    whose snapshot changed yields one audit row."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import MEMBER_CHANGE_SCHEMA, audit_from_member_changes
    t = _t(spark, sf_dir)
    recent = t.orders.where(_d("o_orderdate") >= F.lit(dt.date(2001, 1, 1))).select("o_custkey").distinct() \
        .withColumn("_recent", F.lit(True))
    c = t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left")
    standing = F.when(F.col("c_acctbal") < 0, F.lit("suspended")).otherwise(F.lit("active"))
    first = c.select(F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("first_name"),
                     F.col("c_name").alias("last_name"), standing.alias("status"),
                     F.lit(dt.datetime(2001, 1, 1)).alias("event_time"))
    second = c.select(F.col("c_custkey").alias("member_id"), F.col("c_mktsegment").alias("first_name"),
                      F.col("c_name").alias("last_name"),
                      F.when(F.col("_recent").isNull(), F.lit("expired")).otherwise(standing).alias("status"),
                      F.lit(dt.datetime(2001, 8, 2)).alias("event_time"))
    run = os.path.join(checkpoint_dir(spark), "streams", f"audit_{uuid.uuid4().hex[:12]}")
    first.unionByName(second).write.parquet(os.path.join(run, "source"))
    stream = spark.readStream.schema(MEMBER_CHANGE_SCHEMA).parquet(os.path.join(run, "source"))
    _end_of_stream(spark, os.path.join(run, "source"), MEMBER_CHANGE_SCHEMA)
    out = _run_stream(audit_from_member_changes(stream, _SPAN), run)
    return out.select("table_name", "action", "record_id", F.col("changed_at").cast("timestamp_ntz").alias("changed_at"),
                      "changed_by", "description")


def admission_stream(spark, sf_dir):
    """The admission job run as a stream: purchases ask for copies, members
    are the customers, sign-ups hold copies. Rejections by the member guard,
    then contention for copies in request order; one outcome per request."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import admit_loan_requests
    t = _t(spark, sf_dir)
    run = os.path.join(checkpoint_dir(spark), "streams", f"admission_{uuid.uuid4().hex[:12]}")
    as_of = F.lit(AS_OF_EVENTS)
    _requests(t).select("request_id", "member_id", "copy_id", as_of.alias("loan_date"), F.lit(None).cast("date").alias("due_date"),
                        F.col("requested_at").cast("timestamp").alias("requested_at")).write.parquet(os.path.join(run, "source"))
    _prior_loans(t).write.parquet(os.path.join(run, "base"))
    admit_loan_requests(spark, os.path.join(run, "source"), _members(t), os.path.join(run, "base"), os.path.join(run, "out"),
                        os.path.join(run, "state"), AS_OF_EVENTS)
    return spark.read.parquet(os.path.join(run, "out", "outcomes")).select("request_id", "member_id", "copy_id", "accepted", "outcome")


def fines_cycles_stream(spark, sf_dir):
    """Fines over loans that are lent again and again: a customer is one
    loan id and each of its orders a cycle, active from the order and, if
    finished, returned 12 hours after its last shipment. The rows are dealt
    to files by hash, read two a micro-batch, so cycles arrive in no order."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import LOAN_STATUS_SCHEMA, fines_from_status_events
    t = _t(spark, sf_dir)
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last"))
    o = t.orders.join(last, F.col("o_orderkey") == F.col("l_orderkey"))
    due, none = _due(), F.lit(None).cast("date")
    opened = o.select(F.col("o_custkey").alias("loan_id"), F.lit("active").alias("status"), due.alias("due_date"), none.alias("return_date"),
                      F.col("o_orderdate").cast("timestamp").alias("event_time"))
    closed = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("loan_id"), F.lit("returned").alias("status"), due.alias("due_date"), _d("_last").alias("return_date"),
        (F.col("_last").cast("timestamp") + F.expr("INTERVAL 12 HOURS")).alias("event_time"))
    run = os.path.join(checkpoint_dir(spark), "streams", f"cycles_{uuid.uuid4().hex[:12]}")
    source = os.path.join(run, "source")
    opened.unionByName(closed).repartition(4, F.xxhash64("event_time", "loan_id")).write.parquet(source)
    _end_of_stream(spark, source, LOAN_STATUS_SCHEMA)
    stream = spark.readStream.schema(LOAN_STATUS_SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
    out = _run_stream(fines_from_status_events(stream, _SPAN), run)
    return out.select("loan_id", F.col("fine_amount").cast("double").alias("fine_amount"), "fine_reason", "paid")


def admission_returns_stream(spark, sf_dir):
    """The admission job with returns in the stream: purchases ask for
    copies, error events give one back, sign-ups hold copies at first."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import admit_loan_requests
    t = _t(spark, sf_dir)
    run = os.path.join(checkpoint_dir(spark), "streams", f"returns_{uuid.uuid4().hex[:12]}")
    as_of = F.lit(AS_OF_EVENTS)
    _requests(t).select("request_id", "member_id", "copy_id", as_of.alias("loan_date"), F.lit(None).cast("date").alias("due_date"),
                        F.col("requested_at").cast("timestamp").alias("requested_at")).write.parquet(os.path.join(run, "source"))
    back = t.events.where(F.col("event_type") == "error").select(_copy_key(), F.col("ts").cast("timestamp").alias("returned_at"))
    back.write.parquet(os.path.join(run, "returns"))
    _prior_loans(t).write.parquet(os.path.join(run, "base"))
    admit_loan_requests(spark, os.path.join(run, "source"), _members(t), os.path.join(run, "base"), os.path.join(run, "out"),
                        os.path.join(run, "state"), AS_OF_EVENTS, returns_dir=os.path.join(run, "returns"))
    return spark.read.parquet(os.path.join(run, "out", "outcomes")).select("request_id", "member_id", "copy_id", "accepted", "outcome")


def monthly_activity_stream(spark, sf_dir):
    """Orders per calendar month and status by the chained streaming job
    (days, then months); the months that a 30-day watermark has passed."""
    import os
    import uuid

    from shelfwise.session import checkpoint_dir
    from shelfwise.streaming.streams import monthly_activity as stream_months
    t = _t(spark, sf_dir)
    stream = _table_stream(spark, sf_dir, "orders", t.orders.schema).select(F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("event_type"))
    run = os.path.join(checkpoint_dir(spark), "streams", f"monthly_{uuid.uuid4().hex[:12]}")
    out = _run_stream(stream_months(stream, lateness="30 days"), run)
    return out.select(F.col("month").cast("timestamp_ntz").alias("month"), F.col("event_type").alias("status"), "events", "days")


# ---------------------------------------------------------------- jobs
# Fixed value: copies a part key stands for in the job reports.
_COPIES_PER_KEY = 20


def _copy_key():
    return (_event_key() * _COPIES_PER_KEY + F.col("event_id") % _COPIES_PER_KEY).alias("copy_id")


def _requests(t):
    """Every purchase event asks for one of the copies of its key."""
    e = t.events.where(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("request_id"), F.col("ts").alias("requested_at"),
                    F.col("user_id").alias("member_id"), _copy_key())


def _prior_loans(t):
    """Every sign-up event holds one of the copies of its key."""
    e = t.events.where(F.col("event_type") == "signup")
    return e.select(F.col("event_id").alias("loan_id"), F.col("user_id").alias("member_id"),
                    _copy_key(), F.lit("active").alias("status"))


def _members(t):
    return t.customer.select(F.col("c_custkey").alias("member_id"),
                             F.when(F.col("c_acctbal") < 0, "suspended").otherwise("active").alias("status"))


def checkouts(spark, sf_dir):
    """Checkout requests (purchases) against members and the copies held by
    sign-ups; one outcome per request."""
    t = _t(spark, sf_dir)
    out = jobs.apply_checkouts(_requests(t), _members(t), _prior_loans(t), AS_OF_EVENTS,
                               order_cols=["requested_at", "request_id"])
    return out.select("request_id", "member_id", "copy_id", "outcome")


def quota(spark, sf_dir):
    """Loan quota: existing active loans plus earlier requests may not
    exceed twenty per member."""
    t = _t(spark, sf_dir)
    out = jobs.apply_quota(_requests(t), _prior_loans(t), max_active=20,
                           order_cols=["requested_at", "request_id"])
    return out.select("request_id", "member_id", "accepted")


def overdue_or_open(spark, sf_dir):
    """Customers with overdue open orders or open lines: distinct overdue
    orders (conditional COUNT DISTINCT) and the open-line amount, kept when
    either is positive (OR in HAVING); left joins keep every customer in
    the aggregation."""
    t = _t(spark, sf_dir)
    lines = t.lineitem.where(F.col("l_linestatus") == "O").select("l_orderkey", "l_extendedprice")
    j = (t.customer.select("c_custkey", "c_name")
         .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"),
               F.col("c_custkey") == F.col("o_custkey"), "left")
         .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    late = (_due() < F.lit(AS_OF)) & (F.col("o_orderstatus") == "O")
    g = (j.groupBy("c_custkey", "c_name")
          .agg(F.countDistinct(F.when(late, F.col("o_orderkey"))).alias("overdue_books"),
               F.coalesce(F.sum(_cents("l_extendedprice")), F.lit(0)).alias("_open"))
          .where((F.col("_open") > 0) | (F.col("overdue_books") > 0)))
    return g.select("c_custkey", "c_name", "overdue_books", _from_cents("_open").alias("total_unpaid_fines"))


def allocate(spark, sf_dir):
    """Copy allocation: each purchase asks for a part type (the type of part
    ``props.k``); free parts of that type (mentioned by no event) are handed
    out lowest key first, in request order; requests beyond the free parts
    get none."""
    t = _t(spark, sf_dir)
    asked = t.events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("request_id"), F.col("ts").alias("requested_at"), F.col("user_id").alias("member_id"),
        _event_key().alias("k"))
    copies = t.part.select(F.col("p_partkey").alias("copy_id"), F.col("p_type").alias("book_id"))
    req = asked.join(copies, F.col("k") == F.col("copy_id")).select("request_id", "requested_at", "member_id", "book_id")
    loans = _event_keys(t).select(F.col("k").alias("copy_id"), F.lit("active").alias("status"))
    out = jobs.allocate_copies(req, copies, loans, order_cols=["requested_at", "request_id"])
    # the allocated copy can be NULL: carried as DOUBLE (see summary_cte)
    return out.select("request_id", "member_id", "book_id", F.col("copy_id").cast("double").alias("copy_id"),
                      "accepted")


def returns(spark, sf_dir):
    """Return requests: each 'view' event returns order ``props.k`` (open
    orders are active loans, due 14 days after the order). The first request
    for an active loan returns it with a fine of 0.25 per late day at the
    as-of date; other requests are invalid. One outcome per request."""
    t = _t(spark, sf_dir)
    e = t.events.where(F.col("event_type") == "view")
    req = e.select(F.col("event_id").alias("request_id"), F.col("ts").alias("requested_at"),
                   F.get_json_object("props", "$.k").cast("long").alias("loan_id"))
    loans = t.orders.select(F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("member_id"),
                            _d("o_orderdate").alias("loan_date"), _due().alias("due_date"),
                            F.lit(None).cast("date").alias("return_date"),
                            F.when(F.col("o_orderstatus") == "O", "active").otherwise("returned").alias("status"))
    out, _, _ = jobs.apply_returns(req, loans, AS_OF, order_cols=["requested_at", "request_id"],
                                   cut_lineage=False)
    return out.select("request_id", "loan_id", "accepted", F.col("fine_amount").cast("double").alias("fine_amount"),
                      "outcome")


# ---------------------------------------------------------------- data quality
def dq_pk(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.check_pk(t.lineitem, ["l_orderkey", "l_linenumber"])


def dq_fk(spark, sf_dir):
    """Orders that no line refers to."""
    t = _t(spark, sf_dir)
    return quality.check_fk(t.orders, "o_orderkey", t.lineitem, "l_orderkey").select("o_orderkey", "o_custkey", "o_orderdate")


def dq_values(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.check_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]) \
        .select("o_orderkey", "o_orderpriority")


def dq_summary(spark, sf_dir):
    """One-pass rule counts over lineitem: NULLs per column, CHECK
    violations, values outside the allowed set."""
    t = _t(spark, sf_dir)
    return quality.summary(t.lineitem, not_null=["l_orderkey", "l_partkey", "l_shipdate"],
                           checks={"qty_positive": "l_quantity > 0", "discount_small": "l_discount <= 0.05"},
                           allowed={"l_returnflag": ["A", "N"]})


QUERIES = {
    "overdue": overdue, "overdue_scan": overdue_scan, "recent": recent, "between": between,
    "custom_order": custom_order, "top_amounts": top_amounts,
    "segment_share": segment_share, "status_rollup": status_rollup, "top_types": top_types,
    "gap_by_segment": gap_by_segment, "unsold_parts": unsold_parts,
    "unsold_parts_not_in": unsold_parts_not_in, "unsold_parts_not_exists": unsold_parts_not_exists,
    "customer_activity": customer_activity, "monthly": monthly, "fill_rate": fill_rate,
    "star_chain": star_chain, "on_loan": on_loan, "availability": availability,
    "loans_per_part": loans_per_part, "totals_correlated": totals_correlated,
    "totals_joins": totals_joins, "active_per_customer": active_per_customer,
    "same_nation": same_nation, "attendance": attendance, "author_popularity": author_popularity,
    "never_ordered": never_ordered, "above_average": above_average,
    "above_average_debt": above_average_debt, "summary_cte": summary_cte,
    "all_priorities": all_priorities, "revenue_full_outer": revenue_full_outer,
    "latest_order": latest_order, "recommend": recommend, "people": people,
    "touched_customers": touched_customers, "feed": feed,
    "status_union": status_union, "issues": issues, "top_bottom": top_bottom,
    "rank_customers": rank_customers, "running_total": running_total,
    "top3_per_type": top3_per_type, "monthly_delta": monthly_delta, "next_event": next_event,
    "moving_avg": moving_avg, "moving_avg_calendar": moving_avg_calendar, "dense_ids": dense_ids,
    "active_customers": active_customers, "percentile": percentile, "gaps": gaps, "late_days": late_days_q,
    "overdue_or_open": overdue_or_open, "allocate": allocate, "returns": returns,
    "daily_activity": daily_activity, "percentile_sketch": percentile_sketch, "monthly_sketches": monthly_sketches, "daily_activity_stream": daily_activity_stream, "fines_stream": fines_stream, "fines_cycles_stream": fines_cycles_stream,
    "admission_returns_stream": admission_returns_stream, "monthly_activity_stream": monthly_activity_stream,
    "audit_stream": audit_stream, "admission_stream": admission_stream, "checkouts": checkouts, "quota": quota,
    "dq_pk": dq_pk, "dq_fk": dq_fk, "dq_values": dq_values, "dq_summary": dq_summary,
}
