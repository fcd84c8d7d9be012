"""Named lending reports on the library schema.

Every report takes the table dict (``sources.load_library``) and an explicit
``as_of`` date (never ``current_date()``), and returns a DataFrame. Sorts end
with a key so ties are deterministic; a LIMIT is kept only where the report
is a top-k. Where the SQL and a report's title disagree, the SQL is
implemented and the title's meaning is an option.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.exprs import full_name, late_days, pct_exact, position_in, round_ratio
from shelfwise.operators import aggs, joins, jobs, sets, topk, windows

Tables = dict[str, DataFrame]


def _d(x) -> F.Column:
    return F.lit(dt.date.fromisoformat(x) if isinstance(x, str) else x)


def _loan_chain(t: Tables, mark=lambda loans: loans) -> DataFrame:
    """loans -> members -> copies -> books (inner joins on keys). ``mark`` is
    put on the loans' side of each join (``F.broadcast`` for few loans)."""
    return (mark(mark(mark(t["loans"]).join(t["members"].drop("status"), "member_id"))
                 .join(t["book_copies"], "copy_id"))
            .join(t["books"], "book_id"))


#: rows up to which what is left of a large table is broadcast
FEW_ROWS = 200_000


def _marked(df: DataFrame):
    """``F.broadcast`` if ``df`` has few rows, else nothing."""
    return F.broadcast if df.count() <= FEW_ROWS else lambda x: x


def _book_loan_totals(t: Tables) -> DataFrame:
    """Loans per book with at least one, counted per copy before the copies
    are joined."""
    per_copy = t["loans"].groupBy("copy_id").agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("status") == "active", 1)).alias("_a"))
    return (per_copy.join(t["book_copies"].select("copy_id", "book_id"), "copy_id").groupBy("book_id")
            .agg(F.sum("_n").alias("total_loans"), F.sum("_a").alias("active_loans")))


# ---------------------------------------------------------------- Q3 basic
def active_members(t: Tables, as_of=None) -> DataFrame:
    m = t["members"].where(F.col("status") == "active")
    return topk.sort(m.select("member_id", "first_name", "last_name", "email", "membership_type"),
                     ["last_name", "first_name", "member_id"])


def books_after(t: Tables, as_of=None, year: int = 2001) -> DataFrame:
    b = t["books"].join(t["authors"], "author_id", "left").where(F.col("publication_year") >= year)
    return topk.sort(b.select("book_id", "title", "author_name", "publication_year", "genre"),
                     [F.desc("publication_year"), "book_id"])


def books_in_genre(t: Tables, as_of=None, genre: str = "Fiction") -> DataFrame:
    b = t["books"].join(t["authors"], "author_id", "left").where(F.col("genre") == genre)
    return topk.sort(b.select("book_id", "title", "author_name", "genre", "total_copies"), ["title", "book_id"])


def overdue_loans(t: Tables, as_of) -> DataFrame:
    """Active loans due strictly before ``as_of`` with days overdue."""
    l = _loan_chain(t).where((F.col("status") == "active") & (F.col("due_date") < _d(as_of)))
    out = l.select("loan_id", "first_name", "last_name", "title", "loan_date", "due_date",
                   F.datediff(_d(as_of), F.col("due_date")).alias("days_overdue"))
    return topk.sort(out, [F.desc("days_overdue"), "loan_id"])


def recent_members(t: Tables, as_of, days: int = 180) -> DataFrame:
    """Joined within ``days`` days (inclusive); titled six months, the SQL
    counts 180 days (``months=6`` would use calendar months)."""
    m = t["members"].where(F.col("join_date") >= F.date_sub(_d(as_of), days))
    return topk.sort(m.select("member_id", "first_name", "last_name", "join_date", "membership_type"),
                     [F.desc("join_date"), "member_id"])


def worn_copies(t: Tables, as_of=None, conditions=("poor", "fair")) -> DataFrame:
    """Copies in the listed conditions, ordered by that list, then by
    acquisition date (titled poor; the SQL also returns fair)."""
    c = t["book_copies"].where(F.col("condition").isin(*conditions)).join(t["books"], "book_id")
    out = c.select("copy_id", "title", "copy_number", "condition", "acquisition_date",
                   position_in("condition", *conditions).alias("_pos"))
    return topk.sort(out, ["_pos", "acquisition_date", "copy_id"]).drop("_pos")


def top_unpaid_fines(t: Tables, as_of=None, k: int = 10) -> DataFrame:
    f = (t["fines"].where(F.col("paid") == False)  # noqa: E712  (NULL paid is not unpaid)
                   .join(t["loans"].select("loan_id", "member_id", "loan_date"), "loan_id")
                   .join(t["members"].select("member_id", "first_name", "last_name"), "member_id"))
    out = f.select("fine_id", "first_name", "last_name", "fine_amount", "fine_reason", "loan_date")
    return topk.top_k(out, [F.desc("fine_amount"), "fine_id"], k)


def upcoming_events(t: Tables, as_of, days: int = 30) -> DataFrame:
    """Events from ``as_of`` to ``as_of + days`` inclusive (titled this month)."""
    e = t["events"].where(F.col("event_date").between(_d(as_of), F.date_add(_d(as_of), days)))
    return topk.sort(e.select("event_id", "event_name", "event_date", "event_type", "max_attendees"),
                     ["event_date", "event_id"])


# ---------------------------------------------------------------- Q4 aggregates
def members_by_type(t: Tables, as_of=None) -> DataFrame:
    m = t["members"]
    g = m.groupBy("membership_type").agg(F.count(F.lit(1)).alias("member_count")) \
        .withColumn("percentage", pct_exact(F.col("member_count"), aggs.total_count(m)))
    return topk.sort(g, [F.desc("member_count"), "membership_type"])


def fines_by_paid(t: Tables, as_of=None) -> DataFrame:
    """Sums and counts per paid flag with the grand total (``is_total``)."""
    return aggs.rollup_with_total(t["fines"], "paid", [F.sum("fine_amount").alias("total_amount"),
                                                       F.count(F.lit(1)).alias("fine_count")])


def top_genres(t: Tables, as_of=None, k: int = 5) -> DataFrame:
    g = t["books"].groupBy("genre").agg(F.countDistinct("book_id").alias("titles"),
                                        F.sum("total_copies").alias("copies"))
    return topk.top_k(g, [F.desc("copies"), "genre"], k)


def loan_days_by_type(t: Tables, as_of=None) -> DataFrame:
    """Mean loan length of returned loans per membership type."""
    l = t["loans"].where(F.col("status") == "returned").join(t["members"].drop("status"), "member_id")
    g = l.groupBy("membership_type").agg(F.sum(F.datediff("return_date", "loan_date")).alias("_s"),
                                         F.count(F.lit(1)).alias("loans_count"))
    g = g.select("membership_type", round_ratio(F.col("_s"), F.col("loans_count")).alias("avg_days"),
                 "loans_count")
    return topk.sort(g, [F.desc("avg_days"), "membership_type"])


def books_with_unlent_copy(t: Tables, as_of=None) -> DataFrame:
    """Books having a copy that was never lent, with the earliest
    acquisition among such copies (titled never borrowed; the SQL tests
    copies, see ``never_loaned_books`` for the book-level form)."""
    unlent = joins.anti_join(t["book_copies"], t["loans"], "copy_id")
    b = t["books"].join(t["authors"], "author_id").join(unlent, "book_id")
    g = b.groupBy("book_id", "title", "author_name", "genre").agg(
        F.min("acquisition_date").alias("earliest_acquisition"))
    return topk.sort(g, ["earliest_acquisition", "book_id"])


def member_activity(t: Tables, as_of=None, k: int = 10) -> DataFrame:
    """Loans joined with their unpaid fines per member (a loan with two
    unpaid fines counts twice, as in the SQL); top k by that count."""
    j = joins.left_join_on(
        t["members"].select("member_id", "first_name", "last_name")
        .join(t["loans"].select("loan_id", "member_id", "status"), "member_id"),
        t["fines"].select("loan_id", "fine_amount", "paid"), "loan_id",
        right_filter=F.col("paid") == False).drop("paid")  # noqa: E712  (LEFT JOIN ... ON ... AND paid = FALSE)
    g = (j.groupBy("member_id", "first_name", "last_name")
          .agg(F.count(F.lit(1)).alias("total_loans"),
               F.sum(F.when(F.col("status") == "active", 1).otherwise(0)).alias("active_loans"),
               F.coalesce(F.sum("fine_amount"), F.lit(0)).alias("unpaid_fines"))
          .where(F.col("total_loans") > 0)
          .select("member_id", full_name("first_name", "last_name").alias("member_name"),
                  "total_loans", "active_loans", "unpaid_fines"))
    return topk.top_k(g, [F.desc("total_loans"), "member_id"], k)


def monthly_loans(t: Tables, as_of, months: int = 6, k: int = 6, approx: bool = False) -> DataFrame:
    """Loans since ``as_of`` minus ``months`` calendar months per month. The
    window can touch seven months; LIMIT k keeps the newest k."""
    l = t["loans"].where(F.col("loan_date") >= F.add_months(_d(as_of), -months))
    fn = F.approx_count_distinct if approx else F.countDistinct
    g = l.groupBy(F.year("loan_date").alias("year"), F.month("loan_date").alias("month")).agg(
        F.count(F.lit(1)).alias("total_loans"), fn("member_id").alias("unique_borrowers"),
        fn("copy_id").alias("unique_books"))
    return topk.top_k(g, [F.desc("year"), F.desc("month")], k)


def event_fill(t: Tables, as_of) -> DataFrame:
    """Future events with registrations and fill percentage (0 when no one
    registered; NULL when capacity is 0 or unknown)."""
    e = t["events"].where(F.col("event_date") > _d(as_of))
    j = e.join(t["event_registrations"].select("event_id", "registration_id"), "event_id", "left")
    g = j.groupBy("event_id", "event_name", "event_date", "max_attendees").agg(
        F.count("registration_id").alias("registrations"))
    g = g.withColumn("capacity_percentage", pct_exact(F.col("registrations"), F.col("max_attendees")))
    return topk.sort(g, [F.desc_nulls_last("capacity_percentage"), "event_id"])


# ---------------------------------------------------------------- Q5 joins
def loan_history(t: Tables, as_of=None, k: int = 20) -> DataFrame:
    j = _loan_chain(t).join(t["authors"], "author_id")
    out = j.select("loan_id", "first_name", "last_name", "email", "title", "author_name", "loan_date",
                   "due_date", "return_date", "status")
    return topk.top_k(out, [F.desc("loan_date"), F.desc("loan_id")], k)


def copies_on_loan(t: Tables, as_of) -> DataFrame:
    """Active loans with days until due (negative = overdue)."""
    j = _loan_chain(t).join(t["authors"], "author_id").where(F.col("status") == "active")
    out = j.select("loan_id", "title", "author_name", "copy_number", "first_name", "last_name", "loan_date",
                   "due_date", F.datediff("due_date", _d(as_of)).alias("days_until_due"))
    return topk.sort(out, ["due_date", "loan_id"])


def overdue_or_fined(t: Tables, as_of) -> DataFrame:
    j = joins.left_join_on(
        t["members"].select("member_id", "first_name", "last_name", "email", "phone")
        .join(t["loans"].select("loan_id", "member_id", "due_date", "status"), "member_id", "left"),
        t["fines"].select("loan_id", "fine_amount", "paid"), "loan_id",
        right_filter=F.col("paid") == False).drop("paid")  # noqa: E712
    late = (F.col("due_date") < _d(as_of)) & (F.col("status") == "active")
    g = (j.groupBy("member_id", "first_name", "last_name", "email", "phone")
          .agg(F.countDistinct(F.when(late, F.col("loan_id"))).alias("overdue_books"),
               F.coalesce(F.sum("fine_amount"), F.lit(0)).alias("total_unpaid_fines"))
          .where((F.col("total_unpaid_fines") > 0) | (F.col("overdue_books") > 0)))
    return topk.sort(g, [F.desc("total_unpaid_fines"), F.desc("overdue_books"), "member_id"])


def book_availability(t: Tables, as_of=None) -> DataFrame:
    """Per book: distinct copies, distinct copies on an active loan and the
    difference; books without copies are kept. (book, copy) is deduplicated
    once, so both distinct counts become plain counts (no Expand of the joined
    rows per distinct aggregate); rows are dealt by copy, over as many
    partitions as there are rows for, and only there deduplicated and flagged."""
    active = t["loans"].where(F.col("status") == "active").select("copy_id")
    n = windows.partitions_for(t["book_copies"])
    copies = t["book_copies"].select("book_id", "copy_id").repartition(n, "copy_id").distinct()
    active = active.repartition(n, "copy_id").distinct().withColumn("_on", F.lit(1))
    flagged = copies.join(active, "copy_id", "left")
    per = flagged.groupBy("book_id").agg(F.count("copy_id").alias("total_copies"),
                                         F.count("_on").alias("copies_on_loan"))
    j = t["books"].select("book_id", "title", "author_id").join(t["authors"], "author_id") \
        .join(per, "book_id", "left")
    total = F.coalesce("total_copies", F.lit(0))
    onloan = F.coalesce("copies_on_loan", F.lit(0))
    g = j.select("book_id", "title", "author_name", total.alias("total_copies"), onloan.alias("copies_on_loan"),
                 (total - onloan).alias("available_copies"))
    return topk.sort(g, ["available_copies", "book_id"])


def attendance_list(t: Tables, as_of) -> DataFrame:
    e = t["events"].where(F.col("event_date") > _d(as_of))
    j = e.join(t["event_registrations"], "event_id").join(t["members"], "member_id")
    out = j.select("event_id", "event_name", "event_date", "member_id", "first_name", "last_name", "email",
                   "registration_date")
    return topk.sort(out, ["event_date", "last_name", "first_name", "event_id", "member_id"])


def author_popularity(t: Tables, as_of=None, k: int = 10) -> DataFrame:
    # loans are counted per book, books per author; names come last
    per = t["books"].select("book_id", "author_id").join(_book_loan_totals(t).select("book_id", "total_loans"), "book_id", "left")
    g = (per.groupBy("author_id").agg(F.count(F.lit(1)).alias("book_count"), F.sum("total_loans").alias("total_loans"))
          .where(F.col("total_loans") > 0).join(t["authors"].select("author_id", "author_name"), "author_id")
          .select("author_id", "author_name", "book_count", "total_loans")
          .withColumn("avg_loans_per_book", round_ratio(F.col("total_loans"), F.col("book_count"))))
    return topk.top_k(g, [F.desc("total_loans"), "author_id"], k)


def never_borrowed(t: Tables, as_of=None) -> DataFrame:
    m = joins.anti_join(t["members"], t["loans"], "member_id")
    return topk.sort(m.select("member_id", "first_name", "last_name", "email", "join_date",
                              "membership_type"), ["join_date", "member_id"])


def shared_address(t: Tables, as_of=None) -> DataFrame:
    """Members who share an address with another member, with the number of
    members at it: the linear form of the same-address self-join (every
    pair is two rows with one address)."""
    m = t["members"].select("member_id", "first_name", "last_name", "address")
    return topk.sort(joins.shared_key_members(m, "address", "member_id", size_name="members_at_address"),
                     ["address", "member_id"])


# ---------------------------------------------------------------- Q6 subqueries
def above_average_debtors(t: Tables, as_of=None) -> DataFrame:
    """Members whose unpaid total exceeds the mean of single fines (paid
    included), as the SQL compares."""
    unpaid = t["fines"].where(F.col("paid") == False)  # noqa: E712
    j = t["members"].join(t["loans"].select("loan_id", "member_id"), "member_id").join(unpaid, "loan_id")
    g = j.groupBy("member_id", "first_name", "last_name").agg(
        F.sum("fine_amount").alias("total_fines"), F.count("fine_id").alias("fine_count"))
    g = aggs.above_scalar(g, "total_fines", aggs.scalar(t["fines"], F.avg("fine_amount")))
    return topk.sort(g, [F.desc("total_fines"), "member_id"])


def _loans_per_book(t: Tables) -> DataFrame:
    j = t["book_copies"].select("book_id", "copy_id").join(t["loans"].select("copy_id", "loan_id"),
                                                            "copy_id", "left")
    return j.groupBy("book_id").agg(F.count("loan_id").alias("loan_count"))


def above_average_books(t: Tables, as_of=None) -> DataFrame:
    """Books lent more often than the mean over books that have copies (the
    per-book count is computed once and reused)."""
    per = _loans_per_book(t)
    mean = aggs.scalar(per, F.avg("loan_count"))
    j = per.where(F.col("loan_count") > mean).join(t["books"], "book_id").join(t["authors"], "author_id")
    out = j.select("book_id", "title", "author_name", F.col("loan_count").alias("total_loans"),
                   mean.alias("average_loans"))
    return topk.sort(out, [F.desc("total_loans"), "book_id"])


def member_summary(t: Tables, as_of=None) -> DataFrame:
    """Totals from three aggregates; members without loans keep NULL."""
    l = t["loans"]
    total = l.groupBy("member_id").agg(F.count(F.lit(1)).alias("total_loans"))
    unpaid = (l.select("loan_id", "member_id")
               .join(t["fines"].where(F.col("paid") == False).select("loan_id", "fine_amount"),  # noqa: E712
                     "loan_id", "left")
               .groupBy("member_id").agg(F.coalesce(F.sum("fine_amount"), F.lit(0)).alias("total_fines")))
    active = l.where(F.col("status") == "active").groupBy("member_id").agg(
        F.count(F.lit(1)).alias("active_loans_count"))
    m = t["members"].select("member_id", "first_name", "last_name", "status")
    out = m.join(total, "member_id", "left").join(unpaid, "member_id", "left").join(active, "member_id", "left")
    return topk.sort(out.select("member_id", "first_name", "last_name", "total_loans", "active_loans_count",
                                "total_fines", "status"),
                     [F.desc_nulls_last("total_loans"), "member_id"])


def never_loaned_books(t: Tables, as_of=None) -> DataFrame:
    """Books none of whose copies was ever lent (NOT IN with SQL's NULL
    rules, planned as an anti join)."""
    lent = t["book_copies"].join(t["loans"].select("copy_id"), "copy_id").select("book_id")
    b = joins.not_in(t["books"], "book_id", lent, "book_id").join(t["authors"], "author_id")
    return b.select("book_id", "title", "author_name", "genre", "total_copies")


def all_book_clubs(t: Tables, as_of=None, event_type: str = "book_club") -> DataFrame:
    """Members registered for every event of a type (relational division)."""
    ev = t["events"].where(F.col("event_type") == event_type)
    regs = t["event_registrations"].join(ev.select("event_id"), "event_id")
    div = aggs.relational_division(regs, ["member_id"], "event_id", ev, "event_id", "events_attended")
    out = div.join(t["members"], "member_id").select("member_id", "first_name", "last_name", "events_attended")
    return topk.sort(out, ["first_name", "last_name", "member_id"])


# Membership fee per type.
MEMBERSHIP_FEES = (("standard", 20), ("premium", 50), ("student", 10))


def monthly_revenue(t: Tables, as_of=None, k: int = 12) -> DataFrame:
    """Paid fines by payment month full-outer-joined with membership fees by
    join month; newest k months. Rows with NULL year/month (members with no
    join date) stay separate, as the UNION form keeps them."""
    f = t["fines"].where((F.col("paid") == True) & F.col("payment_date").isNotNull())  # noqa: E712
    fr = f.groupBy(F.year("payment_date").alias("year"), F.month("payment_date").alias("month")) \
        .agg(F.sum("fine_amount").alias("total_fines"))
    fee = None
    for typ, amount in MEMBERSHIP_FEES:
        cond = F.col("membership_type") == typ
        fee = F.when(cond, F.lit(amount)) if fee is None else fee.when(cond, F.lit(amount))
    fee = fee.otherwise(F.lit(0))
    mr = t["members"].groupBy(F.year("join_date").alias("year"), F.month("join_date").alias("month")) \
        .agg(F.sum(fee).alias("total_membership"))
    j = joins.full_outer_coalesce(fr, mr, ["year", "month"])
    fines = F.coalesce("total_fines", F.lit(0))
    mem = F.coalesce("total_membership", F.lit(0))
    out = j.select("year", "month", fines.alias("fine_revenue"), mem.alias("membership_revenue"),
                   (fines + mem).alias("total_revenue"))
    return topk.top_k(out, [F.desc_nulls_last("year"), F.desc_nulls_last("month")], k)


def latest_loan_per_book(t: Tables, as_of=None) -> DataFrame:
    """Lent books with their latest loan date and its borrower (tie on the
    date: highest loan_id), via ``max_by`` instead of a correlated
    ORDER BY ... LIMIT 1."""
    lc = t["loans"].join(t["book_copies"].select("copy_id", "book_id"), "copy_id")
    last = windows.first_per_group(lc, ["book_id"], ["loan_date", "loan_id"], ["loan_date", "member_id"])
    j = (t["books"].join(t["authors"], "author_id").join(last, "book_id")
         .join(t["members"].select("member_id", "first_name", "last_name"), "member_id"))
    out = j.select("book_id", "title", "author_name", F.col("loan_date").alias("most_recent_loan_date"),
                   full_name("first_name", "last_name").alias("borrower_name"))
    return topk.sort(out, [F.desc("most_recent_loan_date"), "book_id"])


def recommendations(t: Tables, as_of=None, k: int = 5) -> DataFrame:
    """Books of each member's favourite genre(s) they never borrowed; first
    k overall by member and title (the LIMIT is global, not per member)."""
    bought = t["loans"].join(t["book_copies"].select("copy_id", "book_id"), "copy_id") \
        .select("member_id", F.col("book_id").alias("item_id"))
    items = t["books"].select(F.col("book_id").alias("item_id"), "genre", "title")
    rec = jobs.recommend(bought, items, per_member=k)
    rec = topk.top_k(rec, ["member_id", "title", "item_id"], k)
    out = rec.join(t["members"].select("member_id", "first_name", "last_name"), "member_id")
    return topk.sort(out.select("member_id", "first_name", "last_name", "genre", "title",
                                F.col("item_id").alias("book_id")), ["member_id", "title", "book_id"])


# ---------------------------------------------------------------- Q7 set operations
def people_directory(t: Tables, as_of=None) -> DataFrame:
    m = t["members"].select(F.col("member_id").alias("id"), full_name("first_name", "last_name").alias("name"),
                            "email", F.lit("Member").alias("type"))
    a = t["authors"].select(F.col("author_id").alias("id"), F.col("author_name").alias("name"),
                            sets.typed_null("email"), F.lit("Author").alias("type"))
    return topk.sort(sets.union_all(m, a), ["type", "name", "id"])


def activity_feed(t: Tables, as_of=None, k: int = 50) -> DataFrame:
    """The latest k loans, events and registrations. Events need no partner,
    so k of them bound the feed: a row dated before the k-th latest event
    can't be in it. Such rows of the other branches stay out of the joins;
    with fewer than k events all go through them. If few rows are left, the
    tables they refer to are not shuffled for them."""
    dates = t["events"].select("event_date").where(F.col("event_date").isNotNull())
    last = topk.top_k(dates, [F.desc("event_date")], k)
    bound = last.select(F.when(F.count(F.lit(1)) >= k, F.min("event_date")).alias("bound")).scalar()
    t = {**t, **{name: t[name].where(F.coalesce(F.col(date) >= bound, bound.isNull()))
                 for name, date in (("loans", "loan_date"), ("event_registrations", "registration_date"))}}
    loans = _loan_chain(t, _marked(t["loans"])).select(F.lit("Loan").alias("activity_type"), F.col("loan_date").alias("activity_date"),
                                  F.col("title").alias("description"))
    events = t["events"].select(F.lit("Event").alias("activity_type"), F.col("event_date").alias("activity_date"),
                                F.col("event_name").alias("description"))
    mark = _marked(t["event_registrations"])
    regs = (mark(mark(t["event_registrations"]).join(t["members"].select("member_id"), "member_id"))
            .join(t["events"], "event_id")
            .select(F.lit("Registration").alias("activity_type"),
                    F.col("registration_date").alias("activity_date"), F.col("event_name").alias("description")))
    return topk.top_k(sets.union_all(loans, events, regs),
                      [F.desc("activity_date"), "activity_type", "description"], k)


def available_vs_on_loan(t: Tables, as_of=None) -> DataFrame:
    """Per book: copies not on an active loan ('Available'; lost copies
    count as available) and copies on one ('On Loan'). ``book_id`` is kept
    through the UNION so books sharing a title do not collapse."""
    active = t["loans"].where(F.col("status") == "active")
    avail = (joins.not_in(t["book_copies"], "copy_id", active, "copy_id").join(t["books"], "book_id")
             .groupBy("book_id", "title").agg(F.count(F.lit(1)).alias("count"))
             .withColumn("status", F.lit("Available")))
    onloan = (active.join(t["book_copies"], "copy_id").join(t["books"], "book_id")
              .groupBy("book_id", "title").agg(F.count(F.lit(1)).alias("count"))
              .withColumn("status", F.lit("On Loan")))
    cols = ["book_id", "title", "status", "count"]
    return topk.sort(sets.union_all(avail.select(*cols), onloan.select(*cols)), ["title", "status", "book_id"])


def members_with_issues(t: Tables, as_of) -> DataFrame:
    m = t["members"].select("member_id", "first_name", "last_name", "email", F.col("status").alias("m_status"))
    name = full_name("first_name", "last_name").alias("member_name")
    od = t["loans"].where((F.col("status") == "active") & (F.col("due_date") < _d(as_of)))
    a = (m.join(od, "member_id").groupBy("member_id", "first_name", "last_name", "email")
          .agg(F.count(F.lit(1)).alias("issue_count")).withColumn("issue", F.lit("Overdue")))
    fl = t["loans"].select("loan_id", "member_id").join(t["fines"].where(F.col("paid") == False), "loan_id")  # noqa: E712
    b = (m.join(fl, "member_id").groupBy("member_id", "first_name", "last_name", "email")
          .agg(F.count(F.lit(1)).alias("issue_count")).withColumn("issue", F.lit("Unpaid Fines")))
    s = (m.where(F.col("m_status") == "suspended")
          .select("member_id", "first_name", "last_name", "email", F.lit(1).cast("long").alias("issue_count"),
                  F.lit("Suspended").alias("issue")))
    cols = ["member_id", name, "email", "issue", "issue_count"]
    u = sets.union_all(a.select(*cols), b.select(*cols), s.select(*cols))
    return topk.sort(u, ["member_name", "issue", "member_id"])


def popular_unpopular(t: Tables, as_of=None, k: int = 10) -> DataFrame:
    """k most and k least lent books (inner joins: never-lent books are in
    neither list); ties at each cut broken by book_id."""
    lent = _book_loan_totals(t).select("book_id", F.col("total_loans").alias("loan_count"))
    named = t["books"].join(t["authors"], "author_id").select("book_id", "title", F.col("author_name").alias("author"))
    counts = lent.join(named, "book_id").select("book_id", "title", "author", "loan_count")
    out = topk.top_and_bottom(counts, "loan_count", ["book_id"], k, "category", "Popular", "Unpopular")
    return topk.sort(out, ["category", "loan_count", "book_id"])


# ---------------------------------------------------------------- Q8 windows
def rank_members(t: Tables, as_of=None) -> DataFrame:
    """RANK and DENSE_RANK by loan count (scale form: no single-partition
    window)."""
    per = t["members"].select("member_id", "first_name", "last_name") \
        .join(t["loans"].select("member_id", "loan_id"), "member_id") \
        .groupBy("member_id", "first_name", "last_name").agg(F.count("loan_id").alias("total_loans"))
    # distinct loan counts are at most sqrt(2 * loans): bounded histogram
    r = windows.global_ranks(per, "total_loans", ascending=False, rank="rank_num", dense_rank="dense_rank_num",
                             bounded_keys=True)
    return topk.sort(r.select("rank_num", "dense_rank_num", "member_id", "first_name", "last_name",
                              "total_loans"), [F.desc("total_loans"), "member_id"])


def running_fines(t: Tables, as_of=None) -> DataFrame:
    """Running total of paid fines by payment date; fines paid on one date
    share the total (RANGE frame)."""
    f = t["fines"].where(F.col("paid") == True).select("fine_id", "payment_date", "fine_amount")  # noqa: E712
    r = windows.running_total(f, "payment_date", "fine_amount", "running_total", bounded_keys=True)  # days
    return topk.sort(r, ["payment_date", "fine_id"])


def top_books_per_genre(t: Tables, as_of=None, n: int = 3) -> DataFrame:
    j = (t["books"].select("book_id", "genre", "title")
         .join(t["book_copies"].select("book_id", "copy_id"), "book_id", "left")
         .join(t["loans"].select("copy_id", "loan_id"), "copy_id", "left"))
    per = j.groupBy("book_id", "genre", "title").agg(F.count("loan_id").alias("loans"))
    r = windows.top_n_within(per, ["genre"], [F.desc("loans")], n, name="genre_rank")
    return topk.sort(r, ["genre", "genre_rank", "book_id"])


def monthly_change(t: Tables, as_of=None) -> DataFrame:
    """Loans per member and month with the previous row's count and the
    change (previous active month, gaps not filled)."""
    m = t["loans"].groupBy("member_id", F.year("loan_date").alias("year"), F.month("loan_date").alias("month")) \
        .agg(F.count(F.lit(1)).alias("loans_this_month"))
    # one row per member and calendar month: groups cannot grow with the
    # data, so the plain partitioned window is safe
    l = windows.lag_columns(m, ["member_id"], ["year", "month"], ["loans_this_month"], prefix="prev_",
                            method="window")
    out = l.select("member_id", "year", "month", "loans_this_month",
                   F.col("prev_loans_this_month").alias("previous_month_loans"),
                   (F.col("loans_this_month") - F.col("prev_loans_this_month")).alias("change"))
    return topk.sort(out, ["member_id", "year", "month"])


def next_event_per_member(t: Tables, as_of) -> DataFrame:
    """Each member's first event from ``as_of`` on (tie: lowest event_id)."""
    j = t["event_registrations"].join(t["events"].where(F.col("event_date") >= _d(as_of)), "event_id")
    first = windows.first_per_group(j, ["member_id"], ["event_date", "event_id"],
                                    ["event_name", "event_date", "event_id"], latest=False)
    out = first.join(t["members"].select("member_id", "first_name", "last_name"), "member_id")
    return topk.sort(out.select("member_id", "first_name", "last_name",
                                F.col("event_name").alias("next_event_name"), "event_date"),
                     ["event_date", "member_id"])


def moving_average_loans(t: Tables, as_of=None, k: int = 30) -> DataFrame:
    """Loans per day with the average over the last 7 rows (days with loans,
    not calendar days); newest k days."""
    daily = t["loans"].groupBy(F.col("loan_date").alias("loan_day")).agg(F.count("loan_id").alias("loans_that_day"))
    # one row per calendar day (bounded by the calendar, not the data): the
    # plain ROWS window is fine; ``windows.moving_average_rows`` is the form
    # for unbounded inputs
    w = Window.orderBy("loan_day").rowsBetween(-6, 0)
    ma = daily.withColumn("seven_day_moving_avg", F.avg("loans_that_day").over(w))
    return topk.top_k(ma, [F.desc("loan_day")], k)


def fine_percentiles(t: Tables, as_of=None) -> DataFrame:
    """PERCENT_RANK of unpaid fines by amount, x100, 2 decimals."""
    f = t["fines"].where(F.col("paid") == False)  # noqa: E712
    r = windows.global_ranks(f, "fine_amount", ascending=True, rank="_r")
    n = aggs.total_count(f)
    pr = F.when(n > 1, pct_exact(F.col("_r") - 1, n - 1)).otherwise(F.lit(0.0))
    j = r.join(t["loans"].select("loan_id", "member_id"), "loan_id") \
        .join(t["members"].select("member_id", "first_name", "last_name"), "member_id")
    out = j.select("fine_id", "first_name", "last_name", "fine_amount", pr.alias("percentile_rank_pct"))
    return topk.sort(out, [F.desc("percentile_rank_pct"), "fine_id"])


def loan_gaps(t: Tables, as_of=None) -> DataFrame:
    j = t["members"].select("member_id", "first_name", "last_name") \
        .join(t["loans"].select("loan_id", "member_id", "loan_date"), "member_id")
    l = windows.lag_columns(j, ["member_id"], ["loan_date", "loan_id"], ["loan_date"], prefix="previous_")
    out = l.select("member_id", "loan_id", "first_name", "last_name", "loan_date",
                   F.col("previous_loan_date"),
                   F.datediff("loan_date", "previous_loan_date").alias("days_gap"))
    return topk.sort(out, ["last_name", "loan_date", "loan_id"])


# ---------------------------------------------------------------- Q9 / Q11
def active_loan_late_days(t: Tables, as_of) -> DataFrame:
    """The late-days function applied to active loans against ``as_of``."""
    j = t["loans"].where(F.col("status") == "active").join(t["book_copies"], "copy_id").join(t["books"], "book_id")
    return j.select("loan_id", "title", late_days("due_date", _d(as_of)).alias("days_overdue"))


def loans_per_book(t: Tables, as_of=None) -> DataFrame:
    named = t["books"].join(t["authors"], "author_id").select("book_id", "title", "author_name")
    g = named.join(_book_loan_totals(t).select("book_id", F.col("total_loans").alias("loan_count")), "book_id")
    return topk.sort(g, [F.desc("loan_count"), "book_id"])


def book_totals_correlated(t: Tables, as_of=None) -> DataFrame:
    """Correlated COUNT subqueries, decorrelated: one grouped aggregate,
    left-joined; books without loans get 0."""
    j = t["books"].select("book_id", "title").join(_book_loan_totals(t), "book_id", "left")
    return j.select("book_id", "title", F.coalesce("total_loans", F.lit(0)).alias("total_loans"),
                    F.coalesce("active_loans", F.lit(0)).alias("active_loans"))


def book_totals_joins(t: Tables, as_of=None) -> DataFrame:
    j = (t["books"].select("book_id", "title")
         .join(t["book_copies"].select("book_id", "copy_id"), "book_id", "left")
         .join(t["loans"].select("copy_id", "loan_id", "status"), "copy_id", "left"))
    return j.groupBy("book_id", "title").agg(
        F.count("loan_id").alias("total_loans"),
        F.sum(F.when(F.col("status") == "active", 1).otherwise(0)).cast("long").alias("active_loans"))


def active_loans_per_member(t: Tables, as_of=None) -> DataFrame:
    j = t["members"].select("member_id", "first_name", "last_name") \
        .join(t["loans"].where(F.col("status") == "active").select("member_id"), "member_id")
    return j.groupBy("member_id", "first_name", "last_name").agg(F.count(F.lit(1)).alias("loan_count"))


def overdue_scan(t: Tables, as_of) -> DataFrame:
    """SELECT * of active loans past due (filters reach the Parquet scan)."""
    return t["loans"].where((F.col("status") == "active") & (F.col("due_date") < _d(as_of)))


CATALOGUE = {
    "Q3.1": active_members, "Q3.2": books_after, "Q3.3": books_in_genre, "Q3.4": overdue_loans,
    "Q3.5": recent_members, "Q3.6": worn_copies, "Q3.7": top_unpaid_fines, "Q3.8": upcoming_events,
    "Q4.1": members_by_type, "Q4.2": fines_by_paid, "Q4.3": top_genres, "Q4.4": loan_days_by_type,
    "Q4.5": books_with_unlent_copy, "Q4.6": member_activity, "Q4.7": monthly_loans, "Q4.8": event_fill,
    "Q5.1": loan_history, "Q5.2": copies_on_loan, "Q5.3": overdue_or_fined, "Q5.4": book_availability,
    "Q5.5": attendance_list, "Q5.6": author_popularity, "Q5.7": never_borrowed, "Q5.8": shared_address,
    "Q6.1": above_average_debtors, "Q6.2": above_average_books, "Q6.3": member_summary,
    "Q6.4": never_loaned_books, "Q6.5": all_book_clubs, "Q6.6": monthly_revenue,
    "Q6.7": latest_loan_per_book, "Q6.8": recommendations,
    "Q7.1": people_directory, "Q7.2": activity_feed, "Q7.3": available_vs_on_loan,
    "Q7.4": members_with_issues, "Q7.5": popular_unpopular,
    "Q8.1": rank_members, "Q8.2": running_fines, "Q8.3": top_books_per_genre, "Q8.4": monthly_change,
    "Q8.5": next_event_per_member, "Q8.6": moving_average_loans, "Q8.7": fine_percentiles,
    "Q8.8": loan_gaps, "Q9.3": active_loan_late_days, "Q11.1": loans_per_book,
    "Q11.2": book_totals_correlated, "Q11.3": book_totals_joins, "Q11.4": active_loans_per_member,
    "Q11.5": overdue_scan,
}
