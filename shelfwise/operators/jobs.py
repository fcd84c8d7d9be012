"""Data-change jobs: the lending rules, usually run one row per
call (procedures, triggers, transactions), as set-based DataFrame jobs over
a table of requests.

Every job returns new or changed rows plus an ``outcome`` column per
request instead of OUT parameters. A batch equals running its requests one
by one in request order: contention for one copy or one member is settled by
an aggregate (``min_by``) or by positions from ``with_position``, both of
which split a hot key across tasks. Nothing is written in place; callers
write new table versions (``shelfwise.sources``).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.session import materialize
from shelfwise.functions.exprs import FINE_PER_DAY, LOAN_DAYS, fine_amount, has_bit
from shelfwise.operators.windows import first_per_group, top_n_within, with_position
from shelfwise.sources.append import assign_ids

# Outcome messages.
MSG_NO_MEMBER = "Member does not exist."
MSG_NOT_ACTIVE = "Member is not active."
MSG_ON_LOAN = "Book copy is already on loan."
MSG_CHECKED_OUT = "Book checked out successfully. Due on "
MSG_INVALID_LOAN = "Invalid or inactive loan."
MSG_RETURNED_FINE = "Book returned. Fine: $"
MSG_RETURNED_OK = "Book returned on time. No fine."
MSG_LOAN_BLOCKED = "Cannot create loan: Member is not active"
MSG_DELETE_BLOCKED = "Cannot delete book: Active loans exist"
MSG_UNKNOWN_MEMBER = "Unknown member"
MSG_NO_FREE_COPY = "No free copy"
MSG_QUOTA = "Too many active loans"
# Audit texts.
DESC_CHECKED_OUT = "Book checked out"
DESC_FINE_PAID = "Fine paid"
DESC_BATCH_RETURN = "Batch return for member "
DESC_MEMBER = "Member {first} {last} updated. Status: {old} -> {new}"


def _lit_date(d) -> Column:
    return F.lit(dt.date.fromisoformat(d) if isinstance(d, str) else d)


def _active_copies(loans: DataFrame) -> DataFrame:
    return loans.where(F.col("status") == "active").select("copy_id").distinct()


# ---------------------------------------------------------------- C1 checkout
def apply_checkouts(requests: DataFrame, members: DataFrame, loans: DataFrame, as_of,
                    loan_days: int = LOAN_DAYS, order_cols=("request_id",)) -> DataFrame:
    """Checkout requests (request_id, member_id, copy_id, ...).

    Reasons in order: member missing, member not active, copy on an active
    loan, else checked out with due date ``as_of + loan_days``. Requests for
    one copy in one batch: the first eligible request (by ``order_cols``)
    wins; later ones find the copy on loan. Copy existence is not checked
    (the foreign key does that, see ``quality.check_fk``); a copy whose last
    loan is ``lost`` is lendable, since only ``active`` blocks.
    """
    m = members.select("member_id", F.col("status").alias("_m_status"), F.lit(True).alias("_m_found"))
    held = _active_copies(loans).withColumn("_held", F.lit(True))
    base = requests.join(m, "member_id", "left").join(held, "copy_id", "left")
    reason = (F.when(F.col("_m_found").isNull(), F.lit(MSG_NO_MEMBER))
               .when(F.col("_m_status") != "active", F.lit(MSG_NOT_ACTIVE))
               .when(F.col("_held"), F.lit(MSG_ON_LOAN)))
    base = base.withColumn("_reason", reason)
    winners = first_per_group(base.where(F.col("_reason").isNull()), ["copy_id"],
                              list(order_cols), ["request_id"], latest=False) \
        .select(F.col("request_id").alias("_win"))
    out = base.join(winners, F.col("request_id") == F.col("_win"), "left")
    due = F.date_add(_lit_date(as_of), loan_days)
    ok = F.col("_win").isNotNull()
    return (out.withColumn("accepted", ok)
               .withColumn("loan_date", F.when(ok, _lit_date(as_of)))
               .withColumn("due_date", F.when(ok, due))
               .withColumn("outcome", F.coalesce(
                   F.col("_reason"),
                   F.when(ok, F.concat(F.lit(MSG_CHECKED_OUT), due.cast("string")))
                    .otherwise(F.lit(MSG_ON_LOAN))))
               .drop("_m_status", "_m_found", "_held", "_reason", "_win"))


def new_loans_from(outcomes: DataFrame) -> DataFrame:
    """Loan rows (without ids) for accepted checkout requests."""
    return outcomes.where("accepted").select(
        "member_id", "copy_id", "loan_date", "due_date",
        F.lit(None).cast("date").alias("return_date"), F.lit("active").alias("status"))


# ---------------------------------------------------------------- C5 / C6
def fill_due_date(loans: DataFrame, days: int = LOAN_DAYS) -> DataFrame:
    """Default due date: loan date + ``days`` when missing."""
    return loans.withColumn("due_date", F.coalesce("due_date", F.date_add("loan_date", days)))


def fines_for_returns(old: DataFrame, new: DataFrame, rate: Decimal = FINE_PER_DAY) -> DataFrame:
    """Fine rows for loans whose status went active -> returned between two
    snapshots: ``(return_date - due_date) * rate`` when positive."""
    o = old.select("loan_id", F.col("status").alias("_old_status"))
    j = new.join(o, "loan_id").where((F.col("_old_status") == "active") & (F.col("status") == "returned"))
    days = F.datediff("return_date", "due_date")
    return (j.where(days > 0)
             .select("loan_id", fine_amount(days, rate).alias("fine_amount"),
                     F.lit("overdue").alias("fine_reason"), F.lit(False).alias("paid"),
                     F.lit(None).cast("date").alias("payment_date")))


# ---------------------------------------------------------------- C2 return
def apply_returns(requests: DataFrame, loans: DataFrame, as_of, order_cols=("request_id",),
                  cut_lineage: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return requests (request_id, loan_id). Returns (outcomes, loans after
    the batch, new fines). A loan that is not active is rejected; repeated
    requests for one loan: the first wins, later ones find it returned.
    Fines come from ``fines_for_returns`` (charged once)."""
    active = loans.where(F.col("status") == "active").select("loan_id", "due_date")
    first = first_per_group(requests.join(active.select("loan_id"), "loan_id", "left_semi"),
                            ["loan_id"], list(order_cols), ["request_id"], latest=False) \
        .select(F.col("request_id").alias("_win"))
    out = requests.join(first, F.col("request_id") == F.col("_win"), "left") \
                  .join(active, "loan_id", "left")
    ok = F.col("_win").isNotNull()
    days = F.datediff(_lit_date(as_of), F.col("due_date"))
    fine = fine_amount(days)
    outcomes = (out.withColumn("accepted", ok)
                   .withColumn("fine_amount", F.when(ok, F.coalesce(fine, F.lit(Decimal("0.00")).cast("decimal(10,2)"))))
                   .withColumn("outcome", F.when(~ok, F.lit(MSG_INVALID_LOAN))
                               .when(days > 0, F.concat(F.lit(MSG_RETURNED_FINE), fine.cast("string")))
                               .otherwise(F.lit(MSG_RETURNED_OK)))
                   .drop("_win", "due_date"))
    if cut_lineage:  # outcomes feed the new loans and, through them, the fines
        outcomes = materialize(outcomes)
    returned = outcomes.where("accepted").select("loan_id", F.lit(True).alias("_ret"))
    new_loans = (loans.join(returned, "loan_id", "left")
                      .withColumn("return_date", F.when(F.col("_ret"), _lit_date(as_of)).otherwise(F.col("return_date")))
                      .withColumn("status", F.when(F.col("_ret"), F.lit("returned")).otherwise(F.col("status")))
                      .drop("_ret").select(*loans.columns))
    return outcomes, new_loans, fines_for_returns(loans, new_loans)


# ---------------------------------------------------------------- C3 audit
def audit_changes(old: DataFrame, new: DataFrame, key: str, cols, as_of_ts,
                  table_name: str = "members") -> DataFrame:
    """Audit rows for keys whose ``cols`` differ (NULL-safe) between two
    snapshots. A snapshot diff cannot see updates that change nothing."""
    o = old.select(key, *[F.col(c).alias(f"old_{c}") for c in old.columns if c != key])
    n = new.select(key, *[F.col(c).alias(f"new_{c}") for c in new.columns if c != key])
    j = o.join(n, key)
    changed = None
    for c in cols:
        d = ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        changed = d if changed is None else (changed | d)
    parts = {"first": "old_first_name", "last": "old_last_name", "old": "old_status", "new": "new_status"}
    desc = F.format_string(DESC_MEMBER.format(**{k: "%s" for k in parts}), *parts.values()) \
        if {"first_name", "last_name", "status"} <= set(old.columns) else F.lit("Row updated")
    return j.where(changed).select(
        F.lit(table_name).alias("table_name"), F.lit("UPDATE").alias("action"),
        F.col(key).alias("record_id"), F.lit(as_of_ts).cast("timestamp").alias("changed_at"),
        F.lit("SYSTEM").alias("changed_by"), desc.alias("description"))


# ---------------------------------------------------------------- C4 guard
def split_admissible(new_loans: DataFrame, members: DataFrame) -> DataFrame:
    """New loan rows with a ``rejection`` column (NULL = admitted). A member
    whose status is not 'active' is rejected; an unknown member is reported
    separately (the guard alone would let it pass; the foreign key stops
    it); a member with NULL status passes, as the guard's comparison is
    NULL."""
    m = members.select("member_id", F.col("status").alias("_m_status"), F.lit(True).alias("_m_found"))
    j = new_loans.join(m, "member_id", "left")
    rej = (F.when(F.col("_m_found").isNull(), F.lit(MSG_UNKNOWN_MEMBER))
            .when(F.col("_m_status") != "active", F.lit(MSG_LOAN_BLOCKED)))
    return j.withColumn("rejection", rej).drop("_m_status", "_m_found")


# ---------------------------------------------------------------- C7 / C8 deletes
def guard_book_delete(book_ids: DataFrame, copies: DataFrame, loans: DataFrame,
                      strict: bool = False) -> DataFrame:
    """(book_id, allowed, reason): a book with an active loan on any copy may
    not be deleted. ``strict=True`` also blocks books with any past loan,
    which the RESTRICT key from loans to copies would stop anyway."""
    l = loans if strict else loans.where(F.col("status") == "active")
    busy = copies.join(l.select("copy_id"), "copy_id", "left_semi").select("book_id").distinct() \
        .withColumn("_busy", F.lit(True))
    j = book_ids.select("book_id").join(busy, "book_id", "left")
    return j.select("book_id", F.col("_busy").isNull().alias("allowed"),
                    F.when(F.col("_busy"), F.lit(MSG_DELETE_BLOCKED)).alias("reason"))


#: ids in at most so many buckets are a broadcast bitmap (4 KB a bucket); beyond that they are joined as they are
BROADCAST_BUCKETS = 4096


def _id_bitmap(ids: DataFrame) -> DataFrame:
    """The ids (one integral column), written once: as bitmaps of 32,768 ids
    if few buckets hold them all, else as distinct ids. Sparse ids (a copy's
    holds two keys) would take a bitmap each."""
    c = F.col(ids.columns[0]).cast("long")
    kept = materialize(ids.where(c.isNotNull()).select(c.alias("_id")).distinct())
    bucket = F.bitmap_bucket_number("_id").alias("_bucket")
    if kept.select(bucket).distinct().limit(BROADCAST_BUCKETS + 1).count() > BROADCAST_BUCKETS:
        return kept
    return F.broadcast(materialize(kept.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))))


def _flagged(df: DataFrame, col: str, bitmap: DataFrame, flag: str) -> DataFrame:
    """``df`` with a boolean: is the id in ``col`` among those of
    ``_id_bitmap`` (NULL: no)."""
    c = F.col(col).cast("long")
    if "_id" in bitmap.columns:
        ids = bitmap.select(F.col("_id").alias(f"{flag}_id"))
        return df.join(ids, c == F.col(f"{flag}_id"), "left").withColumn(flag, F.col(f"{flag}_id").isNotNull()).drop(f"{flag}_id")
    bits = bitmap.select(F.col("_bucket").alias(f"{flag}_bucket"), F.col("_bits").alias(f"{flag}_bits"))
    j = df.join(bits, F.bitmap_bucket_number(c) == F.col(f"{flag}_bucket"), "left")
    hit = F.coalesce(has_bit(f"{flag}_bits", F.bitmap_bit_position(c)), F.lit(False))
    return j.withColumn(flag, hit).drop(f"{flag}_bucket", f"{flag}_bits")


def _parents_first(table: str, edges) -> list[str]:
    """``table`` and the tables that deletions in it can reach, each after
    those it can be reached from. Walks the schema (9 tables), not the data."""
    reached, todo = {table}, [table]
    while todo:
        at = todo.pop()
        new = {child for child, _, par, _, rule in edges if par == at and rule == "cascade"} - reached
        reached |= new
        todo += new
    order = []
    while len(order) < len(reached):
        ready = sorted(t for t in reached - set(order)
                       if all(par in order for child, _, par, _, rule in edges if child == t and par in reached and rule == "cascade"))
        if not ready:
            raise ValueError(f"cascading keys run in a circle: {sorted(reached - set(order))}")
        order += ready
    if mine := [child for child, _, par, _, _ in edges if child == par and child in order and child != table]:
        raise ValueError(f"rows of {mine} refer to each other: delete from them first")
    return order


def cascade_delete(tables: dict[str, DataFrame], table: str, ids: DataFrame,
                   edges=schemas.FOREIGN_KEYS, keys=schemas.PRIMARY_KEYS):
    """Delete ``ids`` (one column: the primary key) from ``table`` and follow
    ON DELETE CASCADE edges. Returns (tables after the delete, violations):
    violations are child rows that a RESTRICT edge protects; when there are
    any, the caller keeps the old version (the statement fails as a whole).

    Deleted ids are bitmaps (``_id_bitmap``). Each table that refers to a deleted one is read
    once, for its key and foreign keys, whatever number of edges leads to it;
    its rows that refer to deleted ids are written once and give its own
    bitmap and the violations. Ids must be integral; NULL ids delete nothing.
    """
    order = _parents_first(table, edges)
    bitmaps = {table: _id_bitmap(ids.select(F.col(ids.columns[0])))}
    protected = sorted({child for child, _, par, _, rule in edges if rule == "restrict" and par in order} - set(order))
    violations = []
    for child in [*order, *protected]:
        into = [(fk, par, rule) for c, fk, par, _, rule in edges if c == child and par in bitmaps]
        pk = keys[child][0]
        if not into:
            continue
        refs = tables[child].select(F.col(pk).cast("long").alias("row_id"), *[F.col(fk).alias(f"_fk{i}") for i, (fk, _, _) in enumerate(into)])
        gone = F.lit(False)
        for i, (_, par, rule) in enumerate(into):
            refs = _flagged(refs, f"_fk{i}", bitmaps[par], f"_in{i}")
            gone = gone | F.col(f"_in{i}") if rule == "cascade" else gone
        if child == table:  # given ids and those a key of its own children leads back to
            refs = _flagged(refs, "row_id", bitmaps[table], "_given")
            gone = gone | F.col("_given")
        hit = F.lit(False)
        for i in range(len(into)):
            hit = hit | F.col(f"_in{i}")
        rows = materialize(refs.withColumn("_gone", gone).where(hit | F.col("_gone")).drop(*[f"_fk{i}" for i in range(len(into))]))
        if child in order and child != table:
            bitmaps[child] = _id_bitmap(rows.where("_gone").select("row_id"))
        for i, (fk, _, rule) in enumerate(into):
            if rule == "restrict":
                violations.append(rows.where(F.col(f"_in{i}") & ~F.col("_gone")).select(F.lit(child).alias("table_name"), F.lit(fk).alias("column"), "row_id"))
    out = {name: (_flagged(df, keys[name][0], bitmaps[name], "_gone").where("NOT _gone").drop("_gone") if name in bitmaps else df)
           for name, df in tables.items()}
    viol = violations[0] if violations else ids.sparkSession.createDataFrame([], "table_name string, `column` string, row_id long")
    for v in violations[1:]:
        viol = viol.unionByName(v)
    return out, viol


# ---------------------------------------------------------------- C9 / C10
def allocate_copies(requests: DataFrame, copies: DataFrame, loans: DataFrame,
                    order_cols=("request_id",)) -> DataFrame:
    """Requests (request_id, member_id, book_id) get a free copy of the book:
    free copies (no active loan) numbered by copy_id are matched to
    requests numbered in request order, per book. No free copy -> NULL
    copy_id and ``accepted`` false."""
    free = copies.join(_active_copies(loans), "copy_id", "left_anti").select("book_id", "copy_id")
    free = with_position(free, ["copy_id"], ["book_id"], name="_n")
    req = with_position(requests, list(order_cols), ["book_id"], name="_n")
    j = req.join(free, ["book_id", "_n"], "left").drop("_n")
    return j.withColumn("accepted", F.col("copy_id").isNotNull()) \
            .withColumn("outcome", F.when(F.col("copy_id").isNull(), F.lit(MSG_NO_FREE_COPY)))


def checkout_and_log(requests: DataFrame, copies: DataFrame, loans: DataFrame, members: DataFrame, as_of,
                     loan_days: int = LOAN_DAYS, order_cols=("request_id",), cut_lineage: bool = True):
    """Admit the member, allocate a copy, create the loan and its audit row,
    per request. Requests of unknown or inactive members (``split_admissible``)
    take no copy. Returns (outcomes, new loans with ids, audit rows)."""
    guarded = split_admissible(requests, members)
    if cut_lineage:
        guarded = materialize(guarded)
    alloc = allocate_copies(guarded.where("rejection is null").drop("rejection"), copies, loans, order_cols)
    refused = guarded.where("rejection is not null").select(
        *requests.columns, F.lit(None).cast(copies.schema["copy_id"].dataType).alias("copy_id"), F.lit(False).alias("accepted"),
        F.col("rejection").alias("outcome"))
    outcomes = alloc.select(*requests.columns, "copy_id", "accepted", "outcome").unionByName(refused)
    start = loans.select(F.coalesce(F.max("loan_id"), F.lit(0)) + 1).scalar()
    new = alloc.where("accepted").select(
        "request_id", "member_id", "copy_id", _lit_date(as_of).alias("loan_date"),
        F.date_add(_lit_date(as_of), loan_days).alias("due_date"),
        F.lit(None).cast("date").alias("return_date"), F.lit("active").alias("status"))
    new = assign_ids(new, ["request_id"], "loan_id", start=start)
    if cut_lineage:  # loan rows and their audit rows must carry the same ids
        new = materialize(new)
    audit = new.select(F.lit("loans").alias("table_name"), F.lit("INSERT").alias("action"),
                       F.col("loan_id").alias("record_id"), F.lit(DESC_CHECKED_OUT).alias("description"))
    return outcomes, new, audit


# ---------------------------------------------------------------- C11
def settle_fines(payment_ids: DataFrame, fines: DataFrame, loans: DataFrame, members: DataFrame,
                 as_of, only_suspended: bool = False, cut_lineage: bool = True):
    """Mark fines paid, then set members of those fines who have no unpaid
    fine left (after the payments) to 'active'. Returns (fines, members,
    audit rows). Without ``only_suspended`` an expired member is
    reactivated too, as the literal rule does."""
    pay = payment_ids.select(F.col(payment_ids.columns[0]).alias("fine_id")).distinct() \
        .withColumn("_pay", F.lit(True))
    f = fines.join(pay, "fine_id", "left")
    new_fines = (f.withColumn("paid", F.when(F.col("_pay"), F.lit(True)).otherwise(F.col("paid")))
                  .withColumn("payment_date", F.when(F.col("_pay"), _lit_date(as_of)).otherwise(F.col("payment_date")))
                  .drop("_pay").select(*fines.columns))
    if cut_lineage:  # the new fines version feeds the reactivation rule
        new_fines = materialize(new_fines)
    owners = fines.join(pay, "fine_id").join(loans.select("loan_id", "member_id"), "loan_id") \
        .select("member_id").distinct()
    still = new_fines.where(F.col("paid") == False).join(loans.select("loan_id", "member_id"), "loan_id") \
        .select("member_id").distinct()  # noqa: E712
    react = owners.join(still, "member_id", "left_anti").withColumn("_react", F.lit(True))
    m = members.join(react, "member_id", "left")
    cond = F.col("_react") & ((F.col("status") == "suspended") if only_suspended else F.lit(True))
    new_members = m.withColumn("status", F.when(cond, F.lit("active")).otherwise(F.col("status"))) \
        .drop("_react").select(*members.columns)
    audit = pay.select(F.lit("fines").alias("table_name"), F.lit("UPDATE").alias("action"),
                       F.col("fine_id").alias("record_id"), F.lit(DESC_FINE_PAID).alias("description"))
    return new_fines, new_members, audit


# ---------------------------------------------------------------- C12 quota
def apply_quota(requests: DataFrame, loans: DataFrame, max_active: int = 5,
                order_cols=("request_id",)) -> DataFrame:
    """A request is accepted while the member's active loans plus the
    requests accepted before it stay within ``max_active``. Accepted
    requests are exactly the member's first ``max_active - existing``
    requests, so a position per member decides."""
    existing = loans.where(F.col("status") == "active").groupBy("member_id") \
        .agg(F.count(F.lit(1)).alias("_have"))
    pos = with_position(requests, list(order_cols), ["member_id"], name="_pos")
    j = pos.join(existing, "member_id", "left")
    ok = F.coalesce(F.col("_have"), F.lit(0)) + F.col("_pos") <= max_active
    return (j.withColumn("accepted", ok)
             .withColumn("outcome", F.when(~ok, F.lit(MSG_QUOTA)))
             .drop("_have", "_pos"))


# ---------------------------------------------------------------- C10 with C12
def checkout_within_quota(requests: DataFrame, copies: DataFrame, loans: DataFrame, members: DataFrame, as_of,
                          max_active: int = 5, loan_days: int = LOAN_DAYS, max_rounds: int = 200) -> DataFrame:
    """Requests (request_id, member_id, book_id), unique request_id, served in
    its order: the guard first, then the member's quota, then a free copy (the
    lowest copy_id left). Whoever gets no copy uses up no quota, and whoever
    is over the quota takes no copy, so the two rules depend on each other.
    Returns the requests with copy_id, loan_date, due_date, accepted, outcome.

    Rounds between two bounds: of the requests still possible, those within
    both limits even if all possible ones before them were served are served
    for certain; and what comes after the last certain one of a used-up
    member or book is refused for certain. The earliest undecided request is
    decided in every round, usually most are; it ends when none is left.
    A group's limit is a top-k, cut down before the shuffle, so a hot member
    or book is not gathered in one task."""
    guarded = materialize(split_admissible(requests, members))
    have = loans.where(F.col("status") == "active").groupBy("member_id").agg(F.count(F.lit(1)).alias("_have"))
    free = copies.join(_active_copies(loans), "copy_id", "left_anti").select("book_id", "copy_id")
    limit_b = free.groupBy("book_id").agg(F.count(F.lit(1)).alias("_limit_b"))
    asked = (guarded.where("rejection is null").select("request_id", "member_id", "book_id")
             .join(have, "member_id", "left").join(limit_b, "book_id", "left")
             .select("request_id", "member_id", "book_id", F.greatest(F.lit(0), max_active - F.coalesce("_have", F.lit(0))).alias("_limit_m"),
                     F.coalesce("_limit_b", F.lit(0)).alias("_limit_b")))
    possible = materialize(asked)
    most_b = possible.agg(F.max("_limit_b")).first()[0] or 0

    def first_of(group: str, most: int, limit: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(group).orderBy("request_id"))
        return possible.withColumn("_i", rank).where(F.col("_i") <= most).where(F.col("_i") <= F.col(limit)).select("request_id")

    def used_up(served: DataFrame, group: str, limit: str, name: str) -> DataFrame:
        full = served.groupBy(group, limit).agg(F.count(F.lit(1)).alias("_n"), F.max("request_id").alias(name))
        return full.where(F.col("_n") == F.col(limit)).select(group, name)

    for _ in range(max_rounds):
        within = first_of("member_id", max_active, "_limit_m").join(first_of("book_id", most_b, "_limit_b"), "request_id")
        served = materialize(possible.join(within, "request_id", "left_semi"))
        left = (possible.where("_limit_m > 0 and _limit_b > 0")
                .join(used_up(served, "member_id", "_limit_m", "_last_m"), "member_id", "left")
                .join(used_up(served, "book_id", "_limit_b", "_last_b"), "book_id", "left")
                .where("coalesce(request_id <= _last_m, true) and coalesce(request_id <= _last_b, true)"))
        possible = materialize(left.select(*asked.columns))
        if possible.count() == served.count():
            break
    else:
        raise RuntimeError("the batch did not settle; serve it in smaller ones")

    # a refused request met its member's quota if that was used up before it
    full = used_up(served, "member_id", "_limit_m", "_last_m")
    over = asked.join(full, "member_id", "left").select("request_id", (
        (F.col("_limit_m") == 0) | F.coalesce(F.col("request_id") > F.col("_last_m"), F.lit(False))).alias("_over"))
    numbered = with_position(served.select("request_id", "book_id"), ["request_id"], ["book_id"], name="_n")
    given = numbered.join(with_position(free, ["copy_id"], ["book_id"], name="_n"), ["book_id", "_n"]).select("request_id", "copy_id")
    out = guarded.join(given, "request_id", "left").join(over, "request_id", "left")
    ok = F.col("copy_id").isNotNull()
    due = F.date_add(_lit_date(as_of), loan_days)
    outcome = F.coalesce("rejection", F.when(ok, F.concat(F.lit(MSG_CHECKED_OUT), due.cast("string")))
                         .when(F.col("_over"), F.lit(MSG_QUOTA)).otherwise(F.lit(MSG_NO_FREE_COPY)))
    return out.select(*requests.columns, "copy_id", F.when(ok, _lit_date(as_of)).alias("loan_date"), F.when(ok, due).alias("due_date"),
                      ok.alias("accepted"), outcome.alias("outcome"))


# ---------------------------------------------------------------- C13
def batch_return(member_ids: DataFrame, loans: DataFrame, fines: DataFrame, as_of,
                 days: str = "as_of", cut_lineage: bool = True):
    """Return every active loan of the given members; then fine each of
    their returned loans that came back late and has no fine yet (old ones
    included). ``days='as_of'`` charges ``as_of - due`` (the literal
    rule); ``days='return_date'`` charges ``return - due`` like the
    return trigger. Returns (loans, new fines, audit rows)."""
    ids = member_ids.select(F.col(member_ids.columns[0]).alias("member_id")).distinct()
    mine = loans.join(ids.withColumn("_mine", F.lit(True)), "member_id", "left")
    hit = F.col("_mine") & (F.col("status") == "active")
    new_loans = (mine.withColumn("return_date", F.when(hit, _lit_date(as_of)).otherwise(F.col("return_date")))
                     .withColumn("status", F.when(hit, F.lit("returned")).otherwise(F.col("status")))
                     .select(*loans.columns, "_mine"))
    if cut_lineage:  # the changed loans feed both the new version and the fines
        new_loans = materialize(new_loans)
    late = new_loans.where(F.col("_mine") & (F.col("status") == "returned")
                           & (F.col("return_date") > F.col("due_date")))
    late = late.join(fines.select("loan_id"), "loan_id", "left_anti")
    end = _lit_date(as_of) if days == "as_of" else F.col("return_date")
    d = F.datediff(end, F.col("due_date"))
    d = F.when(d < 0, F.lit(0)).otherwise(d)
    new_fines = late.select("loan_id", (d.cast("decimal(10,0)") * F.lit(FINE_PER_DAY)).cast("decimal(10,2)")
                            .alias("fine_amount"), F.lit("overdue").alias("fine_reason"),
                            F.lit(False).alias("paid"), F.lit(None).cast("date").alias("payment_date"))
    audit = ids.select(F.lit("loans").alias("table_name"), F.lit("UPDATE").alias("action"),
                       F.col("member_id").alias("record_id"),
                       F.concat(F.lit(DESC_BATCH_RETURN), F.col("member_id").cast("string"))
                       .alias("description"))
    return new_loans.drop("_mine"), new_fines, audit


# ---------------------------------------------------------------- C14
def member_report(member_ids: DataFrame, t: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """Four result sets keyed by member_id for a set of members: profile,
    current loans, unpaid total (one row per member, NULL if none) and
    registered events from ``as_of``."""
    ids = member_ids.select(F.col(member_ids.columns[0]).alias("member_id")).distinct()
    m = t["members"].join(ids, "member_id", "left_semi")
    profile = m.select("member_id", "first_name", "last_name", "email", "membership_type", "status")
    loans = t["loans"].join(ids, "member_id", "left_semi").where(F.col("status") == "active")
    current = loans.join(t["book_copies"], "copy_id").join(t["books"], "book_id") \
        .select("member_id", "title", "loan_date", "due_date")
    mine = t["loans"].select("loan_id", "member_id").join(ids, "member_id", "left_semi")
    unpaid = t["fines"].where(F.col("paid") == False).join(mine, "loan_id") \
        .groupBy("member_id").agg(F.sum("fine_amount").alias("total_unpaid"))  # noqa: E712
    unpaid = ids.join(unpaid, "member_id", "left")
    ev = t["event_registrations"].join(ids, "member_id", "left_semi").join(t["events"], "event_id") \
        .where(F.col("event_date") >= _lit_date(as_of)).select("member_id", "event_name", "event_date")
    return {"profile": profile, "current_loans": current, "unpaid": unpaid, "events": ev}


# ---------------------------------------------------------------- C17
def apply_update(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Keyed update: rows of ``base`` whose key is in ``changes`` take the
    values of the columns ``changes`` carries (an explicit NULL included);
    everything else is unchanged. A key repeated in ``changes`` is an error
    (which of its rows should hold?). Returns the new version."""
    cols = [c for c in changes.columns if c != key]
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit(f"repeated {key} in changes: "), F.col(key).cast("string")))).otherwise(F.lit(True))
    ch = changes.where(F.col(key).isNotNull()).groupBy(key).agg(one.cast("boolean").alias("_hit"), *[F.first(c).alias(f"_new_{c}") for c in cols])
    j = base.join(ch, key, "left")
    for c in cols:
        j = j.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return j.select(*base.columns)


#: items that can be recommended, and rows of members that saw one of them, up to which either is broadcast
BROADCAST_ITEMS = 200_000


# ---------------------------------------------------------------- recommendation
def recommend(bought: DataFrame, items: DataFrame, per_member: int | None = 5) -> DataFrame:
    """For each member, items of their favourite genre(s) (most bought; ties
    give several) that they never bought, as (member_id, item_id, genre,
    title).

    With ``per_member=k`` only each member's first k by (title, item_id) are
    produced, exactly: in a genre where the member has seen s items, the
    first k unseen items lie among the genre's first k + s positions, so
    each (member, genre) expands to at most k + s candidates instead of the
    whole genre (positions from ``with_position``, safe for a huge genre).
    ``per_member=None`` returns every recommendation.
    """
    genre_of = items.select("item_id", "genre")
    # one aggregate feeds everything below: loans per (member, genre, item).
    # Rows without a member or item can never be recommended or matched; the
    # explicit filter keeps both consumers' plans identical (no filter is
    # inferred on one side only), so the aggregate's shuffle is reused.
    b = bought.where(F.col("member_id").isNotNull() & F.col("item_id").isNotNull())
    mgi = b.join(genre_of, "item_id").groupBy("member_id", "genre", "item_id") \
        .agg(F.count(F.lit(1)).alias("_n"))
    if per_member is not None:  # several jobs read it: written, so that none repeats its shuffles
        mgi = materialize(mgi)
    per_genre = mgi.groupBy("member_id", "genre").agg(F.sum("_n").alias("_cnt"),
                                                      F.count(F.lit(1)).alias("_s"))
    fav = top_n_within(per_genre, ["member_id"], [F.desc("_cnt")], 1, name="_rk", kind="rank") \
        .select("member_id", "genre", "_s")

    if per_member is None:
        cand = fav.drop("_s").join(items, "genre")
        # LEFT JOIN ... IS NULL on the same aggregate (reading its count keeps
        # both consumers of ``mgi`` identical, so its shuffle runs once)
        m = mgi.select(F.col("member_id").alias("_m"), F.col("genre").alias("_g"),
                       F.col("item_id").alias("_i"), "_n")
        cond = ((cand["member_id"] == m["_m"]) & cand["genre"].eqNullSafe(m["_g"])
                & (cand["item_id"] == m["_i"]))
        j = cand.join(m, cond, "left")
        return j.where(F.col("_n").isNull()).select("member_id", "item_id", "genre", "title")
    fav = materialize(fav)
    size = items.groupBy("genre").agg(F.count(F.lit(1)).alias("_size"))
    need = fav.join(size, "genre").select(
        "member_id", "genre", F.least(F.lit(per_member) + F.col("_s"), F.col("_size")).alias("_k"))
    slots = need.select("member_id", "genre", F.explode(F.sequence(F.lit(1).cast("long"),
                                                                    F.col("_k").cast("long"))).alias("_pos"))
    positioned = with_position(items.select("item_id", "genre", "title"), ["title", "item_id"], ["genre"],
                               name="_pos")
    # positions beyond the largest need can't be used: what is left of a genre
    # is at most that many rows, whatever the genre's size
    largest = need.groupBy(F.col("genre").alias("_g")).agg(F.max("_k").alias("_max"))
    positioned = positioned.join(largest, positioned["genre"].eqNullSafe(F.col("_g"))).where(F.col("_pos") <= F.col("_max")) \
        .drop("_g", "_max")
    # written and counted, so that a small rest is broadcast: neither the
    # slots nor the members' items are shuffled for it then
    positioned = materialize(positioned)
    if positioned.count() <= BROADCAST_ITEMS:
        positioned = F.broadcast(positioned)
    # seen items by position: of ``mgi`` only the few within those positions,
    # and candidates carry titles only once they are known to be unseen
    p = positioned.select(F.col("item_id").alias("_i"), F.col("genre").alias("_g"), "_pos")
    seen = mgi.join(p, (mgi["item_id"] == p["_i"]) & mgi["genre"].eqNullSafe(p["_g"])) \
        .select("member_id", "genre", "_pos").distinct()
    seen = materialize(seen)
    if seen.count() <= BROADCAST_ITEMS:
        seen = F.broadcast(seen)
    cand = slots.join(seen, ["member_id", "genre", "_pos"], "left_anti").join(positioned, ["genre", "_pos"]).drop("_pos")
    top = top_n_within(cand, ["member_id"], ["title", "item_id"], per_member, name="_rn",
                       kind="row_number")
    return top.select("member_id", "item_id", "genre", "title")
