"""Change jobs: each batch must equal running its requests one by one in
request order (a plain Python model of the one-row-per-call rules)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from fixtures import AS_OF, IDLE_BOOK, IDLE_MEMBER
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import jobs

MEMBERS_T = T.StructType([T.StructField("member_id", T.IntegerType()), T.StructField("status", T.StringType())])
LOANS_T = T.StructType([T.StructField("loan_id", T.IntegerType()), T.StructField("member_id", T.IntegerType()),
                        T.StructField("copy_id", T.IntegerType()), T.StructField("loan_date", T.DateType()),
                        T.StructField("due_date", T.DateType()), T.StructField("return_date", T.DateType()),
                        T.StructField("status", T.StringType())])
REQ_T = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("member_id", T.IntegerType()),
                      T.StructField("copy_id", T.IntegerType())])


def _world(seed, n_members=12, n_copies=8, n_loans=10, n_req=40, hot=True):
    rnd = random.Random(seed)
    members = [(m, rnd.choice(["active", "active", "active", "suspended", "expired"])) for m in range(1, n_members + 1)]
    loans = []
    for i in range(1, n_loans + 1):
        d = AS_OF - dt.timedelta(days=rnd.randint(1, 40))
        st = rnd.choice(["active", "returned", "lost"])
        loans.append((i, rnd.randint(1, n_members), rnd.randint(1, n_copies), d, d + dt.timedelta(days=14),
                      None if st != "returned" else d + dt.timedelta(days=rnd.randint(1, 30)), st))
    reqs = []
    for r in range(1, n_req + 1):
        m = rnd.randint(1, n_members + 2)  # some unknown members
        c = 1 if (hot and rnd.random() < 0.35) else rnd.randint(1, n_copies)  # a hot copy
        reqs.append((r, m, c))
    rnd.shuffle(reqs)
    return members, loans, reqs


def _serial_checkout(members, loans, reqs):
    status = dict(members)
    busy = {c for (_, _, c, _, _, _, s) in loans if s == "active"}
    out = {}
    for rid, m, c in sorted(reqs):
        if m not in status:
            out[rid] = jobs.MSG_NO_MEMBER
        elif status[m] != "active":
            out[rid] = jobs.MSG_NOT_ACTIVE
        elif c in busy:
            out[rid] = jobs.MSG_ON_LOAN
        else:
            busy.add(c)
            out[rid] = jobs.MSG_CHECKED_OUT + str(AS_OF + dt.timedelta(days=14))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checkout_serial_equivalence(spark, seed):
    members, loans, reqs = _world(seed)
    got = jobs.apply_checkouts(spark.createDataFrame(reqs, REQ_T), spark.createDataFrame(members, MEMBERS_T),
                               spark.createDataFrame(loans, LOANS_T), AS_OF)
    assert {r.request_id: r.outcome for r in got.collect()} == _serial_checkout(members, loans, reqs)


@pytest.mark.parametrize("seed", [4, 5])
def test_quota_serial_equivalence(spark, seed):
    members, loans, reqs = _world(seed, n_loans=30, n_req=60)
    active = {}
    for (_, m, _, _, _, _, s) in loans:
        if s == "active":
            active[m] = active.get(m, 0) + 1
    want = {}
    for rid, m, c in sorted(reqs):
        if active.get(m, 0) + 1 <= 3:
            active[m] = active.get(m, 0) + 1
            want[rid] = True
        else:
            want[rid] = False
    got = jobs.apply_quota(spark.createDataFrame(reqs, REQ_T), spark.createDataFrame(loans, LOANS_T), max_active=3)
    assert {r.request_id: r.accepted for r in got.collect()} == want


@pytest.mark.parametrize("seed", [6, 7])
def test_returns_serial_equivalence(spark, seed):
    _, loans, _ = _world(seed, n_loans=20)
    rnd = random.Random(seed)
    reqs = [(r, rnd.randint(1, 22)) for r in range(1, 30)]
    state = {l[0]: l for l in loans}
    want, fines = {}, {}
    for rid, lid in sorted(reqs):
        l = state.get(lid)
        if l is None or l[6] != "active":
            want[rid] = jobs.MSG_INVALID_LOAN
            continue
        days = (AS_OF - l[4]).days
        state[lid] = l[:5] + (AS_OF, "returned")
        if days > 0:
            amt = (Decimal(days) * Decimal("0.25")).quantize(Decimal("0.01"))
            want[rid] = jobs.MSG_RETURNED_FINE + str(amt)
            fines[lid] = amt
        else:
            want[rid] = jobs.MSG_RETURNED_OK
    rq = spark.createDataFrame(reqs, "request_id long, loan_id int")
    out, new_loans, new_fines = jobs.apply_returns(rq, spark.createDataFrame(loans, LOANS_T), AS_OF)
    assert {r.request_id: r.outcome for r in out.collect()} == want
    assert {r.loan_id: r.fine_amount for r in new_fines.collect()} == fines
    assert {r.loan_id: r.status for r in new_loans.collect()} == {k: v[6] for k, v in state.items()}


def test_allocate_copies_serial(spark):
    copies = [(c, 1 + (c - 1) // 3) for c in range(1, 13)]  # 4 books x 3 copies
    loans = [(1, 1, 2, AS_OF, AS_OF, None, "active"), (2, 1, 7, AS_OF, AS_OF, None, "active")]
    reqs = [(r, 1, 1 + (r * 7) % 4) for r in range(1, 15)]
    busy = {2, 7}
    want = {}
    for rid, m, b in sorted(reqs):
        free = [c for c, bk in copies if bk == b and c not in busy]
        want[rid] = min(free) if free else None
        if free:
            busy.add(min(free))
    got = jobs.allocate_copies(spark.createDataFrame(reqs, "request_id long, member_id int, book_id int"),
                               spark.createDataFrame(copies, "copy_id int, book_id int"),
                               spark.createDataFrame(loans, LOANS_T))
    assert {r.request_id: r.copy_id for r in got.collect()} == want


def test_fines_for_returns_and_due_date(spark):
    old = spark.createDataFrame([(1, 1, 1, AS_OF, AS_OF, None, "active"), (2, 1, 2, AS_OF, AS_OF, None, "active"),
                                 (3, 1, 3, AS_OF, AS_OF, None, "returned")], LOANS_T)
    d = lambda n: AS_OF + dt.timedelta(days=n)
    new = spark.createDataFrame([(1, 1, 1, AS_OF, AS_OF, d(16), "returned"), (2, 1, 2, AS_OF, AS_OF, d(-1), "returned"),
                                 (3, 1, 3, AS_OF, AS_OF, d(5), "returned")], LOANS_T)
    f = jobs.fines_for_returns(old, new).collect()
    assert [(r.loan_id, r.fine_amount, r.fine_reason) for r in f] == [(1, Decimal("4.00"), "overdue")]
    filled = jobs.fill_due_date(spark.createDataFrame([(1, AS_OF, None), (2, AS_OF, d(3))],
                                                      "loan_id int, loan_date date, due_date date")).collect()
    assert [r.due_date for r in filled] == [d(14), d(3)]


def test_admission_guard(spark):
    members = spark.createDataFrame([(1, "active"), (2, "suspended"), (3, None)], MEMBERS_T)
    loans = spark.createDataFrame([(1,), (2,), (3,), (4,)], "member_id int")
    r = {x.member_id: x.rejection for x in jobs.split_admissible(loans, members).collect()}
    assert r == {1: None, 2: jobs.MSG_LOAN_BLOCKED, 3: None, 4: jobs.MSG_UNKNOWN_MEMBER}


def test_audit_changes(spark):
    s = "member_id int, first_name string, last_name string, status string"
    old = spark.createDataFrame([(1, "A", "B", "active"), (2, "C", "D", "active"), (3, "E", "F", None)], s)
    new = spark.createDataFrame([(1, "A", "B", "suspended"), (2, "C", "D", "active"), (3, "E", "F", None)], s)
    r = jobs.audit_changes(old, new, "member_id", ["first_name", "last_name", "status"],
                           dt.datetime(2024, 6, 15, 9)).collect()
    assert [(x.record_id, x.description) for x in r] == [(1, "Member A B updated. Status: active -> suspended")]


@pytest.fixture(scope="module")
def raw():
    from fixtures import library_rows
    return library_rows()


def test_delete_guard_and_cascade(spark, lib, raw):
    book_of = {c[0]: c[1] for c in raw["book_copies"]}
    active = {book_of[x[2]] for x in raw["loans"] if x[6] == "active"}
    ever = {book_of[x[2]] for x in raw["loans"]}
    some = [1, IDLE_BOOK, min(active), max(ever - active)]
    ids = spark.createDataFrame([(b,) for b in some], "book_id int")
    for strict, busy in ((False, active), (True, ever)):
        g = {r.book_id: r.allowed for r in jobs.guard_book_delete(ids, lib["book_copies"], lib["loans"], strict=strict).collect()}
        assert g == {b: b not in busy for b in some}
    out, viol = jobs.cascade_delete(lib, "books", spark.createDataFrame([(IDLE_BOOK,)], "book_id int"))
    gone = sum(c[1] == IDLE_BOOK for c in raw["book_copies"])
    assert viol.count() == 0 and out["books"].count() == len(raw["books"]) - 1
    assert out["book_copies"].count() == len(raw["book_copies"]) - gone and gone > 0
    out, viol = jobs.cascade_delete(lib, "members", spark.createDataFrame([(1,)], "member_id int"))
    assert viol.where("table_name = 'loans'").count() == sum(x[1] == 1 for x in raw["loans"])
    assert out["event_registrations"].count() == sum(x[2] != 1 for x in raw["event_registrations"])


def test_settle_fines(spark, lib, raw):
    member_of = {x[0]: x[1] for x in raw["loans"]}
    status = {m[0]: m[8] for m in raw["members"]}
    unpaid = {}
    for f in raw["fines"]:
        if not f[4]:
            unpaid.setdefault(member_of[f[1]], []).append(f[0])
    clears = min(m for m in unpaid if status[m] != "active")  # all of this member's fines are paid
    keeps = min(m for m in unpaid if len(unpaid[m]) > 1 and m != clears)  # of this member's only one
    paid = [*unpaid[clears], unpaid[keeps][0]]
    pay = spark.createDataFrame([(f,) for f in paid], "fine_id int")
    fines, members, audit = jobs.settle_fines(pay, lib["fines"], lib["loans"], lib["members"], AS_OF)
    f = {r.fine_id: (r.paid, r.payment_date) for r in fines.collect()}
    assert f == {x[0]: (True, AS_OF) if x[0] in paid else (x[4], x[5]) for x in raw["fines"]}
    assert {r.member_id: r.status for r in members.collect()} == {m: "active" if m == clears else s for m, s in status.items()}
    _, m2, _ = jobs.settle_fines(pay, lib["fines"], lib["loans"], lib["members"], AS_OF, only_suspended=True)
    assert {r.member_id: r.status for r in m2.collect()}[clears] == ("active" if status[clears] == "suspended" else status[clears])
    assert audit.count() == len(paid)


def test_batch_return(spark, lib, raw):
    fined = {f[1] for f in raw["fines"]}
    late = lambda x, end: max(0, (end - x[4]).days)
    has_late = {x[1] for x in raw["loans"] if x[6] == "returned" and x[5] > x[4] and x[0] not in fined}
    who = min(m for m in has_late if any(x[1] == m and x[6] == "active" for x in raw["loans"]))
    ids = spark.createDataFrame([(who,)], "member_id int")
    loans, fines, audit = jobs.batch_return(ids, lib["loans"], lib["fines"], AS_OF)
    after = [(*x[:5], AS_OF, "returned") if x[1] == who and x[6] == "active" else x for x in raw["loans"]]
    assert sorted(map(tuple, loans.collect())) == sorted(after)
    owed = [x for x in after if x[1] == who and x[6] == "returned" and x[5] > x[4] and x[0] not in fined]
    cents = lambda days: (Decimal(days) * Decimal("0.25")).quantize(Decimal("0.01"))
    assert {r.loan_id: r.fine_amount for r in fines.collect()} == {x[0]: cents(late(x, AS_OF)) for x in owed}  # as_of - due
    _, f2, _ = jobs.batch_return(ids, lib["loans"], lib["fines"], AS_OF, days="return_date")
    assert {r.loan_id: r.fine_amount for r in f2.collect()} == {x[0]: cents(late(x, x[5])) for x in owed}
    assert audit.first().description == f"Batch return for member {who}"


def test_member_report(spark, lib, raw):
    who = (1, IDLE_MEMBER)
    rep = jobs.member_report(spark.createDataFrame([(m,) for m in who], "member_id int"), lib, AS_OF)
    assert rep["profile"].count() == 2
    assert rep["current_loans"].count() == sum(x[1] in who and x[6] == "active" for x in raw["loans"])
    mine = {x[0] for x in raw["loans"] if x[1] == 1}
    owed = sum(f[2] for f in raw["fines"] if f[1] in mine and not f[4]) or None
    assert {r.member_id: r.total_unpaid for r in rep["unpaid"].collect()} == {1: owed, IDLE_MEMBER: None}
    assert rep["events"].where("member_id = 1").count() == sum(x[2] == 1 for x in raw["event_registrations"])


def test_apply_update(spark, lib, raw):
    ch = spark.createDataFrame([(4, "active", None)], "member_id int, status string, phone string")
    new = jobs.apply_update(lib["members"], ch, "member_id")
    r = new.where("member_id = 4").first()
    assert r.status == "active" and r.phone is None and new.count() == len(raw["members"])


def test_checkout_and_log(spark, lib, raw):
    status = {m[0]: m[8] for m in raw["members"]}
    good, bad = min(m for m in status if status[m] == "active"), min(m for m in status if status[m] != "active")
    busy = {x[2] for x in raw["loans"] if x[6] == "active"}
    free = {}
    for c in raw["book_copies"]:
        if c[0] not in busy:
            free.setdefault(c[1], []).append(c[0])
    book = min(b for b in free if len(free[b]) == 1)
    reqs = [(1, bad, book), (2, good, book), (3, good, book), (4, good, IDLE_BOOK), (5, 9999, IDLE_BOOK)]
    out, new, audit = jobs.checkout_and_log(spark.createDataFrame(reqs, "request_id long, member_id int, book_id int"),
                                            lib["book_copies"], lib["loans"], lib["members"], AS_OF)
    got = {r.request_id: (r.copy_id, r.accepted, r.outcome) for r in out.collect()}
    # refused members take no copy
    assert got == {1: (None, False, jobs.MSG_LOAN_BLOCKED), 2: (free[book][0], True, None), 3: (None, False, jobs.MSG_NO_FREE_COPY),
                   4: (free[IDLE_BOOK][0], True, None), 5: (None, False, jobs.MSG_UNKNOWN_MEMBER)}
    assert sorted(r.loan_id for r in new.collect()) == [len(raw["loans"]) + 1, len(raw["loans"]) + 2]
    assert sorted(r.record_id for r in audit.collect()) == sorted(r.loan_id for r in new.collect())


def _serve(requests, members, have, free, most):
    """The combined rules, one request after the other."""
    out, have, free = {}, dict(have), {b: sorted(c) for b, c in free.items()}
    for r, m, b in sorted(requests):
        if members.get(m, "none") != "active" and not (m in members and members[m] is None):
            out[r] = (None, jobs.MSG_UNKNOWN_MEMBER if m not in members else jobs.MSG_LOAN_BLOCKED)
        elif have.get(m, 0) >= most:
            out[r] = (None, jobs.MSG_QUOTA)
        elif not free.get(b):
            out[r] = (None, jobs.MSG_NO_FREE_COPY)
        else:
            out[r] = (free[b].pop(0), "ok")
            have[m] = have.get(m, 0) + 1
    return out


@pytest.mark.parametrize("seed, most, hot", [(1, 3, 0.35), (2, 1, 0.6), (3, 5, 0.0)])
def test_checkout_within_quota_equals_one_by_one(spark, seed, most, hot):
    """A hot member and a hot book that hold a share of the batch; members
    over the quota from the start, books without copies, unknown members."""
    rng = random.Random(seed)
    members = {m: rng.choice(["active"] * 6 + ["suspended", None]) for m in range(30)} | {0: "active"}
    copies = [(c, rng.choice([0, 0, *range(25)])) for c in range(140)]
    loans = [(i, rng.randint(0, 29), c, rng.choice(["active", "returned"])) for i, (c, _) in enumerate(copies) if rng.random() < 0.4]
    requests = [(r, 0 if rng.random() < hot else rng.randint(0, 32), 0 if rng.random() < hot else rng.randint(0, 27)) for r in rng.sample(range(1000), 260)]
    have, free = {}, {}
    for _, m, _, s in loans:
        have[m] = have.get(m, 0) + (s == "active")
    out_now = {c for _, _, c, s in loans if s == "active"}
    for c, b in copies:
        if c not in out_now:
            free.setdefault(b, []).append(c)
    got = jobs.checkout_within_quota(
        spark.createDataFrame(requests, "request_id long, member_id long, book_id long"), spark.createDataFrame(copies, "copy_id long, book_id long"),
        spark.createDataFrame(loans, "loan_id long, member_id long, copy_id long, status string"),
        spark.createDataFrame(list(members.items()), "member_id long, status string"), dt.date(2024, 6, 15), max_active=most).collect()
    assert {r.request_id: (r.copy_id, "ok" if r.accepted else r.outcome) for r in got} == _serve(requests, members, have, free, most)
    assert all(r.accepted == (r.copy_id is not None) == (r.due_date is not None) for r in got)


def test_checkout_within_quota_of_nothing(spark):
    none = spark.createDataFrame([], "request_id long, member_id long, book_id long")
    rest = [spark.createDataFrame([], s) for s in ("copy_id long, book_id long", "member_id long, copy_id long, status string", "member_id long, status string")]
    assert jobs.checkout_within_quota(none, *rest, dt.date(2024, 6, 15)).collect() == []
    asked = spark.createDataFrame([(1, 1, 1)], none.schema)
    assert jobs.checkout_within_quota(asked, *rest, dt.date(2024, 6, 15)).first().outcome == jobs.MSG_UNKNOWN_MEMBER


def test_update_refuses_repeated_keys(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id long, v string")
    with pytest.raises(Exception, match="repeated id in changes: 1"):
        jobs.apply_update(base, twice, "id").collect()
    assert sorted(map(tuple, jobs.apply_update(base, twice.where("v <> 'x'"), "id").collect())) == [(1, "y"), (2, "b")]
