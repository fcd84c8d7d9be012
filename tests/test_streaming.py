"""Streaming jobs against their batch equivalents."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from shelfwise.operators import jobs
from shelfwise.streaming import streams as S

AS_OF = dt.date(2024, 6, 15)


def _dir():
    return tempfile.mkdtemp(prefix="shelfwise-stream-")


def _run_memory(df, name, ckpt, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_daily_activity_matches_batch(spark):
    src = _dir()
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    _run_memory(S.daily_activity(stream), "daily_stream", _dir())
    got = spark.sql("SELECT * FROM daily_stream")
    batch = S.daily_activity(ev)
    max_ts = ev.agg(F.max("ts")).first()[0]
    # append mode emits a window once the watermark (max event time - 1 day)
    # has passed its end; the later windows stay open
    wm = max_ts - dt.timedelta(days=1)
    want = batch.where(F.col("day") + F.expr("INTERVAL 1 DAY") <= F.lit(wm))
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


FAR = dt.datetime(2100, 1, 1)


def _run_files(spark, batches, schema, build, files_per_batch=1):
    """Write each list of rows as a file, then a last one that moves the
    watermark past all; run ``build`` over them, restarted before every file,
    and return the rows it emitted."""
    src, out, ckpt = _dir(), _dir(), _dir()
    end = tuple(FAR if f.name == "event_time" else None for f in schema)
    for rows in [*batches, [end]]:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(src)
        with S.state_store(spark):
            df = build(stream)
            df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out).collect()


def _fines_in_order(rows):
    """Fines of status rows, loan by loan in order of time."""
    out = []
    last = {}
    for loan, status, due, back, _ in sorted((r for r in rows if r[0] is not None and r[4] is not None), key=lambda r: (r[0], r[4], r[1])):
        if status == "returned" and last.get(loan) == "active" and back is not None and due is not None and back > due:
            out.append((loan, (back - due).days * 25))
        last[loan] = status
    return sorted(out)


def test_fines_do_not_depend_on_arrival(spark):
    """Second cycles, returns long after the loan, repeated and early returns,
    other states in between, null keys; rows dealt to files at random."""
    rng = random.Random(21)
    d = lambda n: AS_OF + dt.timedelta(days=n)
    t = lambda n: dt.datetime(2022, 6, 1) + dt.timedelta(hours=n)
    rows = [(1, "active", d(0), None, t(0)), (1, "returned", d(0), d(500), t(12_000)),          # 500 days
            (1, "active", d(510), None, t(12_300)), (1, "returned", d(510), d(514), t(12_800)),  # a second cycle
            (2, "returned", d(0), d(9), t(0)), (2, "active", d(0), None, t(1)),                  # returned before it began
            (3, "active", d(0), None, t(0)), (3, "lost", d(0), None, t(2)), (3, "returned", d(0), d(8), t(4)),
            (4, "active", None, None, t(0)), (4, "returned", None, d(3), t(5)), (None, "active", d(0), None, t(1)), (5, "active", d(0), None, None)]
    for loan in range(10, 60):
        at = 0
        for _ in range(rng.randint(1, 7)):
            at += rng.randint(1, 900)
            rows.append((loan, rng.choice(["active", "returned", "overdue"]), d(rng.randint(0, 9)), rng.choice([None, d(rng.randint(0, 30))]), t(at)))
    files = [[] for _ in range(3)]
    for r in rows:
        rng.choice(files).append(r)
    got = _run_files(spark, files, S.LOAN_STATUS_SCHEMA, lambda st: S.fines_from_status_events(st, "2000 days", buckets=3, shards=2))
    assert sorted((r.loan_id, int(r.fine_amount * 100)) for r in got) == _fines_in_order(rows)
    assert {(1, 12_500), (1, 100)} <= set(_fines_in_order(rows))


def test_audit_does_not_depend_on_arrival(spark):
    rng = random.Random(22)
    t = lambda n: dt.datetime(2024, 6, 1) + dt.timedelta(hours=n)
    rows = [(1, "A", "B", "active", t(0)), (1, "A", "B", "suspended", t(1)), (2, "C", "D", "active", t(0)), (2, "C", "D", "active", t(2)),
            (3, None, "E", "active", t(0)), (3, None, "E", "active", t(3)), (3, "x", "E", None, t(5)), (None, "n", "n", "n", t(1))]
    rows += [(m, rng.choice("ab"), "Z", rng.choice(["active", "expired", None]), t(rng.randint(0, 10_000))) for m in range(10, 50) for _ in range(5)]
    last, want = {}, []
    for m, *now, at in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[4], *(x or "" for x in r[1:4]))):
        if m in last and last[m] != now:
            want.append((m, at, f"Member {last[m][0]} {last[m][1]} updated. Status: {last[m][2]} -> {now[2]}".replace("None", "null")))
        last[m] = now
    files = [[] for _ in range(3)]
    for r in rows:
        rng.choice(files).append(r)
    got = _run_files(spark, files, S.MEMBER_CHANGE_SCHEMA, lambda st: S.audit_from_member_changes(st, "2000 days", buckets=3, shards=2))
    assert sorted((r.record_id, r.changed_at, r.description) for r in got) == sorted(want)


def test_rows_are_held_until_the_watermark_passes(spark):
    """Nothing is emitted for rows that an earlier one could still precede."""
    d = lambda n: AS_OF + dt.timedelta(days=n)
    t = lambda n: dt.datetime(2024, 6, 1) + dt.timedelta(days=n)
    src, out, ckpt = _dir(), _dir(), _dir()
    seen = []
    for rows in ([(1, "returned", d(0), d(4), t(6))], [(1, "active", d(0), None, t(1))], [(9, "active", d(0), None, t(40))]):
        spark.createDataFrame(rows, S.LOAN_STATUS_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(S.LOAN_STATUS_SCHEMA).parquet(src)
        with S.state_store(spark):
            df = S.fines_from_status_events(stream, "10 days", buckets=2, shards=1)
            df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
        seen.append(spark.read.schema(df.schema).parquet(out).count())
    assert seen == [0, 0, 1]


def _admit_in_order(batches, held, rejected):
    """Outcomes of requests and returns, one by one."""
    out, held = {}, set(held)
    for rows in batches:
        for at, kind, ident, copy in sorted(rows, key=lambda r: (r[0], -1 if r[2] is None else r[2])):
            if kind == "return":
                held.discard(copy)
            else:
                out[ident] = ident not in rejected and copy is not None and copy not in held
                if out[ident]:
                    held.add(copy)
    return out


def test_admission_keeps_held_copies_in_state(spark, lib):
    """Three runs of one checkpoint with returns between equal the requests
    one by one; after the first run the loans are not read again, and a
    replayed epoch changes nothing."""
    rng = random.Random(23)
    members = spark.createDataFrame([(m, "active" if m % 5 else "suspended") for m in range(1, 30)], "member_id long, status string")
    loans_dir, src, ret, out, ckpt = (_dir() for _ in range(5))
    base = [(m, c, "active" if c % 3 else "returned") for m, c in enumerate(range(100, 130))]
    spark.createDataFrame(base, "member_id long, copy_id long, status string").write.mode("overwrite").parquet(loans_dir)
    held = [c for _, c, s in base if s == "active"]
    batches, rejected, n = [], set(), 0
    for _ in range(3):
        rows = []
        for _ in range(70):
            n += 1
            at = dt.datetime(2024, 6, 15) + dt.timedelta(minutes=n * 10 + rng.randint(-400, 400), seconds=n)
            if rng.random() < 0.3:
                rows.append((at, "return", None, rng.randint(95, 135)))
            else:
                m = rng.randint(1, 32)
                rows.append((at, "loan", n, rng.choice([110, rng.randint(95, 135), None])))
                if m % 5 == 0 or m >= 30:
                    rejected.add(n)
                rows[-1] += (m,)
        batches.append(rows)
    def run(loans):
        S.admit_loan_requests(spark, src, members, loans, out, ckpt, AS_OF, returns_dir=ret, buckets=3, shards=2)
    for i, rows in enumerate(batches):
        asks = [(r[2], r[4], r[3], AS_OF, None, r[0]) for r in rows if r[1] == "loan"]
        spark.createDataFrame(asks, S.LOAN_REQUEST_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        spark.createDataFrame([(r[3], r[0]) for r in rows if r[1] == "return"], S.RETURN_SCHEMA).coalesce(1).write.mode("append").parquet(ret)
        if i:  # other loans there must not matter any more
            loans_dir = _dir()
            spark.createDataFrame([(1, c, "active") for c in range(90, 140)], "member_id long, copy_id long, status string").write.mode("overwrite").parquet(loans_dir)
        run(loans_dir)
    read = lambda: sorted(map(tuple, spark.read.parquet(os.path.join(out, "outcomes")).select("request_id", "accepted", "outcome").collect()))
    got = read()
    assert {r[0]: r[1] for r in got} == _admit_in_order([[x[:4] for x in b] for b in batches], held, rejected)
    assert sum(r[1] for r in got) > 20
    # the last epoch's commit is forgotten: it runs again
    spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(os.path.join(ckpt, "commits", str(max(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())))), False)
    run(loans_dir)
    assert read() == got


def test_admission_stream_equals_batch(spark, lib):
    from fixtures import library_rows
    raw = library_rows()
    status = {m[0]: m[8] for m in raw["members"]}
    good, bad = [m for m in status if status[m] == "active"], next(m for m in status if status[m] != "active")
    busy = {x[2] for x in raw["loans"] if x[6] == "active"}
    free = [c[0] for c in raw["book_copies"] if c[0] not in busy]
    src, out = _dir(), _dir()
    loans_dir = os.path.join(_dir(), "loans")
    lib["loans"].write.parquet(loans_dir)
    ts = lambda n: dt.datetime(2024, 6, 15, 9) + dt.timedelta(minutes=n)
    reqs = [(1, good[0], free[0], AS_OF, None, ts(1)), (2, good[1], free[0], AS_OF, None, ts(2)), (3, bad, free[1], AS_OF, None, ts(3)),
            (4, 999, free[2], AS_OF, None, ts(4)), (5, good[2], min(busy), AS_OF, None, ts(5)), (6, good[3], free[3], AS_OF, None, ts(6))]
    spark.createDataFrame(reqs, S.LOAN_REQUEST_SCHEMA).write.mode("overwrite").parquet(src)
    run = lambda: S.admit_loan_requests(spark, src, lib["members"], loans_dir, out, ckpt, AS_OF)
    ckpt = os.path.join(_dir(), "ckpt")
    run()
    read = lambda: {r.request_id: r.outcome for r in spark.read.parquet(os.path.join(out, "outcomes")).collect()}
    got = read()
    assert got[1].startswith(jobs.MSG_CHECKED_OUT) and got[2] == jobs.MSG_ON_LOAN
    assert got[3] == jobs.MSG_LOAN_BLOCKED and got[4] == jobs.MSG_UNKNOWN_MEMBER
    assert got[5] == jobs.MSG_ON_LOAN and got[6].startswith(jobs.MSG_CHECKED_OUT)
    assert spark.read.parquet(os.path.join(out, "loans")).count() == 2
    # a later batch sees the loans that the first one made
    later = [(7, good[4], free[0], AS_OF, None, ts(7)), (8, good[4], free[4], AS_OF, None, ts(8))]
    spark.createDataFrame(later, S.LOAN_REQUEST_SCHEMA).write.mode("append").parquet(src)
    run()
    got = read()
    assert got[7] == jobs.MSG_ON_LOAN and got[8].startswith(jobs.MSG_CHECKED_OUT)


def test_months_equal_the_batch_and_late_rows_are_given(spark):
    """Days in order, a row of a closed day, a gap of a month; the months that
    the watermark passed equal the batch without the late rows."""
    src, out, ck1, ck2, late_dir = (_dir() for _ in range(5))
    t = lambda m, d, h=0: dt.datetime(2024, m, d, h)
    batches = [[(t(1, 3), "a"), (t(1, 20, 5), "a"), (t(1, 20, 9), "b"), (t(1, 31, 23), "a")], [(t(2, 4), "a"), (t(2, 3, 12), "b"), (t(1, 30), "near"), (t(1, 3, 1), "a")],
               [(t(4, 1), "a"), (t(2, 4, 3), "near"), (t(1, 30, 5), "a"), (t(1, 3, 2), "a"), (t(1, 5), "b"), (t(4, 2), "b")], [(t(6, 9), "end")]]
    schema = "ts timestamp, event_type string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    with S.state_store(spark):
        df = S.monthly_activity(stream(), lateness="2 days")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck1).trigger(availableNow=True).start().awaitTermination()
    got = {(r["month"].month, r["event_type"]): (r["events"], r["days"]) for r in spark.read.schema(df.schema).parquet(out).collect()}
    late = sorted((r["ts"], r["event_type"]) for r in S.late_rows(spark, stream(), late_dir, ck2, lateness="2 days").collect())
    assert late == [(t(1, 3, 2), "a"), (t(1, 5), "b")]  # the other rows out of order came before their days were closed
    want = {}
    for at, kind in (r for rows in batches for r in rows):
        if (at, kind) not in late and at.month < 6:
            n, days = want.get((at.month, kind), (0, set()))
            want[at.month, kind] = n + 1, days | {at.date()}
    assert got == {k: (n, len(days)) for k, (n, days) in want.items()}
