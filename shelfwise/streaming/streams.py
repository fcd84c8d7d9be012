"""Structured Streaming forms of the event-driven lending rules.

ST1 ``admit_loan_requests``: loan requests (and returns) stream -> stream-static
    join to members (admission guard, default due date) -> contention for
    copies settled against the held copies kept in state; outcomes and new
    loans are written per epoch (idempotent on replay: one directory per
    epoch). The loans are read once, to fill the state.
ST2 ``fines_from_status_events``: a loan's status rows in event-time order; the
    step from 'active' to 'returned' fines a late return, in every cycle.
ST3 ``audit_from_member_changes``: a member's snapshots in event-time order; a
    row that differs from the one before emits one audit row.
ST4 ``daily_activity``: event-time tumbling windows with a watermark;
    windows are emitted once the watermark passes them. ``monthly_activity``
    sums the emitted days up to calendar months.

ST2 and ST3 hold rows until the watermark passes them (``ordered``), so the
result does not depend on the order of arrival; nothing is collected to the
driver.
"""

from __future__ import annotations

import os
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shelfwise.functions.exprs import FINE_PER_DAY, LOAN_DAYS, fine_amount
from shelfwise.operators import jobs
from shelfwise.operators.jobs import DESC_MEMBER
from shelfwise.streaming.held import held_copies
from shelfwise.streaming.ordered import in_event_order, state_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the steps reach executors that don't have this package

LOAN_REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("member_id", T.LongType()),
    T.StructField("copy_id", T.LongType()), T.StructField("loan_date", T.DateType()),
    T.StructField("due_date", T.DateType()), T.StructField("requested_at", T.TimestampType())])

LOAN_STATUS_SCHEMA = T.StructType([
    T.StructField("loan_id", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("due_date", T.DateType()), T.StructField("return_date", T.DateType()),
    T.StructField("event_time", T.TimestampType())])

MEMBER_CHANGE_SCHEMA = T.StructType([
    T.StructField("member_id", T.LongType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampType())])


# ---------------------------------------------------------------- ST1
def admission_stream(requests: DataFrame, members: DataFrame, loan_days: int = LOAN_DAYS) -> DataFrame:
    """Stream-static part of admission: default due date, then the guard's
    rejection reason per request (NULL = admitted)."""
    filled = jobs.fill_due_date(requests, loan_days)
    return jobs.split_admissible(filled, members)


RETURN_SCHEMA = T.StructType([T.StructField("copy_id", T.LongType()), T.StructField("returned_at", T.TimestampType())])


def admit_loan_requests(spark: SparkSession, source_dir: str, members: DataFrame, loans_dir: str,
                        out_dir: str, checkpoint: str, as_of, returns_dir: str | None = None, buckets: int = 32, shards: int = 16,
                        files_per_batch: int | None = None):
    """Run ST1 over the files in ``source_dir`` until they are consumed.

    Admitted requests compete for copies in order of (requested_at,
    request_id); a copy is held from an accepted request, or from an active
    loan in ``loans_dir`` when the checkpoint is new, until a row of
    ``returns_dir`` (RETURN_SCHEMA) gives it back. The held copies are state:
    a micro-batch reads and writes those shards whose copies it asks for,
    however many loans there were before. Outcomes and new loans are written
    to ``out_dir/outcomes`` and ``out_dir/loans`` under ``epoch=<id>``,
    overwritten on replay."""
    def files(schema: T.StructType, path: str) -> DataFrame:
        reader = spark.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)

    rows = admission_stream(files(LOAN_REQUEST_SCHEMA, source_dir), members).select(
        F.lit("loan").alias("kind"), "request_id", "member_id", "copy_id", F.col("requested_at").alias("at"), "rejection")
    if returns_dir is not None:
        rows = rows.unionByName(files(RETURN_SCHEMA, returns_dir).select(F.lit("return").alias("kind"), "copy_id", F.col("returned_at").alias("at")),
                                allowMissingColumns=True)
    base = spark.read.parquet(loans_dir).where(F.col("status") == "active").select("copy_id")
    due = F.date_add(F.lit(as_of).cast("date"), LOAN_DAYS)
    outcome = F.coalesce("rejection", F.when(F.col("accepted"), F.concat(F.lit(jobs.MSG_CHECKED_OUT), due.cast("string"))).otherwise(F.lit(jobs.MSG_ON_LOAN)))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        path = os.path.join(out_dir, "outcomes", f"epoch={epoch_id}")
        batch.select("request_id", "member_id", "copy_id", "accepted", outcome.alias("outcome")).write.mode("overwrite").parquet(path)
        accepted = spark.read.schema("request_id long, member_id long, copy_id long, accepted boolean, outcome string").parquet(path)
        loans = accepted.withColumn("loan_date", F.lit(as_of).cast("date")).withColumn("due_date", due)
        jobs.new_loans_from(loans).write.mode("overwrite").parquet(os.path.join(out_dir, "loans", f"epoch={epoch_id}"))

    with state_store(spark):
        q = (held_copies(rows, base, buckets, shards).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    return q


# ---------------------------------------------------------------- ST2
_ACTIVE, _RETURNED = "active", "returned"


def _fine_step(rows: pd.DataFrame, before: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    charged = (rows["status"] == _RETURNED) & (before["status"] == _ACTIVE)
    # only an open loan's row can matter to a later one
    return rows.loc[charged, ["loan_id", "due_date", "return_date"]], (rows["status"] == _ACTIVE).to_numpy()


def fines_from_status_events(events: DataFrame, lateness: str, buckets: int = 32, shards: int = 16) -> DataFrame:
    """Fine rows from a stream of loan status rows (LOAN_STATUS_SCHEMA): a
    'returned' row whose loan's row before it (by event time, then status)
    is 'active' is fined when late, in every cycle of the loan and however
    long it was out.

    A loan's rows may arrive in any order within ``lateness`` (rows later
    than that are dropped by the watermark); a fine is emitted once the
    watermark passes the return. State: the rows the watermark has not passed
    and one row per open loan. Start it inside ``state_store``."""
    out = T.StructType([LOAN_STATUS_SCHEMA[c] for c in ("loan_id", "due_date", "return_date")])
    steps = in_event_order(events, "loan_id", "event_time", lateness, ["status", "due_date", "return_date"], ["status"], out, _fine_step, buckets, shards)
    return _fines(steps)


def _fines(returned: DataFrame) -> DataFrame:
    days = F.datediff("return_date", "due_date")
    return returned.where(days > 0).select("loan_id", fine_amount(days, FINE_PER_DAY).alias("fine_amount"),
                                           F.lit("overdue").alias("fine_reason"), F.lit(False).alias("paid"))


# ---------------------------------------------------------------- ST3
_MEMBER = ["first_name", "last_name", "status"]


def _audit_step(rows: pd.DataFrame, before: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    now, was = rows[_MEMBER].astype(object), before[_MEMBER]
    same = ((now == was) | (now.isna() & was.isna())).all(axis=1)
    hit = before["known"].astype(bool) & ~same
    out = rows.loc[hit, ["member_id", "at_us", "status"]]
    return pd.concat([out, was[hit].add_prefix("old_")], axis=1), np.ones(len(rows), dtype=bool)


def audit_from_member_changes(changes: DataFrame, lateness: str, buckets: int = 32, shards: int = 16) -> DataFrame:
    """Audit rows from a stream of member snapshots (MEMBER_CHANGE_SCHEMA):
    each row that differs (NULL-safe) from the member's row before it by
    event time emits one audit row; the first only sets the state.

    Rows may arrive in any order within ``lateness``; an audit row is emitted
    once the watermark passes its snapshot. State: the rows the watermark has
    not passed and one row per member. Start it inside ``state_store``."""
    text = T.StringType()
    out = T.StructType([T.StructField("member_id", T.LongType()), T.StructField("at_us", T.LongType()), T.StructField("status", text),
                        *(T.StructField(f"old_{c}", text) for c in _MEMBER)])
    steps = in_event_order(changes, "member_id", "event_time", lateness, _MEMBER, _MEMBER, out, _audit_step, buckets, shards)
    parts = {"first": "old_first_name", "last": "old_last_name", "old": "old_status", "new": "status"}
    return steps.select(F.lit("members").alias("table_name"), F.lit("UPDATE").alias("action"), F.col("member_id").alias("record_id"),
                        F.timestamp_micros("at_us").alias("changed_at"), F.lit("SYSTEM").alias("changed_by"),
                        F.format_string(DESC_MEMBER.format(**{k: "%s" for k in parts}), *parts.values()).alias("description"))


# ---------------------------------------------------------------- ST4
def daily_activity(events: DataFrame, ts_col: str = "ts", key_col: str = "event_type",
                   watermark: str = "1 day", window: str = "1 day") -> DataFrame:
    """Event counts per day and key. In append mode a window is emitted once
    the watermark passes its end; rows later than the watermark are
    dropped."""
    ts = F.col(ts_col).cast("timestamp")
    return (events.withColumn("_ts", ts).withWatermark("_ts", watermark)
                  .groupBy(F.window("_ts", window).alias("w"), key_col)
                  .agg(F.count(F.lit(1)).alias("events"))
                  .select(F.col("w.start").alias("day"), key_col, "events"))


class _Months(StatefulProcessor):
    """One month and key: the sum of its days, emitted when the watermark
    passes the month's end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", T.StructType([T.StructField("events", T.LongType()), T.StructField("days", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        events = days = 0
        for frame in rows:
            events, days, end = events + int(frame["events"].sum()), days + len(frame), int(frame["ends_ms"].iloc[0])
        was = self.total.get() if self.total.exists() else (0, 0)
        self.total.update((was[0] + events, was[1] + days))
        self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        events, days = self.total.get()
        self.total.clear()
        yield pd.DataFrame({"month": [key[0]], "key": [key[1]], "events": [events], "days": [days]})

    def close(self) -> None:
        pass


def monthly_activity(events: DataFrame, ts_col: str = "ts", key_col: str = "event_type", lateness: str = "1 day") -> DataFrame:
    """Event counts per calendar month and key (month, key_col, events, days
    with events): the days that ``daily_activity`` emits, summed up in state
    until the watermark passes the month's end. Start it inside
    ``state_store``; rows of days already emitted are dropped, and
    ``late_rows`` gives them."""
    daily = (events.withColumn("event_at", F.col(ts_col).cast("timestamp")).withWatermark("event_at", lateness)
                   .groupBy(F.window("event_at", "1 day").alias("w"), F.col(key_col).alias("key")).agg(F.count(F.lit(1)).alias("events")))
    month = F.trunc(F.to_date("w.start"), "month")
    ends = F.unix_millis(F.add_months(month, 1).cast("timestamp"))
    days = daily.select(F.window_time("w").alias("day_at"), month.cast("string").alias("month"), "key", "events", ends.alias("ends_ms"))
    out = T.StructType([T.StructField("month", T.StringType()), T.StructField("key", T.StringType()), T.StructField("events", T.LongType()),
                        T.StructField("days", T.LongType())])
    months = days.groupBy("month", "key").transformWithStateInPandas(_Months(), out, "Append", "EventTime")
    return months.select(F.col("month").cast("date").alias("month"), F.col("key").alias(key_col), "events", "days")


def late_rows(spark: SparkSession, events: DataFrame, out_dir: str, checkpoint: str, ts_col: str = "ts", lateness: str = "1 day") -> DataFrame:
    """The rows of the stream ``events`` whose day ``daily_activity`` and
    ``monthly_activity`` had already closed when they came, so those dropped
    them: run over the same files in the same micro-batches of one run, it
    compares each row's day with the watermark that Spark drops late rows by,
    that of the batch before last, which it keeps beside the rows (one value
    per epoch, overwritten on replay)."""
    at = F.col(ts_col).cast("timestamp")
    state = lambda epoch: os.path.join(out_dir, "watermark", f"epoch={epoch}")
    schema = "latest timestamp"

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        latest = lambda e: spark.read.schema(schema).parquet(state(e)).first()["latest"] if e >= 0 else None
        before, dropping = latest(epoch_id - 1), latest(epoch_id - 2)
        closed = F.date_add(F.to_date(at), 1).cast("timestamp") <= F.lit(dropping).cast("timestamp") - F.expr(f"interval {lateness}")
        batch.where(closed if dropping is not None else F.lit(False)).write.mode("overwrite").parquet(os.path.join(out_dir, "late", f"epoch={epoch_id}"))
        batch.agg(F.greatest(F.max(at), F.lit(before).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(state(epoch_id))

    events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(os.path.join(out_dir, "late", "epoch=*"))
