"""Keyed rules over rows in event-time order, whatever order they arrive in.

A rule such as "fine a loan that goes from active to returned" needs each
key's rows in order of their event time and the row before each. Rows are held
in list state until the watermark has passed them, released by an event-time
timer, sorted, and stepped through with the key's last row from map state.

State is grouped in buckets of keys: one Python call, one sort and one timer
serve many keys. Held rows are kept as Arrow blobs, one for each batch; the
last rows as one blob for each shard of a bucket's keys, and only the shards
of keys in a release are read and written. What is held is bounded by the
lateness, the map by the keys that a rule still needs.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: step(rows in order with the last status of each key's row before) -> (output rows, which rows' keys stay in the map)
Step = Callable[[pd.DataFrame, pd.DataFrame], tuple[pd.DataFrame, np.ndarray]]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the state processor reaches executors that don't have this package


class _InOrder(StatefulProcessor):
    def __init__(self, key: str, order: list[str], last: list[str], schema: T.StructType, step: Step):
        self.key, self.order, self.last_columns, self.schema, self.step = key, order, last, schema, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.handle = handle
        self.rows = to_arrow_schema(self.schema)
        self.lasts = to_arrow_schema(T.StructType([self.schema[c] for c in (self.key, "state_shard", *self.last_columns)]))
        blob = T.StructType([T.StructField("blob", T.BinaryType())])
        self.held = handle.getListState("held", blob)
        self.last = handle.getMapState("last", T.StructType([T.StructField("shard", T.LongType())]), blob)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = None
        for frame in rows:
            frame = frame.loc[frame[self.key].notna(), self.rows.names]
            if len(frame):
                first = int(frame["at_us"].min())
                low = first if low is None else min(low, first)
                self.held.appendValue((_pack(frame, self.rows),))
        if low is not None:
            self.handle.registerTimer(low // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        frames = [_unpack(x[0]) for x in self.held.get()]
        if not frames or min(f["at_us"].min() for f in frames) > passed:
            return
        rows = pd.concat(frames, ignore_index=True)
        due = rows["at_us"] <= passed
        rest = rows[~due]
        if len(rest):
            self.held.put([(_pack(rest, self.rows),)])
            self.handle.registerTimer(int(rest["at_us"].min()) // 1000)
        else:
            self.held.clear()
        rows = rows[due].sort_values([self.key, "at_us", *self.order], kind="stable", ignore_index=True, na_position="first")
        shards = rows["state_shard"].unique().tolist()
        stored = {s: self.last.getValue((s,)) for s in shards}
        known = [_unpack(x[0]) for x in stored.values() if x is not None]
        known = pd.concat(known, ignore_index=True) if known else self.lasts.empty_table().to_pandas(integer_object_nulls=True)

        keys = rows[self.key]
        starts = (keys != keys.shift()).to_numpy()
        ends = np.append(starts[1:], True)
        before = rows[self.last_columns].astype(object).shift()
        before["known"] = ~starts
        at = pd.Index(known[self.key]).get_indexer(keys[starts])
        here = np.flatnonzero(starts)
        for i, c in enumerate(self.last_columns):
            values = known[c].astype(object).to_numpy()
            before.iloc[here, i] = [values[j] if j >= 0 else None for j in at.tolist()]
        before.iloc[here, -1] = at >= 0
        out, keep = self.step(rows, before)
        now = rows.loc[ends & keep, self.lasts.names]
        after = pd.concat([known[~known[self.key].isin(keys)], now], ignore_index=True) if len(known) else now
        parts = dict(iter(after.groupby("state_shard")))
        for s in shards:
            if s in parts:
                self.last.updateValue((s,), (_pack(parts[s], self.lasts),))
            elif stored[s] is not None:
                self.last.removeKey((s,))
        if len(out):
            yield out

    def close(self) -> None:
        pass


def _pack(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema) as w:
        w.write_table(pa.Table.from_pandas(frame, schema=schema, preserve_index=False))
    return out.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(blob)).read_all().to_pandas(integer_object_nulls=True)


def in_event_order(rows: DataFrame, key: str, time: str, lateness: str, order: list[str], last: list[str], out: T.StructType, step: Step,
                   buckets: int = 32, shards: int = 16) -> DataFrame:
    """``step`` over each key's rows of the stream ``rows`` in order of
    ``time``, ties by ``order``, released once the watermark (latest time less
    ``lateness``) has passed them.

    ``last``: the columns of a key's row that the map keeps. ``step`` gets the
    released rows of a bucket in order, with ``at_us`` (microseconds), and for
    each the columns ``last`` of the row before with ``known`` (False where
    the key has none); it returns output rows and, for each row, whether the
    key stays in the map if that is its last row. Rows with a null key only
    move the watermark on, rows with a null time are left out, and rows later
    than ``lateness`` are dropped by the watermark. ``buckets`` times
    ``shards`` should leave some hundred keys to a shard."""
    named = rows.where(F.col(time).isNotNull()).withWatermark(time, lateness)
    plain = [c for c in rows.columns if c != time]
    place = F.pmod(F.xxhash64(key), F.lit(buckets * shards).cast("long"))
    keyed = named.select(*plain, time, F.unix_micros(time).alias("at_us"), (place % buckets).alias("state_bucket"),
                         F.floor(place / buckets).alias("state_shard"))
    schema = T.StructType([*(rows.schema[c] for c in plain), T.StructField("at_us", T.LongType()), T.StructField("state_shard", T.LongType())])
    return keyed.groupBy("state_bucket").transformWithStateInPandas(_InOrder(key, order, last, schema, step), out, "Append", "EventTime")


@contextlib.contextmanager
def state_store(spark: SparkSession):
    """The state store with the column families that map and list state need,
    for the queries started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
