"""Copies on loan as stream state: who gets a copy that several requests ask
for, without reading the loans again.

State is grouped in buckets of copies and, inside, in shards that hold a sorted
array of held copies each; a micro-batch touches the shards of the copies it
names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the state processor reaches executors that don't have this package

_OUT = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("member_id", T.LongType()), T.StructField("copy_id", T.LongType()),
                     T.StructField("rejection", T.StringType()), T.StructField("accepted", T.BooleanType())])


class _Held(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", T.StructType([T.StructField("shard", T.LongType())]), T.StructType([T.StructField("copies", T.BinaryType())]))

    def _get(self, shard: int) -> np.ndarray:
        was = self.held.getValue((shard,))
        return np.empty(0, dtype=np.int64) if was is None else np.frombuffer(bytes(was[0]), dtype="<i8")

    def _put(self, shard: int, copies: np.ndarray) -> None:
        if len(copies):
            self.held.updateValue((shard,), (np.sort(copies).astype("<i8").tobytes(),))
        else:
            self.held.removeKey((shard,))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for shard, part in initialState.groupby("state_shard"):
            self._put(int(shard), np.union1d(self._get(int(shard)), part["copy_id"].to_numpy(dtype=np.int64)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["at", "request_id"], kind="stable", ignore_index=True)
        shards = frame["state_shard"].unique().tolist()
        before = {s: self._get(s) for s in shards}
        held = np.concatenate(list(before.values()))
        back = (frame["kind"] == "return").to_numpy()
        # a copy's rows between two returns: the first admitted request gets it, unless it was on loan when the batch began
        frame["given_back"] = back
        turn = frame.groupby("copy_id")["given_back"].cumsum().to_numpy()
        free = (turn > 0) | ~frame["copy_id"].isin(held).to_numpy()
        asks = ~back & frame["rejection"].isna().to_numpy() & free
        wins = asks.copy()
        wins[asks] = ~pd.DataFrame({"copy": frame.loc[asks, "copy_id"], "turn": turn[asks]}).duplicated().to_numpy()
        frame["accepted"] = wins

        named = frame["copy_id"].unique()
        last = pd.Series(turn).groupby(frame["copy_id"].to_numpy()).max()
        taken = frame.loc[wins, "copy_id"][turn[wins] == last.reindex(frame.loc[wins, "copy_id"]).to_numpy()].to_numpy(dtype=np.int64)
        kept = np.array([c for c in held[np.isin(held, named)].tolist() if last[c] == 0], dtype=np.int64)
        on_loan = np.union1d(taken, kept)
        of_shard = frame.drop_duplicates("copy_id").set_index("copy_id")["state_shard"]
        for s in shards:
            mine = on_loan[of_shard.reindex(on_loan).to_numpy() == s]
            after = np.union1d(before[s][~np.isin(before[s], named)], mine)
            if not np.array_equal(after, before[s]):
                self._put(s, after)
        out = frame.loc[~back, _OUT.fieldNames()]
        if len(out):
            yield out

    def close(self) -> None:
        pass


def held_copies(rows: DataFrame, base: DataFrame, buckets: int, shards: int) -> DataFrame:
    """The stream ``rows`` (kind loan or return, request_id, member_id,
    copy_id, at, rejection) with ``accepted`` for its loan rows: a request
    that is not rejected gets its copy if no earlier one holds it. ``base``:
    copies (copy_id) held when the stream first starts. Rows without a copy
    are never accepted. ``buckets`` times ``shards`` should leave some
    hundred held copies to a shard."""
    rows, base = (df.withColumn("copy_id", F.col("copy_id").cast("long")) for df in (rows, base))  # one type, one hash
    place = F.pmod(F.xxhash64("copy_id"), F.lit(buckets * shards).cast("long"))
    keys = (place % buckets).alias("state_bucket"), F.floor(place / buckets).alias("state_shard")
    copy = F.coalesce("copy_id", F.lit(-1).cast("long"))
    lost = F.coalesce(F.col("rejection"), F.when(F.col("copy_id").isNull(), F.lit("No copy given")))
    keyed = rows.where("kind = 'loan' or copy_id is not null").select(
        "kind", F.coalesce("request_id", F.lit(-1).cast("long")).alias("request_id"), F.coalesce("member_id", F.lit(-1).cast("long")).alias("member_id"),
        copy.alias("copy_id"), F.unix_micros("at").alias("at"), F.when(F.col("kind") == "loan", lost).alias("rejection"), *keys)
    start = base.where("copy_id is not null").select("copy_id", *keys).groupBy("state_bucket")
    out = keyed.groupBy("state_bucket").transformWithStateInPandas(_Held(), _OUT, "Append", "None", start)
    none = lambda c: F.nullif(c, F.lit(-1).cast("long")).alias(c)
    return out.select(none("request_id"), none("member_id"), none("copy_id"), "rejection", "accepted")
