"""Key index: which keys a table holds, without reading the table.

Beside the table lie, by part of the key's hash, its keys and a blocked bloom
filter of them: a key belongs to one block of 32,768 bits and sets HASHES bits
there. New keys are looked up in the blocks of their parts; only the keys that
hit are compared exactly, with the key files of the hits' parts. So a look-up
reads what the new rows touch, and its answer is exact at any load of the
filter: a fuller filter only means more hits to compare (``create_index`` again
with a larger ``expected`` then).

A manifest names the batches that count. ``reserve`` publishes it with a batch
marked as open before the table is appended to, ``commit`` after; whoever finds
an open batch (a job died in between) is told to build the index anew.

    <path>/<batch>/keys/part=<p>/*.parquet      the key columns
    <path>/<batch>/bits/part=<p>/*.parquet      block, bits
    <path>/manifest/<version>.json              {"key", "parts", "blocks", "batches", "open", "top"}
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.exprs import has_bit
from shelfwise.session import materialize
from shelfwise.sources.manifests import _manifest, _publish, versions

#: bits of a block, as Spark's bitmap functions have it
BLOCK_BITS = 32768
#: bits that a key sets; with BITS_PER_KEY about 1 % of absent keys hit
HASHES = 5
BITS_PER_KEY = 10


def _hash(key: list[str], what: int) -> Column:
    # as text, whatever type a key comes in; lengths keep (a, bc) and (ab, c) apart
    return F.xxhash64(F.lit(what), *[c for k in key for c in (F.length(F.col(k).cast("string")), F.col(k).cast("string"))])


def _placed(df: DataFrame, m: dict) -> DataFrame:
    """The distinct non-null keys of ``df`` with part, block and bit positions."""
    key = m["key"]
    keys = df.select(*key).dropna("any").distinct()
    block = F.pmod(_hash(key, 0), F.lit(m["parts"] * m["blocks"]))
    pos = F.array(*[F.pmod(_hash(key, i), F.lit(BLOCK_BITS)) for i in range(1, HASHES + 1)])
    return keys.withColumn("_block", block).withColumn("part", (F.col("_block") % m["parts"]).cast("int")).withColumn("_pos", pos)


def _write_batch(df: DataFrame, path: str, m: dict) -> str:
    batch = f"batch-{uuid.uuid4().hex}"
    # dealt by part once, so that blocks are built where their keys are, each in one place
    placed = materialize(_placed(df, m).drop("_pos").repartition(m["parts"], "part"))
    placed.select(*m["key"], "part").write.partitionBy("part").parquet(f"{path}/{batch}/keys")
    positions = F.explode(F.array(*[F.pmod(_hash(m["key"], i), F.lit(BLOCK_BITS)) for i in range(1, HASHES + 1)])).alias("pos")
    bits = (placed.repartition(m["parts"], "part").select("part", "_block", positions)
                  .groupBy("part", "_block").agg(F.bitmap_construct_agg(F.col("pos")).alias("bits")))
    bits.write.partitionBy("part").parquet(f"{path}/{batch}/bits")
    return batch


def _state(spark: SparkSession, path: str) -> dict:
    m = _manifest(spark, path, None)
    if m["open"]:
        raise RuntimeError(f"an append to the table of {path} didn't end: build its index anew")
    return m


def _next(spark: SparkSession, path: str, m: dict, **changes) -> dict:
    new = {**m, **changes}
    version = new.pop("version") + 1
    _publish(spark, path, version, new)
    return {**new, "version": version}


def create_index(table: DataFrame, path: str, key: list[str], expected: int, parts: int = 64) -> None:
    """Index the keys of ``table`` (one read of its key columns). ``expected``:
    the number of keys the filter is laid out for."""
    spark = table.sparkSession
    if {"part", "_block", "_pos"} & set(key):
        raise ValueError("the column names part, _block and _pos are taken by the index")
    if versions(spark, path):
        raise ValueError(f"{path} holds an index")
    m = {"key": list(key), "parts": parts, "blocks": max(1, math.ceil(expected * BITS_PER_KEY / BLOCK_BITS / parts))}
    integral = len(key) == 1 and table.schema[key[0]].dataType.typeName() in ("byte", "short", "integer", "long")
    top = table.agg(F.max(key[0])).first()[0] if integral else None
    _publish(spark, path, 1, {**m, "batches": [_write_batch(table, path, m)], "open": "", "top": top})


def _read(spark: SparkSession, path: str, m: dict, what: str, parts: list[int]) -> DataFrame | None:
    """Rows of the batches in ``parts`` (partition filter); None if no batch has any."""
    out = None
    for batch in m["batches"]:  # one an append; create the index anew to merge them
        at = f"{path}/{batch}/{what}"
        try:
            df = spark.read.parquet(at)
        except Exception as e:  # an empty batch writes no file to take a schema from
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            continue
        df = df.where(F.col("part").isin(parts))
        out = df if out is None else out.unionByName(df)
    return out


def hits(new: DataFrame, path: str) -> DataFrame:
    """The distinct keys of ``new`` that the filter can't rule out, with their part."""
    spark = new.sparkSession
    m = _state(spark, path)
    placed = materialize(_placed(new, m))
    parts = [r["part"] for r in placed.select("part").distinct().collect()]  # at most ``parts`` numbers
    bits = _read(spark, path, m, "bits", parts) if parts else None
    if bits is None:
        return placed.select(*m["key"], "part").limit(0)
    bits = bits.select(F.col("part").alias("_part"), F.col("_block").alias("_at"), "bits")
    every = F.lit(True)
    for i in range(HASHES):
        every = every & has_bit("bits", F.col("_pos")[i])
    return placed.join(bits, (F.col("part") == F.col("_part")) & (F.col("_block") == F.col("_at")) & every, "left_semi").select(*m["key"], "part")


def taken(new: DataFrame, path: str) -> DataFrame:
    """The distinct keys of ``new`` that the table holds, exactly. Keys with a
    null collide with nothing."""
    spark = new.sparkSession
    m = _state(spark, path)
    found = materialize(hits(new, path))
    parts = [r["part"] for r in found.select("part").distinct().collect()]  # at most ``parts`` numbers
    keys = _read(spark, path, m, "keys", parts) if parts else None
    if keys is None:
        return found.select(*m["key"]).limit(0)
    return found.select(*m["key"]).join(keys.select(*m["key"]), m["key"], "left_semi")


def top(spark: SparkSession, path: str):
    """The highest key of a single integral key, None for an empty table."""
    return _state(spark, path)["top"]


def reserve(new: DataFrame, path: str) -> str:
    """Write the keys of ``new`` as a batch and mark it open."""
    spark = new.sparkSession
    m = _state(spark, path)
    batch = _write_batch(new, path, m)
    best = m["top"]
    if len(m["key"]) == 1 and new.schema[m["key"][0]].dataType.typeName() in ("byte", "short", "integer", "long"):
        best = max((x for x in (best, new.agg(F.max(m["key"][0])).first()[0]) if x is not None), default=None)
    _next(spark, path, m, open=batch, top=best)
    return batch


def commit(spark: SparkSession, path: str, batch: str) -> None:
    """The table holds the rows of ``batch``."""
    m = _manifest(spark, path, None)
    if m["open"] != batch:
        raise RuntimeError(f"{path} doesn't wait for {batch}")
    _next(spark, path, m, batches=[*m["batches"], batch], open="")
