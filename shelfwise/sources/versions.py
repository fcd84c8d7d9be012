"""Versioned tables: a keyed update rewrites only the parts that hold changed
keys, and readers see one whole version or the next.

Rows are dealt to a fixed number of parts by their key's hash. A version is a
manifest, one small file naming for each part the folder that holds it; an
update writes the touched parts to a folder of its own and then renames its
manifest into place. Until then readers keep the version before, and a
job that fails leaves only files that no manifest names. Of two writers the
later rename fails. Every version stays readable.

    <path>/data/<version>-<job>/part=<p>/*.parquet
    <path>/manifest/<version>.json        {"key", "parts", "schema", "where": {p: folder}}
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.jobs import apply_update
from shelfwise.sources.manifests import _fs, _manifest, _publish, versions


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(parts)).cast("int")  # one text, whatever type the key came in


def _write(df: DataFrame, path: str, version: int, key: str, parts: int) -> dict[str, str]:
    """Write rows to a new folder; the folder of each part that got rows. A
    part is in one shuffle partition, so it is one file."""
    spark = df.sparkSession
    folder = f"{version}-{uuid.uuid4().hex}"  # of this job alone: a writer that loses overwrites nothing
    partitions = min(parts, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    df.withColumn("part", _part(key, parts)).repartition(partitions, "part").write.partitionBy("part").parquet(f"{path}/data/{folder}")
    fs, p = _fs(spark, f"{path}/data/{folder}")
    return {f.getPath().getName()[5:]: folder for f in fs.listStatus(p) if f.getPath().getName().startswith("part=")}


def create_versioned(df: DataFrame, path: str, key: str, parts: int) -> int:
    """Write ``df`` as version 1. ``parts`` fixes how finely updates can
    rewrite the table; it should leave a part some 100 MB."""
    if "part" in df.columns:
        raise ValueError("the column name part is taken by the layout")
    spark = df.sparkSession
    if versions(spark, path):
        raise ValueError(f"{path} holds a table")
    _publish(spark, path, 1, {"key": key, "parts": parts, "schema": df.schema.json(), "where": _write(df, path, 1, key, parts)})
    return 1


def _read(spark: SparkSession, path: str, manifest: dict, only: list[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    paths = [f"{path}/data/{folder}/part={p}" for p, folder in manifest["where"].items() if only is None or int(p) in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of ``version`` (by default the last one)."""
    return _read(spark, path, _manifest(spark, path, version))


def update_version(spark: SparkSession, path: str, changes: DataFrame) -> int:
    """Apply ``changes`` (the key and the columns to set, as in
    ``jobs.apply_update``; a repeated key is an error, one the table lacks
    changes nothing) as a new version. Reads and writes only the parts that
    the changed keys fall in; no changes, no new version. Returns the current
    version."""
    m = _manifest(spark, path, None)
    key, parts = m["key"], m["parts"]
    changes = changes.where(F.col(key).isNotNull())
    touched = [r["part"] for r in changes.select(_part(key, parts).alias("part")).distinct().collect()]  # at most ``parts`` numbers
    touched = [p for p in touched if str(p) in m["where"]]
    if not touched:
        return m["version"]
    version = m["version"] + 1
    new = apply_update(_read(spark, path, m, touched), changes, key)
    where = m["where"] | _write(new, path, version, key, parts)
    _publish(spark, path, version, {"key": key, "parts": parts, "schema": m["schema"], "where": where})
    return version
