"""Table scans. Readers pass the declared schema (no inference); Catalyst
prunes columns and pushes filters into the Parquet scan."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

from shelfwise import schemas


def _path(base: str, name: str) -> str:
    p = os.path.join(base, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in base else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one table; library tables get their declared schema."""
    reader = spark.read
    if name in schemas.SCHEMAS:
        reader = reader.schema(schemas.SCHEMAS[name])
    return reader.parquet(_path(base, name))


def load_library(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, base, n) for n in schemas.TABLE_ORDER}


def save_library(tables: dict[str, DataFrame], base: str, mode: str = "overwrite") -> None:
    for name, df in tables.items():
        df.write.mode(mode).parquet(os.path.join(base, name))


def input_version(spark: SparkSession, path: str) -> str:
    """Digest of a table's files (paths, sizes, modification times), whether
    it is one file or a folder of part files, in any store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    parts = []
    while files.hasNext():
        f = files.next()
        parts.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:16]


class DriverTables:
    """Lazy accessor for the driver's parquet tables; nothing is read until a
    table is used, and each scan is created once per session."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self._cache = spark, base, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "base"):
            raise AttributeError(name)
        path = _path(self.base, name)
        version = input_version(self.spark, path)
        if self._cache.get(name, ("",))[0] != version:
            self._cache[name] = (version, self.spark.read.parquet(path))
        return self._cache[name][1]

    __getitem__ = __getattr__


_SCANS: dict[tuple, DriverTables] = {}


def load_driver_tables(spark: SparkSession, base: str) -> DriverTables:
    """Scans of the driver tables, shared by every report of one session:
    the Parquet footer is read once per table, not once per report; a change
    of the files is noticed at the next use."""
    key = (id(spark), spark.sparkContext.applicationId, base)
    if key not in _SCANS:
        _SCANS[key] = DriverTables(spark, base)
    return _SCANS[key]
