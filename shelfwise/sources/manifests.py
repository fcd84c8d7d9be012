"""Numbered manifests: small files that name what of a folder counts, put in
place by a rename, so that readers see one whole version or the next."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the table, ascending."""
    fs, p = _fs(spark, f"{path}/manifest")
    if not fs.exists(p):
        return []
    return sorted(int(f.getPath().getName()[:-5]) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json"))


def _manifest(spark: SparkSession, path: str, version: int | None) -> dict:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {version if version is not None else ''} of {path}")
    text = spark.read.option("wholetext", True).text(f"{path}/manifest/{version or known[-1]}.json").first()[0]
    return {**json.loads(text), "version": version or known[-1]}


def _publish(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    fs, final = _fs(spark, f"{path}/manifest/{version}.json")
    fs.mkdirs(final.getParent())
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest/.{version}-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(manifest), "utf-8"))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of {path} was written by another job")
