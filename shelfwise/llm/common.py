"""Helpers shared by the corpus operators: scratch tables in the shared
checkpoint folder and connected components of an edge list."""

from __future__ import annotations

import io
import uuid
import zipfile
import zlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark (any store Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in
    ``spark.checkpoint.dir``; every job gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back:
    cuts lineage, and everything derived from it sees the same rows even when
    an executor is lost."""
    return staged(df, name)[0]


def staged(df: DataFrame, name: str, options: dict | None = None) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table this job wrote and no longer reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: rows up to which a table of a few numbers a row (about 50 MB in memory) is broadcast
BROADCAST_ROWS = 1_000_000


def small_or_plain(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it has at most
    ``rows`` rows; beyond that it is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package: a zip of its sources in the
    shared folder, registered once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent).as_posix())
    jvm = spark.sparkContext._jvm
    path = scratch_path(spark, "package") + ".zip"
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def crc_of_id(col: str):
    """crc32 of an id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def py_crc(text: str) -> int:
    return zlib.crc32(text.encode())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node of an undirected edge list.

    ``edges`` has long columns ``a`` and ``b``; self edges, repeats and either
    direction are allowed, rows with a null end are ignored. Returns one row
    per node that has an edge: ``node``, ``root``. Alternating large-star and
    small-star rounds: every round is two map-side combined minima and two
    joins on a node (a hot node is a skewed join that AQE splits); the number
    of edges never grows, and the rounds are logarithmic in the path length.
    Each round is written to the shared folder and the one before it deleted.
    """
    spark = edges.sparkSession
    cur, path = staged(
        edges.where("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def signature(df):
        r = df.agg(F.count(F.lit(1)).alias("n"),
                   F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    seen = signature(cur)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").where("v <> m")
                     .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        new = (large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(small.select("a", F.col("m").alias("b"))).distinct())
        new, new_path = staged(new, "edges")
        now = signature(new)
        drop_path(spark, path)
        cur, path = new, new_path
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    roots = cur.groupBy("b").count().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
