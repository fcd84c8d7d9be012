"""Index definitions re-aimed as data layout. A B-tree on a low-cardinality
filter column becomes a directory partition (partition pruning); one on a
join key becomes bucketing (no shuffle when both sides share it); one on a
range-filtered column becomes sorted files (Parquet row-group min/max let
the scan skip groups). An index over two range-filtered columns becomes a
Z-order, whose files are narrow in either column; an id looked up by equality
gets a Parquet bloom filter."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_layout(df: DataFrame, path: str | None = None, partition_by=(), bucket_by=(),
                 sort_by=(), buckets: int | None = None, table: str | None = None,
                 mode: str = "overwrite") -> None:
    """Write ``df`` partitioned, bucketed and sorted.

    Bucketing needs a catalog table (``table``); for a plain path the rows
    are hash-clustered on ``bucket_by`` instead, which keeps each key in one
    file per partition directory. ``buckets`` is required with
    ``bucket_by`` for a catalog table, as it fixes the number of files for
    good; without a table it may be left to the shuffle partition setting.
    """
    if bucket_by and table is not None and not buckets:
        raise ValueError("a bucketed table needs its number of buckets")
    if bucket_by and table is None:
        df = df.repartition(*([buckets] if buckets else []), *bucket_by)
    if sort_by:
        df = df.sortWithinPartitions(*[*partition_by, *sort_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by and table is not None:
        w = w.bucketBy(buckets, *bucket_by)
        if sort_by:
            w = w.sortBy(*sort_by)
        if path:
            w = w.option("path", path)
        w.format("parquet").saveAsTable(table)
    else:
        w.parquet(path)


def _number(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.NumericType, T.BooleanType)):
        return F.col(col).cast("timestamp").cast("double") if isinstance(kind, T.TimestampNTZType) else F.col(col).cast("double")
    raise ValueError(f"{col}: a Z-order needs numbers, dates or times")


def z_value(df: DataFrame, cols: list[str], bits: int = 8, accuracy: int = 10_000) -> DataFrame:
    """``df`` with ``z_value``: the interleaved bits of each column's place
    among 2^``bits`` equally full ranges (approximate quantiles, all that
    reaches the driver), so skewed columns count as much as even ones. NULLs
    come first."""
    if bits * len(cols) > 62:
        raise ValueError("bits times columns must stay below 63")
    n = 1 << bits
    grid = [i / n for i in range(1, n)]
    cuts = df.agg(*[F.percentile_approx(_number(df, c), grid, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        splits = [float("-inf"), *sorted(set(cuts[i] or [0.0])), float("inf")]
        out = Bucketizer(splits=splits, inputCol=f"z_in{i}", outputCol=f"z_at{i}", handleInvalid="keep").transform(out.withColumn(f"z_in{i}", _number(df, c)))
    z = F.lit(0).cast("long")
    for i, c in enumerate(cols):
        place = F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.least(F.col(f"z_at{i}").cast("long"), F.lit(n - 1))).cast("long")
        for b in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(place, b).bitwiseAND(F.lit(1).cast("long")), b * len(cols) + i))
    return out.withColumn("z_value", z).drop(*[f"z_{x}{i}" for x in ("in", "at") for i in range(len(cols))])


def write_z_order(df: DataFrame, path: str, cols: list[str], files: int, bloom: tuple[str, ...] = (), bits: int = 8, mode: str = "overwrite") -> None:
    """Write ``df`` to ``files`` files clustered on ``cols`` together: a range
    of any one of them touches about files^(1 - 1/len(cols)) files. ``bloom``:
    columns whose row groups get a bloom filter for equality look-ups. A value
    pair held by very many rows, equal ones too, is spread over files by the
    rows' place in the input."""
    spread = F.monotonically_increasing_id() % 64
    ordered = z_value(df, cols, bits).repartitionByRange(files, "z_value", spread).sortWithinPartitions("z_value").drop("z_value")
    w = ordered.write.mode(mode)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
