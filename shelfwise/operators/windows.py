"""Window operators.

Partitioned windows (``rank_within``, ``top_n_within``) use Spark windows
directly: a rank filter becomes ``WindowGroupLimit`` (partial top-n before the
shuffle), so a hot group is cut on the map side.

Windows with no PARTITION BY (global RANK, running sums, ROWS frames over the
whole table) would run in one task in plain Spark. Their scale forms here
never do: the order key is pre-aggregated (a hot value collapses to one row),
range-partitioned, and each range partition computes local results; the
per-partition totals (one row per partition, a proven bound) become offsets.
The same machinery gives positions within a group that survive a group
holding a large share of the rows, which the positional LAG uses.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

_PID, _LOC = "_sw_pid", "_sw_loc"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _null_safe_on(left: DataFrame, right: DataFrame, cols):
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _join_back(left: DataFrame, right: DataFrame, cols, how="inner") -> DataFrame:
    """Join on ``cols`` null-safely and keep one copy of the key columns."""
    if not cols:
        raise ValueError("join keys required")
    r = right.select(*[F.col(c).alias(f"_sw_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    conds = [left[c].eqNullSafe(r[f"_sw_r_{c}"]) for c in cols]
    out = left.join(r, reduce(lambda a, b: a & b, conds), how)
    return out.drop(*[f"_sw_r_{c}" for c in cols])


#: rows of a few columns that a task sorts and aggregates in some 100 MB
TASK_ROWS = 500_000


def partitions_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """Partitions of at most about ``rows`` rows of ``df`` (a table scan: its
    rows are counted from the files' footers), no fewer than the session has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


# ---------------------------------------------------------------- positions
def _ranged(df: DataFrame, keys) -> DataFrame:
    """``df`` dealt and sorted by ``keys``, with the number of its range
    partition and its place there as written columns.

    The frame is written once (reliable checkpoint): its readers need
    different columns, and a range exchange planned once per reader would
    sample other boundaries for each, so their partition numbers would not
    agree. Written, the numbers are a property of the row: column pruning,
    coalescing and recomputation cannot change them.
    """
    pid = F.spark_partition_id()
    return materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn(_PID, pid)
                         .withColumn(_LOC, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)))


def with_position(df: DataFrame, order_cols, group_cols=(), name: str = "pos") -> DataFrame:
    """1-based row position within ``group_cols`` in ``order_cols`` order.

    ``group_cols + order_cols`` must be unique (end the order with a key), so
    the order is total and recomputation after a lost executor gives the
    same numbers. No task ever holds more than one range partition.
    """
    group_cols = list(group_cols)
    ranged = _ranged(df, [F.col(g) for g in group_cols] + [_col(o) for o in order_cols])
    stats = ranged.groupBy(_PID, *group_cols).agg(F.min(_LOC).alias("_sw_start"),
                                                   F.count(F.lit(1)).alias("_sw_n"))
    w = (Window.partitionBy(*group_cols).orderBy(_PID)
         .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.select(_PID, *group_cols, "_sw_start",
                         F.coalesce(F.sum("_sw_n").over(w), F.lit(0)).alias("_sw_before"))
    if not group_cols:
        # one row per range partition: a proven small side
        stats = F.broadcast(stats)
    out = _join_back(ranged, stats, [_PID, *group_cols])
    return (out.withColumn(name, F.col("_sw_before") + F.col(_LOC) - F.col("_sw_start") + 1)
               .drop(_PID, _LOC, "_sw_start", "_sw_before"))


def cumulative_sums(df: DataFrame, order_cols, sum_cols, group_cols=(),
                    suffix: str = "_cum", bounded: bool = False) -> DataFrame:
    """Inclusive prefix sums of ``sum_cols`` in ``order_cols`` order (within
    ``group_cols``). ``group_cols + order_cols`` must be unique.

    ``bounded=True`` declares that ``df`` has a size bound independent of
    the data volume (e.g. one row per calendar day, or per distinct count
    value); then a plain window does it in fewer stages."""
    group_cols = list(group_cols)
    if bounded:
        w = (Window.partitionBy(*group_cols).orderBy(*[_col(o) for o in order_cols])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.select("*", *[F.sum(c).over(w).alias(c + suffix) for c in sum_cols])
    ranged = _ranged(df, [F.col(g) for g in group_cols] + [_col(o) for o in order_cols])
    wl = (Window.partitionBy(_PID, *group_cols).orderBy(_LOC)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(c).over(wl).alias(f"_sw_l_{c}") for c in sum_cols])
    totals = ranged.groupBy(_PID, *group_cols).agg(*[F.sum(c).alias(f"_sw_t_{c}") for c in sum_cols])
    wo = (Window.partitionBy(*group_cols).orderBy(_PID)
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(_PID, *group_cols, *[
        F.coalesce(F.sum(f"_sw_t_{c}").over(wo), F.lit(0)).alias(f"_sw_o_{c}") for c in sum_cols])
    if not group_cols:
        offsets = F.broadcast(offsets)  # one row per range partition
    out = _join_back(local, offsets, [_PID, *group_cols])
    for c in sum_cols:
        out = out.withColumn(c + suffix, F.col(f"_sw_l_{c}") + F.col(f"_sw_o_{c}"))
    return out.drop(_PID, _LOC, *[f"_sw_l_{c}" for c in sum_cols], *[f"_sw_o_{c}" for c in sum_cols])


# ---------------------------------------------------------------- global ranks
def global_ranks(df: DataFrame, order_col: str, ascending: bool = True,
                 rank: str | None = "rank", dense_rank: str | None = None,
                 percent_rank: str | None = None, bounded_keys: bool = False) -> DataFrame:
    """RANK / DENSE_RANK / PERCENT_RANK over the whole frame ordered by one
    column (NULLs first ascending, last descending, as Spark orders them).

    Histogram of the order key (map-side combined, so a hot value is one
    row) -> prefix counts over distinct values -> join back on the value.
    ``bounded_keys=True`` declares the number of distinct keys bounded
    independently of the data (e.g. per-member counts: n distinct counts
    need at least 1 + 2 + ... + n rows, so at most sqrt(2 * rows) of them).
    """
    hist = (df.groupBy(order_col).agg(F.count(F.lit(1)).alias("_sw_n"))
              .withColumn("_sw_one", F.lit(1)))
    o = F.col(order_col).asc_nulls_first() if ascending else F.col(order_col).desc_nulls_last()
    cum = cumulative_sums(hist, [o], ["_sw_n", "_sw_one"], bounded=bounded_keys)
    cols = [F.col(order_col)]
    if rank or percent_rank:
        cols.append((F.col("_sw_n_cum") - F.col("_sw_n") + 1).alias("_sw_rank"))
    if dense_rank:
        cols.append(F.col("_sw_one_cum").alias(dense_rank))
    out = _join_back(df, cum.select(*cols), [order_col])
    if percent_rank:
        total = df.select(F.count(F.lit(1))).scalar()
        out = out.withColumn(percent_rank, F.when(total > 1, (F.col("_sw_rank") - 1).cast("double")
                                                  / (total - 1).cast("double")).otherwise(F.lit(0.0)))
    if rank:
        out = out.withColumnRenamed("_sw_rank", rank)
    else:
        out = out.drop("_sw_rank")
    return out


def running_total(df: DataFrame, order_col: str, value_col: str, name: str,
                  group_cols=(), bounded_keys: bool = False) -> DataFrame:
    """SUM(value) OVER (PARTITION BY group ORDER BY order_col) with the
    default RANGE frame: rows with equal order values share one total.
    ``bounded_keys=True``: the distinct order values are bounded (e.g.
    calendar days), so the per-value table is summed with a plain window."""
    group_cols = list(group_cols)
    per_key = df.groupBy(*group_cols, order_col).agg(F.sum(value_col).alias("_sw_v"))
    cum = cumulative_sums(per_key, [F.col(order_col).asc_nulls_first()], ["_sw_v"], group_cols,
                          bounded=bounded_keys)
    cum = cum.select(*group_cols, order_col, F.col("_sw_v_cum").alias(name))
    return _join_back(df, cum, [*group_cols, order_col])


def moving_average_rows(df: DataFrame, order_cols, value_col: str, preceding: int,
                        name: str) -> DataFrame:
    """AVG(value) OVER (ORDER BY ... ROWS BETWEEN n PRECEDING AND CURRENT ROW)
    over the whole frame. Each row contributes to the next ``preceding``
    positions (a fixed fan-out), then an equi-aggregate per position."""
    pos = with_position(df, order_cols, name="_sw_pos")
    contrib = pos.select(
        F.explode(F.sequence(F.col("_sw_pos"), F.col("_sw_pos") + F.lit(preceding))).alias("_sw_pos"),
        F.col(value_col).alias("_sw_v"))
    avg = contrib.groupBy("_sw_pos").agg(F.avg("_sw_v").alias(name))
    return pos.join(avg, "_sw_pos").drop("_sw_pos")


def moving_average_range(df: DataFrame, date_col: str, value_col: str, days: int, name: str,
                         group_cols=()) -> DataFrame:
    """AVG(value) OVER (ORDER BY date RANGE BETWEEN INTERVAL n DAYS PRECEDING
    AND CURRENT ROW), optionally per group: each row contributes to the
    next ``days`` calendar days, then one aggregate per (group, day); days
    absent from the input stay absent from the average."""
    group_cols = list(group_cols)
    contrib = df.select(*group_cols,
                        F.explode(F.sequence(F.col(date_col), F.date_add(F.col(date_col), days))).alias(date_col),
                        F.col(value_col).alias("_sw_v"))
    avg = contrib.groupBy(*group_cols, date_col).agg(F.avg("_sw_v").alias(name))
    return _join_back(df, avg, [*group_cols, date_col])


def lag_columns(df: DataFrame, group_cols, order_cols, value_cols, prefix: str = "prev_",
                offset: int = 1, method: str = "position") -> DataFrame:
    """LAG(value, offset) OVER (PARTITION BY group ORDER BY order) for each
    value column, named ``prefix + column``.

    ``method='position'`` takes LAG within range partitions and patches the
    first row of each from the partition before (for offsets over 1 it joins
    positions), so no group lands in one task; ``method='window'`` is the plain window, fine when groups are small.
    ``group_cols + order_cols`` must be unique.
    """
    group_cols = list(group_cols)
    if method == "window":
        w = Window.partitionBy(*group_cols).orderBy(*[_col(o) for o in order_cols])
        return df.select("*", *[F.lag(v, offset).over(w).alias(prefix + v) for v in value_cols])
    if offset != 1:
        pos = with_position(df, order_cols, group_cols, name="_sw_pos")
        prev = pos.select(*group_cols, (F.col("_sw_pos") + offset).alias("_sw_pos"),
                          *[F.col(v).alias(prefix + v) for v in value_cols])
        return _join_back(pos, prev, [*group_cols, "_sw_pos"], how="left").drop("_sw_pos")
    ranged = _ranged(df, [F.col(g) for g in group_cols] + [_col(o) for o in order_cols])
    inside = Window.partitionBy(_PID, *group_cols).orderBy(_LOC)
    vals = F.struct(*[F.col(v) for v in value_cols])
    rows = ranged.withColumn("_sw_prev", F.lag(vals).over(inside))
    # only the first row of a (partition, group) takes its value from another
    # partition: the last row of the group's partition before
    ends = ranged.groupBy(_PID, *group_cols).agg(F.max_by(vals, _LOC).alias("_sw_end"))
    before = Window.partitionBy(*group_cols).orderBy(_PID)
    carry = ends.select(_PID, *group_cols, F.lag("_sw_end").over(before).alias("_sw_carry"))
    if not group_cols:
        carry = F.broadcast(carry)  # one row per range partition
    out = _join_back(rows, carry, [_PID, *group_cols])
    prev = F.coalesce("_sw_prev", "_sw_carry")
    return out.select(*df.columns, *[prev[v].alias(prefix + v) for v in value_cols])


# ---------------------------------------------------------------- partitioned
def rank_within(df: DataFrame, group_cols, order_cols, name: str = "rank",
                kind: str = "rank") -> DataFrame:
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[kind]
    w = Window.partitionBy(*group_cols).orderBy(*[_col(o) for o in order_cols])
    return df.withColumn(name, fn().over(w))


def top_n_within(df: DataFrame, group_cols, order_cols, n: int, name: str = "rank",
                 kind: str = "rank") -> DataFrame:
    """Rows whose rank within the group is <= n (RANK keeps ties, so a group
    can return more than n). The filter lets Catalyst insert a partial
    WindowGroupLimit before the shuffle."""
    return rank_within(df, group_cols, order_cols, name, kind).where(F.col(name) <= n)


def first_per_group(df: DataFrame, group_cols, order_cols, value_cols,
                    latest: bool = True) -> DataFrame:
    """Values of the first (or latest) row per group by ``order_cols``, as an
    aggregate (``max_by`` / ``min_by`` of a struct): partial aggregation on
    the map side, so a hot group is not sent whole to one task."""
    key = F.struct(*[_col(o) for o in order_cols])
    val = F.struct(*[F.col(v) for v in value_cols])
    pick = F.max_by(val, key) if latest else F.min_by(val, key)
    return (df.groupBy(*group_cols).agg(pick.alias("_sw_pick"))
              .select(*group_cols, *[F.col(f"_sw_pick.{v}").alias(v) for v in value_cols]))
