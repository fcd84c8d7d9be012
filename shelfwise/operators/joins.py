"""Join operators. Physical strategy (broadcast / sort-merge / shuffle-hash)
is left to Catalyst and AQE, which broadcast only sides whose measured size
is under the threshold and split skewed partitions otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(left: DataFrame, right: DataFrame, left_keys, right_keys) -> Column:
    conds = [left[a] == right[b] for a, b in zip(left_keys, right_keys)]
    return reduce(lambda a, b: a & b, conds)


def left_join_on(left: DataFrame, right: DataFrame, keys, extra: Column | None = None,
                 right_filter: Column | None = None) -> DataFrame:
    """LEFT JOIN ... ON key AND <predicate on the right side>. The predicate
    filters the right side before the join (it must not become a WHERE after
    the join, which would drop the unmatched left rows)."""
    if right_filter is not None:
        right = right.where(right_filter)
    return left.join(right, keys, "left")


def anti_join(left: DataFrame, right: DataFrame, left_keys, right_keys=None) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` (LEFT JOIN .. IS NULL,
    NOT EXISTS, NOT IN over a non-null key)."""
    right_keys = right_keys or left_keys
    if isinstance(left_keys, str):
        left_keys, right_keys = [left_keys], [right_keys]
    r = right.select(*[F.col(k).alias(f"_aj_{i}") for i, k in enumerate(right_keys)])
    cond = reduce(lambda a, b: a & b, [left[k] == r[f"_aj_{i}"] for i, k in enumerate(left_keys)])
    return left.join(r, cond, "left_anti")


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """SQL ``left_col NOT IN (SELECT right_col FROM right)`` with its NULL
    rules: an empty list keeps every row; a NULL in the list keeps none; a
    NULL on the left is kept only when the list is empty.

    Written as a plain anti join plus two EXISTS scalars, so it plans as a
    hash or sort-merge anti join at any size (SQL NOT IN plans a null-aware
    anti join that needs a broadcast side).
    """
    rk = right.select(F.col(right_col).alias("_ni_k"))
    nonempty = rk.exists()
    has_null = rk.where(F.col("_ni_k").isNull()).exists()
    anti = left.join(rk.where(F.col("_ni_k").isNotNull()), left[left_col] == F.col("_ni_k"),
                     "left_anti")
    return anti.where(~nonempty | (F.col(left_col).isNotNull() & ~has_null))


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """FULL OUTER JOIN on ``keys`` with the key columns coalesced, which is
    what a UNION of two mirrored LEFT JOINs computes. NULL keys never match
    and stay as separate rows, as in the UNION form."""
    l = left.select(*[F.col(k).alias(f"_fl_{k}") for k in keys],
                    *[c for c in left.columns if c not in keys])
    r = right.select(*[F.col(k).alias(f"_fr_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [l[f"_fl_{k}"] == r[f"_fr_{k}"] for k in keys])
    j = l.join(r, cond, "full_outer")
    return j.select(*[F.coalesce(f"_fl_{k}", f"_fr_{k}").alias(k) for k in keys],
                    *[c for c in j.columns if not c.startswith(("_fl_", "_fr_"))])


def shared_key_members(df: DataFrame, key: str, id_col: str, min_size: int = 2,
                       size_name: str = "group_size", unique_ids: bool = True) -> DataFrame:
    """Rows whose ``key`` (non-NULL) is shared with at least one other row of
    a different ``id_col``, tagged with the number of distinct ids sharing it.

    This is the linear form of the self-join ``a.key = b.key AND a.id <> b.id``:
    the pair list grows with the square of a group (one address or nation
    holding a large share of rows would emit billions of pairs); every pair
    is recoverable from this output as (a, b) for a != b within one key.
    With ``unique_ids`` (``id_col`` is a key of ``df``) group sizes are a
    map-side combined count, so a hot key costs one row per map task; without
    it the ids are deduplicated first.
    """
    d = df.where(F.col(key).isNotNull())
    sizes = d.groupBy(key).agg((F.count if unique_ids else F.countDistinct)(id_col).alias(size_name)) \
             .where(F.col(size_name) >= min_size)
    return d.join(sizes, key, "inner")
