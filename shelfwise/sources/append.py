"""Appends: defaults for omitted columns, dense ids, validation, write."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import quality
from shelfwise.operators.windows import with_position
from shelfwise.session import materialize
from shelfwise.sources import keyindex


def apply_defaults(df: DataFrame, table: str, as_of: dt.date, as_of_ts: dt.datetime | None = None) -> DataFrame:
    """Add declared defaults for columns the input omits. A column that is
    present keeps its values, explicit NULLs included. ``as_of`` is the load
    date (never the wall clock); the load time defaults to its midnight."""
    schema = schemas.SCHEMAS[table]
    stamp = as_of_ts if as_of_ts is not None else dt.datetime.combine(as_of, dt.time())
    for col, default in schemas.DEFAULTS.get(table, {}).items():
        if col in df.columns:
            continue
        v = F.lit({"as_of": as_of, "as_of_ts": stamp}.get(default, default))
        df = df.withColumn(col, v.cast(schema[col].dataType))
    return df


def assign_ids(df: DataFrame, order_cols, name: str, start=1) -> DataFrame:
    """Dense ids ``start, start+1, ...`` in ``order_cols`` order (must be
    unique). Range partitions + per-partition counts + offsets: no global
    single-task row_number, no gaps (unlike monotonically_increasing_id)."""
    s = start if isinstance(start, Column) else F.lit(start)
    pos = with_position(df, list(order_cols), name="_id_pos")
    return pos.withColumn(name, (s + F.col("_id_pos") - 1).cast("long")).drop("_id_pos")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table`` in declared order; omitted
    columns without a default are NULL, as in an INSERT."""
    schema = schemas.SCHEMAS[table]
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _index(index: str, key: list[str]) -> str:
    return f"{index.rstrip('/')}/{'-'.join(key)}"


#: keys of a part of an index that is laid out by the table's rows
PART_KEYS = 1 << 18


def index_keys(existing: DataFrame, table: str, index: str, expected: int | None = None, parts: int | None = None) -> None:
    """Build the key indexes of ``table`` (primary key and UNIQUE keys) under
    the new folder ``index``, for appends that don't read the table. Unless
    said, it is laid out for twice the rows of ``existing``, with a part for
    each ``PART_KEYS`` of them (8 at least)."""
    expected = expected or max(1 << 20, 2 * existing.count())
    parts = parts or max(8, -(-expected // PART_KEYS))
    for key in [schemas.PRIMARY_KEYS[table], *schemas.UNIQUE_KEYS.get(table, [])]:
        keyindex.create_index(conform(existing, table), _index(index, key), key, expected, parts)


def taken_keys(df: DataFrame, index: str, key: list[str]) -> DataFrame:
    """The distinct keys of ``df`` that the indexed table holds."""
    return keyindex.taken(df, _index(index, key))


def append_rows(df: DataFrame, table: str, path: str, as_of: dt.date, parents: dict[str, DataFrame] | None = None,
                existing: DataFrame | None = None, as_of_ts: dt.datetime | None = None, order_cols=None, index: str | None = None):
    """Literal-rows insert as a validated append: defaults -> ids after the
    current maximum -> quality rules -> append. Returns (written rows,
    violations by rule); nothing is written when a rule fails.

    ``parents`` are the tables that foreign keys of ``table`` refer to; a
    missing one is an error, as its rule could not run. Ids follow
    ``order_cols``, which must be unique in the input (by default all its
    columns, and repeated rows are refused). The new rows are written once to
    the checkpoint folder, so the rules and the append read the same rows.
    Only the new rows are checked. For keys ``existing`` is consulted, or the
    key indexes under ``index`` (``index_keys``): then the old table isn't read,
    and the indexes take in the new keys."""
    if existing is not None and index is not None:
        raise ValueError("either existing or index")
    spark = df.sparkSession
    needed = {par for child, _, par, _, _ in schemas.FOREIGN_KEYS if child == table}
    if missing := needed - set(parents or {}):
        raise ValueError(f"tables of foreign keys are missing: {sorted(missing)}")
    pk = schemas.PRIMARY_KEYS[table][0]
    df = apply_defaults(df, table, as_of, as_of_ts)
    if pk not in df.columns:
        start = (existing.select(F.coalesce(F.max(pk), F.lit(0)) + 1).scalar()
                 if existing is not None else F.lit(1 if index is None else (keyindex.top(spark, _index(index, [pk])) or 0) + 1))
        df = assign_ids(df, list(order_cols or df.columns), pk, start)
    df = materialize(conform(df, table))
    tables = {**(parents or {}), table: df}
    bad = quality.violated(tables, table)
    keys = [schemas.PRIMARY_KEYS[table], *schemas.UNIQUE_KEYS.get(table, [])]
    if existing is not None or index is not None:
        for key in keys:
            held = existing.select(*key) if existing is not None else keyindex.taken(df, _index(index, key))
            taken = df.join(held, key, "left_semi")  # NULLs never collide
            if not taken.isEmpty():
                bad.setdefault("pk" if key == schemas.PRIMARY_KEYS[table] else f"unique_{'_'.join(key)}", taken)
    if not bad:
        opened = [(at, keyindex.reserve(df, at)) for at in (_index(index, key) for key in keys)] if index is not None else []
        df.write.mode("append").parquet(path)
        for at, batch in opened:
            keyindex.commit(spark, at, batch)
    return df, bad


def append_from(df: DataFrame, table: str, path: str) -> DataFrame:
    """INSERT ... SELECT: append an already shaped DataFrame (omitted columns
    are NULL). Returns the appended rows."""
    out = materialize(conform(df, table))
    out.write.mode("append").parquet(path)
    return out
