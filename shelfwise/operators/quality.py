"""Constraints re-aimed as data-quality checks. Each returns the violating
rows (or one summary row). NULL passes a CHECK, allowed-value or foreign-key
test, as in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise import schemas


def _any_null(cols):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def check_pk(df: DataFrame, cols, count_name: str = "row_count") -> DataFrame:
    """Primary key: key values held by more than one row, and NULL keys.
    One row per offending key with its row count and the reason."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_name))
    return (g.where((F.col(count_name) > 1) | _any_null(cols))
             .withColumn("reason", F.when(_any_null(cols), F.lit("null key")).otherwise(F.lit("duplicate"))))


def check_unique(df: DataFrame, cols, count_name: str = "row_count") -> DataFrame:
    """UNIQUE: duplicate non-NULL key values (NULLs never collide)."""
    g = df.where(~_any_null(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias(count_name))
    return g.where(F.col(count_name) > 1)


def check_not_null(df: DataFrame, cols, summary: bool = False) -> DataFrame:
    """NOT NULL: rows with a NULL in any of ``cols``, or (summary) one row
    of NULL counts per column computed in one pass."""
    if summary:
        return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return df.where(_any_null(cols))


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign key: child rows whose non-NULL key has no parent."""
    p = parent.select(F.col(pk).alias("_fk_pk"))
    c = child.where(F.col(fk).isNotNull())
    return c.join(p, c[fk] == p["_fk_pk"], "left_anti")


def check_values(df: DataFrame, col: str, allowed) -> DataFrame:
    """Allowed values (ENUM): rows whose non-NULL value is outside the set."""
    return df.where(~F.col(col).isin(list(allowed)))


def check_length(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """VARCHAR(n): rows whose value is longer than ``max_len`` characters."""
    return df.where(F.char_length(col) > max_len)


def check_expr(df: DataFrame, expr: str) -> DataFrame:
    """CHECK (expr): rows where the expression is FALSE (NULL passes)."""
    return df.where(~F.expr(expr))


def summary(df: DataFrame, not_null=(), checks=None, allowed=None) -> DataFrame:
    """All row-level rules counted in a single scan (one output row)."""
    parts = [F.count_if(F.col(c).isNull()).cast("long").alias(f"null_{c}") for c in not_null]
    for name, expr in (checks or {}).items():
        parts.append(F.count_if(~F.expr(expr)).cast("long").alias(f"check_{name}"))
    for c, vals in (allowed or {}).items():
        parts.append(F.count_if(~F.col(c).isin(list(vals))).cast("long").alias(f"values_{c}"))
    parts.append(F.count(F.lit(1)).alias("row_total"))
    return df.agg(*parts)


def check_table(tables: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Every declared rule of one library table, by rule name."""
    df = tables[name]
    out = {"pk": check_pk(df, schemas.PRIMARY_KEYS[name])}
    req = [f.name for f in schemas.SCHEMAS[name].fields if not f.nullable]
    out["not_null"] = check_not_null(df, req)
    for cols in schemas.UNIQUE_KEYS.get(name, []):
        out["unique_" + "_".join(cols)] = check_unique(df, cols)
    for child, fk, parent, pk, _ in schemas.FOREIGN_KEYS:
        if child == name and parent in tables:
            out[f"fk_{fk}"] = check_fk(df, fk, tables[parent], pk)
    for (t, c), vals in schemas.ALLOWED_VALUES.items():
        if t == name:
            out[f"values_{c}"] = check_values(df, c, vals)
    for (t, c), n in schemas.MAX_LENGTHS.items():
        if t == name:
            out[f"length_{c}"] = check_length(df, c, n)
    for i, expr in enumerate(schemas.CHECKS.get(name, [])):
        out[f"check_{i}"] = check_expr(df, expr)
    return out


def violated(tables: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """The declared rules of one table that fail, with their violations. All
    row-level rules (NOT NULL, allowed values, lengths, CHECKs) are counted in
    one pass; key rules run one by one, as each needs its own shuffle."""
    rules = check_table(tables, name)
    req = [f.name for f in schemas.SCHEMAS[name].fields if not f.nullable]
    broken = {"not_null": _any_null(req)}
    broken |= {f"values_{c}": ~F.col(c).isin(list(v)) for (t, c), v in schemas.ALLOWED_VALUES.items() if t == name}
    broken |= {f"length_{c}": F.char_length(c) > n for (t, c), n in schemas.MAX_LENGTHS.items() if t == name}
    broken |= {f"check_{i}": ~F.expr(e) for i, e in enumerate(schemas.CHECKS.get(name, []))}
    counts = tables[name].agg(*[F.count_if(cond).alias(rule) for rule, cond in broken.items()]).first().asDict()
    return {rule: df for rule, df in rules.items() if (counts[rule] > 0 if rule in counts else not df.isEmpty())}
