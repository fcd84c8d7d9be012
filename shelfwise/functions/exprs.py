"""Column-level expressions. All are built-in Spark expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: fine charged per late day.
FINE_PER_DAY = Decimal("0.25")
# Fixed value: default loan period in days.
LOAN_DAYS = 14


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_late(due, ret) -> Column:
    """Signed difference ``ret - due`` in days."""
    return F.datediff(_c(ret), _c(due))


def late_days(due, ret) -> Column:
    """Days late, never negative; NULL when either date is NULL (the NULL
    difference falls through to the ELSE branch)."""
    d = F.datediff(_c(ret), _c(due))
    return F.when(d < 0, F.lit(0)).otherwise(d)


def fine_amount(days, rate: Decimal = FINE_PER_DAY) -> Column:
    """Fine for a number of late days as DECIMAL(10,2); NULL when not late."""
    d = _c(days)
    return F.when(d > 0, (d.cast("decimal(10,0)") * F.lit(rate)).cast("decimal(10,2)"))


def position_in(c, *values) -> Column:
    """1-based position of ``c`` in ``values``; 0 when absent, NULL on NULL
    (custom sort order by an explicit value list)."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), _c(c))


def ratio(num, den, scale: int = 2) -> Column:
    """num / den as a double rounded to ``scale``; NULL when den is 0 or NULL."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den).cast("double")), scale)


def pct(num, den, scale: int = 2) -> Column:
    """100 * num / den as a double rounded to ``scale``; NULL when den is 0."""
    return F.round(F.try_divide(_c(num).cast("double") * F.lit(100.0),
                                _c(den).cast("double")), scale)


def round_ratio(num, den, scale: int = 2, mult: int = 1) -> Column:
    """ROUND(mult * num / den, scale) for integral ``num`` and ``den`` computed
    exactly in integer arithmetic (half away from zero, as ROUND on exact
    decimals does), returned as a double; NULL when ``den`` is 0 or NULL.
    Exact, so the result does not depend on the engine's float rounding."""
    m = 10 ** scale
    n = _c(num).cast("long") * F.lit(mult * m)
    d = F.when(_c(den).cast("long") != 0, _c(den).cast("long"))
    a = F.abs(n) * 2 + d
    b = d * 2
    q = (a - a % b) / b
    return F.signum(n) * q / F.lit(float(m))


def pct_exact(num, den, scale: int = 2) -> Column:
    """100 * num / den rounded exactly (integral inputs); see ``round_ratio``."""
    return round_ratio(num, den, scale, mult=100)


def full_name(first, last) -> Column:
    """``first || ' ' || last``; NULL if either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def same_text(c, value: str, collation: str = "UNICODE_CI_AI") -> Column:
    """String equality under a collation (default: case- and
    accent-insensitive). Plain ``==`` compares binary strings."""
    return F.collate(_c(c), collation) == F.lit(value)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the column functions callable from Spark SQL as temporary SQL
    functions (no Python involved at run time)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_fine_days(due DATE, ret DATE) "
        "RETURNS INT RETURN CASE WHEN datediff(ret, due) < 0 THEN 0 ELSE datediff(ret, due) END")


def has_bit(bits: Column | str, pos: Column | str) -> Column:
    """Whether position ``pos`` (0-32767) of a bitmap of Spark's is set."""
    pos = _c(pos)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(pos / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (pos % 8).cast("int")) == 1
