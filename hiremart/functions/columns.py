"""Reusable column expressions.

All of them are compositions of ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiremart.constants import UNKNOWN_LABEL

#: exact type of a salary point: a midpoint of two DECIMAL(18,2) bounds needs
#: one more digit of scale and two more of precision, so nothing is rounded.
SALARY_POINT_TYPE = T.DecimalType(22, 3)



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def empty_to_null(x) -> Column:
    """``''`` → NULL, other values unchanged."""
    return F.nullif(_c(x), F.lit(""))


def text_to_decimal(x, dtype: T.DecimalType = T.DecimalType(18, 2)) -> Column:
    """JSON text of a number → exact decimal; empty text is NULL.

    Under ANSI a malformed number fails the job, as the reference's cast does.
    """
    return empty_to_null(x).cast(dtype)


def text_to_bool(x) -> Column:
    """JSON text of a boolean → BOOLEAN; empty text is NULL."""
    return empty_to_null(x).cast("boolean")


def parse_iso_timestamp(x) -> Column:
    """ISO-8601 text with ``+0300``, ``-05:00`` or ``Z`` → instant (UTC session)."""
    return _c(x).cast(T.TimestampType())


def naive_timestamp(x) -> Column:
    """ISO-8601 text → wall-clock TIMESTAMP_NTZ; the offset is dropped, not applied.

    ``2025-11-11T19:03:31+0300`` keeps ``19:03:31``; NULL stays NULL.  The first
    19 characters are the local date-time whatever the offset's sign.
    """
    return F.to_timestamp_ntz(F.replace(F.substring(_c(x), 1, 19), F.lit("T"), F.lit(" ")))


def salary_point(lo, hi) -> Column:
    """Midpoint when both bounds exist, else whichever exists, else NULL (exact)."""
    lo, hi = _c(lo), _c(hi)
    mid = ((lo + hi).cast(T.DecimalType(20, 3)) * F.lit(0.5).cast(T.DecimalType(2, 1)))
    return (F.when(lo.isNotNull() & hi.isNotNull(), mid.cast(SALARY_POINT_TYPE))
            .otherwise(F.coalesce(lo, hi).cast(SALARY_POINT_TYPE)))


def currency_label(x) -> Column:
    """Empty or NULL currency → ``'UNKNOWN'``."""
    return F.coalesce(empty_to_null(x), F.lit(UNKNOWN_LABEL))


def month_start(x) -> Column:
    """First day of the month of a DATE (or timestamp) as DATE."""
    return F.trunc(_c(x).cast("date"), "MM")


def day_of_week_sun0(x) -> Column:
    """Day of week with Sunday = 0 … Saturday = 6 (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(_c(x)) - F.lit(1)).cast("int")


def iso_week(x) -> Column:
    """ISO-8601 week number."""
    return F.weekofyear(_c(x)).cast("int")


def surrogate_key(*cols) -> Column:
    """Deterministic 64-bit surrogate key: stable under task retry, no global sort."""
    return F.xxhash64(*[_c(c) for c in cols])


def safe_ratio(num, den) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL (ANSI ``/`` would raise)."""
    num, den = _c(num), _c(den)
    return F.when(den == 0, F.lit(None).cast("double")).otherwise(
        num.cast("double") / den.cast("double"))


def round_half_up(x, digits: int = 6) -> Column:
    """``floor(x · 10^d + 0.5) / 10^d`` as DOUBLE.

    Spelled out (rather than ``round``) so that any engine doing the same IEEE
    operations gets the same bits: used where a mean of floating-point means
    depends on summation order and is reported at fixed precision.
    """
    scale = float(10 ** digits)
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
