"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from hiremart.functions.columns import (  # noqa: F401
    currency_label, day_of_week_sun0, empty_to_null, iso_week, month_start,
    naive_timestamp, parse_iso_timestamp, round_half_up, safe_ratio, salary_point,
    surrogate_key, text_to_bool, text_to_decimal, SALARY_POINT_TYPE,
)
