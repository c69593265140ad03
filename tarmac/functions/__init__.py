"""Column expressions: every function maps ``Column``s to a ``Column``.

They are plain compositions of ``pyspark.sql.functions``, so they stay inside
whole-stage codegen; none runs Python per row.
"""

from tarmac.functions.calendar import (
    month_key,
    month_start,
    months_between_predicate,
    previous_month_of,
    raw_month_path,
    year_month,
)
from tarmac.functions.delays import (
    delay_bucket,
    is_delayed,
    largest_cause,
    primary_delay_cause,
    severity,
    total_delay,
    within_outlier_limit,
)
from tarmac.functions.keys import name_or_code, route, surrogate_key
from tarmac.functions.parsing import parse_date, parse_float, parse_int

__all__ = [
    "delay_bucket",
    "is_delayed",
    "largest_cause",
    "month_key",
    "month_start",
    "months_between_predicate",
    "name_or_code",
    "parse_date",
    "parse_float",
    "parse_int",
    "previous_month_of",
    "primary_delay_cause",
    "raw_month_path",
    "route",
    "severity",
    "surrogate_key",
    "total_delay",
    "within_outlier_limit",
    "year_month",
]
