"""Delay-derived columns (``Column → Column``), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import schema as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total_delay(arr_delay: Column | str = "arr_delay") -> Column:
    """Arrival delay with null read as 0 (double)."""
    return F.coalesce(_col(arr_delay), F.lit(0.0))


def is_delayed(arr_delay: Column | str = "arr_delay") -> Column:
    """``arr_delay > 15``; null → false."""
    return F.coalesce(_col(arr_delay) > S.DELAYED_AFTER_MIN, F.lit(False))


def delay_bucket(arr_delay: Column | str = "arr_delay", null_bucket: str | None = S.BUCKET_EXTREME) -> Column:
    """Bucket label of an arrival delay; bounds are inclusive.

    A null delay lands in ``null_bucket``, which defaults to the last bucket,
    as the source job does; pass ``None`` to keep it null.
    """
    a = _col(arr_delay)
    lo, minor, moderate, severe = S.BUCKET_BOUNDS
    expr = (
        F.when(a <= lo, S.BUCKET_ON_TIME)
        .when(a <= minor, S.BUCKET_MINOR)
        .when(a <= moderate, S.BUCKET_MODERATE)
        .when(a <= severe, S.BUCKET_SEVERE)
    )
    if null_bucket is None:
        return expr.when(a.isNotNull(), S.BUCKET_EXTREME)
    if null_bucket == S.BUCKET_EXTREME:
        return expr.otherwise(S.BUCKET_EXTREME)
    return expr.when(a.isNull(), null_bucket).otherwise(S.BUCKET_EXTREME)


def largest_cause(
    carrier: Column | str = "carrier_delay",
    weather: Column | str = "weather_delay",
    nas: Column | str = "nas_delay",
    security: Column | str = "security_delay",
    late_aircraft: Column | str = "late_aircraft_delay",
) -> Column:
    """Greatest of the five cause delays, each null read as 0."""
    return F.greatest(*[F.coalesce(_col(c), F.lit(0.0)) for c in (carrier, weather, nas, security, late_aircraft)])


def primary_delay_cause(
    greatest: Column | str,
    carrier: Column | str = "carrier_delay",
    weather: Column | str = "weather_delay",
    nas: Column | str = "nas_delay",
    late_aircraft: Column | str = "late_aircraft_delay",
    security: Column | str | None = None,
) -> Column:
    """Label of the first cause whose (non-null) value equals ``greatest``.

    Order is Carrier, Weather, NAS, Late Aircraft; ties go to the earlier one.
    No match (all null, or security alone largest) gives "Unknown". Pass a
    ``security`` column to test it last under its own label.

    ``greatest`` is a column computed once in an inner projection
    (:func:`largest_cause`), so the five-way maximum is not re-evaluated per
    branch.
    """
    g = _col(greatest)
    expr = (
        F.when(_col(carrier) == g, S.CAUSE_CARRIER)
        .when(_col(weather) == g, S.CAUSE_WEATHER)
        .when(_col(nas) == g, S.CAUSE_NAS)
        .when(_col(late_aircraft) == g, S.CAUSE_LATE_AIRCRAFT)
    )
    if security is not None:
        expr = expr.when(_col(security) == g, S.CAUSE_SECURITY)
    return expr.otherwise(S.CAUSE_UNKNOWN)


def within_outlier_limit(c: Column | str, limit: float = S.OUTLIER_LIMIT_MIN) -> Column:
    """True when the delay is null or its magnitude is at most ``limit``."""
    x = _col(c)
    return x.isNull() | (F.abs(x) <= limit)


def severity(avg_delay: Column | str) -> Column:
    """Band of an average arrival delay: >20 high, >10 medium, else low.

    A null average compares false on both tests and is "low".
    """
    a = _col(avg_delay)
    return (
        F.when(a > S.SEVERITY_HIGH_ABOVE, "high")
        .when(a > S.SEVERITY_MEDIUM_ABOVE, "medium")
        .otherwise("low")
    )
