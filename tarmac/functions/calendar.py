"""Date helpers (``Column → Column``) and partition predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_month(d: Column | str) -> Column:
    """``'2024-03'`` label of a date, cut from its ISO text: no formatter runs per row."""
    return F.substring_index(_col(d).cast("date").cast("string"), "-", 2)


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month as a date."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def previous_month_of(run_date: _dt.date) -> tuple[int, int]:
    """(year, month) before ``run_date``'s month: the month a monthly run loads."""
    last = run_date.replace(day=1) - _dt.timedelta(days=1)
    return last.year, last.month


def raw_month_path(raw_root: str, run_date: _dt.date) -> str:
    """Folder of the month that a run on ``run_date`` loads: ``<root>/YYYY/MM/``."""
    year, month = previous_month_of(run_date)
    return f"{raw_root.rstrip('/')}/{year:04d}/{month:02d}/"


def month_key(year: Column | str, month: Column | str) -> Column:
    """``year * 100 + month``: one orderable int per month."""
    return _col(year).cast("int") * 100 + _col(month).cast("int")


def months_between_predicate(
    lo: _dt.date | str, hi: _dt.date | str, year_col: str = "year", month_col: str = "month"
) -> Column:
    """Predicate on partition columns alone, true for every month touching [lo, hi].

    Written only over the partition columns, Spark turns it into a
    ``PartitionFilters`` entry and skips whole month directories.
    """
    lo_d = _as_date(lo)
    hi_d = _as_date(hi)
    key = month_key(year_col, month_col)
    return key.between(lo_d.year * 100 + lo_d.month, hi_d.year * 100 + hi_d.month)


def _as_date(d: _dt.date | str) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)
