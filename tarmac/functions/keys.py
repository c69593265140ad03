"""Keys and labels built from several columns (``Column → Column``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import schema as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """Hex MD5 of the columns as text, joined by ``-``, null as a sentinel.

    Each part is cast to string (dates as ``yyyy-MM-dd``, ints in decimal), so
    the key is stable across engines that share those text forms.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(S.KEY_NULL_SENTINEL)) for c in cols]
    return F.md5(F.concat_ws(S.KEY_SEPARATOR, *parts))


def route(origin: Column | str, dest: Column | str) -> Column:
    """``'LAX → JFK'``; null if either end is null."""
    return F.concat(_col(origin), F.lit(S.ROUTE_SEPARATOR), _col(dest))


def name_or_code(name: Column | str, code: Column | str) -> Column:
    """Dimension name, falling back to the code when the lookup missed."""
    return F.coalesce(_col(name), _col(code))
