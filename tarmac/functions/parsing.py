"""Text → typed column parsers (``Column → Column``).

All of them return null for malformed text instead of failing, under either
setting of ``spark.sql.ansi.enabled``: monthly source files carry the odd bad
value and one bad cell must not sink a whole month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PATTERN = "yyyy-MM-dd"
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, pattern: str = DATE_PATTERN) -> Column:
    """``'2024-01-15'`` → date; unparseable text (``'2024-13-40'``) → null.

    The usual pattern is tested as text and then cast, at a tenth of the cost of a formatter;
    a month 13 builds no error that has to be caught. Years have four digits.
    """
    text = _col(c)
    if pattern == DATE_PATTERN:
        return F.when(text.rlike(ISO_DATE), text.try_cast("date"))
    return F.try_to_date(text, pattern)


# Fixed value: the text the source job's integer cast accepts (Spark's
# non-ANSI string → int): optional sign, digits, optional '.' and digits,
# surrounded by blanks or control characters; the fraction is dropped.
INT_TEXT_PATTERN = r"^[\x00-\x20]*([+-]?)([0-9]*)(?:\.[0-9]*)?[\x00-\x20]*$"


def parse_int(c: Column | str) -> Column:
    """Text → int. Decimal text truncates (``'12.0'`` → 12); bad text → null.

    Accepts exactly what the source job's cast did with ANSI off: ``'12.7'``
    → 12, ``'.5'`` → 0, ``' 42 '`` → 42; exponents (``'1e3'``), type suffixes
    and hex give null, as does a value outside the int range. The whole
    part is cut out as text and cast, so no float rounding is involved.

    Plain digit text, the usual case, is cast directly; other text goes
    through the pattern. The guard matters: a cast that fails builds an
    error before ``try_`` turns it into null, which costs more per row than
    the pattern itself.
    """
    text = _col(c)
    ok = text.rlike(INT_TEXT_PATTERN) & text.rlike(r"[0-9.]")
    sign = F.regexp_extract(text, INT_TEXT_PATTERN, 1)
    whole = F.regexp_extract(text, INT_TEXT_PATTERN, 2)
    digits = F.when(whole == "", F.lit("0")).otherwise(whole)
    patterned = F.when(ok, F.concat(sign, digits).try_cast("int"))
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("int")).otherwise(patterned)


def parse_float(c: Column | str) -> Column:
    """Text → float32; bad text → null, ``'NaN'`` → NaN."""
    return _col(c).try_cast("float")
