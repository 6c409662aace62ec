"""Months as six-digit text (``YYYYMM``) and as a running integer index.

The index ``year * 12 + month - 1`` makes successor, length and gap plain integer arithmetic and
has no calendar limits (year 0000 is a legal text).  It also bounds every month axis: four-digit
years give at most ``MAX_MONTHS`` distinct months.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanlake.functions.amounts import quoted

# Fixed value: four year digits and a month 01-12.  \z, unlike $, refuses a trailing newline.
MONTH_PATTERN = r"^[0-9]{4}(0[1-9]|1[0-2])\z"

MAX_MONTHS = 120_000

MONTH_TEXT = "lpad(string(({0} div 12) * 100 + {0} % 12 + 1), 6, '0')"
"""SQL of the month text of an index."""

MONTH_INDEX = "int((int({0}) div 100) * 12 + int({0}) % 100 - 1)"
"""SQL of the index of a well-formed month text."""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_month(c: Column | str) -> Column:
    """True for a well-formed month text, NULL for NULL."""
    return _col(c).rlike(MONTH_PATTERN)


def month_index(c: str, checked: bool = False) -> Column:
    """Running index of the month text in column ``c``; NULL when the text is not a month.

    ``checked`` texts are known to be months and are not looked at again.
    """
    index = F.expr(MONTH_INDEX.format(quoted(c)))
    return index if checked else F.when(is_month(c), index)


def month_text(c: str) -> Column:
    """Month text of the index in column ``c``, the inverse of :func:`month_index`."""
    return F.expr(MONTH_TEXT.format(quoted(c)))


def month_of(time: Column | str) -> Column:
    """Month text of a date or timestamp."""
    t = _col(time)
    return F.lpad((F.year(t) * 100 + F.month(t)).cast("string"), 6, "0")


def month_label(c: Column | str) -> Column:
    """``YYYY-MM`` label of a month text."""
    return F.concat_ws("-", F.substring(_col(c), 1, 4), F.substring(_col(c), 5, 2))


def whole_number(c: Column | str) -> Column:
    """Number without decimals and with thousands separators, as text."""
    return F.format_number(_col(c), 0)


def month_count(first: str | None, last: str | None) -> int:
    """Months from the first to the last month text, 0 where there is none."""
    if first is None or last is None:
        return 0
    return max(0, 12 * (int(last[:4]) - int(first[:4])) + int(last[4:]) - int(first[4:]) + 1)
