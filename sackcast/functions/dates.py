"""Month arithmetic on DATE columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x.strftime("%Y-%m-%d")).cast("date")
    return F.col(x)


def first_of_month(d) -> Column:
    """First day of the month as DATE (``trunc``; ``date_trunc`` would give a timestamp)."""
    return F.trunc(_c(d).cast("date"), "MM")


def prev_month_start(asof) -> Column:
    """First day of the month before the as-of date."""
    return F.add_months(first_of_month(asof), -1)


def yyyymm(d) -> Column:
    """Integer period ``yyyyMM``."""
    return F.date_format(_c(d), "yyyyMM").cast("int")


def month_index(d) -> Column:
    """Months since year 0: differences of it count calendar months."""
    c = _c(d)
    return F.year(c) * 12 + F.month(c) - 1


def months_seq(start, n: int) -> Column:
    """Array of ``n`` consecutive month starts from ``start``."""
    s = _c(start)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.add_months(s, k))
