"""Calendar expressions: operating days per system, business days, months.

Calendars are generated in Spark (``sequence`` + ``explode``) from a date
range that is itself computed from the data, never collected to the driver.
ISO weekday numbering is used throughout (Monday = 1 ... Sunday = 7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import SYSTEM_CALENDARS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_weekday(d) -> Column:
    return F.weekday(_c(d)) + 1


def is_business_day(d) -> Column:
    return iso_weekday(d) <= 5


def operates_on(system, d) -> Column:
    """True when ``system`` works on day ``d`` (NULL for an unknown system)."""
    system, dow = _c(system), iso_weekday(d)
    expr = None
    for name, days in SYSTEM_CALENDARS.items():
        cond = system == F.lit(name)
        val = dow.isin(*days)
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def month_label(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def days_between(df: DataFrame, start: str, end: str, out: str = "dia") -> DataFrame:
    """One row per day in [start, end] for each input row (a calendar)."""
    return df.select("*", F.explode(F.sequence(F.col(start), F.col(end))).alias(out))
