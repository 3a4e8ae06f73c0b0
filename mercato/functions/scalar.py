"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_total(quantity: str | Column = "quantity", unit_price: str | Column = "unit_price") -> Column:
    """Quantity × unit price, a missing product counted as 0."""
    return F.coalesce(col(quantity) * col(unit_price), F.lit(0.0))


def parse_time(text: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text to timestamp; unparseable text becomes NULL instead of failing."""
    return F.try_to_timestamp(col(text), F.lit(fmt))


def weekday0(ts: str | Column) -> Column:
    """Day of week with Monday = 0 … Sunday = 6."""
    return F.weekday(col(ts))


def calendar_columns(ts: str | Column = "invoice_date") -> dict[str, Column]:
    """year, month, quarter, day_of_week (Monday = 0) and hour of a timestamp."""
    t = col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "quarter": F.quarter(t),
        "day_of_week": weekday0(t),
        "hour": F.hour(t),
    }


def day_name(ts: str | Column) -> Column:
    """English day name, e.g. Monday."""
    return F.date_format(col(ts), "EEEE")


def year_month(ts: str | Column) -> Column:
    """Calendar month label ``yyyy-MM``."""
    return F.date_format(col(ts), "yyyy-MM")


def log1p(c: str | Column) -> Column:
    """log(1 + x); NULL where x <= -1."""
    return F.log1p(col(c))


def expm1(c: str | Column) -> Column:
    """Inverse of ``log1p``."""
    return F.expm1(col(c))


def elapsed_days(start: str | Column, end: str | Column) -> Column:
    """Whole days elapsed from ``start`` to ``end``: floor of the time
    difference, like ``timedelta.days``; not the calendar boundary count of
    ``datediff`` (A12). ``timestamp_diff`` on wall-clock (NTZ) values does
    not depend on the session time zone, so a daylight-saving hour cannot
    shift the result by a day."""
    micros = F.timestamp_diff("MICROSECOND", col(start), col(end))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising on a zero divisor."""
    return F.try_divide(num, den)
