"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def purchase_day(ts: Column | str) -> Column:
    """The calendar day of a date or timestamp."""
    return F.to_date(ts)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MONTH")


def period_end(period: Column) -> Column:
    """One month after ``period``, less a day: the month end when ``period`` starts a month."""
    return F.date_sub(F.add_months(period, 1), 1)


def months_before(ts: Column, months: int) -> Column:
    """``ts`` moved back by whole months, time of day kept, clamped to the month's last day."""
    return ts - F.make_ym_interval(F.lit(0), F.lit(months))


def midnight(day: Column) -> Column:
    """A date as a timestamp at midnight; a timestamp is returned unchanged."""
    return day.cast("timestamp_ntz")


def monthly_rate(annual: Column) -> Column:
    """The monthly rate that compounds to ``annual``, to six decimals."""
    return F.round(F.pow(1 + annual, F.lit(1.0) / 12) - 1, 6)


def monthly_rate_of(annual: float) -> float:
    """``monthly_rate`` for a plain number."""
    return round((1 + annual) ** (1 / 12) - 1, 6)


def id_suffix(key: Column | str, width: int = 2) -> Column:
    return F.substring(key, -width, width)


def clamp_nonneg(value: Column) -> Column:
    """Negative values become 0; null and NaN pass through."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def missing_to_zero(value: Column) -> Column:
    """Null and NaN both become 0."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def strip_prefix(text: Column | str, separator: str = ".") -> Column:
    """Drop everything up to and including the first separator; unchanged without one."""
    column = F.col(text) if isinstance(text, str) else text
    at = F.instr(column, separator)
    return F.when(at > 0, F.substr(column, at + F.lit(len(separator)))).otherwise(column)


def file_stamp(ts: Column) -> Column:
    """A timestamp as it appears in file names."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
