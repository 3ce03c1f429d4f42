"""Calendar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish national holidays (month-day).
HOLIDAYS = ("01-01", "01-06", "05-01", "08-15", "10-12", "11-01", "12-06", "12-08", "12-25")
# Tariff labels.
TARIFF_LABELS = {"P1": "punta", "P2": "llano", "P3": "valle", "P6": "super-valle"}


def year_of(t: Column) -> Column:
    return F.year(t).cast("bigint")


def month_of(t: Column) -> Column:
    return F.month(t).cast("bigint")


def period(t: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(t, "yyyy-MM")


def month_floor(t: Column) -> Column:
    return F.trunc(t, "MM")


def week_monday(t: Column) -> Column:
    """Monday-first week number 0..53 (days before the first Monday are week 0)."""
    return F.floor((F.dayofyear(t) + F.lit(6) - F.weekday(t)) / F.lit(7)).cast("bigint")


def is_weekend(t: Column) -> Column:
    return F.dayofweek(t).isin(1, 7)


def epoch(t: Column) -> Column:
    return F.unix_timestamp(t.cast("timestamp")).cast("bigint")


def day_gap(later: Column, earlier: Column) -> Column:
    """Exact gap in days as a double; wrap in ``half_up`` or ``floor`` as the job needs."""
    return (epoch(later) - epoch(earlier)) / F.lit(86400.0)


def between_days(t: Column, first: str, last: str) -> Column:
    """First to last day inclusive, as a half-open range that keeps rows with a time part on the last day."""
    return (t >= F.lit(first).cast("timestamp_ntz")) & (t < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))


def in_year(t: Column, year: int) -> Column:
    """Range form of ``year(t) = year``: reaches the parquet scan as a pushed filter."""
    return between_days(t, f"{year}-01-01", f"{year}-12-31")


def quarter_label(t: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(t).cast("string"))


def seniority(hired: Column, today: str) -> Column:
    years = F.year(F.lit(today).cast("date")) - F.year(hired)
    return F.when(years > 20, "VETERAN").when(years >= 10, "SENIOR").otherwise("JUNIOR")


def is_holiday(t: Column, days: tuple[str, ...] = HOLIDAYS) -> Column:
    return F.date_format(t, "MM-dd").isin(*days)


def tariff_period(local: Column) -> Column:
    """Electricity tariff period of a local clock time."""
    hour = F.hour(local)
    peak = hour.between(10, 13) | hour.between(18, 21)
    flat = hour.between(8, 9) | hour.between(14, 17) | hour.between(22, 23)
    return (
        F.when((F.weekday(local) >= 5) | is_holiday(local), "P6").when(peak, "P1").when(flat, "P2").otherwise("P3")
    )


def tariff_label(p: Column) -> Column:
    out = None
    for code, label in TARIFF_LABELS.items():
        out = F.when(p == code, label) if out is None else out.when(p == code, label)
    return out


def parse_hour_range(day: Column, hours: Column) -> Column:
    """``dd/MM/yyyy`` and ``HH-HH`` to the start of the hour; NULL when malformed."""
    start = F.trim(F.try_element_at(F.split(hours, "-"), F.lit(1)))
    return F.try_to_timestamp(F.concat_ws(" ", day, start), F.lit("dd/MM/yyyy HH"))
