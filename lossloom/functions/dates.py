"""Date measures. Anything that depends on today takes `as_of`; nothing reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_difference(start: Column, end: Column) -> Column:
    """Calendar-day boundaries between two moments."""
    return F.datediff(end, start)


def _second_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.extract(F.lit("SECOND"), moment)


def elapsed_days(start: Column, end: Column, default: int | None = None) -> Column:
    """Whole 24-hour units between two moments, rounded down, with an optional value for null."""
    short = (_second_of_day(end) < _second_of_day(start)).cast("int")
    days = F.datediff(end, start) - short
    return days if default is None else F.coalesce(days, F.lit(default))


def year_difference(start: Column, end: Column, zero_as_one: bool = False) -> Column:
    years = F.year(end) - F.year(start)
    return F.when(years == 0, 1).otherwise(years) if zero_as_one else years


def open_days(reported: Column, closed: Column, as_of: Column) -> Column:
    return F.datediff(F.coalesce(F.to_date(closed), F.to_date(as_of)), reported)


def inside(moment: Column, start: Column, end: Column) -> Column:
    """1 when strictly between the two ends, else 0."""
    return F.when((moment > start) & (moment < end), 1).otherwise(0)


def oldest_valid(original: Column, effective: Column, first_year: int = 1991) -> Column:
    """Original date unless missing or before `first_year`, else the effective date."""
    return F.when(original.isNull() | (F.year(original) < first_year), effective).otherwise(original)


def hour_bucket(moment: Column) -> Column:
    """Four-way bucket; the minute after midnight is apart, exact midnight counts as night."""
    hour = F.hour(moment)
    return (
        F.when((hour == 0) & (F.minute(moment) == 0) & (F.second(moment) > 0), "twelveam")
        .when((hour >= 22) | (hour < 4), "midnight")
        .when(hour < 8, "early morning")
        .when(hour < 22, "dayhours")
    )


def quarter_day(moment: Column) -> Column:
    """Six-hour bucket as text; a missing moment falls in the last one."""
    hour = F.hour(moment)
    return (
        F.when(hour <= 5, "0 to 5").when(hour <= 11, "6 to 11").when(hour <= 17, "12 to 17").otherwise("18 to 23")
    )


def weekend(moment: Column) -> Column:
    """1 on Friday, Saturday and Sunday."""
    return F.when(F.dayofweek(moment).isin(1, 6, 7), 1).otherwise(0)


def second_half(moment: Column) -> Column:
    return F.when(F.month(moment) > 6, 1).otherwise(0)


def long_policy(start: Column, end: Column, days: int = 359) -> Column:
    return F.when(F.datediff(end, start) > days, 1).otherwise(0)


def policy_period_extreme(moment: Column, start: Column, end: Column) -> Column:
    """1 in the first 20 % or the last 30 % of the policy period (whole days, half up)."""
    span = F.datediff(end, start)
    early = F.date_add(F.to_date(start), F.round(span * 0.2).cast("int"))
    late = F.date_sub(F.to_date(end), F.round(span * 0.3).cast("int"))
    return F.when((moment <= early) | (moment >= late), 1).otherwise(0)


def year_month(moment: Column) -> Column:
    return F.year(moment) * 100 + F.month(moment)


def days_open_in_month(reported: Column, as_of: Column) -> Column:
    """Days open since the report, counted from the first of the month for older reports."""
    return F.when(year_month(reported) != year_month(as_of), F.dayofmonth(as_of)).otherwise(F.datediff(as_of, reported))


def in_month_of(moment: Column, as_of: Column) -> Column:
    """Range test for the month of `as_of`, written so that it can be pushed to the scan."""
    first = F.trunc(as_of, "month")
    return (moment >= first) & (moment < F.add_months(first, 1))


def vehicle_age(loss: Column, model_year: Column) -> Column:
    return F.year(loss) - model_year
