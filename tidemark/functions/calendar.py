"""Date expressions: parsing, weekends, Easter, national holidays, quarters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed


def parse_dmy(text: Column) -> Column:
    """Day-first date with one- or two-digit day and month; NULL when it is not one."""
    tidy = F.trim(text)
    return F.when(
        tidy.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(tidy, "d/M/yyyy")
    )


def parse_day(text: Column) -> Column:
    """A day-first date, else an ISO one (year first, never swapped); NULL when it is neither."""
    tidy = F.trim(text)
    iso = F.when(tidy.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(tidy, "y-M-d"))
    return F.coalesce(parse_dmy(text), iso)


def format_dmy(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def date_suffix(day: Column) -> Column:
    return F.date_format(day, "ddMMyyyy")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian year (integer arithmetic, no lookup)."""

    def quotient(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    y = year.cast("int")
    golden, century, rest = y % 19, quotient(y, 100), y % 100
    leap_centuries, century_rest = quotient(century, 4), century % 4
    moon_shift = quotient(century - quotient(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - leap_centuries - moon_shift + 15) % 30
    leaps, leaps_rest = quotient(rest, 4), rest % 4
    to_sunday = (century_rest * 2 + leaps * 2 + 32 - epact - leaps_rest) % 7
    late = quotient(golden + epact * 11 + to_sunday * 22, 451)
    serial = epact + to_sunday - late * 7 + 114
    return F.make_date(y, quotient(serial, 31), serial % 31 + 1)


def holidays_of(year: Column) -> Column:
    """Array with the national holidays of the year."""
    y = year.cast("int")
    fixed_days = [F.make_date(y, F.lit(m), F.lit(d)) for m, d in fixed.FIXED_HOLIDAYS]
    moving = [F.date_sub(easter(y), n) for n in fixed.EASTER_HOLIDAY_OFFSETS]
    return F.array(*fixed_days, *moving)


def is_holiday(day: Column) -> Column:
    """National holiday test as a plain expression: no join, no calendar table."""
    month_day = F.month(day) * 100 + F.dayofmonth(day)
    on_fixed_day = month_day.isin([m * 100 + d for m, d in fixed.FIXED_HOLIDAYS])
    before_easter = F.datediff(easter(F.year(day)), day).isin(fixed.EASTER_HOLIDAY_OFFSETS)
    return on_fixed_day | before_easter


def is_holiday_in(day: Column, year: int) -> Column:
    """Holiday test for a calendar that is only filled for one year."""
    return (F.year(day) == year) & is_holiday(day)


def weekdays_between(start: Column, end: Column) -> Column:
    """Monday-to-Friday days in the closed range; holidays count."""

    def up_to(day: Column) -> Column:
        n = F.datediff(day, F.lit("1970-01-05").cast("date"))
        return F.floor(n / F.lit(7)) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))

    return (up_to(end) - up_to(F.date_sub(start, 1))).cast("int")


def range_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def previous_quarter(day: Column) -> Column:
    """Struct ``inicio, fin`` of the calendar quarter before the one holding the day."""
    quarter = F.trunc(day, "quarter")
    return F.struct(
        F.add_months(quarter, -3).alias("inicio"), F.date_sub(quarter, 1).alias("fin")
    )
