"""Calendar attributes of a DATE column.

Everything is a pure function of the date, so a fact table gets its calendar columns in the scan
stage: no join with a calendar table, no shuffle, and a date that holds a third of the rows costs
nothing extra.  Years are astronomical (year 0 exists, -1 is 2 BCE).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month, weekday and season names.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
SEASON_NAMES = ["Winter", "Spring", "Summer", "Autumn"]

# First month-and-day of spring, summer, autumn and winter.
SPRING, SUMMER, AUTUMN, WINTER = 320, 621, 922, 1221


def _name(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def _period_number(year: Column, length: int) -> Column:
    """Ordinal of the century or millennium: counted up from 1 CE, truncated towards 0 before it."""
    ce = F.floor((year + (length - 1)) / length)
    bce = F.ceil(year / length)
    return F.when(year > 0, ce).otherwise(bce).cast("int")


def season_number(dt: Column) -> Column:
    month_day = F.month(dt) * 100 + F.day(dt)
    return (
        F.when((month_day < SPRING) | (month_day >= WINTER), 1)
        .when(month_day < SUMMER, 2)
        .when(month_day < AUTUMN, 3)
        .otherwise(4)
    )


def is_leap_year(year: Column) -> Column:
    divisor = F.when(year % 100 == 0, 400).otherwise(4)
    return year % divisor == 0


def calendar_columns(dt: Column) -> dict[str, Column]:
    """The calendar attributes in table order; `description` comes from a label join."""
    year, month, day = F.year(dt), F.month(dt), F.day(dt)
    quarter, week, weekday = F.quarter(dt), F.weekofyear(dt), F.dayofweek(dt)
    century = _period_number(year, 100)
    season = season_number(dt)
    return {
        "era": F.when(year > 0, "CE").otherwise("BCE"),
        "dt": dt,
        "iso_date": dt.cast("string"),
        "millennium": _period_number(year, 1000),
        "century": century,
        "century_name": F.concat(century.cast("string"), F.lit(" Century")),
        "decade": (F.floor(year / 10) * 10).cast("int"),
        "year_num": year,
        "quarter": quarter,
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "season_num": season,
        "season_name": _name(SEASON_NAMES, season),
        "month_num": month,
        "month_name": _name(MONTH_NAMES, month),
        "week_num": week,
        "week_name": F.concat(F.lit("Week "), week.cast("string")),
        "day_num": day,
        "day_name": _name(DAY_NAMES, weekday),
        "year_month": year * 100 + month,
        "year_month_day": year * 10000 + month * 100 + day,
        "flg_leap_year": is_leap_year(year),
        "flg_weekend": weekday.isin(1, 7),
    }


def indicator_columns(dt: Column) -> dict[str, Column]:
    """Position of the date inside its year, quarter, month and week."""
    into_quarter = F.datediff(dt, F.trunc(dt, "quarter"))
    into_month = F.datediff(dt, F.trunc(dt, "month"))
    return {
        "quarter_num": F.quarter(dt),
        "month_num": F.month(dt),
        "month_in_quarter": (F.month(dt) - 1) % 3 + 1,
        "week_num": F.weekofyear(dt),
        "week_in_quarter": F.floor(into_quarter / 7).cast("int") + 1,
        "week_in_month": F.floor(into_month / 7).cast("int") + 1,
        "day_of_year": F.dayofyear(dt),
        "day_in_quarter": into_quarter + 1,
        "day_in_month": F.day(dt),
        "day_in_week": F.dayofweek(dt),
    }


def iso_week_year(dt: Column) -> Column:
    """The year an ISO week belongs to; differs from `year` around New Year."""
    return F.extract(F.lit("YEAROFWEEK"), dt)
