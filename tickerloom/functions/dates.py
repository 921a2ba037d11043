"""Week, month and exchange-session arithmetic on DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .flags import any_of

# One-off full-day closures of the US equity exchanges since 1972.
SPECIAL_CLOSURES = (
    "1972-12-28",
    "1973-01-25",
    "1977-07-14",
    "1985-09-27",
    "1994-04-27",
    "2001-09-11",
    "2001-09-12",
    "2001-09-13",
    "2001-09-14",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29",
    "2012-10-30",
    "2018-12-05",
    "2025-01-09",
)


def week_start(day: Column | str) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(day, "week")


def months_before(day: Column | str, months: int) -> Column:
    return F.add_months(day, -months)


def good_friday(year: Column) -> Column:
    """Good Friday of the years 1900 to 2099, by Carter's rule for Easter Sunday."""
    moon = (F.lit(204) - (year % 19) * 11) % 30 + 21
    moon = moon - F.when(moon > 48, 1).otherwise(0)
    weekday = (year + F.floor(year / F.lit(4)) + moon + 1) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(1)), (moon - weekday + 4).cast("int"))


def is_exchange_holiday(day: Column) -> Column:
    """Regular full-day US equity closures, from the published NYSE/NASDAQ rules (1972 on).

    A holiday on Sunday is kept on Monday and one on Saturday on Friday, except that
    New Year's Day on a Saturday is not moved.
    """
    year, month, dom = F.year(day), F.month(day), F.dayofmonth(day)
    dow = F.weekday(day)  # Monday = 0
    monday, thursday, friday = dow == 0, dow == 3, dow == 4

    def fixed(m: int, d: int, saturday_moves: bool = True) -> Column:
        hit = (dom == d) | (monday & (dom == d + 1))
        if saturday_moves:
            hit = hit | (friday & (dom == d - 1))
        return (month == m) & hit

    return any_of(
        [
            fixed(1, 1, saturday_moves=False),
            (year >= 1998) & (month == 1) & monday & dom.between(15, 21),
            (month == 2) & monday & dom.between(15, 21),
            friday & month.isin(3, 4) & (day == good_friday(year)),
            (month == 5) & monday & (dom >= 25),
            (year >= 2022) & fixed(6, 19),
            fixed(7, 4),
            (month == 9) & monday & (dom <= 7),
            (month == 11) & thursday & dom.between(22, 28),
            fixed(12, 25),
            day.isin(*[F.lit(d).cast("date") for d in SPECIAL_CLOSURES]),
        ]
    )


def is_session(day: Column) -> Column:
    """Whether the US equity exchanges trade on this day."""
    return (F.weekday(day) < 5) & ~is_exchange_holiday(day)
