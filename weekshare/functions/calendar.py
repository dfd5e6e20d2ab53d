"""ISO-week calendar as native expressions.

Time in the fact table is two integers, an ISO year and an ISO week, plus a
relative week on one running scale: 0 is the last ISO week of the year before
the current one, so week numbers of the current ISO year are unchanged and
earlier years count down. The "current" year always comes from one explicit
``as_of`` date, never from the clock (N20).

Each rule has a SQL-text form (``*_sql``, over SQL expressions, used when
composing larger expressions) and a Column form over column names.
With a literal ``as_of`` they fold to constants.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import ident

DateLike = _dt.date | str


def _to_date(value: DateLike) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if isinstance(value, str):
        return _dt.date.fromisoformat(value)
    raise TypeError(f"expected a date or ISO date string, got {value!r}")


def date_sql(value: DateLike) -> str:
    """A date literal."""
    return f"DATE '{_to_date(value).isoformat()}'"


# --- SQL text -----------------------------------------------------------------

def iso_week_sql(date: str) -> str:
    """ISO week number (Spark's ``weekofyear`` is ISO 8601)."""
    return f"CAST(weekofyear({date}) AS BIGINT)"


def iso_year_sql(date: str) -> str:
    """ISO year (T5): 2021-01-01 belongs to ISO year 2020."""
    return f"CAST(extract(YEAROFWEEK FROM {date}) AS BIGINT)"


def _make_date_sql(year: str, month: int, day: int) -> str:
    # Years outside 1..9999 give NULL instead of an ANSI error, so one bad
    # export row cannot fail a load; the invalid-week check reports it.
    return (f"CASE WHEN {year} BETWEEN 1 AND 9999 "
            f"THEN make_date(CAST({year} AS INT), {month}, {day}) END")


def weeks_in_year_sql(year: str) -> str:
    """ISO weeks (52 or 53) of an ISO year (T2): 28 December always falls in
    the year's last ISO week."""
    return f"CAST(weekofyear({_make_date_sql(year, 12, 28)}) AS BIGINT)"


def _iso_year_start_sql(year: str) -> str:
    # 4 January is always in ISO week 1; its Monday starts the ISO year.
    return f"trunc({_make_date_sql(year, 1, 4)}, 'week')"


def year_delta_sql(year: str, current_year: str) -> str:
    """Total ISO weeks of the years ``[year, current_year)``.

    Closed form: whole weeks between the first Mondays of the two ISO years.
    Years at or after ``current_year`` give 0, as an empty range does (N23).
    """
    days = f"datediff({_iso_year_start_sql(current_year)}, {_iso_year_start_sql(year)})"
    weeks = f"CAST(floor({days} / 7) AS BIGINT)"
    # Clamp at 0 but keep NULL for an unknown year (``greatest`` would skip it).
    return f"CASE WHEN {weeks} < 0 THEN CAST(0 AS BIGINT) ELSE {weeks} END"


def rel_week_sql(semana: str, year: str, as_of: DateLike) -> str:
    """Relative week (T4): ``Semana - year_delta(Year, iso_year(as_of))``."""
    delta = year_delta_sql(year, iso_year_sql(date_sql(as_of)))
    return f"CAST(CAST({semana} AS BIGINT) - {delta} AS BIGINT)"


def expected_week_sql(date: str, back_weeks: int) -> tuple[str, str]:
    """ISO year and week that a run on ``date`` reports as its newest."""
    day = f"date_sub({date}, {7 * int(back_weeks)})"
    return iso_year_sql(day), iso_week_sql(day)


def week_monday_sql(semana: str, year: str) -> str:
    """Monday of an ISO week; NULL for a year outside 1..9999."""
    return f"date_add({_iso_year_start_sql(year)}, CAST(7 * ({semana} - 1) AS INT))"


# --- Python values --------------------------------------------------------------

def anchor_value(as_of: DateLike, back_weeks: int = 1) -> int:
    """Newest reported week (T1): ISO week of ``as_of`` minus ``back_weeks``.

    May be zero or negative early in a year; relative weeks use the same
    scale, so the five-week window still crosses the year boundary (N19).
    ``datetime.date.isocalendar`` and Spark's ``weekofyear`` agree (ISO 8601).
    """
    if isinstance(back_weeks, bool) or not isinstance(back_weeks, int):
        raise TypeError(f"back_weeks must be an int, got {back_weeks!r}")
    return _to_date(as_of).isocalendar()[1] - back_weeks


# --- Columns ----------------------------------------------------------------------

def iso_week(as_of: DateLike) -> Column:
    return F.expr(iso_week_sql(date_sql(as_of)))


def iso_year(as_of: DateLike) -> Column:
    return F.expr(iso_year_sql(date_sql(as_of)))


def anchor_week(as_of: DateLike, back_weeks: int = 1) -> Column:
    return F.lit(anchor_value(as_of, back_weeks)).cast("long")


def expected_week(as_of: DateLike, back_weeks: int = 1) -> tuple[Column, Column]:
    year, week = expected_week_sql(date_sql(as_of), back_weeks)
    return F.expr(year), F.expr(week)


def weeks_in_year(year: str) -> Column:
    return F.expr(weeks_in_year_sql(ident(year)))


def year_delta(year: str, as_of: DateLike) -> Column:
    """ISO weeks from the start of ISO year ``year`` to the ISO year of ``as_of``."""
    return F.expr(year_delta_sql(ident(year), iso_year_sql(date_sql(as_of))))


def rel_week(semana: str, year: str, as_of: DateLike) -> Column:
    return F.expr(rel_week_sql(ident(semana), ident(year), as_of))
