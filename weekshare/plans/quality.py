"""Data-quality checks on the base table (D1-D4; D5 is in sources.export).

Each check is a small aggregate; none collects fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.calendar import DateLike, expected_week, weeks_in_year


def _valid():
    """Year and week form a real ISO week; never NULL."""
    return F.coalesce(F.col("Semana").between(F.lit(1), weeks_in_year("Year")), F.lit(False))


def owners_present(base: DataFrame) -> DataFrame:
    """Distinct carrier codes as loaded."""
    return base.select("Owner").distinct()


def latest_week(base: DataFrame, as_of: DateLike, back_weeks: int = 1) -> DataFrame:
    """Newest valid (Year, Semana) loaded against the reported week.

    The reported week is the ISO week ``back_weeks`` weeks before the run
    date, which may lie in the year before. One row: ``Year, Semana,
    expected_year, expected_week, is_current``; without a valid week the
    first two are NULL.
    """
    year, week = expected_week(as_of, back_weeks)
    newest = base.where(_valid()).agg(F.max(F.struct("Year", "Semana")).alias("m"))
    return newest.select(
        F.col("m.Year").alias("Year"), F.col("m.Semana").alias("Semana"),
        year.alias("expected_year"), week.alias("expected_week"),
        F.coalesce((F.col("m.Year") == year) & (F.col("m.Semana") == week),
                   F.lit(False)).alias("is_current"))


def lagged_weeks(base: DataFrame) -> DataFrame:
    """Weeks present for the late-reporting airports in the newest year (D3):
    ``Year, PostaDestinoAWB, Semana, n``.

    One scan: a small aggregate keyed by year, with airport and week kept
    only for late-airport rows (all other rows fold into one row per year);
    the newest year is then taken from that small result.
    """
    late = F.col("PostaDestinoAWB").isin(list(R.LATE_AIRPORTS))
    # Only real weeks: the small aggregate is then bounded by the calendar.
    per_year = (base.where(_valid()).groupBy("Year",
                             F.when(late, F.col("PostaDestinoAWB")).alias("PostaDestinoAWB"),
                             F.when(late, F.col("Semana")).alias("Semana"),
                             late.alias("late"))
                .agg(F.count(F.lit(1)).alias("n")))
    # The aggregate has at most years x (1 + late airports x 53) rows, so one
    # unpartitioned window over it is bounded by the calendar, not the data.
    newest = F.max("Year").over(Window.partitionBy())
    return (per_year.withColumn("newest", newest)
            .where("late AND Year = newest")
            .select("Year", "PostaDestinoAWB", "Semana", "n"))


def bad_weeks(base: DataFrame) -> DataFrame:
    """(Year, Semana) pairs that are not a real ISO week (D4): ``Year, Semana, n``."""
    return (base.where(~_valid()).groupBy("Year", "Semana")
            .agg(F.count(F.lit(1)).alias("n")))


def week_validity(base: DataFrame) -> DataFrame:
    """Every loaded (Year, Semana) with the rule D4 applies:
    ``Year, Semana, weeks, valid, n``."""
    return (base.groupBy("Year", "Semana").agg(F.count(F.lit(1)).alias("n"))
            .select("Year", "Semana", weeks_in_year("Year").alias("weeks"),
                    _valid().alias("valid"), "n"))
