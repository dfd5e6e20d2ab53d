import datetime as dt

import pytest

from weekshare.functions.calendar import (anchor_value, anchor_week, iso_week, iso_year,
                                          rel_week, weeks_in_year, year_delta)


def test_weeks_in_year(spark):
    df = spark.createDataFrame([(2015,), (2018,), (2020,), (2021,), (2026,)], "Year long")
    got = {r.Year: r.w for r in df.select("Year", weeks_in_year("Year").alias("w")).collect()}
    assert got == {2015: 53, 2018: 52, 2020: 53, 2021: 52, 2026: 53}


def test_year_delta_matches_sum_of_weeks(spark):
    # Current ISO year 2020: 2018 -> 52 + 52 = 104; 2015 -> 53 + 52 * 4 = 261.
    years = list(range(2010, 2024))
    df = spark.createDataFrame([(y,) for y in years], "Year long")
    got = {r.Year: r.d for r in df.select("Year", year_delta("Year", "2020-06-01").alias("d")).collect()}
    expected = {y: sum(dt.date(x, 12, 28).isocalendar()[1] for x in range(y, 2020)) for y in years}
    assert got == expected
    assert got[2018] == 104 and got[2015] == 261 and got[2020] == 0 and got[2021] == 0


def test_worked_example_week_50_of_2018(spark):
    df = spark.createDataFrame([(2018, 50)], "Year long, Semana long")
    assert df.select(rel_week("Semana", "Year", "2020-03-01").alias("r")).first().r == -54


def test_iso_year_boundary(spark):
    row = spark.range(1).select(iso_year("2021-01-01").alias("y"), iso_week("2021-01-01").alias("w")).first()
    assert (row.y, row.w) == (2020, 53)
    assert dt.date(2021, 1, 1).isocalendar()[:2] == (2020, 53)


def test_anchor_may_be_zero_or_negative(spark):
    assert anchor_value("2021-01-04", 1) == 0
    assert anchor_value("2021-01-04", 3) == -2
    assert spark.range(1).select(anchor_week("2001-06-15", 1).alias("a")).first().a == 23


def test_back_weeks_must_be_int():
    with pytest.raises(TypeError):
        anchor_value("2021-01-04", "1")
