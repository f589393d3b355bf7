import datetime as dt

from pyspark.sql import functions as F

from tourlens.functions import dates

D = dt.date


def test_mixed_date(evaluate):
    given = ["31-12-2020", "2020-12-31", "1-2-2020", "31-02-2020", "2020", "", None, "31-12-1999", "TBA"]
    assert evaluate(dates.mixed_date, given) == [
        D(2020, 12, 31),
        D(2020, 12, 31),
        D(2020, 2, 1),
        None,
        None,
        None,
        None,
        D(1999, 12, 31),
        None,
    ]


def test_iso_date_takes_nothing_else(evaluate):
    given = ["2020-1-2", "2020-01-02 10:00:00", "2020", "2020-13-01", "01-02-2020"]
    assert evaluate(dates.iso_date, given) == [D(2020, 1, 2), None, None, None, None]


def test_setlist_year(evaluate):
    given = ["31-12-1999", "01-01-2000", "", None, "TBA", "1-2-x"]
    assert evaluate(dates.setlist_year, given) == [1999, 2000, None, None, None, None]


def test_leading_year(evaluate):
    given = ["1998", "1998-05", "98", "", None, "19x8"]
    assert evaluate(dates.leading_year, given) == [1998, 1998, None, None, None, None]


def test_listing_window(evaluate):
    start = D(2024, 1, 1)
    given = [D(2023, 12, 31), start, start + dt.timedelta(365), start + dt.timedelta(366), None]
    assert evaluate(lambda c: dates.within_listing_window(c, start), given, "DATE") == [
        False,
        True,
        True,
        False,
        None,
    ]


def test_reference_moments(spark):
    at = dt.datetime(2024, 5, 6, 7)
    row = spark.range(1).select(
        dates.day(D(2024, 1, 1)).alias("d"),
        dates.day(None).alias("today"),
        dates.moment(at).alias("t"),
        dates.moment(F.lit("2024-01-01").cast("timestamp")).alias("c"),
    )
    got = row.first()
    assert got.d == D(2024, 1, 1) and got.t == at and got.today is not None
