import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cabstand.functions import clock, geo, labels, messages, paths


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_path_parts(spark):
    path = "gs://bucket/folder/category/category_name_2022-01.extension"
    parts = paths.path_parts(F.lit(path))
    assert one(spark, *[c.alias(n) for n, c in parts.items()]) == (
        "category_name_2022-01.extension",
        "bucket",
        "folder/category/category_name_2022-01.extension",
        "category",
    )


def test_path_parts_of_a_bare_name_do_not_raise(spark):
    parts = paths.path_parts(F.lit("name.parquet"))
    assert one(spark, *[c.alias(n) for n, c in parts.items()]) == ("name.parquet", None, "", None)


@pytest.mark.parametrize(
    "name, category, date",
    [
        ("green_tripdata_2022-09.parquet", "green", dt.date(2022, 9, 1)),
        ("tripdata_2022-10.csv", "tripdata", dt.date(2022, 10, 1)),
        ("tripdata_2022-10-10.csv", "tripdata", dt.date(2022, 10, 1)),
        ("nothing.csv", "nothing.csv", None),
    ],
)
def test_run_metadata_from_names(spark, name, category, date):
    assert one(spark, paths.name_category(F.lit(name)), paths.name_run_date(F.lit(name))) == (category, date)


@pytest.mark.parametrize(
    "text, granularity, expected",
    [("2023-10-01", "MONTH", "202310"), ("2022-09-05", "YEAR", "2022"), ("2021-02-22", "DAY", "2021-02-22")],
)
def test_reformat_date(spark, text, granularity, expected):
    assert one(spark, clock.reformat_date(F.lit(text), granularity)) == (expected,)


def test_reformat_date_rejects_other_granularities():
    with pytest.raises(ValueError):
        clock.reformat_date(F.lit("2021-02-22"), "HOUR")


def test_date_parts_start_the_week_on_sunday(spark):
    parts = clock.date_parts(F.lit("2022-11-01 00:03:32").cast("timestamp"))
    assert one(spark, *parts.values()) == (1, 11, 2022, 3, 0)


def test_whole_minutes_truncate(spark):
    start = F.lit("2022-11-01 00:03:32").cast("timestamp")
    end = F.lit("2022-11-01 00:06:14").cast("timestamp")
    assert one(spark, clock.whole_minutes(start, end), clock.seconds_between(start, end)) == (2, 162)


def test_distance_in_miles(spark):
    ends = [F.lit(x) for x in (-74.0060, 40.7128, -87.6298, 41.8818)]
    assert one(spark, geo.distance(*ends, unit="mi"))[0] == pytest.approx(711.03843176, abs=1e-3)


def test_trip_distance_uses_latitude_as_latitude(spark):
    ends = [F.lit(x) for x in (-74.18755828249991, 40.55066406499992, -74.17153349999995, 40.68948349999988)]
    assert one(spark, geo.distance(*ends, unit="mi"))[0] == pytest.approx(9.62822, abs=1e-4)


def test_airport_distances_in_miles(spark):
    found = geo.airport_distances(
        {"pickup": (F.lit(-74.187558), F.lit(40.550664)), "dropoff": (F.lit(-74.171533), F.lit(40.689483))}, "mi"
    )
    expected = {
        "pickup_jfk_distance": 22.306055,
        "dropoff_jfk_distance": 20.863664,
        "pickup_ewr_distance": 9.850164,
        "dropoff_ewr_distance": 0.258613,
        "pickup_lga_distance": 22.749948,
        "dropoff_lga_distance": 16.784075,
    }
    got = dict(zip(found, one(spark, *found.values())))
    assert got == pytest.approx(expected, rel=1e-3)


def test_distance_of_a_missing_point_is_null_and_of_equal_points_zero(spark):
    null = F.lit(None).cast("double")
    x, y = F.lit(-74.0), F.lit(40.0)
    assert one(spark, geo.distance(x, y, null, y), geo.distance(x, y, x, y)) == (None, 0.0)


def test_distance_of_opposite_points_is_half_the_circumference(spark):
    got = one(spark, geo.distance(F.lit(0.0), F.lit(0.0), F.lit(180.0), F.lit(0.0)))[0]
    assert got == pytest.approx(math.pi * 6371010.0)


def test_labels(spark):
    code = F.lit(3)
    assert one(spark, labels.vendor_name(code), labels.payment_form(code), labels.payment_form(F.lit(9))) == (
        "Other",
        "No charge",
        None,
    )


def test_numbers(spark):
    values = (labels.money(F.lit(12.345)), labels.money(F.lit(12.5)), labels.percent_to_fraction(F.lit("10%")))
    assert one(spark, *values) == ("$12.34", "$12.5", 0.1)


def test_typed_texts(spark):
    def value(text, kind):
        return messages.typed(F.lit(text).cast("string"), kind)

    assert one(spark, value("1.0", "int"), value("1.5", "int"), value("x", "int"), value("NaN", "double"), value("2.5", "double")) == (
        1,
        None,
        None,
        None,
        2.5,
    )


@pytest.mark.parametrize("text", ["202211", "2022-11", "2022-11-17", "2022-11-17 10:00:00+00:00"])
def test_a_month_can_be_named_in_several_ways(text):
    assert clock.month_bounds(text) == (dt.datetime(2022, 11, 1), dt.datetime(2022, 12, 1))


def test_month_bounds_over_the_year_end():
    assert clock.month_bounds("2022-12-15") == (dt.datetime(2022, 12, 1), dt.datetime(2023, 1, 1))
