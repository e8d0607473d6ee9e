import datetime as dt
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cabstand.catalog.bindings import table, trips as bound
from cabstand.operators import summary
from cabstand.plans import report
from cabstand.specs import SUMMARY_COLUMNS, YELLOW, struct_of
from tests.support import plan_of, rows_of, trips, zones


def at(hour, **more):
    start = dt.datetime(2022, 11, 5, hour, 10)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=9, seconds=30), **more}


def test_columns_types_and_order_are_as_declared(spark):
    schema = summary.monthly_summary(trips(spark), YELLOW).schema
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == SUMMARY_COLUMNS
    assert schema.names == list(SUMMARY_COLUMNS)


def test_busiest_hour_per_group_and_overall(spark):
    df = trips(spark, at(5), at(5), at(9), at(9), at(23, payment_type=2), at(23, payment_type=2), at(23, payment_type=2))
    per_group = summary.monthly_summary(df, YELLOW).select("payment_type", "busiest_hour_of_day", "trip_count")
    assert rows_of(per_group) == [(1, 5, 4), (2, 23, 3)]
    overall = summary.monthly_summary(df, YELLOW, "global").select("payment_type", "busiest_hour_of_day", "trip_count")
    assert rows_of(overall) == [(1, 23, 4), (2, 23, 3)]


def test_durations_are_seconds_and_true_hours(spark):
    row = summary.monthly_summary(trips(spark, at(1), at(1)), YELLOW).first()
    assert row["total_duration_seconds"] == 1140
    assert row["total_duration_hours"] == pytest.approx(1140 / 3600)
    assert row["avg_duration_minutes"] == pytest.approx(9.5)


def test_nulls_in_keys_times_and_measures(spark):
    df = trips(
        spark,
        {"tpep_pickup_datetime": None, "passenger_count": None, "airport_fee": None},
        {"tpep_pickup_datetime": None, "passenger_count": None, "airport_fee": None},
    )
    row = summary.monthly_summary(df, YELLOW).first()
    assert row["first_day_of_month"] is None and row["busiest_hour_of_day"] is None
    assert row["average_passenger_count"] is None and row["monthly_airport_fee"] is None
    assert row["total_duration_seconds"] is None and row["trip_count"] == 2


def test_empty_input_gives_an_empty_summary(spark):
    assert summary.monthly_summary(trips(spark).limit(0), YELLOW).count() == 0
    assert summary.monthly_summary(trips(spark).limit(0), YELLOW, "global").count() == 0


def test_summary_equals_brute_force_with_one_hot_group(spark, sf):
    """A third of all trips share one key; pandas works out the same numbers row by row."""
    hot = F.col("fare_amount") % 3 < 1
    df = bound(spark, sf)
    for name in ("VendorID", "payment_type", "PULocationID", "DOLocationID"):
        df = df.withColumn(name, F.when(hot, F.lit(1)).otherwise(F.col(name)))
    df = df.withColumn("store_and_fwd_flag", F.lit("N"))
    got = {tuple(r[:6]): r for r in map(tuple, summary.monthly_summary(df, YELLOW).collect())}
    pdf = df.toPandas()
    keys = ["VendorID", "payment_type", "store_and_fwd_flag", "PULocationID", "DOLocationID"]
    pdf["month"] = pdf["tpep_pickup_datetime"].dt.to_period("M").dt.to_timestamp().dt.date
    groups = list(pdf.groupby([*keys, "month"], dropna=False))
    assert len(groups) == len(got)
    for key, group in groups:
        clean = tuple(None if pd.isna(k) else k for k in key)
        row = dict(zip(SUMMARY_COLUMNS, got[clean]))
        hours = Counter(group["tpep_pickup_datetime"].dt.hour)
        assert row["trip_count"] == len(group)
        assert row["monthly_fare_amount"] == pytest.approx(group["fare_amount"].sum())
        assert row["busiest_hour_of_day"] == min(hours, key=lambda h: (-hours[h], h))
        seconds = (group["tpep_dropoff_datetime"] - group["tpep_pickup_datetime"]).dt.total_seconds().sum()
        assert row["total_duration_seconds"] == seconds


def test_summary_stays_in_hash_aggregates(spark, sf):
    plan = plan_of(summary.monthly_summary(bound(spark, sf), YELLOW))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_mode_per_group_breaks_ties_low(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("b", 9)], "k string, v int")
    assert rows_of(summary.mode_per_group(df, ["k"], F.col("v"), "m")) == [("a", 1, 2), ("b", 9, 1)]


def test_histogram_counts_are_cumulative_and_ordered(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 7.0), ("b", None)], "k string, v double")
    table_ = summary.histogram(df, ["k"], F.col("v"), [1.0, 2.0, 5.0])
    assert rows_of(table_) == [("a", 10.0, 3, [1.0, 2.0, 5.0], [1, 2, 2]), ("b", None, 1, [1.0, 2.0, 5.0], [0, 0, 0])]
    assert summary.histogram_rows(table_, ["k"]).count() == 6


def test_best_run_is_the_lowest_error(spark):
    runs = spark.createDataFrame(
        [("r1", "p", 3.0), ("r2", "p", 1.0), ("r3", None, 2.0), ("r4", None, None)],
        "run_id string, parent_run_id string, rmse double",
    )
    assert summary.best_run(runs).first()["chosen_run_id"] == "p"
    assert summary.best_run(runs.where("parent_run_id IS NULL")).first()["chosen_run_id"] == "r3"


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    assert summary.rmse(df, "y", "p").first()["rmse"] == pytest.approx((5 / 2) ** 0.5)


GOLDEN_SUMMARY = {
    "VendorID": 2, "payment_type": 1, "store_and_fwd_flag": "N", "pickup_zone": 237, "dropoff_zone": 142,
    "first_day_of_month": dt.date(2023, 4, 1), "monthly_fare_amount": 52.0, "monthly_total_amount": 70.69000244140625,
    "monthly_extra_amount": 0.0, "monthly_mta_tax": 0.5, "monthly_tip_amount": 14.140000343322754,
    "monthly_tolls_amount": 0.0, "monthly_improvement_surcharge": 0.30000001192092896,
    "monthly_congestion_surcharge": 2.5, "monthly_airport_fee": 1.25, "average_passenger_count": 1.0,
    "average_trip_distance": 0.93000000715255737, "trip_count": 1, "avg_duration_minutes": 540.56666666666672,
    "total_duration_seconds": 32434, "total_duration_hours": 32434 / 3600, "busiest_hour_of_day": 18,
}


def golden_summary(spark, *changes):
    rows = [tuple({**GOLDEN_SUMMARY, **change}[c] for c in SUMMARY_COLUMNS) for change in changes or ({},)]
    return spark.createDataFrame(rows, struct_of(SUMMARY_COLUMNS))


def test_report_golden_row(spark):
    row = report.monthly_report(golden_summary(spark), zones(spark), as_of="2023-12-31").first().asDict()
    expected = {
        "vendors": "VeriFone Inc.", "year": 2023, "month": 4, "monthly_fare_amount": 52.0, "average_passenger_count": 1.0,
        "average_trip_distance": 0.93000000715255737, "monthly_extra_amount": 0.0, "monthly_mta_tax": 0.5,
        "monthly_tip_amount": 14.140000343322754, "monthly_tolls_amount": 0.0,
        "monthly_improvement_surcharge": 0.30000001192092896, "monthly_total_amount": 70.69000244140625,
        "monthly_congestion_surcharge": 2.5, "pickup_borough": "Manhattan", "pickup_zone": "Upper East Side South",
        "dropoff_borough": "Manhattan", "dropoff_zone": "Lincoln Square East",
        "avg_duration_minutes": 540.56666666666672, "trip_count": 1, "total_duration_seconds": 32434,
        "total_duration_hours": 32434 / 3600, "busiest_hour_of_day": 18, "airport_trip": 1.25, "is_airport_trip": True,
        "payment_type": "Credit card",
    }
    assert row == expected


def test_report_filters(spark):
    rows = golden_summary(
        spark,
        {"first_day_of_month": dt.date(2009, 12, 1)},
        {"first_day_of_month": dt.date(2010, 1, 1), "average_passenger_count": None, "monthly_airport_fee": None},
        {"first_day_of_month": dt.date(2024, 1, 1)},
        {"average_passenger_count": 7.5},
        {"pickup_zone": 104},
        {"VendorID": 4, "payment_type": 7},
    )
    got = report.monthly_report(rows, zones(spark), as_of="2023-12-31")
    kept = got.select("year", "vendors", "payment_type", "airport_trip", "is_airport_trip")
    assert rows_of(kept) == [
        (2010, "VeriFone Inc.", "Credit card", 0.0, False),
        (2023, "Other", None, 1.25, True),
    ]
    lists = report.value_lists(got)
    assert [r[0] for r in lists["year"].collect()] == [2010, 2023]
    assert report.filtered(got, {"vendors": ["Other"], "month": "All"}).count() == 1


def test_report_year_range_reaches_the_files(spark, folder):
    golden_summary(spark).write.mode("overwrite").parquet(folder)
    plan = plan_of(report.monthly_report(spark.read.parquet(folder), zones(spark), as_of="2023-12-31"))
    assert "GreaterThanOrEqual(first_day_of_month,2010-01-01)" in plan


def test_row_summary_of_events_matches_sql(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("ev")
    want = spark.sql("SELECT hour(ts) h FROM ev GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1").first()[0]
    assert summary.busiest(table(spark, sf, "events"), F.hour("ts"), "h").first()[0] == want
