"""The monthly report view and its value lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from cabstand.functions import clock, labels
from cabstand.operators import filters, joins
from cabstand.operators.summary import distinct_values

FIRST_YEAR = 2010
MAX_PASSENGERS = 7

# The value lists a dashboard offers, and the columns handed through unchanged.
REPORT_LISTS = ("month", "year", "vendors", "pickup_borough", "pickup_zone")
REPORT_MEASURES = (
    "monthly_fare_amount",
    "average_passenger_count",
    "average_trip_distance",
    "monthly_extra_amount",
    "monthly_mta_tax",
    "monthly_tip_amount",
    "monthly_tolls_amount",
    "monthly_improvement_surcharge",
    "monthly_total_amount",
    "monthly_congestion_surcharge",
)


def monthly_report(summary: DataFrame, zones: DataFrame, as_of: clock.Moment | None = None) -> DataFrame:
    """Summary rows with place names, vendor and payment labels; rows of unknown places drop out.

    ``airport_trip`` is the month's airport fee (0 when there is none); ``is_airport_trip`` is the
    flag.
    """
    rows = filters.in_years(summary, "first_day_of_month", FIRST_YEAR, clock.as_datetime(as_of).year)
    rows = rows.where(labels.at_most(F.col("average_passenger_count"), MAX_PASSENGERS, 1))
    rows = rows.withColumnsRenamed({"pickup_zone": "_pickup", "dropoff_zone": "_dropoff"})
    rows = joins.with_roles(
        rows, zones, "LocationID", {"pickup_": "_pickup", "dropoff_": "_dropoff"}, {"borough": "borough", "zone": "zone"}
    )
    fee = labels.or_default(F.col("monthly_airport_fee"), 0.0)
    seconds = [F.col("total_duration_seconds")] if "total_duration_seconds" in summary.columns else []
    return rows.select(
        labels.vendor_name(F.col("VendorID")).alias("vendors"),
        F.year("first_day_of_month").alias("year"),
        F.month("first_day_of_month").alias("month"),
        *REPORT_MEASURES,
        "pickup_borough",
        "pickup_zone",
        "dropoff_borough",
        "dropoff_zone",
        "avg_duration_minutes",
        "trip_count",
        *seconds,
        "total_duration_hours",
        "busiest_hour_of_day",
        fee.alias("airport_trip"),
        (fee > 0).alias("is_airport_trip"),
        labels.payment_form(F.col("payment_type")).alias("payment_type"),
    )


def value_lists(report: DataFrame) -> dict[str, DataFrame]:
    """The ordered value list of each dashboard filter."""
    return {name: distinct_values(report, name) for name in REPORT_LISTS}


def filtered(report: DataFrame, chosen: Mapping[str, str | Iterable[str]]) -> DataFrame:
    """The report for the values chosen per column; "All" leaves a column open."""
    for column, values in chosen.items():
        report = filters.choose(report, column, values)
    return report
