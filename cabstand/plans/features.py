"""The fare feature table: one function for training rows and for requests to be scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabstand.functions import clock, geo
from cabstand.operators import filters, joins
from cabstand.sources import storage, tables
from cabstand.specs import TRIP_COMMENTS

FEATURE_COLUMNS = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "pickup_long",
    "pickup_lat",
    "dropoff_long",
    "dropoff_lat",
    "date",
    "trip_duration",
    *clock.DATE_PARTS,
    *[f"{end}_{code}_distance" for code in geo.AIRPORTS for end in ("pickup", "dropoff")],
)

#: Types of the stored features.
FEATURE_TYPES = {
    **dict.fromkeys(FEATURE_COLUMNS, "double"), "passenger_count": "int", "date": "date", "trip_duration": "bigint",
    **dict.fromkeys(clock.DATE_PARTS, "int"),
}

_END = {"pickup": "pickup", "dropoff": "dropoff"}
#: Short descriptions of the features.
FEATURE_COMMENTS = {
    **{name: TRIP_COMMENTS[name] for name in ("passenger_count", "trip_distance", "fare_amount")},
    **{f"{end}_{short}": f"{text} of the {end} zone's centre" for end in _END for short, text in (("long", "longitude"), ("lat", "latitude"))},
    "date": "day of the pickup",
    "trip_duration": "whole minutes from pickup to dropoff",
    **{part: f"{part.replace('_', ' ')} of the pickup" for part in clock.DATE_PARTS},
    **{f"{end}_{code}_distance": f"metres from the {end} zone to the airport {code.upper()}" for code in geo.AIRPORTS for end in _END},
}

_PLACE = {"longitude": "long", "latitude": "lat", **{f"{code}_distance": f"{code}_distance" for code in geo.AIRPORTS}}


def with_places(df: DataFrame, zones: DataFrame, key: str, pickup: str, dropoff: str, how: str, unit: str = "m") -> DataFrame:
    """Coordinates and airport distances of both ends of a trip. The distances are worked out on the
    dimension, once per place, and joined."""
    places = geo.with_airport_distances(zones, unit=unit)
    return joins.with_roles(df, places, key, {"pickup_": pickup, "dropoff_": dropoff}, _PLACE, how)


def fare_features(trips: DataFrame, zones: DataFrame, since: clock.Moment | None = None) -> DataFrame:
    """Model features of trips with known places; ``since`` keeps trips from that day on."""
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    rows = trips if since is None else filters.since_day(trips, start, since)
    rows = with_places(rows, zones, "LocationID", "PULocationID", "DOLocationID", "inner")
    return rows.withColumns(
        {
            "date": F.to_date(start),
            "trip_duration": clock.whole_minutes(start, end),
            **clock.date_parts(start),
        }
    ).select(*FEATURE_COLUMNS)


def build_features(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, path: str, since: clock.Moment | None = None
) -> tables.Written:
    """Write the feature table. Without ``since`` it is rebuilt; with it the months from that day on
    are replaced as whole months, so that a rerun repeats nothing and loses nothing."""
    if since is None:
        rows = tables.declared(fare_features(trips, zones), FEATURE_TYPES, FEATURE_COMMENTS)
        return tables.replace_table(rows, path, "date", label="features-full")
    first = clock.month_bounds(since)[0]
    months = [m for m in storage.partition_values(spark, path, tables.PART) if m >= f"{first:%Y%m}" and m.isdigit()]
    rows = tables.declared(fare_features(trips, zones, first), FEATURE_TYPES, FEATURE_COMMENTS)
    written = tables.overwrite_months(rows, path, "date", label=f"features-{first:%Y%m}")
    tables.drop_stale(spark, path, written, months)
    return written


def request_features(requests: DataFrame, zones: DataFrame, as_of: clock.Moment | None = None, unit: str = "m") -> DataFrame:
    """Features of requested trips given by zone names, with the names and units of training.

    ``requests``: passenger_count, pickup_zone, dropoff_zone, trip_duration (minutes) and any other
    columns, which pass through. Requests with an unknown zone keep NULL coordinates.
    ``trip_distance`` is the great-circle distance in miles, the unit of the trip meter.
    """
    by_zone = joins.unique_dimension(zones.select("zone", "longitude", "latitude"), "zone")
    rows = with_places(requests, by_zone, "zone", "pickup_zone", "dropoff_zone", "left", unit)
    now = clock.instant(as_of)
    miles = geo.distance(F.col("pickup_long"), F.col("pickup_lat"), F.col("dropoff_long"), F.col("dropoff_lat"), "mi")
    return rows.withColumns({"trip_distance": miles, "date": F.to_date(now), **clock.date_parts(now)})
