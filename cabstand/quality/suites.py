"""The named suites. They differ on purpose: what is accepted at ingest is wider than what a model
may be trained on."""

from __future__ import annotations

from cabstand.quality.rules import Rule, Suite
from cabstand.specs import TRIP_COLUMNS

# Fixed values below: rule kinds, columns and bounds.

INTEGER_TYPE_NAMES = (
    "INTEGER", "integer", "int", "int_", "int8", "int16", "int32", "int64", "uint8", "uint16",
    "uint32", "uint64", "INT", "TINYINT", "BYTEINT", "SMALLINT", "BIGINT", "IntegerType",
    "LongType", "DECIMAL", "float_",
)


def _between(column: str, low, high) -> Rule:
    return Rule("between", column, {"low": low, "high": high, "strict": False})


def _in(column: str, values, mostly: float = 1.0) -> Rule:
    return Rule("in_set", column, {"values": list(values)}, mostly)


def _declared(types: dict[str, str]) -> list[Rule]:
    rules = []
    for column, family in types.items():
        rules += [Rule("column_exists", column), Rule("column_type", column, {"type": family})]
    return rules


def _not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", column) for column in columns]


INGEST = Suite(
    "trip_ingest",
    (
        Rule("columns_ordered", None, {"columns": list(TRIP_COLUMNS)}),
        Rule("max_between", "DOLocationID", {"low": 1, "high": 265}),
        _in("passenger_count", range(0, 7), mostly=0.9),
        Rule("not_null", "passenger_count", mostly=0.9),
        Rule("type_list", "passenger_count", {"types": list(INTEGER_TYPE_NAMES)}, mostly=0.5),
        *_not_null(
            "DOLocationID",
            "PULocationID",
            "fare_amount",
            "trip_distance",
            "tpep_dropoff_datetime",
            "total_amount",
            "tpep_pickup_datetime",
        ),
        _in("VendorID", range(1, 7), mostly=0.9),
        _in("payment_type", range(0, 6)),
        _in("store_and_fwd_flag", ["Y", "N"]),
    ),
)

STAGING_TYPES = {
    "VendorID": "integer",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string",
    "RatecodeID": "integer",
    "PULocationID": "integer",
    "DOLocationID": "integer",
    "passenger_count": "integer",
    "trip_distance": "float",
    "fare_amount": "float",
    "extra": "float",
    "mta_tax": "float",
    "tip_amount": "float",
    "tolls_amount": "float",
    "improvement_surcharge": "float",
    "total_amount": "float",
    "payment_type": "integer",
    "congestion_surcharge": "float",
    "airport_fee": "float",
}

STAGING = Suite(
    "trip_staging",
    (
        Rule("recent", "tpep_pickup_datetime", {"keys": ["payment_type"], "unit": "month", "interval": 5}),
        Rule("columns_set", None, {"columns": list(STAGING_TYPES)}),
        Rule("column_count", None, {"count": 19}),
        Rule("pair_greater", None, {"a": "total_amount", "b": "fare_amount", "or_equal": False}),
        *_declared(STAGING_TYPES),
        *_not_null(
            "VendorID",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "PULocationID",
            "DOLocationID",
            "passenger_count",
            "trip_distance",
            "fare_amount",
        ),
        _in("VendorID", [1, 2]),
        _in("store_and_fwd_flag", ["Y", "N"]),
        _in("airport_fee", [0, 1.25, 1.75]),
        _between("RatecodeID", 1, 6),
        _between("PULocationID", 1, 265),
        _between("DOLocationID", 1, 265),
        _between("passenger_count", 1, 7),
        _between("fare_amount", 2.5, 250),
        _between("improvement_surcharge", 0, 3.1),
        _between("payment_type", 1, 6),
        _between("congestion_surcharge", 0, 3),
        Rule("within_stdevs", "trip_distance", {"sigmas": 4}),
        Rule("within_stdevs", "fare_amount", {"sigmas": 4}),
        Rule("within_stdevs", "tolls_amount", {"sigmas": 4}),
        Rule("unique_share", "trip_distance", {"low": 0.3, "high": 1}),
        Rule("unique_share", "mta_tax", {"low": 0, "high": 0.01}),
    ),
)

FEATURE_TYPES = {
    "passenger_count": "integer",
    "trip_distance": "float",
    "trip_duration": "float",
    "fare_amount": "float",
    "date": "date",
    "day_of_month": "integer",
    "month": "integer",
    "year": "integer",
    "day_of_week": "integer",
    "hour_of_day": "integer",
    "pickup_jfk_distance": "float",
    "dropoff_jfk_distance": "float",
    "pickup_ewr_distance": "float",
    "dropoff_ewr_distance": "float",
    "pickup_lga_distance": "float",
    "dropoff_lga_distance": "float",
}

FEATURES = Suite(
    "fare_features",
    (
        *_declared(FEATURE_TYPES),
        *_not_null(*FEATURE_TYPES),
        _between("passenger_count", 1, 7),
        _between("fare_amount", 2.5, 250),
        _between("day_of_month", 1, 31),
        _between("month", 1, 12),
        _between("year", 2010, 2023),
        _between("day_of_week", 1, 7),
        _between("hour_of_day", 0, 23.999),
        Rule("within_stdevs", "trip_distance", {"sigmas": 4}),
        Rule("within_stdevs", "fare_amount", {"sigmas": 4}),
        Rule("unique_share", "trip_distance", {"low": 0.3, "high": 1}),
    ),
)

ZONES = Suite(
    "zones",
    (
        *[Rule("unique", c) for c in ("LocationID", "zone", "longitude", "latitude")],
        *_not_null("LocationID", "borough", "zone", "longitude", "latitude"),
        _between("longitude", -74.28, -73.65),
        _between("latitude", 40.48, 40.93),
    ),
)

SUITES = {suite.name: suite for suite in (INGEST, STAGING, FEATURES, ZONES)}
