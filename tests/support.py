"""Small builders shared by the tests."""

from __future__ import annotations

import datetime as dt

from cabstand.specs import TRIP_COLUMNS, ZONE_COLUMNS, struct_of

GOOD_TRIP = {
    "VendorID": 2,
    "tpep_pickup_datetime": dt.datetime(2022, 11, 1, 0, 3, 32),
    "tpep_dropoff_datetime": dt.datetime(2022, 11, 1, 0, 6, 14),
    "passenger_count": 3,
    "trip_distance": 0.87999999523162842,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 229,
    "DOLocationID": 233,
    "payment_type": 1,
    "fare_amount": 4.5,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 1.2400000095367432,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.30000001192092896,
    "total_amount": 9.5399999618530273,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}

ZONE_ROWS = [
    (142, "Manhattan", "Lincoln Square East", -73.981530168, 40.773658667499916),
    (229, "Manhattan", "Sutton Place/Turtle Bay North", -73.96499747655662, 40.75657363039551),
    (233, "Manhattan", "UN/Turtle Bay South", -73.96997990593074, 40.749123894014915),
    (237, "Manhattan", "Upper East Side South", -73.96563511049996, 40.76861400849991),
]


def trips(spark, *changes: dict):
    """One good trip per entry, with the entry's changes."""
    rows = [tuple({**GOOD_TRIP, **change}[name] for name in TRIP_COLUMNS) for change in changes or ({},)]
    return spark.createDataFrame(rows, struct_of(TRIP_COLUMNS))


def zones(spark, *extra: tuple):
    return spark.createDataFrame([*ZONE_ROWS, *extra], struct_of(ZONE_COLUMNS))


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
