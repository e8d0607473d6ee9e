"""Dataset declarations: schemas, cleansing rules, table layout and quality suites as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F, types as T

from cabstand.functions import clock

# Columns of a trip file and the types they are loaded as.
TRIP_COLUMNS = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# Columns of the monthly summary table.
SUMMARY_COLUMNS = {
    "VendorID": "int",
    "payment_type": "int",
    "store_and_fwd_flag": "string",
    "pickup_zone": "int",
    "dropoff_zone": "int",
    "first_day_of_month": "date",
    "monthly_fare_amount": "double",
    "monthly_total_amount": "double",
    "monthly_extra_amount": "double",
    "monthly_mta_tax": "double",
    "monthly_tip_amount": "double",
    "monthly_tolls_amount": "double",
    "monthly_improvement_surcharge": "double",
    "monthly_congestion_surcharge": "double",
    "monthly_airport_fee": "double",
    "average_passenger_count": "double",
    "average_trip_distance": "double",
    "trip_count": "bigint",
    "avg_duration_minutes": "double",
    "total_duration_seconds": "bigint",
    "total_duration_hours": "double",
    "busiest_hour_of_day": "int",
}

# Columns of the place dimension.
ZONE_COLUMNS = {
    "LocationID": "int",
    "borough": "string",
    "zone": "string",
    "longitude": "double",
    "latitude": "double",
}

#: Short descriptions stored with the trip columns.
TRIP_COMMENTS = {
    "VendorID": "provider of the record: 1 Creative Mobile Technologies, 2 VeriFone",
    "tpep_pickup_datetime": "meter engaged",
    "tpep_dropoff_datetime": "meter disengaged",
    "passenger_count": "passengers, entered by the driver",
    "trip_distance": "miles reported by the meter",
    "RatecodeID": "rate in effect at the end of the trip",
    "store_and_fwd_flag": "Y when the record was held in the vehicle before sending",
    "PULocationID": "zone of the pickup",
    "DOLocationID": "zone of the dropoff",
    "payment_type": "how the passenger paid",
    "fare_amount": "time-and-distance fare",
    "extra": "rush-hour, overnight and other extras",
    "mta_tax": "tax that the metered rate triggers",
    "tip_amount": "tip paid by card; cash tips are not recorded",
    "tolls_amount": "all tolls of the trip",
    "improvement_surcharge": "surcharge at the start of the trip",
    "congestion_surcharge": "state surcharge for congestion",
    "total_amount": "charged in total, without cash tips",
    "airport_fee": "fee for pickups at an airport",
}

#: Short descriptions of the summary, by column.
SUMMARY_COMMENTS = {
    "VendorID": TRIP_COMMENTS["VendorID"],
    "payment_type": TRIP_COMMENTS["payment_type"],
    "store_and_fwd_flag": TRIP_COMMENTS["store_and_fwd_flag"],
    "pickup_zone": TRIP_COMMENTS["PULocationID"],
    "dropoff_zone": TRIP_COMMENTS["DOLocationID"],
    "first_day_of_month": "month of the pickups",
    **{
        name: f"sum over the month's trips: {TRIP_COMMENTS[source]}"
        for name, source in {
            "monthly_fare_amount": "fare_amount",
            "monthly_total_amount": "total_amount",
            "monthly_extra_amount": "extra",
            "monthly_mta_tax": "mta_tax",
            "monthly_tip_amount": "tip_amount",
            "monthly_tolls_amount": "tolls_amount",
            "monthly_improvement_surcharge": "improvement_surcharge",
            "monthly_congestion_surcharge": "congestion_surcharge",
            "monthly_airport_fee": "airport_fee",
        }.items()
    },
    "average_passenger_count": "mean number of passengers",
    "average_trip_distance": "mean distance in miles",
    "trip_count": "number of trips",
    "avg_duration_minutes": "mean time from pickup to dropoff in minutes",
    "total_duration_seconds": "time from pickup to dropoff, summed, in seconds",
    "total_duration_hours": "time from pickup to dropoff, summed, in hours",
    "busiest_hour_of_day": "hour with the most pickups, the earliest of several",
}

#: Short descriptions of what routing adds to a trip.
ROUTE_COMMENTS = {"route": "clean or triage", "failed_rules": "cleansing rules that the trip does not meet"}


def struct_of(columns: Mapping[str, str], comments: Mapping[str, str] | None = None) -> T.StructType:
    """A declared ``StructType``; comments travel in the field metadata and so into the table."""
    comments = comments or {}
    return T.StructType(
        [
            T.StructField(
                name,
                T.DataType.fromDDL(kind),
                True,
                {"comment": comments[name]} if name in comments else {},
            )
            for name, kind in columns.items()
        ]
    )


def narrowed(columns: Mapping[str, str]) -> dict[str, str]:
    """The same columns with 32-bit floats, for parity with tables stored that way."""
    return {name: "float" if kind == "double" else kind for name, kind in columns.items()}


@dataclass(frozen=True)
class NamedRule:
    """One named condition a row has to meet."""

    name: str
    condition: Column


@dataclass(frozen=True)
class SummarySpec:
    """Monthly rollup: keys and measures by output name, from input column names."""

    keys: Mapping[str, str]
    sums: Mapping[str, str]
    averages: Mapping[str, str]


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the pipelines need to know about one kind of file."""

    name: str
    columns: Mapping[str, str]
    start: str
    end: str
    rules: Callable[[clock.Moment | None], list[NamedRule]]
    summary: SummarySpec
    cluster_rows: tuple[str, ...] = ()
    cluster_summary: tuple[str, ...] = ()
    retention_days: int = 180
    recent_months: int = 6
    comments: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return struct_of(self.columns, self.comments)


def trip_rules(as_of: clock.Moment | None = None) -> list[NamedRule]:
    """Cleansing conditions of a trip row. The accepted ranges."""
    c = F.col
    now = clock.instant(as_of)
    rules = [
        ("pickup_before_dropoff", c("tpep_pickup_datetime") < c("tpep_dropoff_datetime")),
        ("passenger_count_1_8", c("passenger_count").between(1, 8)),
        ("vendor_1_3", c("VendorID").between(1, 3)),
        ("rate_code_1_7", c("RatecodeID").between(1, 7)),
        ("payment_type_1_7", c("payment_type").between(1, 7)),
        ("fare_at_least_2_5", c("fare_amount") >= 2.5),
        ("fare_below_250", c("fare_amount") < 250),
    ]
    rules += [
        (f"{name}_present", c(name).isNotNull())
        for name in (
            "DOLocationID",
            "PULocationID",
            "fare_amount",
            "trip_distance",
            "tpep_dropoff_datetime",
            "tpep_pickup_datetime",
        )
    ]
    rules += [
        ("pickup_in_past", c("tpep_pickup_datetime") < now),
        ("dropoff_in_past", c("tpep_dropoff_datetime") < now),
    ]
    return [NamedRule(name, condition) for name, condition in rules]


YELLOW = DatasetSpec(
    name="yellow",
    columns=TRIP_COLUMNS,
    start="tpep_pickup_datetime",
    end="tpep_dropoff_datetime",
    rules=trip_rules,
    summary=SummarySpec(
        keys={
            "VendorID": "VendorID",
            "payment_type": "payment_type",
            "store_and_fwd_flag": "store_and_fwd_flag",
            "pickup_zone": "PULocationID",
            "dropoff_zone": "DOLocationID",
        },
        sums={
            "monthly_fare_amount": "fare_amount",
            "monthly_total_amount": "total_amount",
            "monthly_extra_amount": "extra",
            "monthly_mta_tax": "mta_tax",
            "monthly_tip_amount": "tip_amount",
            "monthly_tolls_amount": "tolls_amount",
            "monthly_improvement_surcharge": "improvement_surcharge",
            "monthly_congestion_surcharge": "congestion_surcharge",
            "monthly_airport_fee": "airport_fee",
        },
        averages={
            "average_passenger_count": "passenger_count",
            "average_trip_distance": "trip_distance",
        },
    ),
    cluster_rows=("PULocationID", "VendorID", "payment_type"),
    cluster_summary=("pickup_zone", "payment_type"),
    comments=TRIP_COMMENTS,
)

DATASETS = {YELLOW.name: YELLOW}
