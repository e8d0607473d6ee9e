"""The given tables in the roles of trips and places, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cabstand.operators.columns import cast_columns
from cabstand.specs import TRIP_COLUMNS

AS_OF = "2001-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a trip, in the types files carry: long codes, doubles, zone-less times."""
    c = F.col
    pickup = c("l_shipdate") + F.make_interval(hours=c("l_suppkey") % 24, mins=c("l_partkey") % 60)
    ride = F.make_interval(mins=(c("l_quantity") - 3).cast("int"), secs=(c("l_orderkey") % 60).cast("decimal(8,6)"))
    rows = table(spark, sf_dir, "lineitem").select(
        (c("l_linenumber") % 4).cast("long").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + ride).alias("tpep_dropoff_datetime"),
        F.when(c("l_orderkey") % 11 != 0, c("l_orderkey") % 10).alias("passenger_count"),
        (c("l_quantity") / 4).alias("trip_distance"),
        (c("l_partkey") % 8 + 1).alias("RatecodeID"),
        F.when(c("l_suppkey") % 13 != 0, F.when(c("l_returnflag") == "R", "Y").otherwise("N")).alias("store_and_fwd_flag"),
        (c("l_partkey") % 27).alias("PULocationID"),
        F.nullif(c("l_suppkey") % 27, F.lit(5)).alias("DOLocationID"),
        (c("l_orderkey") % 7 + 1).alias("payment_type"),
        (F.floor(c("l_extendedprice") / 4) / 100).alias("fare_amount"),
        (c("l_discount") * 10).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (c("l_tax") * 50).alias("tip_amount"),
        F.when(c("l_linenumber") == 7, 6.55).otherwise(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.when(c("l_linestatus") == "O", 2.5).otherwise(0.0).alias("congestion_surcharge"),
        F.when(c("l_suppkey") % 17 != 0, F.when(c("l_partkey") % 27 < 3, 1.25).otherwise(0.0)).alias("airport_fee"),
    )
    paid = c("fare_amount") + c("extra") + c("tip_amount") + c("tolls_amount") + c("congestion_surcharge")
    return rows.withColumn("total_amount", paid).select(*TRIP_COLUMNS)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the declared types."""
    return cast_columns(raw_trips(spark, sf_dir), TRIP_COLUMNS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as a place, its region as the borough."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("LocationID"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        (F.col("n_nationkey") * 0.02 - 74.25).alias("longitude"),
        (F.col("n_nationkey") * 0.015 + 40.5).alias("latitude"),
    )


TRIPS_SQL = """
trips_raw AS (
  SELECT CAST(l_linenumber % 4 AS INTEGER) AS VendorID,
         l_shipdate + to_hours(l_suppkey % 24) + to_minutes(l_partkey % 60) AS tpep_pickup_datetime,
         l_shipdate + to_hours(l_suppkey % 24) + to_minutes(l_partkey % 60)
           + to_minutes(CAST(l_quantity - 3 AS BIGINT)) + to_seconds(l_orderkey % 60) AS tpep_dropoff_datetime,
         CAST(CASE WHEN l_orderkey % 11 <> 0 THEN l_orderkey % 10 END AS INTEGER) AS passenger_count,
         l_quantity / 4 AS trip_distance,
         CAST(l_partkey % 8 + 1 AS INTEGER) AS RatecodeID,
         CASE WHEN l_suppkey % 13 <> 0 THEN CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END END AS store_and_fwd_flag,
         CAST(l_partkey % 27 AS INTEGER) AS PULocationID,
         CAST(nullif(l_suppkey % 27, 5) AS INTEGER) AS DOLocationID,
         CAST(l_orderkey % 7 + 1 AS INTEGER) AS payment_type,
         floor(l_extendedprice / 4) / 100 AS fare_amount,
         l_discount * 10 AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         l_tax * 50 AS tip_amount,
         CAST(CASE WHEN l_linenumber = 7 THEN 6.55 ELSE 0 END AS DOUBLE) AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         CAST(CASE WHEN l_linestatus = 'O' THEN 2.5 ELSE 0 END AS DOUBLE) AS congestion_surcharge,
         CAST(CASE WHEN l_suppkey % 17 <> 0 THEN CASE WHEN l_partkey % 27 < 3 THEN 1.25 ELSE 0 END END AS DOUBLE) AS airport_fee
  FROM lineitem
), trips AS (
  SELECT *, fare_amount + extra + tip_amount + tolls_amount + congestion_surcharge AS total_amount FROM trips_raw
)"""

ZONES_SQL = """
zones AS (
  SELECT n_nationkey + 1 AS LocationID, r_name AS borough, n_name AS zone,
         n_nationkey * CAST(0.02 AS DOUBLE) - 74.25 AS longitude,
         n_nationkey * CAST(0.015 AS DOUBLE) + 40.5 AS latitude
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

def column_facts(columns: Mapping[str, str], ranged: Mapping[str, int] | None = None) -> dict[str, str]:
    """Expressions over every column that Spark and SQL read alike: how many values, and their sum (exact, in hundredths) or range.

    ``ranged`` names numbers that are not whole hundredths: their range is given, to so many digits.
    """
    ranged = ranged or {}
    facts = {"rows": "count(*)"}
    for name, kind in columns.items():
        facts[f"n_{name}"] = f"count({name})"
        if name in ranged:
            facts |= {f"low_{name}": f"round(min({name}), {ranged[name]})", f"high_{name}": f"round(max({name}), {ranged[name]})"}
        elif kind in ("int", "bigint"):
            facts[f"sum_{name}"] = f"CAST(sum({name}) AS BIGINT)"
        elif kind == "double":
            facts[f"sum_{name}"] = f"CAST(sum(CAST(round({name} * 100) AS BIGINT)) AS BIGINT)"
        else:
            facts |= {f"low_{name}": f"min({name})", f"high_{name}": f"max({name})"}
    return facts


def facts_by(df: DataFrame, keys: Sequence[str], facts: Mapping[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(text).alias(name) for name, text in facts.items()])


def facts_sql(facts: Mapping[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in facts.items())


TRIP_FACTS = column_facts(TRIP_COLUMNS)

RULES_SQL = f"""(tpep_pickup_datetime < tpep_dropoff_datetime
  AND passenger_count BETWEEN 1 AND 8 AND VendorID BETWEEN 1 AND 3
  AND RatecodeID BETWEEN 1 AND 7 AND payment_type BETWEEN 1 AND 7
  AND fare_amount >= 2.5 AND fare_amount < 250
  AND DOLocationID IS NOT NULL AND PULocationID IS NOT NULL AND trip_distance IS NOT NULL
  AND tpep_pickup_datetime < TIMESTAMP '{AS_OF}' AND tpep_dropoff_datetime < TIMESTAMP '{AS_OF}')"""


def distance_sql(lon1: str, lat1: str, lon2: str, lat2: str, radius: float) -> str:
    chord = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"2 * {radius} * asin(sqrt(CASE WHEN {chord} > 1 THEN 1.0 ELSE {chord} END))"
