"""Column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstand.catalog.bindings import TRIPS_SQL, ZONES_SQL, distance_sql, table, trips, zones
from cabstand.catalog.registry import query
from cabstand.functions import clock, geo, labels
from cabstand.plans import features


@query(
    "h1_h5_calendar",
    """SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month_start, CAST(hour(ts) AS INTEGER) AS hour_of_day,
              CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(ts AS DATE) AS day
       FROM events""",
)
def h1(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        clock.month_start(ts).alias("month_start"),
        *[column.alias(name) for name, column in clock.date_parts(ts).items()],
        F.to_date(ts).alias("day"),
    )


@query(
    "h6_h7_durations",
    f"""WITH {TRIPS_SQL}
        SELECT VendorID, payment_type, CAST(sum(date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)) AS BIGINT) AS minutes,
               CAST(sum(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) AS BIGINT) AS seconds
        FROM trips GROUP BY 1, 2""",
)
def h6(spark, sf):
    start, end = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return trips(spark, sf).groupBy("VendorID", "payment_type").agg(
        F.sum(clock.whole_minutes(start, end)).alias("minutes"), F.sum(clock.seconds_between(start, end)).alias("seconds")
    )


@query(
    "h8_h9_interval_arithmetic",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS plus_month,
              strftime(o_orderdate - INTERVAL 6 MONTH, '%Y-%m-%d') AS minus_half_year,
              strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS parsed
       FROM orders""",
)
def h8(spark, sf):
    when = F.col("o_orderdate")
    parsed = clock.date_from_text(F.concat(clock.month_id(when), F.lit("01")))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(when + F.expr("INTERVAL 1 MONTH"), "yyyy-MM-dd").alias("plus_month"),
        F.date_format(when - F.expr("INTERVAL 6 MONTH"), "yyyy-MM-dd").alias("minus_half_year"),
        parsed.cast("string").alias("parsed"),
    )


_POINTS_SQL = """points AS (
  SELECT c_custkey, -74.25 + c_nationkey * CAST(0.02 AS DOUBLE) AS lon1, 40.5 + c_nationkey * CAST(0.015 AS DOUBLE) AS lat1,
         -74.25 + (c_custkey % 600) / CAST(1000 AS DOUBLE) AS lon2, 40.5 + (c_custkey % 400) / CAST(1000 AS DOUBLE) AS lat2
  FROM customer)"""


def _points(spark, sf):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        (nation * 0.02 - 74.25).alias("lon1"),
        (nation * 0.015 + 40.5).alias("lat1"),
        (key % 600 / 1000.0 - 74.25).alias("lon2"),
        (key % 400 / 1000.0 + 40.5).alias("lat2"),
    )


@query(
    "h14_h16_h18_distance",
    f"""WITH {_POINTS_SQL}
        SELECT c_custkey, round({distance_sql('lon1', 'lat1', 'lon2', 'lat2', 6371010.0)}, 3) AS metres,
               round({distance_sql('lon1', 'lat1', 'lon2', 'lat2', 3958.756)}, 6) AS miles FROM points""",
)
def h14(spark, sf):
    ends = [F.col(n) for n in ("lon1", "lat1", "lon2", "lat2")]
    return _points(spark, sf).select(
        "c_custkey",
        F.round(geo.distance(*ends), 3).alias("metres"),
        F.round(geo.distance(*ends, unit="mi"), 6).alias("miles"),
    )


def _airports_sql(radius: float) -> str:
    return ", ".join(
        f"round({distance_sql(str(lon), str(lat), f'lon{i}', f'lat{i}', radius)}, 3) AS {end}_{code}_distance"
        for code, (lon, lat) in geo.AIRPORTS.items()
        for i, end in ((1, "pickup"), (2, "dropoff"))
    )


def _airports(spark, sf, unit):
    ends = {"pickup": (F.col("lon1"), F.col("lat1")), "dropoff": (F.col("lon2"), F.col("lat2"))}
    found = geo.airport_distances(ends, unit)
    return _points(spark, sf).select("c_custkey", *[F.round(c, 3).alias(n) for n, c in found.items()])


@query("h15_k1_airport_distances", f"WITH {_POINTS_SQL} SELECT c_custkey, {_airports_sql(6371010.0)} FROM points")
def h15(spark, sf):
    return _airports(spark, sf, "m")


@query("h17_airport_distances_miles", f"WITH {_POINTS_SQL} SELECT c_custkey, {_airports_sql(3958.756)} FROM points")
def h17(spark, sf):
    return _airports(spark, sf, "mi")


_REQUEST_SQL = f"""WITH {ZONES_SQL}, requests AS (
  SELECT c_custkey, c_nationkey, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS pickup_zone,
         'NATION_' || CAST(c_custkey % 26 AS VARCHAR) AS dropoff_zone FROM customer)
SELECT c_custkey, round({distance_sql('z1.longitude', 'z1.latitude', 'z2.longitude', 'z2.latitude', 3958.756)}, 6) AS trip_distance,
       round({distance_sql('-73.778889', '40.639722', 'z1.longitude', 'z1.latitude', 6371010.0)}, 3) AS pickup_jfk_distance,
       round({distance_sql('-73.872611', '40.77725', 'z2.longitude', 'z2.latitude', 6371010.0)}, 3) AS dropoff_lga_distance,
       5 AS day_of_month, 3 AS month, 2023 AS year, 1 AS day_of_week, 14 AS hour_of_day
FROM requests LEFT JOIN zones z1 ON pickup_zone = z1.zone LEFT JOIN zones z2 ON dropoff_zone = z2.zone"""


@query("h19_l7_request_features", _REQUEST_SQL)
def h19(spark, sf):
    """Every customer asks for a ride; clock features come from the moment of asking."""
    key = F.col("c_custkey")
    requests = table(spark, sf, "customer").select(
        "c_custkey",
        F.lit(1).alias("passenger_count"),
        F.lit(10).alias("trip_duration"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("pickup_zone"),
        F.concat(F.lit("NATION_"), (key % 26).cast("string")).alias("dropoff_zone"),
    )
    rows = features.request_features(requests, zones(spark, sf), as_of="2023-03-05 14:30:00")
    return rows.select(
        "c_custkey",
        F.round("trip_distance", 6).alias("trip_distance"),
        F.round("pickup_jfk_distance", 3).alias("pickup_jfk_distance"),
        F.round("dropoff_lga_distance", 3).alias("dropoff_lga_distance"),
        *clock.DATE_PARTS,
    )


@query(
    "h20_h21_h25_numbers",
    """SELECT p_partkey, round_even(p_size / 4, 1) AS rounded, '$' || CAST(p_size / CAST(4 AS DOUBLE) AS VARCHAR) AS money,
              p_size / CAST(100 AS DOUBLE) AS share
       FROM part""",
)
def h20(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.bround(size / 4, 1).alias("rounded"),
        labels.money(size / 4).alias("money"),
        labels.percent_to_fraction(F.concat(size.cast("string"), F.lit("%"))).alias("share"),
    )


#: All features of all trips between known places.
FEATURES_SQL = f"""WITH {TRIPS_SQL}, {ZONES_SQL}, features_raw AS (
        SELECT passenger_count, trip_distance, fare_amount,
               round(z1.longitude, 6) AS pickup_long, round(z1.latitude, 6) AS pickup_lat,
               round(z2.longitude, 6) AS dropoff_long, round(z2.latitude, 6) AS dropoff_lat,
               CAST(tpep_pickup_datetime AS DATE) AS "date",
               date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration,
               CAST(day(tpep_pickup_datetime) AS INTEGER) AS day_of_month, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
               CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week,
               CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour_of_day,
               {", ".join(
                   f"round({distance_sql(str(lon), str(lat), f'{z}.longitude', f'{z}.latitude', 6371010.0)}, 3) AS {end}_{code}_distance"
                   for code, (lon, lat) in geo.AIRPORTS.items() for z, end in (('z1', 'pickup'), ('z2', 'dropoff')))}
        FROM trips LEFT JOIN zones z1 ON PULocationID = z1.LocationID LEFT JOIN zones z2 ON DOLocationID = z2.LocationID
        WHERE z1.LocationID IS NOT NULL AND z2.LocationID IS NOT NULL)"""


@query("m5_k1_fare_features", f"""{FEATURES_SQL} SELECT * FROM features_raw WHERE "date" >= DATE '1998-01-15'""")
def m5(spark, sf):
    """All features of the trips from one day on."""
    rows = features.fare_features(trips(spark, sf), zones(spark, sf), since="1998-01-15")
    digits = {c: 6 for c in ("pickup_long", "pickup_lat", "dropoff_long", "dropoff_lat")}
    digits |= {c: 3 for c in rows.columns if c.endswith("_distance") and c != "trip_distance"}
    return rows.withColumns({c: F.round(c, n) for c, n in digits.items()})
