"""Aggregations, modes, histograms, value lists and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstand.catalog.bindings import TRIPS_SQL, ZONES_SQL, table, trips, zones
from cabstand.catalog.registry import query
from cabstand.functions import clock
from cabstand.operators import summary
from cabstand.plans import report
from cabstand.plans.fare_model import ranked
from cabstand.sources import dimensions
from cabstand.specs import YELLOW

MONEY = list(YELLOW.summary.sums)


def rounded(rows):
    """Sums to cents, averages to six digits: what does not depend on the order of addition."""
    digits = {**{name: 2 for name in MONEY}, **{name: 6 for name in YELLOW.summary.averages}}
    digits |= {"avg_duration_minutes": 6, "total_duration_hours": 6}
    return rows.withColumns({name: F.round(name, n) for name, n in digits.items() if name in rows.columns})


SUMMARY_SQL = f"""
WITH {TRIPS_SQL}, keyed AS (
  SELECT *, PULocationID AS pickup_zone, DOLocationID AS dropoff_zone,
         CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS first_day_of_month,
         hour(tpep_pickup_datetime) AS h,
         CAST(epoch(tpep_dropoff_datetime) AS BIGINT) - CAST(epoch(tpep_pickup_datetime) AS BIGINT) AS secs
  FROM trips
), hours AS (
  SELECT VendorID, payment_type, store_and_fwd_flag, pickup_zone, dropoff_zone, first_day_of_month, h,
         row_number() OVER (PARTITION BY VendorID, payment_type, store_and_fwd_flag, pickup_zone, dropoff_zone, first_day_of_month
                            ORDER BY count(*) DESC, h) AS place
  FROM keyed GROUP BY VendorID, payment_type, store_and_fwd_flag, pickup_zone, dropoff_zone, first_day_of_month, h
), summary AS (
  SELECT k.VendorID, k.payment_type, k.store_and_fwd_flag, k.pickup_zone, k.dropoff_zone, k.first_day_of_month,
         sum(fare_amount) AS monthly_fare_amount, sum(total_amount) AS monthly_total_amount,
         sum(extra) AS monthly_extra_amount, sum(mta_tax) AS monthly_mta_tax, sum(tip_amount) AS monthly_tip_amount,
         sum(tolls_amount) AS monthly_tolls_amount, sum(improvement_surcharge) AS monthly_improvement_surcharge,
         sum(congestion_surcharge) AS monthly_congestion_surcharge, sum(airport_fee) AS monthly_airport_fee,
         avg(passenger_count) AS average_passenger_count, avg(trip_distance) AS average_trip_distance,
         count(*) AS trip_count, avg(secs / 60) AS avg_duration_minutes, CAST(sum(secs) AS BIGINT) AS total_duration_seconds,
         sum(secs) / 3600 AS total_duration_hours, BUSIEST
  FROM keyed k JOINED
  GROUP BY ALL
)"""

GROUP_HOUR_SQL = SUMMARY_SQL.replace("BUSIEST", "CAST(any_value(hours.h) AS INTEGER) AS busiest_hour_of_day").replace(
    "JOINED",
    """JOIN hours ON hours.place = 1 AND k.VendorID IS NOT DISTINCT FROM hours.VendorID
    AND k.payment_type IS NOT DISTINCT FROM hours.payment_type AND k.store_and_fwd_flag IS NOT DISTINCT FROM hours.store_and_fwd_flag
    AND k.pickup_zone IS NOT DISTINCT FROM hours.pickup_zone AND k.dropoff_zone IS NOT DISTINCT FROM hours.dropoff_zone
    AND k.first_day_of_month IS NOT DISTINCT FROM hours.first_day_of_month""",
)
_ONE_HOUR = SUMMARY_SQL.replace(
    "BUSIEST",
    "(SELECT CAST(h AS INTEGER) FROM keyed GROUP BY h ORDER BY count(*) DESC, h LIMIT 1) AS busiest_hour_of_day",
).replace("JOINED", "")

SUMMARY_COLUMNS_SQL = (
    "VendorID, payment_type, store_and_fwd_flag, pickup_zone, dropoff_zone, first_day_of_month, "
    + ", ".join(f"round({name}, 2) AS {name}" for name in MONEY)
    + ", round(average_passenger_count, 6) AS average_passenger_count, round(average_trip_distance, 6) AS average_trip_distance"
    ", trip_count, round(avg_duration_minutes, 6) AS avg_duration_minutes, total_duration_seconds"
    ", round(total_duration_hours, 6) AS total_duration_hours, busiest_hour_of_day"
)

REPORT_SQL = f"""
{GROUP_HOUR_SQL}, shifted AS (
  SELECT * REPLACE (CAST(first_day_of_month + INTERVAL 12 YEAR AS DATE) AS first_day_of_month) FROM summary
), {ZONES_SQL}, report AS (
  SELECT CASE WHEN VendorID = 1 THEN 'Creative Mobile Technologies, LLC' WHEN VendorID = 2 THEN 'VeriFone Inc.' ELSE 'Other' END AS vendors,
         CAST(year(first_day_of_month) AS INTEGER) AS year, CAST(month(first_day_of_month) AS INTEGER) AS month,
         {", ".join(f"round({name}, 2) AS {name}" for name in MONEY if name != "monthly_airport_fee")},
         round(average_passenger_count, 6) AS average_passenger_count, round(average_trip_distance, 6) AS average_trip_distance,
         z1.borough AS pickup_borough, z1.zone AS pickup_zone, z2.borough AS dropoff_borough, z2.zone AS dropoff_zone,
         round(avg_duration_minutes, 6) AS avg_duration_minutes, trip_count, total_duration_seconds,
         round(total_duration_hours, 6) AS total_duration_hours, busiest_hour_of_day,
         round(coalesce(monthly_airport_fee, 0), 2) AS airport_trip, coalesce(monthly_airport_fee, 0) > 0 AS is_airport_trip,
         CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
              WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END AS payment_type
  FROM shifted LEFT JOIN zones z1 ON shifted.pickup_zone = z1.LocationID LEFT JOIN zones z2 ON shifted.dropoff_zone = z2.LocationID
  WHERE z1.LocationID IS NOT NULL AND z2.LocationID IS NOT NULL AND coalesce(average_passenger_count, 1) <= 7
    AND year(first_day_of_month) BETWEEN 2010 AND 2011
)"""


def shifted_summary(spark, sf):
    """The monthly summary moved on by twelve years, into the years the report covers."""
    rows = summary.monthly_summary(trips(spark, sf), YELLOW)
    return rows.withColumn("first_day_of_month", F.add_months("first_day_of_month", 144))


def monthly_report(spark, sf):
    return report.monthly_report(shifted_summary(spark, sf), zones(spark, sf), as_of="2011-12-31")


@query("d1_d7_monthly_summary", f"{GROUP_HOUR_SQL} SELECT {SUMMARY_COLUMNS_SQL} FROM summary")
def d1(spark, sf):
    """Six keys, nine sums, two averages, count, durations, busiest hour of each group: two shuffles, per key and hour, then per key."""
    return rounded(summary.monthly_summary(trips(spark, sf), YELLOW))


@query("d5_d7_summary_one_busiest_hour", f"{_ONE_HOUR} SELECT {SUMMARY_COLUMNS_SQL} FROM summary")
def d7(spark, sf):
    return rounded(summary.monthly_summary(trips(spark, sf), YELLOW, busiest_scope="global"))


@query(
    "d1_h7_order_line_summary",
    """SELECT l_returnflag, l_linestatus, CAST(date_trunc('month', l_shipdate) AS DATE) AS first_day_of_month,
              round(sum(l_extendedprice), 2) AS price, round(avg(l_quantity), 6) AS quantity, count(*) AS items,
              CAST(sum(epoch(l_shipdate) - epoch(o_orderdate)) AS BIGINT) AS wait_seconds
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
)
def d1_lines(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("l_returnflag", "l_linestatus", clock.month_start("l_shipdate").alias("first_day_of_month")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.avg("l_quantity"), 6).alias("quantity"),
        F.count("*").alias("items"),
        F.sum(clock.seconds_between("o_orderdate", "l_shipdate")).alias("wait_seconds"),
    )


@query(
    "d7_f1_busiest_hour",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
)
def d7_global(spark, sf):
    return summary.busiest(table(spark, sf, "events"), F.hour("ts"), "hour")


@query(
    "d7_busiest_hour_per_group",
    """SELECT event_type, CAST(h AS INTEGER) AS hour, rows FROM (
         SELECT event_type, hour(ts) AS h, count(*) AS rows,
                row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, hour(ts)) AS place
         FROM events GROUP BY 1, 2) WHERE place = 1""",
)
def d7_groups(spark, sf):
    return summary.mode_per_group(table(spark, sf, "events"), ["event_type"], F.hour("ts"), "hour")


for _name in report.REPORT_LISTS:
    @query(f"d8_f2_list_{_name}", f"{REPORT_SQL} SELECT DISTINCT {_name} FROM report ORDER BY 1")
    def d8(spark, sf, name=_name):
        return report.value_lists(monthly_report(spark, sf))[name]


@query(
    "d15_histogram",
    """SELECT event_type, CAST(le AS DOUBLE) AS le, count(*) FILTER (value <= le) AS bucket, round(sum(value), 2) AS value_sum, count(*) AS value_count
       FROM events, (SELECT unnest([1.0, 2, 5, 15, 30, 60, 90, 120, 300]) AS le) GROUP BY event_type, le""",
)
def d15(spark, sf):
    table_ = summary.histogram(
        table(spark, sf, "events"), ["event_type"], F.col("value"), [1.0, 2.0, 5.0, 15.0, 30.0, 60.0, 90.0, 120.0, 300.0]
    ).withColumn("value_sum", F.round("value_sum", 2))
    return summary.histogram_rows(table_, ["event_type", "value_sum", "value_count"])


@query(
    "d16_box_centres",
    """SELECT l_suppkey, (min(l_quantity) + max(l_quantity)) / 2 AS longitude, (min(l_discount) + max(l_discount)) / 2 AS latitude
       FROM lineitem GROUP BY l_suppkey""",
)
def d16(spark, sf):
    return dimensions.box_centres(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity", "l_discount")


_RUNS = """runs AS (
  SELECT o_orderpriority || '-' || o_orderstatus AS run_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS parent_run_id,
         round(sqrt(avg((o_totalprice - 250000) * (o_totalprice - 250000))), 4) AS rmse
  FROM orders GROUP BY o_orderpriority, o_orderstatus)"""


def _runs(spark, sf):
    orders = table(spark, sf, "orders").withColumn("miss", F.col("o_totalprice") - 250000)
    parent = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return (
        orders.groupBy("o_orderpriority", "o_orderstatus")
        .agg(F.round(F.sqrt(F.avg(F.col("miss") * F.col("miss"))), 4).alias("rmse"))
        .select(F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("run_id"), parent.alias("parent_run_id"), "rmse")
    )


@query("f4_best_run", f"WITH {_RUNS} SELECT run_id, rmse, coalesce(parent_run_id, run_id) AS chosen_run_id FROM runs ORDER BY rmse, run_id LIMIT 1")
def f4(spark, sf):
    return summary.best_run(_runs(spark, sf)).select("run_id", "rmse", "chosen_run_id")


@query(
    "d14_trial_ranks",
    f"""WITH {_RUNS} SELECT run_id, parent_run_id, rmse,
          CASE WHEN parent_run_id IS NOT NULL THEN CAST(rank() OVER (PARTITION BY parent_run_id ORDER BY rmse) AS INTEGER) END AS rank
        FROM runs""",
)
def d14(spark, sf):
    return ranked(_runs(spark, sf))


@query(
    "d13_rmse",
    "SELECT round(sqrt(avg(pow(l_extendedprice - l_quantity * 1050, 2))), 4) AS rmse FROM lineitem",
)
def d13(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 1050)
    return summary.rmse(rows, "l_extendedprice", "guess").select(F.round("rmse", 4).alias("rmse"))


@query("m4_monthly_report", f"{REPORT_SQL} SELECT * FROM report")
def m4(spark, sf):
    """Summary, two place roles, labels, defaults and the year range."""
    rows = rounded(monthly_report(spark, sf))
    return rows.withColumn("airport_trip", F.round("airport_trip", 2))


@query(
    "m4_report_filtered",
    f"{REPORT_SQL} SELECT year, month, pickup_borough, CAST(sum(trip_count) AS BIGINT) AS trips FROM report "
    "WHERE vendors IN ('VeriFone Inc.', 'Other') AND pickup_borough = 'EUROPE' GROUP BY 1, 2, 3",
)
def m4_filtered(spark, sf):
    chosen = {"vendors": ["VeriFone Inc.", "Other"], "pickup_borough": "EUROPE", "pickup_zone": "All"}
    rows = report.filtered(monthly_report(spark, sf), chosen)
    return rows.groupBy("year", "month", "pickup_borough").agg(F.sum("trip_count").alias("trips"))
