"""Projections, filters, routing and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstand.catalog.bindings import AS_OF, RULES_SQL, TRIPS_SQL, ZONES_SQL, table, trips, zones
from cabstand.catalog.registry import query
from cabstand.functions import clock, labels
from cabstand.operators import columns, filters, joins, routing
from cabstand.operators.summary import busiest
from cabstand.specs import YELLOW


@query(
    "b1_cast_columns",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, CAST(trunc(c_acctbal) AS INTEGER) AS c_acctbal,
              TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer""",
)
def b1(spark, sf):
    """Mapped columns by name in any case; a text that is no number becomes NULL."""
    return columns.cast_columns(table(spark, sf, "customer"), {"c_custkey": "int", "c_acctbal": "int", "c_mktsegment": "double"})


@query(
    "b1_cast_failures",
    """SELECT 'c_custkey' AS "column", 0 AS failed UNION ALL SELECT 'c_mktsegment', count(*) FROM customer""",
)
def b1_failures(spark, sf):
    return columns.cast_failures(table(spark, sf, "customer"), {"c_custkey": "int", "c_mktsegment": "double"})


@query(
    "b2_b3_b4_project",
    "SELECT c_custkey AS place, c_name AS name, c_acctbal, c_mktsegment, 'yellow' AS category FROM customer",
)
def b2(spark, sf):
    rows = columns.rename(table(spark, sf, "customer"), {"c_custkey": "place", "c_name": "name"})
    return columns.all_except(rows, "c_nationkey").withColumn("category", F.lit("yellow"))


@query(
    "b5_month_window",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01'""",
)
def b5(spark, sf):
    rows = filters.in_month(table(spark, sf, "lineitem"), "l_shipdate", "1997-03-01")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "b5_month_window_inclusive",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-01' + INTERVAL 1 MONTH""",
)
def b5_inclusive(spark, sf):
    rows = filters.in_month(table(spark, sf, "lineitem"), "l_shipdate", "1997-03-01", inclusive_end=True)
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "b6_h8_recent_months",
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{AS_OF}' - INTERVAL 6 MONTH""",
)
def b6(spark, sf):
    return filters.in_recent_months(table(spark, sf, "orders"), "o_orderdate", 6, AS_OF).select("o_orderkey", "o_totalprice")


_ROUTED = f"""WITH {TRIPS_SQL}
  SELECT CASE WHEN {RULES_SQL} THEN 'clean' ELSE 'triage' END AS route, VendorID, payment_type,
         count(*) AS trips, round(sum(fare_amount), 2) AS fares
  FROM trips GROUP BY 1, 2, 3"""


@query("b7_b8_clean_triage", _ROUTED)
def b8(spark, sf):
    """Every trip is clean or triage, also when a rule yields NULL."""
    routed = routing.with_route(trips(spark, sf), YELLOW.rules(AS_OF))
    return routed.groupBy("route", "VendorID", "payment_type").agg(
        F.count("*").alias("trips"), F.round(F.sum("fare_amount"), 2).alias("fares")
    )


@query(
    "b8_clean_triage_dropping_nulls",
    f"""WITH {TRIPS_SQL}
        SELECT 'clean' AS route, count(*) AS trips FROM trips WHERE {RULES_SQL}
        UNION ALL SELECT 'triage', count(*) FROM trips WHERE NOT {RULES_SQL}""",
)
def b8_drop(spark, sf):
    routed = routing.with_route(trips(spark, sf), YELLOW.rules(AS_OF), null_policy="drop")
    return routed.groupBy("route").agg(F.count("*").alias("trips"))


@query(
    "b8_triage_reasons",
    f"""WITH {TRIPS_SQL}, failed AS (
          SELECT unnest([
            CASE WHEN NOT coalesce(tpep_pickup_datetime < tpep_dropoff_datetime, false) THEN 'pickup_before_dropoff' END,
            CASE WHEN NOT coalesce(passenger_count BETWEEN 1 AND 8, false) THEN 'passenger_count_1_8' END,
            CASE WHEN NOT coalesce(VendorID BETWEEN 1 AND 3, false) THEN 'vendor_1_3' END,
            CASE WHEN NOT coalesce(RatecodeID BETWEEN 1 AND 7, false) THEN 'rate_code_1_7' END,
            CASE WHEN NOT coalesce(fare_amount >= 2.5, false) THEN 'fare_at_least_2_5' END,
            CASE WHEN NOT coalesce(fare_amount < 250, false) THEN 'fare_below_250' END,
            CASE WHEN DOLocationID IS NULL THEN 'DOLocationID_present' END,
            CASE WHEN NOT (tpep_pickup_datetime < TIMESTAMP '{AS_OF}') THEN 'pickup_in_past' END,
            CASE WHEN NOT (tpep_dropoff_datetime < TIMESTAMP '{AS_OF}') THEN 'dropoff_in_past' END]) AS rule
          FROM trips)
        SELECT rule, count(*) AS rows FROM failed WHERE rule IS NOT NULL GROUP BY rule""",
)
def b8_reasons(spark, sf):
    return routing.reasons(routing.with_route(trips(spark, sf), YELLOW.rules(AS_OF)))


@query(
    "b10_h13_null_defaults",
    f"""WITH {TRIPS_SQL} SELECT VendorID, count(*) AS trips, round(sum(coalesce(airport_fee, 0)), 2) AS fees
        FROM trips WHERE coalesce(passenger_count, 1) <= 7 GROUP BY VendorID""",
)
def b10(spark, sf):
    rows = trips(spark, sf).where(labels.at_most(F.col("passenger_count"), 7, 1))
    fee = labels.or_default(F.col("airport_fee"), 0.0)
    return rows.groupBy("VendorID").agg(F.count("*").alias("trips"), F.round(F.sum(fee), 2).alias("fees"))


@query("b11_year_range", "SELECT o_orderkey, o_orderstatus FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def b11(spark, sf):
    return filters.in_years(table(spark, sf, "orders"), "o_orderdate", 1996, 1998).select("o_orderkey", "o_orderstatus")


@query("b12_since_day", "SELECT o_orderkey, o_orderstatus FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-02-11'")
def b12(spark, sf):
    return filters.since_day(table(spark, sf, "orders"), "o_orderdate", "2001-02-11").select("o_orderkey", "o_orderstatus")


@query("b13_h26_random_share", "SELECT true AS from_source, true AS none_twice, true AS near_share, count(*) AS source_rows FROM orders")
def b13(spark, sf):
    """Facts about a random tenth: its rows are rows of the table, none comes twice, and the share is within five deviations."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    drawn = filters.random_share(orders, 0.1, seed=7).groupBy("o_orderkey").agg(F.count("*").alias("times"))
    both = orders.join(drawn.withColumnRenamed("o_orderkey", "key"), F.col("o_orderkey") == F.col("key"), "full")
    n = F.count("o_orderkey")
    return both.agg(
        (F.count(F.when(F.col("o_orderkey").isNull(), 1)) == 0).alias("from_source"),
        (F.max(F.coalesce("times", F.lit(0))) == 1).alias("none_twice"),
        (F.abs(F.count("key") - n * 0.1) <= 5 * F.sqrt(n * 0.09)).alias("near_share"),
        n.alias("source_rows"),
    )


@query(
    "b13_keyed_share",
    """SELECT * FROM orders
       WHERE CAST('0x' || substr(md5('7|' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.1::DOUBLE""",
)
def b13_keyed(spark, sf):
    return filters.keyed_share(table(spark, sf, "orders"), ["o_orderkey"], 0.1, seed=7)


@query(
    "b14_label_and_features",
    "SELECT c_acctbal AS label, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
)
def b14(spark, sf):
    customers = table(spark, sf, "customer")
    target, features = columns.label_and_features(customers, "C_ACCTBAL")
    return customers.select(F.col(target).alias("label"), *features)


@query(
    "b15_d10_drill_down",
    "SELECT DISTINCT p_type FROM part WHERE p_brand = 'Brand#12'",
)
def b15(spark, sf):
    return filters.drill_down(table(spark, sf, "part"), "p_brand", "Brand#12", "p_type")


@query(
    "b16_multi_select",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2",
)
def b16(spark, sf):
    orders = filters.choose(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    orders = filters.choose(orders, "o_orderstatus", "All")
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))


@query(
    "c1_role_playing_join",
    """SELECT z1.n_name AS customer_nation, z2.n_name AS supplier_nation, count(*) AS items,
              round(sum(l_extendedprice), 2) AS price
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation z1 ON c_nationkey = z1.n_nationkey LEFT JOIN nation z2 ON s_nationkey = z2.n_nationkey
       WHERE z1.n_nationkey IS NOT NULL AND z2.n_nationkey IS NOT NULL GROUP BY 1, 2""",
)
def c1(spark, sf):
    """One dimension in two roles. Line items are first summed per nation key pair, so the names are
    joined to a few hundred rows."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    facts = (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("items"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    )
    roles = {"customer_": "c_nationkey", "supplier_": "s_nationkey"}
    named = joins.with_roles(facts, table(spark, sf, "nation"), "n_nationkey", roles, {"n_name": "nation"})
    return named.select("customer_nation", "supplier_nation", "items", "price")


_PAIRS = f"""WITH {TRIPS_SQL}, {ZONES_SQL}
  SELECT z1.borough AS pickup_borough, z2.borough AS dropoff_borough, count(*) AS trips, round(sum(fare_amount), 2) AS fares
  FROM trips LEFT JOIN zones z1 ON PULocationID = z1.LocationID LEFT JOIN zones z2 ON DOLocationID = z2.LocationID
"""


def _borough_pairs(spark, sf, how):
    roles = {"pickup_": "pulocationid", "dropoff_": "dolocationid"}
    rows = joins.with_roles(trips(spark, sf), zones(spark, sf), "LocationID", roles, {"borough": "borough"}, how)
    return rows.groupBy("pickup_borough", "dropoff_borough").agg(
        F.count("*").alias("trips"), F.round(F.sum("fare_amount"), 2).alias("fares")
    )


@query("c2_b9_role_join_rows", _PAIRS + "WHERE z1.LocationID IS NOT NULL AND z2.LocationID IS NOT NULL GROUP BY 1, 2")
def c2(spark, sf):
    return _borough_pairs(spark, sf, "inner")


@query("c2_role_join_keeping_unknown", _PAIRS + "GROUP BY 1, 2")
def c2_left(spark, sf):
    return _borough_pairs(spark, sf, "left")


@query(
    "c2_unmatched_places",
    f"""WITH {TRIPS_SQL}, {ZONES_SQL}
        SELECT count(*) FILTER (z1.LocationID IS NULL) AS pickup_unmatched,
               count(*) FILTER (z2.LocationID IS NULL) AS dropoff_unmatched, count(*) AS facts
        FROM trips LEFT JOIN zones z1 ON PULocationID = z1.LocationID LEFT JOIN zones z2 ON DOLocationID = z2.LocationID""",
)
def c2_unmatched(spark, sf):
    return joins.unmatched(
        trips(spark, sf), zones(spark, sf), "LocationID", {"pickup_": "PULocationID", "dropoff_": "DOLocationID"}
    )


@query(
    "c3_join_by_name",
    f"""WITH {ZONES_SQL}
        SELECT c_custkey, round(longitude, 6) AS pickup_long, round(latitude, 6) AS pickup_lat
        FROM customer LEFT JOIN zones ON zone = 'NATION_' || CAST(c_nationkey * 2 AS VARCHAR)""",
)
def c3(spark, sf):
    """Coordinates by place name; customers of an unknown place keep NULL."""
    requests = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), (F.col("c_nationkey") * 2).cast("string")).alias("pickup_zone")
    )
    places = joins.unique_dimension(zones(spark, sf).select("zone", "longitude", "latitude"), "zone")
    rows = joins.with_roles(
        requests, places, "zone", {"pickup_": "pickup_zone"}, {"longitude": "long", "latitude": "lat"}, "left"
    )
    return rows.select("c_custkey", F.round("pickup_long", 6).alias("pickup_long"), F.round("pickup_lat", 6).alias("pickup_lat"))


@query(
    "c5_scalar_column",
    """SELECT event_type, count(*) AS events,
              (SELECT CAST(hour(ts) AS INTEGER) FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS busiest_hour
       FROM events GROUP BY event_type""",
)
def c5(spark, sf):
    events = table(spark, sf, "events")
    counted = events.groupBy("event_type").agg(F.count("*").alias("events"))
    return joins.with_scalar(counted, busiest(events, F.hour("ts"), "hour"), "busiest_hour")


@query("c6_existing", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def c6(spark, sf):
    return joins.existing(table(spark, sf, "customer"), table(spark, sf, "orders"), {"c_custkey": "o_custkey"}).select("c_custkey")


@query(
    "c6_missing",
    """SELECT o_orderkey FROM orders WHERE NOT EXISTS
         (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def c6_missing(spark, sf):
    returned = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    return joins.missing(table(spark, sf, "orders"), returned, {"o_orderkey": "l_orderkey"}).select("o_orderkey")


@query(
    "c7_h11_h12_labels",
    f"""WITH {TRIPS_SQL}
        SELECT CASE WHEN VendorID = 1 THEN 'Creative Mobile Technologies, LLC' WHEN VendorID = 2 THEN 'VeriFone Inc.'
                    ELSE 'Other' END AS vendors,
               CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
                    WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END AS payment_form, count(*) AS trips
        FROM trips GROUP BY 1, 2""",
)
def c7(spark, sf):
    keys = [labels.vendor_name(F.col("VendorID")).alias("vendors"), labels.payment_form(F.col("payment_type")).alias("payment_form")]
    return trips(spark, sf).groupBy(*keys).agg(F.count("*").alias("trips"))


@query(
    "g1_concat",
    """SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def g1(spark, sf):
    people = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    firms = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name")
    return joins.concat([people, firms])


@query(
    "h10_as_of_filter",
    "SELECT count(*) AS past FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-09-09 12:00:00'",
)
def h10(spark, sf):
    rows = table(spark, sf, "lineitem")
    now = clock.instant("1999-09-09 12:00:00", clock.field_type(rows, "l_shipdate"))
    return rows.where(F.col("l_shipdate") < now).agg(F.count("*").alias("past"))
