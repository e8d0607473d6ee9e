"""Tables over time: switches, merged streams, positions, co-located layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstand.catalog.bindings import AS_OF, RULES_SQL, TRIP_FACTS, TRIPS_SQL, facts_by, facts_sql, raw_trips, table, trips, zones
from cabstand.catalog.registry import query
from cabstand.functions.messages import to_message
from cabstand.operators import routing, summary
from cabstand.plans import features, load
from cabstand.session import scratch
from cabstand.sources import costs, files, footers, snapshots, tables
from cabstand.specs import ROUTE_COMMENTS, SUMMARY_COMMENTS, TRIP_COLUMNS, TRIP_COMMENTS, YELLOW
from cabstand.streaming import ingest

_ROUTED = f"""SELECT *, CASE WHEN {RULES_SQL} THEN 'clean' ELSE 'triage' END AS route,
                 strftime(tpep_pickup_datetime, '%Y%m') AS part_month"""
_BY_ROUTE = f"SELECT route, part_month, {facts_sql(TRIP_FACTS)} FROM routed GROUP BY 1, 2"


def _by_route(rows):
    return facts_by(rows, ("route", "part_month"), TRIP_FACTS)


@query(
    "m2_a9_snapshot_refresh",
    f"""WITH {TRIPS_SQL}, recent AS ({_ROUTED} FROM trips WHERE tpep_pickup_datetime > TIMESTAMP '{AS_OF}' - INTERVAL 6 MONTH)
        SELECT 'before' AS reader, route, part_month, {facts_sql(TRIP_FACTS)} FROM recent WHERE VendorID < 2 GROUP BY 2, 3
        UNION ALL SELECT 'after', route, part_month, {facts_sql(TRIP_FACTS)} FROM recent GROUP BY 2, 3""",
)
def m2_snapshots(spark, sf):
    """Two refreshes of one table: a reader from before the second one has the old rows, one from after it the new ones."""
    folder = scratch(spark, "snapshots")
    out = load.Outputs(f"{folder}/summary", f"{folder}/trips", snapshots=True)
    rows = raw_trips(spark, sf)
    rows.where(F.col("VendorID") < 2).write.parquet(f"{folder}/raw/a")
    load.run_full(spark, YELLOW, files.manifest(spark, f"{folder}/raw"), out, AS_OF)
    before = load.read_table(spark, out.trips)
    rows.where(F.col("VendorID") >= 2).write.parquet(f"{folder}/raw/b")
    load.run_full(spark, YELLOW, files.manifest(spark, f"{folder}/raw"), out, AS_OF)
    after = load.read_table(spark, out.trips)
    kept = [_by_route(rows).withColumn("reader", F.lit(reader)) for reader, rows in (("before", before), ("after", after))]
    return kept[0].unionByName(kept[1])


@query(
    "j1_a16_stream_compaction",
    f"WITH {TRIPS_SQL}, routed AS ({_ROUTED} FROM trips) SELECT *, true AS one_folder_each FROM ({_BY_ROUTE})",
)
def j1_merged(spark, sf):
    """Trips as messages in several batches, merged, then more batches and merged again: every column, and a folder per month."""
    folder = scratch(spark, "stream")
    inbox, out, state = f"{folder}/inbox", f"{folder}/trips", f"{folder}/state"
    rows = trips(spark, sf)
    for vendor in range(4):
        ingest.publish_files(rows.where(F.col("VendorID") == vendor), inbox)
        ingest.start_snapshot_ingest(ingest.file_stream(spark, inbox), YELLOW, out, state, AS_OF, once=True).awaitTermination()
        if vendor == 1:
            ingest.merge_table(spark, YELLOW, out)
    ingest.merge_table(spark, YELLOW, out)
    one = all(len(of) == 1 for of in snapshots.present(spark, out).folders.values())
    return _by_route(snapshots.read(spark, out)).withColumn("one_folder_each", F.lit(one))


def _records(rows):
    """Rows as records of a topic with three partitions, in the connector's columns.

    Every task numbers the messages it has, of whichever partition: offsets are unique and rise within a file, and have gaps,
    as those of a compacted topic. No task has to hold a partition of the topic.
    """
    lane = F.pmod(F.xxhash64("value"), F.lit(3)).cast("int")
    return to_message(rows).select(
        F.lit("trips").alias("topic"), lane.alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.col("value").cast("binary").alias("value"),
    )


@query(
    "a15_topic_positions",
    f"""WITH {TRIPS_SQL}, routed AS ({_ROUTED} FROM trips)
        SELECT *, (SELECT count(*) FROM trips) AS messages_at_known_positions FROM ({_BY_ROUTE})""",
)
def a15_positions(spark, sf):
    """Trips as records of a topic with three partitions, read twice with different checkpoints: nothing comes twice."""
    folder = scratch(spark, "topic")
    _records(trips(spark, sf)).write.option("compression", "zstd").parquet(f"{folder}/topic")
    for state in ("first", "second"):
        stream = spark.readStream.schema("topic string, partition int, offset long, value binary").parquet(f"{folder}/topic")
        ingest.start_snapshot_ingest(ingest.positioned(stream), YELLOW, f"{folder}/trips", f"{folder}/{state}", AS_OF, once=True).awaitTermination()
    ends = spark.read.parquet(f"{folder}/topic").groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    known = ingest.positions(spark, f"{folder}/trips").join(ends, ["topic", "partition"]).where(F.col("next") == F.col("last") + 1)
    of_known = spark.read.parquet(f"{folder}/topic").join(known, ["topic", "partition"]).count()
    return _by_route(snapshots.read(spark, f"{folder}/trips")).withColumn("messages_at_known_positions", F.lit(of_known).cast("long"))


#: Keys of the co-located layout: all keys of the summary, under its names.
_CO_KEYS = ("VendorID", "payment_type", "store_and_fwd_flag", "pickup_zone", "dropoff_zone", "first_day_of_month")


def co_located(spark, sf, buckets: int = 8):
    """Trips and their monthly summary, bucketed alike."""
    folder = scratch(spark, "bucketed")
    name = "cabstand_" + folder.rsplit("-", 1)[-1]
    rows = trips(spark, sf)
    month = F.trunc("tpep_pickup_datetime", "month").alias("first_day_of_month")
    keyed = rows.select("VendorID", "payment_type", "store_and_fwd_flag", F.col("PULocationID").alias("pickup_zone"),
                        F.col("DOLocationID").alias("dropoff_zone"), month, "fare_amount")
    monthly = summary.monthly_summary(rows, YELLOW).select(*_CO_KEYS, "trip_count", "monthly_fare_amount")
    left = tables.bucketed(keyed, f"{name}_trips", f"{folder}/trips", _CO_KEYS, buckets)
    right = tables.bucketed(monthly, f"{name}_summary", f"{folder}/summary", _CO_KEYS, buckets)
    return left, right


@query(
    "a11_bucketed_join",
    f"""WITH {TRIPS_SQL}, keyed AS (
          SELECT VendorID, payment_type, store_and_fwd_flag, PULocationID AS pickup_zone, DOLocationID AS dropoff_zone,
                 CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS first_day_of_month, fare_amount FROM trips),
        monthly AS (SELECT {", ".join(_CO_KEYS)}, count(*) AS n, sum(fare_amount) AS s FROM keyed GROUP BY ALL)
        SELECT {", ".join(_CO_KEYS)}, n AS trip_count, count(*) FILTER (fare_amount * n > s + 0.005) AS dearer_than_average
        FROM keyed JOIN monthly USING ({", ".join(_CO_KEYS)}) GROUP BY ALL""",
)
def a11_bucketed(spark, sf):
    """Trips that cost more than the mean of their group, from two tables with one layout: the join and the count shuffle nothing."""
    rows, monthly = co_located(spark, sf)
    dearer = F.col("fare_amount") * F.col("trip_count") > F.col("monthly_fare_amount") + 0.005
    return rows.join(monthly, list(_CO_KEYS)).groupBy(*_CO_KEYS, "trip_count").agg(F.count_if(dearer).alias("dearer_than_average"))


@query(
    "a12_cost_by_label",
    """SELECT 'orders-load' AS label, count(*) AS rows_written, true AS took_time, true AS wrote_bytes FROM orders
       UNION ALL SELECT 'events-load', count(*), true, true FROM events""",
)
def a12_costs(spark, sf):
    """Two labelled loads; their figures are kept by run and read back."""
    folder = scratch(spark, "costs")
    tables.overwrite_months(table(spark, sf, "orders"), f"{folder}/orders", "o_orderdate", label="orders-load")
    tables.overwrite_months(table(spark, sf, "events"), f"{folder}/events", "ts", label="events-load")
    costs.save_costs(costs.costs(spark, "orders-load", "events-load"), f"{folder}/costs", "run-1")
    kept = spark.read.parquet(f"{folder}/costs")
    took, wrote = (F.col(name) > 0 for name in ("cpu_ms", "bytes_written"))
    return kept.select("label", "rows_written", took.alias("took_time"), wrote.alias("wrote_bytes"))


def _described_sql(name: str, texts, rows: str) -> str:
    values = ", ".join("('{}', '{}')".format(c, t.replace("'", "''")) for c, t in texts.items())
    return f"""SELECT '{name}' AS "table", c AS "column", t AS comment, ({rows}) AS rows FROM (VALUES {values}) AS v(c, t)"""


_MONTH_SQL = "tpep_pickup_datetime >= TIMESTAMP '2000-02-01' AND tpep_pickup_datetime < TIMESTAMP '2000-03-01'"


@query(
    "a28_a21_described_tables",
    f"WITH {TRIPS_SQL}, month AS (SELECT * FROM trips WHERE {_MONTH_SQL}) "
    + " UNION ALL ".join(
        [
            _described_sql("trips", {**TRIP_COMMENTS, **ROUTE_COMMENTS}, "SELECT count(*) FROM month"),
            _described_sql(
                "summary", SUMMARY_COMMENTS,
                "SELECT count(*) FROM (SELECT DISTINCT VendorID, payment_type, store_and_fwd_flag, PULocationID, DOLocationID FROM month)",
            ),
            _described_sql("features", features.FEATURE_COMMENTS, "SELECT count(*) FROM month WHERE PULocationID BETWEEN 1 AND 25 AND DOLocationID BETWEEN 1 AND 25"),
        ]
    ),
)
def a28_described(spark, sf):
    """The descriptions that the loads store with their tables, read back from the files of a month."""
    folder = scratch(spark, "described")
    out = load.Outputs(f"{folder}/summary", f"{folder}/trips")
    raw_trips(spark, sf).write.parquet(f"{folder}/raw")
    load.run_month(spark, YELLOW, [f"{folder}/raw"], "2000-02-01", out, AS_OF)
    stored = tables.read_months(spark, out.trips).select(*YELLOW.columns)
    features.build_features(spark, stored, zones(spark, sf), f"{folder}/features")
    parts = []
    for name, path in (("trips", out.trips), ("summary", out.summary), ("features", f"{folder}/features")):
        rows = spark.read.parquet(path)
        texts = tables.descriptions(rows).where(~F.col("column").isin(tables.PART, routing.ROUTE))
        if name == "trips":
            texts = texts.unionByName(spark.createDataFrame([(routing.ROUTE, ROUTE_COMMENTS[routing.ROUTE])], texts.schema))
        parts.append(texts.select(F.lit(name).alias("table"), "column", "comment", F.lit(rows.count()).alias("rows")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "a5_b5_zone_map",
    """WITH months AS (SELECT strftime(o_orderdate, '%Y%m') AS part_month, count(*) AS rows, min(o_orderdate) AS low, max(o_orderdate) AS high
                     FROM orders GROUP BY 1)
       SELECT part_month, CAST(rows AS BIGINT) AS rows, low, high,
              high >= TIMESTAMP '1996-05-15' AND low < TIMESTAMP '1997-02-01' AS may_hold FROM months""",
)
def a5_zone_map(spark, sf):
    """Ranges of the order dates from the footers of monthly files, and which files may hold days of a window: no row is read."""
    folder = scratch(spark, "orders")
    tables.overwrite_months(table(spark, sf, "orders"), folder, "o_orderdate")
    ranges = footers.row_group_ranges(files.manifest(spark, folder), "o_orderdate")
    may = footers.files_between(ranges, "1996-05-15", "1997-02-01").withColumn("may", F.lit(True))
    month = F.regexp_extract("link", f"{tables.PART}=([0-9]+)", 1).alias("part_month")
    by_month = ranges.join(may, "link", "left").groupBy(month).agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.count_if("may").alias("files")
    )
    return by_month.select("part_month", "rows", "low", "high", (F.col("files") > 0).alias("may_hold"))


@query(
    "a6_a7_compatible_reads",
    f"""WITH {TRIPS_SQL}, drifted AS (SELECT * REPLACE (CASE WHEN VendorID = 1 THEN NULL ELSE airport_fee END AS airport_fee,
            CASE WHEN VendorID = 3 THEN CAST(0 AS DOUBLE) ELSE mta_tax END AS mta_tax) FROM trips)
        SELECT VendorID, {facts_sql(TRIP_FACTS)}, CAST(2 AS BIGINT) AS scans FROM drifted GROUP BY VendorID""",
)
def a7_compatible(spark, sf):
    """Files of four schemas, of which one is in real conflict with another: two scans, every column."""
    folder = scratch(spark, "drifting")
    rows, vendor = raw_trips(spark, sf), F.col("VendorID")
    rows.where(vendor == 0).write.parquet(f"{folder}/a")
    rows.where(vendor == 1).drop("airport_fee").write.parquet(f"{folder}/b")
    rows.where(vendor == 2).withColumn("VendorID", vendor.cast("int")).write.parquet(f"{folder}/c")
    rows.where(vendor == 3).withColumn("mta_tax", F.lit(0).cast("long")).write.parquet(f"{folder}/d")
    groups = footers.compatible_groups(files.manifest(spark, folder), list(TRIP_COLUMNS))
    together = footers.read_compatible(spark, groups, TRIP_COLUMNS)
    return facts_by(together, ("VendorID",), TRIP_FACTS).withColumn("scans", F.lit(len(groups)).cast("long"))


@query(
    "i11_d4_footer_extremes",
    """SELECT count(*) AS rows, count(l_orderkey) AS n_l_orderkey, min(l_orderkey) AS low_l_orderkey, max(l_orderkey) AS high_l_orderkey,
              count(l_quantity) AS n_l_quantity, min(l_quantity) AS low_l_quantity, max(l_quantity) AS high_l_quantity FROM lineitem""",
)
def i11_extremes(spark, sf):
    """Counts and extremes of line items out of the footers, without reading a row."""
    row, _ = footers.extremes(spark, [f"{sf}/lineitem.parquet"], ["l_orderkey", "l_quantity"])
    return row
