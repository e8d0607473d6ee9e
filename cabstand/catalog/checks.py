"""Data-quality rules."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cabstand import quality
from cabstand.catalog.bindings import AS_OF, TRIPS_SQL, ZONES_SQL, table, trips, zones
from cabstand.catalog.registry import query
from cabstand.catalog.scalars import FEATURES_SQL
from cabstand.operators import joins
from cabstand.plans import features
from cabstand.plans.load import validate
from cabstand.quality import run, states, suites
from cabstand.quality.rules import Rule, Suite, suite_from_json
from cabstand.session import scratch
from cabstand.sources import tables

_RESULT = ("rule_id", "total", "failing", "observed", "success", "severity")


def shown(results):
    return results.select(*_RESULT).withColumn("observed", F.round("observed", 6))


def _sql(rule_id: str, total: str, failing: str, observed: str, success: str, source: str, ctes: str = "") -> str:
    return (
        f"SELECT '{rule_id}' AS rule_id, total, failing, round(CAST(observed AS DOUBLE), 6) AS observed, success, "
        "CASE WHEN failing > 10000 THEN 'error' WHEN failing > 1000 THEN 'warn' ELSE 'pass' END AS severity FROM ("
        f"SELECT CAST({total} AS BIGINT) AS total, CAST({failing} AS BIGINT) AS failing, {observed} AS observed, "
        f"{success} AS success FROM {source})"
    )


def _row_sql(rule_id: str, counted: str, fails: str, source: str, mostly: float = 1.0) -> str:
    total, bad = f"count(*) FILTER ({counted})", f"count(*) FILTER (({counted}) AND ({fails}))"
    share = f"CASE WHEN {total} > 0 THEN ({total} - {bad}) / {total} END"
    success = f"{bad} = 0" if mostly >= 1 else f"coalesce(({share}) >= {mostly}, true)"
    return _sql(rule_id, total, bad, share, success, source)


def _fixed_sql(rule_id: str, ok: bool, observed: str = "NULL") -> str:
    return _sql(rule_id, "NULL", "0" if ok else "1", observed, "true" if ok else "false", "(SELECT 1)")


def _union(parts, ctes: str = "") -> str:
    return (f"WITH {ctes} " if ctes else "") + " UNION ALL ".join(parts)


def _in_sql(column: str, values, source: str, mostly: float = 1.0) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return _row_sql(f"in_set:{column}", f"{column} IS NOT NULL", f"{column} NOT IN ({listed})", source, mostly)


def _between_sql(column: str, low, high, source: str) -> str:
    return _row_sql(f"between:{column}", f"{column} IS NOT NULL", f"NOT ({column} BETWEEN {low} AND {high})", source)


def _null_sql(column: str, source: str, mostly: float = 1.0) -> str:
    return _row_sql(f"not_null:{column}", "true", f"{column} IS NULL", source, mostly)


def _sigma_sql(column: str, sigmas: int, source: str) -> str:
    stats = f"(SELECT {column} AS v, avg({column}) OVER () AS mu, stddev_samp({column}) OVER () AS sd FROM {source})"
    return _row_sql(f"within_stdevs:{column}", "v IS NOT NULL", f"abs(v - mu) / nullif(sd, 0) > {sigmas}", stats)


def _unique_sql(column: str, source: str) -> str:
    copies = f"(SELECT {column} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"
    bad = "count(*) FILTER (n > 1)"
    return _sql(f"unique:{column}", "coalesce(sum(n), 0)", bad, "count(*) / sum(n)", f"{bad} = 0", copies)


def _share_sql(column: str, low, high, source: str) -> str:
    share = f"count(DISTINCT {column}) / count({column})"
    inside = f"({share}) BETWEEN {low} AND {high}"
    return _sql(f"unique_share:{column}", f"count({column})", f"CASE WHEN {inside} THEN 0 ELSE 1 END", share, inside, source)


_INGEST_NULLS = (
    "DOLocationID", "PULocationID", "fare_amount", "trip_distance", "tpep_dropoff_datetime", "total_amount",
    "tpep_pickup_datetime",
)

INGEST_SQL = _union(
    [
        _fixed_sql("columns_ordered", True, "19"),
        _fixed_sql("type_list:passenger_count", True),
        _sql(
            "max_between:DOLocationID", "count(*)", "CASE WHEN max(DOLocationID) BETWEEN 1 AND 265 THEN 0 ELSE 1 END",
            "max(DOLocationID)", "max(DOLocationID) BETWEEN 1 AND 265", "trips",
        ),
        _in_sql("passenger_count", range(0, 7), "trips", 0.9),
        _null_sql("passenger_count", "trips", 0.9),
        *[_null_sql(c, "trips") for c in _INGEST_NULLS],
        _in_sql("VendorID", range(1, 7), "trips", 0.9),
        _in_sql("payment_type", range(0, 6), "trips"),
        _in_sql("store_and_fwd_flag", ["Y", "N"], "trips"),
    ],
    TRIPS_SQL,
)


@query("i1_i6_i7_i8_i11_ingest_suite", INGEST_SQL)
def ingest(spark, sf):
    """The ingest suite over all trips: one scan for its thirteen data rules."""
    return shown(quality.evaluate(trips(spark, sf), suites.INGEST, AS_OF))


_RECENT = """(SELECT payment_type, max(tpep_pickup_datetime) >= TIMESTAMP '2001-06-01' - INTERVAL 5 MONTH AS recent
              FROM trips GROUP BY payment_type)"""

STAGING_SQL = _union(
    [
        _fixed_sql("columns_set", True, "19"),
        _fixed_sql("column_count", True, "19"),
        *[_fixed_sql(f"{kind}:{c}", True) for c in suites.STAGING_TYPES for kind in ("column_exists", "column_type")],
        _sql(
            "recent:tpep_pickup_datetime", "count(*)", "count(*) FILTER (NOT recent)",
            "(count(*) - count(*) FILTER (NOT recent)) / count(*)", "count(*) FILTER (NOT recent) = 0", _RECENT,
        ),
        _row_sql("pair_greater:total_amount-fare_amount", "total_amount IS NOT NULL AND fare_amount IS NOT NULL", "NOT (total_amount > fare_amount)", "trips"),
        *[
            _null_sql(c, "trips")
            for c in (
                "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
                "passenger_count", "trip_distance", "fare_amount",
            )
        ],
        _in_sql("VendorID", [1, 2], "trips"),
        _in_sql("store_and_fwd_flag", ["Y", "N"], "trips"),
        _in_sql("airport_fee", [0, 1.25, 1.75], "trips"),
        _between_sql("RatecodeID", 1, 6, "trips"),
        _between_sql("PULocationID", 1, 265, "trips"),
        _between_sql("DOLocationID", 1, 265, "trips"),
        _between_sql("passenger_count", 1, 7, "trips"),
        _between_sql("fare_amount", 2.5, 250, "trips"),
        _between_sql("improvement_surcharge", 0, 3.1, "trips"),
        _between_sql("payment_type", 1, 6, "trips"),
        _between_sql("congestion_surcharge", 0, 3, "trips"),
        *[_sigma_sql(c, 4, "trips") for c in ("trip_distance", "fare_amount", "tolls_amount")],
        _share_sql("trip_distance", 0.3, 1, "trips"),
        _share_sql("mta_tax", 0, 0.01, "trips"),
    ],
    TRIPS_SQL,
)


@query("i2_i5_i9_i10_i12_i13_i14_i15_staging_suite", STAGING_SQL)
def staging(spark, sf):
    return shown(quality.evaluate(trips(spark, sf), suites.STAGING, AS_OF))


ZONES_CHECK_SQL = _union(
    [
        *[_unique_sql(c, "zones") for c in ("LocationID", "zone", "longitude", "latitude")],
        *[_null_sql(c, "zones") for c in ("LocationID", "borough", "zone", "longitude", "latitude")],
        _between_sql("longitude", -74.28, -73.65, "zones"),
        _between_sql("latitude", 40.48, 40.93, "zones"),
    ],
    ZONES_SQL,
)


@query("i10_i16_zone_suite", ZONES_CHECK_SQL)
def zone_suite(spark, sf):
    return shown(quality.evaluate(zones(spark, sf), suites.ZONES))


_TABLES = Suite(
    "tables",
    (
        Rule("unique", "l_orderkey"),
        Rule("unique", "l_extendedprice"),
        Rule("unique_share", "l_partkey", {"low": 0.0, "high": 0.5}),
        Rule("within_stdevs", "l_extendedprice", {"sigmas": 1}),
        Rule("between", "l_quantity", {"low": 1, "high": 50, "strict": True}),
        Rule("pair_greater", None, {"a": "l_discount", "b": "l_tax", "or_equal": True}),
    ),
)


@query(
    "i10_i12_i13_i14_i16_line_rules",
    _union(
        [
            _unique_sql("l_orderkey", "lineitem"),
            _unique_sql("l_extendedprice", "lineitem"),
            _share_sql("l_partkey", 0, 0.5, "lineitem"),
            _sigma_sql("l_extendedprice", 1, "lineitem"),
            _row_sql("between:l_quantity", "l_quantity IS NOT NULL", "NOT (l_quantity > 1 AND l_quantity < 50)", "lineitem"),
            _row_sql("pair_greater:l_discount-l_tax", "true", "NOT (l_discount >= l_tax)", "lineitem"),
        ]
    ),
)
def line_rules(spark, sf):
    return shown(quality.evaluate(table(spark, sf, "lineitem"), _TABLES))


@query(
    "i15_group_recency",
    """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest,
              max(ts) >= TIMESTAMP '2024-02-01' - INTERVAL 2 DAY AS recent FROM events GROUP BY event_type""",
)
def recency(spark, sf):
    rule = Rule("recent", "ts", {"keys": ["event_type"], "unit": "day", "interval": 2})
    rows = run.group_recency(table(spark, sf, "events"), rule, "2024-02-01")
    return rows.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_DECLARED = json.dumps(
    {
        "expectation_suite_name": "declared",
        "expectations": [
            {"expectation_type": "expect_table_column_count_to_equal", "kwargs": {"value": 6}},
            {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "o_orderstatus", "value_set": ["O", "F"], "mostly": 0.5}},
            {"expectation_type": "expect_column_max_to_be_between", "kwargs": {"column": "o_totalprice", "min_value": 1, "max_value": 1000}},
            {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "o_custkey"}},
        ],
    }
)
_DECLARED_PARTS = [
    _fixed_sql("column_count", True, "6"),
    _in_sql("o_orderstatus", ["O", "F"], "orders", 0.5),
    _sql("max_between:o_totalprice", "count(*)", "1", "max(o_totalprice)", "false", "orders"),
    _null_sql("o_custkey", "orders"),
]


@query("i19_suite_from_json", _union(_DECLARED_PARTS))
def declared(spark, sf):
    return shown(quality.evaluate(table(spark, sf, "orders"), suite_from_json(_DECLARED)))


@query(
    "i17_d11_verdict",
    f"SELECT count(*) AS rules, count(*) FILTER (success) AS passed, avg(CAST(success AS INTEGER)) * 100 AS success_percent FROM ({_union(_DECLARED_PARTS)})",
)
def verdict(spark, sf):
    return quality.verdict(quality.evaluate(table(spark, sf, "orders"), suite_from_json(_DECLARED)))


@query("m3_a27_gate_and_saved_results", _union(_DECLARED_PARTS))
def gate(spark, sf):
    """Gate at 70 percent (three of four rules pass); the stored results are what is returned."""
    suite = suite_from_json(_DECLARED)
    return shown(validate(table(spark, sf, "orders"), suite, "70%", AS_OF, scratch(spark, "results"), "run-1"))


@query(
    "a26_failing_rows",
    """SELECT 'between:l_quantity' AS rule_id, count(*) AS records, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE NOT (l_quantity > 1 AND l_quantity < 50)
       UNION ALL SELECT 'pair_greater:l_discount-l_tax', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem WHERE NOT (l_discount >= l_tax)
       UNION ALL SELECT 'within_stdevs:l_extendedprice', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem, (SELECT avg(l_extendedprice) mu, stddev_samp(l_extendedprice) sd FROM lineitem) WHERE abs(l_extendedprice - mu) / sd > 1
       UNION ALL SELECT 'unique:l_orderkey', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'unique:l_extendedprice', count(*), CAST(NULL AS BIGINT) FROM (SELECT l_extendedprice FROM lineitem GROUP BY 1 HAVING count(*) > 1)""",
)
def failing(spark, sf):
    """Failing records stored by rule and read back."""
    folder = scratch(spark, "failures")
    run.save_failures(quality.failing_rows(table(spark, sf, "lineitem"), _TABLES), folder, "run-1")
    stored = spark.read.parquet(folder)
    key = F.get_json_object("record", "$.l_orderkey").try_cast("bigint")
    return stored.groupBy("rule_id").agg(F.count("*").alias("records"), F.sum(key).alias("keys"))


@query(
    "i18_frame_difference",
    "SELECT CAST(0 AS BIGINT) AS only_left, count(*) AS only_right FROM orders WHERE o_orderstatus = 'P'",
)
def difference(spark, sf):
    """Orders against orders in which every pending one occurs twice."""
    orders = table(spark, sf, "orders")
    more = orders.unionByName(orders.where(F.col("o_orderstatus") == "P"))
    return joins.difference_counts(orders, more)


@query(
    "d12_severity",
    """SELECT l_returnflag || l_linestatus AS part, CASE WHEN n > 10000 THEN 'error' WHEN n > 1000 THEN 'warn' ELSE 'pass' END AS severity
       FROM (SELECT l_returnflag, l_linestatus, count(*) FILTER (l_discount > 0.05) AS n FROM lineitem GROUP BY 1, 2)""",
)
def severity(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("part")).agg(
        F.count_if(F.col("l_discount") > 0.05).alias("n")
    )
    return counted.select("part", run.severity(F.col("n"), _TABLES).alias("severity"))


_FEATURE_CHECKS = FEATURES_SQL[FEATURES_SQL.index("WITH ") + 5 :] + ", features AS (SELECT * FROM features_raw)"


@query(
    "m5_i10_i13_feature_suite",
    _union(
        [
            *[_fixed_sql(f"column_exists:{name}", True) for name in suites.FEATURE_TYPES],
            *[_fixed_sql(f"column_type:{name}", name != "trip_duration") for name in suites.FEATURE_TYPES],
            *[_null_sql(name if name != "date" else '"date"', "features").replace('not_null:"date"', "not_null:date") for name in suites.FEATURE_TYPES],
            _between_sql("passenger_count", 1, 7, "features"),
            _between_sql("fare_amount", 2.5, 250, "features"),
            _between_sql("day_of_month", 1, 31, "features"),
            _between_sql("month", 1, 12, "features"),
            _between_sql("year", 2010, 2023, "features"),
            _between_sql("day_of_week", 1, 7, "features"),
            _between_sql("hour_of_day", 0, 23.999, "features"),
            _sigma_sql("trip_distance", 4, "features"),
            _sigma_sql("fare_amount", 4, "features"),
            _share_sql("trip_distance", 0.3, 1, "features"),
        ],
        _FEATURE_CHECKS,
    ),
)
def feature_suite(spark, sf):
    """The whole feature suite over the stored features of all trips."""
    folder = scratch(spark, "features")
    features.build_features(spark, trips(spark, sf), zones(spark, sf), folder)
    return shown(quality.evaluate(tables.read_months(spark, folder), suites.FEATURES, AS_OF))


@query("i_a27_merged_ingest_suite", INGEST_SQL)
def merged_ingest(spark, sf):
    """The ingest suite from what months have contributed in two runs, the second of which reads the new months alone."""
    folder = scratch(spark, "states")
    rows = tables.with_month(trips(spark, sf), "tpep_pickup_datetime")
    states.update(spark, rows.where(F.col(tables.PART) < "199901"), suites.INGEST, folder, AS_OF)
    new = states.missing_months(spark, folder, [r[0] for r in rows.select(tables.PART).distinct().collect()])
    states.keep(rows.where(F.col(tables.PART).isin(new)), suites.INGEST, folder)
    return shown(states.merged(states.read(spark, folder), rows.drop(tables.PART), suites.INGEST, AS_OF))


@query("i10_i13_merged_staging_suite", STAGING_SQL)
def merged_staging(spark, sf):
    """Rules on deviations, distinct values and recency, merged from months."""
    folder = scratch(spark, "states")
    rows = tables.with_month(trips(spark, sf), "tpep_pickup_datetime")
    states.keep(rows, suites.STAGING, folder)
    return shown(states.merged(states.read(spark, folder), rows.drop(tables.PART), suites.STAGING, AS_OF))
