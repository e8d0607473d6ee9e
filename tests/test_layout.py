"""Co-located layouts, declared columns and descriptions, cost by label."""

import pytest
from pyspark.sql import functions as F

from cabstand.catalog import lifecycle
from cabstand.plans import features, load
from cabstand.sources import costs, tables
from cabstand.specs import SUMMARY_COLUMNS, SUMMARY_COMMENTS, TRIP_COLUMNS, TRIP_COMMENTS, YELLOW
from tests.support import plan_of, trips


def test_bucketed_tables_join_and_group_without_an_exchange(spark, sf):
    rows, monthly = lifecycle.co_located(spark, sf, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rows.join(monthly, list(lifecycle._CO_KEYS)).groupBy(*lifecycle._CO_KEYS).agg(F.count("*"))
        plan = plan_of(joined).split("== Physical Plan ==")[1]
        joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    files = [name.rsplit("_", 1)[-1] for name in rows.inputFiles()]
    assert len(files) == len(set(files)) == 4


def test_every_column_of_every_table_is_described(spark, sf):
    assert set(TRIP_COMMENTS) == set(TRIP_COLUMNS) and set(SUMMARY_COMMENTS) == set(SUMMARY_COLUMNS)
    assert set(features.FEATURE_COMMENTS) == set(features.FEATURE_TYPES) == set(features.FEATURE_COLUMNS)


def test_undeclared_columns_stop_a_load_before_it_writes(spark, folder):
    rows = trips(spark).withColumn("surprise", F.lit(1))
    with pytest.raises(ValueError, match="surprise"):
        tables.declared(rows, TRIP_COLUMNS, TRIP_COMMENTS)
    made = tables.declared(trips(spark).drop("airport_fee").withColumn("route", F.lit("clean")), TRIP_COLUMNS, TRIP_COMMENTS, ("route",))
    assert made.columns == [*TRIP_COLUMNS, "route"] and made.first()["airport_fee"] is None
    assert made.schema["extra"].metadata["comment"] == TRIP_COMMENTS["extra"]


def test_loads_store_declared_types_and_descriptions(spark, folder):
    trips(spark, {}, {"fare_amount": 1.0}).withColumn("VendorID", F.col("VendorID").cast("long")).write.parquet(folder + "/raw")
    out = load.Outputs(folder + "/s", folder + "/t")
    load.run_month(spark, YELLOW, [folder + "/raw"], "2022-11-01", out, "2023-06-01")
    summary = spark.read.parquet(out.summary)
    assert dict(summary.drop("part_month").dtypes) == SUMMARY_COLUMNS
    assert {r["column"]: r["comment"] for r in tables.descriptions(summary.drop("part_month")).collect()} == SUMMARY_COMMENTS


def test_costs_tell_labels_apart(spark, folder):
    with tables.labelled(spark, "one-load"):
        spark.range(1000).repartition(3).write.parquet(folder + "/one")
    spark.range(50).write.parquet(folder + "/none")
    tables.overwrite_months(spark.range(7).withColumn("day", F.lit("2022-01-02").cast("date")), folder + "/two", "day", label="two-load")
    found = {r["label"]: r for r in costs.costs(spark, "one-load", "two-load", "never").collect()}
    assert found["one-load"]["rows_written"] == 1000 and found["one-load"]["bytes_shuffled"] > 0 and found["one-load"]["tasks"] >= 3
    assert found["two-load"]["rows_written"] == 7 and found["two-load"]["bytes_written"] > 0
    assert found["never"]["jobs"] == found["never"]["tasks"] == 0
    for _ in range(2):
        costs.save_costs(costs.costs(spark, "one-load"), folder + "/costs", "r1")
    assert spark.read.parquet(folder + "/costs").count() == 1
