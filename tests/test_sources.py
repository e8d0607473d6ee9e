import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cabstand.operators import joins
from cabstand.quality import evaluate, suites
from cabstand.sources import dimensions, files, samples, storage, tables
from cabstand.specs import TRIP_COLUMNS, TRIP_COMMENTS, ZONE_COLUMNS, struct_of
from tests.support import ZONE_ROWS, plan_of, rows_of, trips, zones


def test_read_parquet_takes_a_list_only(spark):
    with pytest.raises(ValueError):
        files.read_parquet(spark, "a/b.parquet")
    with pytest.raises(ValueError):
        files.read_parquet(spark, [])


def test_schema_groups_of_alternating_types(spark):
    months = ["2019-01", "2019-02", "2019-03", "2019-04"]
    rows = [
        (month, pos, column, "int64" if column != "airport_fee" or i % 2 else "double")
        for i, month in enumerate(months)
        for pos, column in enumerate(["VendorID", "passenger_count", "airport_fee"])
    ]
    assigned = files.with_schema_id(spark.createDataFrame(rows, files.FOOTER_SCHEMA))
    groups = sorted(r["links"] for r in files.schema_groups(assigned).collect())
    assert groups == [["2019-01", "2019-03"], ["2019-02", "2019-04"]]


def test_many_files_of_one_schema_come_in_several_lists(spark):
    assigned = spark.range(500).select(F.format_string("f%04d", "id").alias("link"), F.lit("x").alias("schema_id"))
    lists = [r["links"] for r in files.schema_groups(assigned, bundle=50).collect()]
    assert len(lists) > 5 and max(map(len, lists)) < 120
    assert sorted(sum(lists, [])) == [f"f{i:04d}" for i in range(500)]


def test_wide_schemas(spark):
    rows = [("a", 0, "x", "int64"), ("a", 1, "y", "string"), ("b", 0, "x", "double")]
    wide = files.wide_schemas(spark.createDataFrame(rows, files.FOOTER_SCHEMA), ["x", "y"])
    assert rows_of(wide) == [("a", "int64", "string"), ("b", "double", None)]


def write_drifting(spark, folder):
    """Fee as double, as whole number, missing, columns reversed, another letter case."""
    base = trips(spark, {"airport_fee": 1.0})
    base.coalesce(1).write.parquet(f"{folder}/a")
    base.withColumn("airport_fee", F.col("airport_fee").cast("long")).coalesce(1).write.parquet(f"{folder}/b")
    base.drop("airport_fee").coalesce(1).write.parquet(f"{folder}/c")
    base.select(*reversed(base.columns)).coalesce(1).write.parquet(f"{folder}/d")
    base.withColumnRenamed("RatecodeID", "RateCodeID").coalesce(1).write.parquet(f"{folder}/e")
    base.coalesce(1).write.parquet(f"{folder}/f")


def test_drift_safe_load(spark, folder):
    write_drifting(spark, folder)
    found = files.manifest(spark, folder)
    assert found.count() == 6
    groups = files.drift_groups(found)
    assert sorted(map(len, groups)) == [1, 1, 1, 3]
    rows = files.read_drifting(spark, found, TRIP_COLUMNS)
    assert rows.schema == struct_of(TRIP_COLUMNS)
    assert sorted((r["airport_fee"] for r in rows.collect()), key=str) == [1.0, 1.0, 1.0, 1.0, 1.0, None]
    assert {r["RatecodeID"] for r in rows.collect()} == {1}


def test_filter_before_the_cast_reaches_every_scan(spark, folder):
    write_drifting(spark, folder)
    groups = files.drift_groups(files.manifest(spark, folder))
    rows = files.read_groups(spark, groups, TRIP_COLUMNS, keep=lambda df: df.where(F.col("fare_amount") > 3.0))
    scans = [line for line in plan_of(rows).split("== Physical Plan ==")[1].splitlines() if "FileScan" in line]
    assert len(scans) == 4 and all("GreaterThan(fare_amount,3.0)" in line for line in scans)


def test_footers_match_the_files(spark, folder):
    trips(spark).coalesce(1).write.parquet(folder + "/t")
    footers = files.footer_schemas(files.manifest(spark, folder))
    name = glob.glob(folder + "/t/*.parquet")[0]
    schema = pq.read_schema(name)
    assert [(r["column"], r["type"]) for r in footers.orderBy("pos").collect()] == [(f.name, str(f.type)) for f in schema]


def test_manifest_reads_no_contents_and_empty_is_an_error(spark, folder):
    trips(spark).write.parquet(folder + "/t")
    plan = plan_of(files.manifest(spark, folder))
    assert "content:" not in plan.split("ReadSchema:")[-1]
    with pytest.raises(ValueError):
        files.require_files(files.manifest(spark, folder, prefix="nothing"))


def test_select_files_against_the_ledger(spark):
    names = ["yellow_2022-01.parquet", "yellow_2022-02.parquet", "yellow_2009-01.parquet", "green_2022-01.parquet"]
    found = spark.createDataFrame([(f"s3://b/{n}", n) for n in names], "path string, filename string")
    ledger = found.where(F.col("filename") == "yellow_2022-01.parquet").select("path")
    picked = files.select_files(found, ["yellow_"], ["yellow_2009"], ledger)
    assert [r["filename"] for r in picked.collect()] == ["yellow_2022-02.parquet"]
    with pytest.raises(FileExistsError):
        files.select_files(found, ["yellow_"], (), ledger, fail_if_present=True)
    with pytest.raises(Exception):
        files.select_files(found, ["green_"], (), found.select("path"), fail_if_present=True)
    assert files.select_files(found).count() == 4


def test_zone_csv_is_typed_and_made_unique(spark, folder):
    raw = zones(spark, (56, "Queens", "Corona", -73.86, 40.74), (56, "Queens", "Corona", -73.84, 40.76))
    raw.coalesce(1).write.option("header", True).csv(folder + "/z")
    assert dimensions.read_csv(spark, folder + "/z", ZONE_COLUMNS).schema == struct_of(ZONE_COLUMNS)
    unique = {r["rule_id"]: r["success"] for r in evaluate(dimensions.read_zones(spark, folder + "/z", "as_is"), suites.ZONES).collect()}
    assert unique["unique:LocationID"] is False and unique["unique:zone"] is False
    made = dimensions.read_zones(spark, folder + "/z")
    assert made.count() == len(ZONE_ROWS) + 1
    assert all(r["success"] for r in evaluate(made, suites.ZONES).collect())


def test_bad_csv_value_fails_the_load(spark, folder):
    with open(folder + "/z.csv", "w") as handle:
        handle.write("LocationID,borough,zone,longitude,latitude\nx,a,b,1.0,2.0\n")
    with pytest.raises(Exception):
        dimensions.read_csv(spark, folder + "/z.csv", ZONE_COLUMNS).collect()


def test_zone_dimension_from_points(spark):
    points = spark.createDataFrame(
        [(1, 10, 0.0, 0.0), (1, 10, 2.0, 4.0), (1, 10, 1.0, 9.0), (56, 20, 0.0, 0.0), (56, 21, 4.0, 8.0)],
        "LocationID int, polygon int, x double, y double",
    )
    attributes = spark.createDataFrame(
        [(1, "A", "one"), (56, "Q", "Corona"), (56, "Q", "Corona"), (99, "Z", "no shape")],
        "LocationID int, borough string, zone string",
    )
    assert rows_of(dimensions.zone_dimension(points, attributes)) == [
        (1, "A", "one", 1.0, 4.5),
        (56, "Q", "Corona", 2.0, 4.0),
        (99, "Z", "no shape", None, None),
    ]
    assert dimensions.zone_dimension(points, attributes, "as_is").count() == 6


def month(n, **more):
    return {"tpep_pickup_datetime": dt.datetime(2022, n, 3), **more}


def test_overwrite_is_idempotent_and_leaves_other_months(spark, folder):
    path = folder + "/t"
    tables.overwrite_months(trips(spark, month(1), month(2), month(3)), path, "tpep_pickup_datetime", ("PULocationID",))
    again = trips(spark, month(2, VendorID=1), month(2, VendorID=1))
    for _ in range(2):
        written = tables.overwrite_months(again, path, "tpep_pickup_datetime")
        assert (written.rows, written.partitions) == (2, frozenset({"part_month=202202"}))
    table = tables.read_months(spark, path)
    assert rows_of(table.groupBy("part_month").count()) == [("202201", 1), ("202202", 2), ("202203", 1)]
    assert storage.partition_values(spark, path, "part_month") == ["202201", "202202", "202203"]


def test_rows_without_a_date_are_kept_apart(spark, folder):
    tables.overwrite_months(trips(spark, {"tpep_pickup_datetime": None}), folder + "/t", "tpep_pickup_datetime")
    assert rows_of(tables.read_months(spark, folder + "/t").select("part_month")) == [("none",)]


def test_append_repeats_rows_on_a_rerun(spark, folder):
    for _ in range(2):
        tables.append_months(trips(spark, month(1)), folder + "/t", "tpep_pickup_datetime")
    assert tables.read_months(spark, folder + "/t").count() == 2


def test_replace_drops_months_the_new_data_lacks(spark, folder):
    path = folder + "/t"
    tables.replace_table(trips(spark, month(1), month(2)), path, "tpep_pickup_datetime")
    tables.replace_table(trips(spark, month(2), month(3)), path, "tpep_pickup_datetime")
    assert storage.partition_values(spark, path, "part_month") == ["202202", "202203"]


def test_files_are_sorted_by_the_cluster_columns(spark, folder, sf):
    from cabstand.catalog.bindings import trips as bound

    tables.overwrite_months(bound(spark, sf), folder + "/t", "tpep_pickup_datetime", ("PULocationID", "VendorID"))
    names = glob.glob(folder + "/t/*/*.parquet")
    assert names
    for name in names:
        rows = pq.ParquetFile(name).read(["PULocationID", "VendorID"]).to_pylist()
        keys = [(r["PULocationID"], r["VendorID"]) for r in rows]
        assert keys == sorted(keys)


def test_a_hot_month_is_split_over_files(spark, folder):
    """All rows in one month: AQE cuts the single partition at the advisory size."""
    df = spark.range(0, 200000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(dt.date(2022, 1, 5)).alias("d"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.overwrite_months(df, folder + "/t", "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(folder + "/t/part_month=202201/*.parquet")) > 2
    assert tables.read_months(spark, folder + "/t").count() == 200000


def test_month_range_prunes_folders_and_filters_rows(spark, folder):
    tables.overwrite_months(trips(spark, month(1), month(2), month(3)), folder + "/t", "tpep_pickup_datetime")
    rows = tables.read_months(spark, folder + "/t", "tpep_pickup_datetime", "2022-01-15", "2022-03-03")
    assert rows_of(rows.select("part_month")) == [("202202",)]
    scan = plan_of(rows).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(part_month" in scan and "GreaterThanOrEqual(tpep_pickup_datetime" in scan


def test_retention(spark, folder):
    path = folder + "/t"
    tables.overwrite_months(trips(spark, month(1), month(2), month(3), {"tpep_pickup_datetime": None}), path, "tpep_pickup_datetime")
    assert tables.expired_months(["202201", "none", "x"], "2022-03-03", 30) == ["202201"]
    assert tables.expired_months(["202201"], "2022-03-02 23:00:00", 30) == []
    assert tables.expire(spark, path, "2022-03-31", 30) == ["202201", "202202"]
    assert storage.partition_values(spark, path, "part_month") == ["202203", "none"]


def test_ddl_and_descriptions(spark, folder):
    sql = tables.create_table_sql("declared_trips", TRIP_COLUMNS, TRIP_COMMENTS, folder + "/d", "it's a table")
    spark.sql(sql)
    try:
        fields = {f.name: f for f in spark.table("declared_trips").schema.fields}
        assert list(fields) == [*TRIP_COLUMNS, "part_month"]
        assert fields["fare_amount"].metadata["comment"] == TRIP_COMMENTS["fare_amount"]
    finally:
        spark.sql("DROP TABLE declared_trips")
    tables.commented(trips(spark), TRIP_COMMENTS).write.parquet(folder + "/c")
    kept = {r["column"]: r["comment"] for r in tables.descriptions(spark.read.parquet(folder + "/c")).collect()}
    assert kept == TRIP_COMMENTS


def test_undeclared_columns_are_refused(spark):
    with pytest.raises(ValueError):
        tables.enforced(trips(spark).withColumn("more", F.lit(1)), TRIP_COLUMNS)
    assert tables.enforced(trips(spark).drop("extra"), TRIP_COLUMNS).columns == list(TRIP_COLUMNS)


def test_samples_leave_out_nothing(spark):
    df = spark.range(100_000).withColumn("date", F.current_date())
    assert samples.training_sample(df, share=1.0, seed=1).count() == df.count()
    assert samples.training_sample(df, seed=1).columns == ["id"]
    assert 9000 < samples.training_sample(df, seed=1).count() < 11000
    assert samples.query_sample(spark, "SELECT * FROM range(1000000)").count() == 1_000_000


def test_view_follows_its_source(spark, sf):
    from cabstand.catalog.bindings import table

    view = tables.as_view(table(spark, sf, "nation"), "v_nation")
    assert spark.sql("SELECT count(*) FROM v_nation").first()[0] == view.count() == 25


def test_no_local_checkpoint_and_lineage_cut(spark):
    from cabstand.session import cut_lineage

    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Scan ExistingRDD" in plan_of(df)
    assert os.path.isdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))


def test_join_helpers_never_force_a_broadcast(spark, sf):
    from cabstand.catalog.bindings import trips as bound, zones as places

    joined = joins.with_roles(bound(spark, sf), places(spark, sf), "LocationID", {"p_": "PULocationID"}, {"zone": "zone"})
    assert "ResolvedHint" not in plan_of(joined)


def test_footer_stores_follow_the_scheme():
    options = {"fs.s3a.access.key": "a", "fs.s3a.secret.key": "b", "fs.s3a.endpoint": "http://store:9000", "fs.s3a.endpoint.region": "x"}
    for link in ("s3a://bucket/a/b.parquet", "s3://bucket/a/b.parquet"):
        store, path = files.arrow_store(link, options)
        assert store.type_name == "s3" and store.region == "x" and path == "bucket/a/b.parquet"
    for link in ("/tmp/b.parquet", "file:/tmp/b.parquet", "file:///tmp/b.parquet"):
        store, path = files.arrow_store(link, {})
        assert store.type_name == "local" and path == "/tmp/b.parquet"
    with pytest.raises(ValueError):
        files.arrow_store("odd://somewhere/b.parquet", {})


def test_no_machine_folder_on_a_cluster():
    from types import SimpleNamespace

    from cabstand.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf={}, sparkContext=context))
