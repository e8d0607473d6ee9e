import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from cabstand.operators import columns, filters, joins, routing
from cabstand.specs import TRIP_COLUMNS, YELLOW, narrowed, struct_of, trip_rules
from tests.support import GOOD_TRIP, plan_of, rows_of, trips, zones

AS_OF = "2023-06-01"


def test_cast_columns_types_and_values(spark):
    rows = [
        (1, "2022-01-01 12:34:56", "2022-01-01 12:45:23", 1, 2.5, 1, 100.0),
        (2, "2022-02-01 13:34:56", "garbage", 3, 3.5, 2, 150.0),
    ]
    df = spark.createDataFrame(
        rows,
        "VendorID long, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count long, "
        "trip_distance double, RateCodeID long, fare_amount double",
    )
    mapping = {k: v for k, v in TRIP_COLUMNS.items() if k != "fare_amount"}
    cast = columns.cast_columns(df, mapping)
    assert [(f.name, f.dataType.simpleString()) for f in cast.schema.fields] == [
        ("VendorID", "int"),
        ("tpep_pickup_datetime", "timestamp"),
        ("tpep_dropoff_datetime", "timestamp"),
        ("passenger_count", "int"),
        ("trip_distance", "double"),
        ("RatecodeID", "int"),
        ("fare_amount", "double"),
    ]
    assert [tuple(r) for r in cast.collect()] == [
        (1, dt.datetime(2022, 1, 1, 12, 34, 56), dt.datetime(2022, 1, 1, 12, 45, 23), 1, 2.5, 1, 100.0),
        (2, dt.datetime(2022, 2, 1, 13, 34, 56), None, 3, 3.5, 2, 150.0),
    ]
    failures = {r["column"]: r["failed"] for r in columns.cast_failures(df, mapping).collect()}
    assert failures["tpep_dropoff_datetime"] == 1 and sum(failures.values()) == 1
    assert "airport_fee" in columns.missing_columns(df, TRIP_COLUMNS)
    assert "RatecodeID" not in columns.missing_columns(df, TRIP_COLUMNS)


def test_narrow_floats_are_selectable(spark):
    cast = columns.cast_columns(trips(spark), narrowed(TRIP_COLUMNS))
    assert cast.schema["fare_amount"].dataType.simpleString() == "float"


def test_month_window_at_the_boundary(spark):
    midnight = {"tpep_pickup_datetime": dt.datetime(2022, 12, 1)}
    df = trips(spark, {}, midnight)
    assert filters.in_month(df, "tpep_pickup_datetime", "2022-11-01").count() == 1
    assert filters.in_month(df, "tpep_pickup_datetime", "2022-11-01", inclusive_end=True).count() == 2
    assert filters.in_month(df, "tpep_pickup_datetime", "2022-12-01").count() == 1


def test_recent_months_are_strictly_later(spark):
    edge = dt.datetime(2022, 12, 1)
    df = trips(spark, {"tpep_pickup_datetime": edge}, {"tpep_pickup_datetime": edge + dt.timedelta(seconds=1)})
    assert filters.in_recent_months(df, "tpep_pickup_datetime", 6, AS_OF).count() == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_filters_reach_the_scan(spark, folder, kind):
    spark.sql(f"SELECT CAST('2022-11-05' AS {kind}) AS t").write.mode("overwrite").parquet(folder)
    df = spark.read.parquet(folder)
    for filtered in (
        filters.in_month(df, "t", "2022-11-01"),
        filters.in_recent_months(df, "t", 6, "2023-01-01"),
        filters.in_years(df, "t", 2022, 2022),
        filters.since_day(df, "t", "2022-11-05"),
    ):
        assert filtered.count() == 1
        pushed = [line for line in plan_of(filtered).splitlines() if "PushedFilters" in line]
        assert pushed and ("GreaterThan" in pushed[-1])


def test_keyed_share_is_repeatable_and_about_right(spark):
    df = spark.range(20000)
    first = filters.keyed_share(df, ["id"], 0.1, seed=3)
    again = filters.keyed_share(df.repartition(7), ["id"], 0.1, seed=3)
    assert rows_of(first) == rows_of(again)
    assert 1700 < first.count() < 2300


def test_choose_all_keeps_everything(spark):
    df = zones(spark)
    assert filters.choose(df, "borough", "All").count() == 4
    assert filters.choose(df, "zone", ["Lincoln Square East", "none"]).count() == 1
    assert filters.drill_down(df, "borough", "Queens", "zone").count() == 0


NULL_ABLE = [n for n in GOOD_TRIP if n in (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "RatecodeID",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount")]


@pytest.mark.parametrize("name", NULL_ABLE)
def test_a_null_in_any_rule_column_goes_to_triage(spark, name):
    df = trips(spark, {}, {name: None})
    clean, triage = routing.split(df, trip_rules(AS_OF))
    assert (clean.count(), triage.count()) == (1, 1)
    routed = routing.with_route(df, trip_rules(AS_OF))
    assert sorted(r[0] for r in routed.select("route").collect()) == ["clean", "triage"]


def test_dropping_nulls_loses_rows_whose_rules_are_unknown(spark):
    df = trips(spark, {}, {"passenger_count": None}, {"passenger_count": None, "fare_amount": 1.0}, {"fare_amount": 250.0})
    clean, triage = routing.split(df, trip_rules(AS_OF), null_policy="drop")
    assert (clean.count(), triage.count()) == (1, 2)
    routed = routing.with_route(df, trip_rules(AS_OF), null_policy="drop")
    assert rows_of(routed.groupBy("route").count()) == [("clean", 1), ("triage", 2)]


@pytest.mark.parametrize(
    "change, failed",
    [
        ({"fare_amount": 2.5}, []),
        ({"fare_amount": 2.49}, ["fare_at_least_2_5"]),
        ({"fare_amount": 249.99}, []),
        ({"fare_amount": 250.0}, ["fare_below_250"]),
        ({"passenger_count": 8}, []),
        ({"passenger_count": 9, "VendorID": 0}, ["passenger_count_1_8", "vendor_1_3"]),
        ({"payment_type": 7, "RatecodeID": 7, "VendorID": 3}, []),
        ({"payment_type": 8, "RatecodeID": 8}, ["rate_code_1_7", "payment_type_1_7"]),
        ({"tpep_dropoff_datetime": GOOD_TRIP["tpep_pickup_datetime"]}, ["pickup_before_dropoff"]),
        ({"tpep_dropoff_datetime": dt.datetime(2023, 6, 1)}, ["dropoff_in_past"]),
        ({"DOLocationID": None}, ["DOLocationID_present"]),
    ],
)
def test_rule_boundaries(spark, change, failed):
    row = routing.with_route(trips(spark, change), trip_rules(AS_OF)).first()
    assert row["failed_rules"] == failed
    assert row["route"] == ("triage" if failed else "clean")


def test_without_as_of_the_rules_use_the_time_of_the_run(spark):
    rules = trip_rules()
    soon = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(seconds=3)
    df = trips(spark, {"tpep_dropoff_datetime": soon})
    routed = routing.with_route(df, rules).select("route", "failed_rules")
    assert tuple(routed.first()) == ("triage", ["dropoff_in_past"])
    time.sleep(4)
    assert routing.with_route(df, rules).first()["route"] == "clean"


def test_routes_add_up_on_the_given_tables(spark, sf):
    from cabstand.catalog.bindings import trips as bound

    df = bound(spark, sf)
    clean, triage = routing.split(df, YELLOW.rules("2001-06-01"))
    assert clean.count() + triage.count() == df.count()
    assert rows_of(joins.difference_counts(df, clean.unionByName(triage))) == [(0, 0)]


def test_repeated_dimension_keys_do_not_multiply_facts(spark):
    twice = zones(spark, (56, "Queens", "Corona", -73.86, 40.74), (56, "Queens", "Corona", -73.84, 40.76))
    fact = trips(spark, {"PULocationID": 56, "DOLocationID": 142})
    roles = {"pickup_": "PULocationID", "dropoff_": "DOLocationID"}
    raw = joins.with_roles(fact, joins.unique_dimension(twice, "LocationID", "as_is"), "LocationID", roles, {"longitude": "x"})
    once = joins.with_roles(fact, joins.unique_dimension(twice, "LocationID"), "LocationID", roles, {"longitude": "x"})
    assert raw.count() == 2
    assert [r["pickup_x"] for r in once.collect()] == [pytest.approx(-73.85)]
    with pytest.raises(Exception, match="repeated LocationID: 56"):
        joins.unique_dimension(twice, "LocationID", "strict").collect()


def test_unknown_places_are_dropped_and_counted(spark):
    fact = trips(spark, {}, {"PULocationID": 57}, {"DOLocationID": None})
    roles = {"pickup_": "PULocationID", "dropoff_": "DOLocationID"}
    assert joins.with_roles(fact, zones(spark), "LocationID", roles, {"zone": "zone"}).count() == 1
    assert rows_of(joins.unmatched(fact, zones(spark), "LocationID", roles)) == [(1, 1, 3)]


def test_role_join_is_the_same_with_and_without_broadcast(spark, sf):
    from cabstand.catalog.bindings import trips as bound, zones as places

    roles = {"pickup_": "PULocationID", "dropoff_": "DOLocationID"}

    def joined():
        return joins.with_roles(bound(spark, sf), places(spark, sf), "LocationID", roles, {"zone": "zone"})

    small = joined()
    assert "BroadcastHashJoin" in plan_of(small) and "CartesianProduct" not in plan_of(small)
    known = rows_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joined()
        assert "SortMergeJoin" in plan_of(large) and "BroadcastHashJoin" not in plan_of(large)
        assert rows_of(large) == known
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_existence_with_a_key_that_fills_a_third_of_the_rows(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 4).otherwise(F.col("id") % 8).alias("j"))
    assert rows_of(joins.existing(left, right, {"k": "j"})) == [(i,) for i in range(8)]
    assert rows_of(joins.missing(left, right, {"k": "j"})) == [(8,), (9,)]


def test_nulls_match_nothing(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows_of(joins.existing(left, left.withColumnRenamed("k", "j"), {"k": "j"})) == [(1,)]
    assert rows_of(joins.missing(left, left.withColumnRenamed("k", "j"), {"k": "j"})) == [(None,)]


def test_concat_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2.5, 2)], "c double, a int")
    assert rows_of(joins.concat([a, b])) == [(1, "x", None), (2, None, 2.5)]
    with pytest.raises(ValueError):
        joins.concat([])


def test_difference_counts_multiplicity(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None), (3, "x")], "a int, b string")
    assert rows_of(joins.difference_counts(a, b)) == [(2, 1)]
    assert rows_of(joins.difference_counts(a.limit(0), b.limit(0))) == [(0, 0)]


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("7", 1.0)], "B string, extra_column double")
    out = columns.conform(df, {"a": "int", "b": "int"})
    assert out.columns == ["a", "b"] and rows_of(out) == [(None, 7)]


def test_label_and_features(spark):
    target, features = columns.label_and_features(zones(spark), "ZONE", drop=("borough",))
    assert (target, features) == ("zone", ["LocationID", "longitude", "latitude"])
    with pytest.raises(ValueError):
        columns.label_and_features(zones(spark), "fare")


def test_schema_carries_comments():
    schema = struct_of({"a": "int"}, {"a": "text"})
    assert schema["a"].metadata == {"comment": "text"}
