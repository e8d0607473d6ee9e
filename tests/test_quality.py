import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cabstand import quality
from cabstand.plans.load import validate
from cabstand.quality import Rule, Suite, evaluate, failing_rows, rule_from_declaration, run, suites
from cabstand.specs import TRIP_COLUMNS
from tests.support import plan_of, rows_of, trips, zones


def outcome(spark_df, *rules, **limits):
    results = evaluate(spark_df, Suite("s", tuple(rules), **limits), as_of="2023-01-01").collect()
    return results[0] if len(results) == 1 else results


def values(spark, *items, kind="int"):
    return spark.createDataFrame([(i,) for i in items], f"x {kind}")


@pytest.mark.parametrize(
    "items, mostly, total, failing, success",
    [
        ((1, 2, None, None), 1.0, 4, 2, False),
        ((1, 2, None, None), 0.5, 4, 2, True),
        ((1, 2, None, None), 0.51, 4, 2, False),
        ((), 1.0, 0, 0, True),
    ],
)
def test_not_null_counts_all_rows(spark, items, mostly, total, failing, success):
    row = outcome(values(spark, *items), Rule("not_null", "x", mostly=mostly))
    assert (row["total"], row["failing"], row["success"]) == (total, failing, success)


@pytest.mark.parametrize(
    "items, mostly, total, failing, success",
    [
        ((1, 2, 9, None), 1.0, 3, 1, False),
        ((1, 2, 9, None), 0.6, 3, 1, True),
        ((1, 2, 9, None), 0.7, 3, 1, False),
        ((None, None), 0.9, 0, 0, True),
        ((), 0.9, 0, 0, True),
    ],
)
def test_in_set_ignores_nulls(spark, items, mostly, total, failing, success):
    row = outcome(values(spark, *items), Rule("in_set", "x", {"values": [1, 2]}, mostly))
    assert (row["total"], row["failing"], row["success"]) == (total, failing, success)


@pytest.mark.parametrize("strict, failing", [(False, 1), (True, 3)])
def test_between_with_and_without_its_ends(spark, strict, failing):
    row = outcome(values(spark, 1, 2, 3, 4, None), Rule("between", "x", {"low": 1, "high": 3, "strict": strict}))
    assert (row["total"], row["failing"]) == (4, failing)


def test_open_ended_between(spark):
    assert outcome(values(spark, 1, 2), Rule("between", "x", {"low": 2}))["failing"] == 1


@pytest.mark.parametrize("or_equal, failing", [(False, 2), (True, 1)])
def test_pair(spark, or_equal, failing):
    df = spark.createDataFrame([(2, 1), (1, 1), (0, 1), (None, 1)], "p int, q int")
    row = outcome(df, Rule("pair_greater", None, {"a": "p", "b": "q", "or_equal": or_equal}))
    assert (row["total"], row["failing"]) == (3, failing)


def test_max_between(spark):
    rule = Rule("max_between", "x", {"low": 1, "high": 3})
    assert outcome(values(spark, 0, 3), rule)["success"] is True
    assert outcome(values(spark, 0, 4), rule)["success"] is False
    assert outcome(values(spark, 0, 0), rule)["success"] is False
    assert outcome(values(spark), rule)["success"] is True


def test_within_stdevs(spark):
    df = values(spark, *([0.0] * 50 + [1.0] * 50 + [100.0]), kind="double")
    assert outcome(df, Rule("within_stdevs", "x", {"sigmas": 4}))["failing"] == 1
    assert outcome(values(spark, 5.0, 5.0, kind="double"), Rule("within_stdevs", "x", {"sigmas": 4}))["failing"] == 0


def test_unique_and_unique_share(spark):
    df = values(spark, 1, 1, 1, 2, 3, 3, None, None)
    unique, share = outcome(df, Rule("unique", "x"), Rule("unique_share", "x", {"low": 0.3, "high": 0.5}))
    assert (unique["total"], unique["failing"], unique["success"]) == (6, 2, False)
    assert (share["observed"], share["success"]) == (0.5, True)


def test_unique_share_can_be_estimated_in_the_one_pass(spark, folder):
    spark.range(20000).select((F.col("id") % 5000).alias("x")).write.parquet(folder + "/t")
    rule = Rule("unique_share", "x", {"low": 0.2, "high": 0.3, "approximate": 0.02})
    results = evaluate(spark.read.parquet(folder + "/t"), Suite("s", (rule, Rule("not_null", "x"))))
    row = results.where("kind = 'unique_share'").first()
    assert row["success"] and row["observed"] == pytest.approx(0.25, rel=0.1)
    assert plan_of(results).split("== Physical Plan ==")[1].count("FileScan parquet") == 1


def test_recency_per_group_and_for_the_whole_table(spark):
    old, new = dt.datetime(2022, 7, 1), dt.datetime(2022, 12, 1)
    df = spark.createDataFrame([(1, old), (1, new), (2, old), (3, None)], "k int, t timestamp")
    params = {"unit": "month", "interval": 5}
    grouped = outcome(df, Rule("recent", "t", {**params, "keys": ["k"]}))
    assert (grouped["total"], grouped["failing"]) == (3, 2)
    assert outcome(df, Rule("recent", "t", params))["success"] is True
    edge = df.where("k = 1").withColumn("t", F.lit("2022-08-01").cast("timestamp"))
    assert outcome(edge, Rule("recent", "t", {**params, "keys": ["k"]}))["success"] is True


@pytest.mark.parametrize(
    "rule, success",
    [
        (Rule("columns_ordered", None, {"columns": ["a", "b"]}), True),
        (Rule("columns_ordered", None, {"columns": ["b", "a"]}), False),
        (Rule("columns_set", None, {"columns": ["B", "a"]}), True),
        (Rule("columns_set", None, {"columns": ["a"]}), False),
        (Rule("column_count", None, {"count": 2}), True),
        (Rule("column_exists", "A"), True),
        (Rule("column_exists", "z"), False),
        (Rule("column_type", "a", {"type": "integer"}), True),
        (Rule("column_type", "a", {"type": "float"}), False),
        (Rule("column_type", "z", {"type": "float"}), False),
        (Rule("type_list", "a", {"types": list(suites.INTEGER_TYPE_NAMES)}, 0.5), True),
        (Rule("type_list", "b", {"types": list(suites.INTEGER_TYPE_NAMES)}, 0.5), False),
        (Rule("not_null", "z"), False),
    ],
)
def test_schema_rules(spark, rule, success):
    df = spark.createDataFrame([(1, "x")], "a long, b string")
    assert outcome(df, rule)["success"] is success


def test_ingest_suite_on_a_good_and_a_bad_file(spark):
    good = evaluate(trips(spark), suites.INGEST)
    assert good.count() == 15 and good.where("NOT success").count() == 0
    bad = trips(spark, {}, {"DOLocationID": 999, "fare_amount": None, "store_and_fwd_flag": "?", "VendorID": 9})
    failed = {r["rule_id"] for r in evaluate(bad, suites.INGEST).where("NOT success").collect()}
    assert failed == {"max_between:DOLocationID", "not_null:fare_amount", "in_set:store_and_fwd_flag", "in_set:VendorID"}


def test_mostly_lets_a_tenth_fail(spark):
    df = trips(spark, *([{}] * 9), {"passenger_count": None})
    rows = {r["rule_id"]: r for r in evaluate(df, suites.INGEST).collect()}
    assert rows["not_null:passenger_count"]["success"] is True
    df = trips(spark, *([{}] * 8), {"passenger_count": None}, {"passenger_count": None})
    rows = {r["rule_id"]: r for r in evaluate(df, suites.INGEST).collect()}
    assert rows["not_null:passenger_count"]["success"] is False


def test_row_rules_share_one_scan(spark, folder):
    trips(spark).write.parquet(folder + "/t")
    plan = plan_of(evaluate(spark.read.parquet(folder + "/t"), suites.INGEST)).split("== Physical Plan ==")[1]
    assert plan.count("FileScan parquet") == 1


def test_distinct_rules_read_one_column_each(spark, folder):
    trips(spark).write.parquet(folder + "/t")
    suite = Suite("s", (Rule("unique", "fare_amount"), Rule("unique_share", "mta_tax", {"low": 0, "high": 1})))
    plan = plan_of(evaluate(spark.read.parquet(folder + "/t"), suite)).split("== Physical Plan ==")[1]
    assert plan.count("FileScan parquet") == 2 and "Expand" not in plan
    assert "ReadSchema: struct<fare_amount:double>" in plan and "ReadSchema: struct<mta_tax:double>" in plan


def test_severity_limits(spark):
    df = values(spark, *([None] * 3))
    for warn, error, expected in ((3, 4, "pass"), (2, 3, "warn"), (1, 2, "error")):
        row = outcome(df, Rule("not_null", "x"), warn_above=warn, error_above=error)
        assert row["severity"] == expected
    assert (Suite("s", ()).warn_above, Suite("s", ()).error_above) == (1000, 10000)


@pytest.mark.parametrize("threshold, passes", [("50%", True), (50, True), ("50.1%", False), ("10%", True), (51, False)])
def test_threshold_is_in_percent(spark, threshold, passes):
    df = values(spark, 1, None)
    suite = Suite("s", (Rule("not_null", "x"), Rule("column_exists", "x")))
    if passes:
        assert quality.gate(evaluate(df, suite), threshold) == 50.0
    else:
        with pytest.raises(quality.ValidationFailed):
            quality.gate(evaluate(df, suite), threshold)


def test_one_passed_rule_in_many_does_not_meet_ten_percent(spark):
    rules = [Rule("column_exists", "x"), *[Rule("column_exists", f"c{i}") for i in range(19)]]
    with pytest.raises(quality.ValidationFailed):
        quality.gate(evaluate(values(spark, 1), Suite("s", tuple(rules))), "10%")


def test_declared_suite(spark):
    text = json.dumps(
        {
            "expectation_suite_name": "declared",
            "expectations": [
                {"expectation_type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": list(TRIP_COLUMNS)}},
                {"expectation_type": "expect_column_max_to_be_between", "kwargs": {"column": "DOLocationID", "min_value": 1, "max_value": 265}},
                {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "passenger_count", "value_set": [0, 1, 2, 3, 4, 5, 6], "mostly": 0.9}},
                {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "passenger_count", "mostly": 0.9}},
                {"expectation_type": "expect_column_values_to_be_in_type_list", "kwargs": {"column": "passenger_count", "type_list": ["LongType", "IntegerType"], "mostly": 0.5}},
            ],
        }
    )
    suite = quality.suite_from_json(text)
    assert suite.rules == (suites.INGEST.rules[0], suites.INGEST.rules[1], suites.INGEST.rules[2], suites.INGEST.rules[3],
                           Rule("type_list", "passenger_count", {"types": ["LongType", "IntegerType"]}, 0.5))
    assert evaluate(trips(spark), suite).where("success").count() == 5


@pytest.mark.parametrize(
    "name, arguments, rule",
    [
        ("dbt_expectations.expect_column_values_to_be_within_n_stdevs", {}, Rule("within_stdevs", "c", {"sigmas": 3})),
        ("expect_column_values_to_be_in_set", {"value_set": [1], "quote_values": False}, Rule("in_set", "c", {"values": [1]})),
        ("accepted_values", {"values": ["Y"]}, Rule("in_set", "c", {"values": ["Y"]})),
        ("unique", None, Rule("unique", "c")),
        (
            "expect_grouped_row_values_to_have_recent_data",
            {"group_by": ["p"], "timestamp_column": "t", "datepart": "month", "interval": 5},
            Rule("recent", "t", {"keys": ["p"], "unit": "month", "interval": 5}),
        ),
    ],
)
def test_declarations(name, arguments, rule):
    assert rule_from_declaration(name, arguments, "c") == rule


def test_unknown_declarations_are_errors(spark):
    with pytest.raises(ValueError):
        rule_from_declaration("expect_magic")
    with pytest.raises(ValueError):
        rule_from_declaration("unique", {"colum": "x"})
    with pytest.raises(ValueError):
        evaluate(values(spark, 1), Suite("s", (Rule("magic", "x"),)))


def test_failing_rows_are_kept_whole(spark, folder):
    df = trips(spark, {}, {"VendorID": 3, "fare_amount": 400.0}, {"PULocationID": 300})
    kept = failing_rows(df, suites.STAGING, as_of="2023-01-01").collect()
    found = {(r["rule_id"], json.loads(r["record"])["PULocationID"]) for r in kept}
    assert found == {
        ("in_set:VendorID", 229),
        ("between:fare_amount", 229),
        ("pair_greater:total_amount-fare_amount", 229),
        ("between:PULocationID", 300),
    }
    for _ in range(2):
        run.save_failures(failing_rows(df, suites.STAGING, as_of="2023-01-01"), folder + "/f", "run-1")
    assert spark.read.parquet(folder + "/f").count() == 4


def test_failing_values_of_unique_and_recency(spark):
    twice = zones(spark, (142, "Manhattan", "x", -74.0, 40.6))
    kept = [(r["rule_id"], json.loads(r["record"])) for r in failing_rows(twice, suites.ZONES).collect()]
    assert kept == [("unique:LocationID", {"LocationID": 142, "copies": 2})]
    stale = failing_rows(trips(spark), Suite("s", (suites.STAGING.rules[0],)), as_of="2024-01-01").first()
    assert json.loads(stale["record"])["payment_type"] == 1


def test_results_are_stored_per_run(spark, folder):
    df = trips(spark)
    for name in ("r1", "r2", "r2"):
        validate(df, suites.INGEST, "100%", None, folder + "/r", name)
    assert rows_of(spark.read.parquet(folder + "/r").groupBy("run_id").count()) == [("r1", 15), ("r2", 15)]
    assert run.run_id("yellow", "2022-11-01 10:20:30") == "20221101-102030-yellow"


def test_feature_suite_on_features(spark):
    from cabstand.plans.features import fare_features

    results = evaluate(fare_features(trips(spark), zones(spark)), suites.FEATURES)
    failed = {r["rule_id"] for r in results.where("NOT success").collect()}
    assert failed == {"column_type:trip_duration"}  # declared a float, whole minutes are an integer
