import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from cabstand.functions import clock
from cabstand.functions.messages import decode_messages, to_message
from cabstand.operators import routing
from cabstand.plans import fare_model, features, load
from cabstand.sources import files, storage, tables
from cabstand.specs import TRIP_COLUMNS, YELLOW
from cabstand.streaming import ingest
from tests.support import GOOD_TRIP, plan_of, rows_of, trips, zones

AS_OF = "2023-06-01"


def month(n, year=2022, **more):
    start = dt.datetime(year, n, 3, 8)
    return {"tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(minutes=7), **more}


def outputs(folder):
    return load.Outputs(folder + "/summary", folder + "/trips")


def routes(spark, out):
    return rows_of(tables.read_months(spark, out.trips).groupBy("part_month", "route").count())


def test_feature_golden_row(spark):
    row = features.fare_features(trips(spark), zones(spark)).first().asDict()
    assert {k: row[k] for k in ("date", "trip_duration", "day_of_month", "month", "year", "day_of_week", "hour_of_day")} == {
        "date": dt.date(2022, 11, 1), "trip_duration": 2, "day_of_month": 1, "month": 11, "year": 2022, "day_of_week": 3, "hour_of_day": 0,
    }
    golden = {
        "pickup_jfk_distance": 20371.247181423132, "dropoff_jfk_distance": 20187.4464462738,
        "pickup_ewr_distance": 18578.848705612403, "dropoff_ewr_distance": 17884.494262726341,
        "pickup_lga_distance": 8113.0115686447125, "dropoff_lga_distance": 8776.6254127346783,
    }
    assert {k: row[k] for k in golden} == pytest.approx(golden, abs=1e-6)
    assert list(row) == list(features.FEATURE_COLUMNS)


def test_month_run_twice_is_the_same(spark, folder):
    source, out = folder + "/src", outputs(folder)
    first_of_next = {"tpep_pickup_datetime": dt.datetime(2022, 12, 1), "tpep_dropoff_datetime": dt.datetime(2022, 12, 1, 1)}
    trips(spark, {}, {"fare_amount": None}, first_of_next, month(12)).write.parquet(source)
    for _ in range(2):
        report = load.run_month(spark, YELLOW, [source], "2022-11-01", out, AS_OF)
        assert report == load.LoadReport(2 - 1, 2)
        assert routes(spark, out) == [("202211", "clean", 1), ("202211", "triage", 1)]
    load.run_month(spark, YELLOW, [source], "2022-12-01", out, AS_OF)
    assert routes(spark, out) == [("202211", "clean", 1), ("202211", "triage", 1), ("202212", "clean", 2)]
    assert tables.read_months(spark, out.summary).agg(F.sum("trip_count")).first()[0] == 4
    assert load.trips(spark, out.trips, YELLOW).columns == [*TRIP_COLUMNS, "part_month"]
    assert load.trips(spark, out.trips, YELLOW, "triage").first()["failed_rules"] == ["fare_at_least_2_5", "fare_below_250", "fare_amount_present"]


def test_a_route_or_month_that_comes_out_empty_keeps_nothing_old(spark, folder):
    out = outputs(folder)
    trips(spark, {}, {"fare_amount": 1.0}).write.parquet(folder + "/bad")
    trips(spark, {}).write.parquet(folder + "/good")
    trips(spark, month(1)).write.parquet(folder + "/other")
    load.run_month(spark, YELLOW, [folder + "/bad"], "2022-11-01", out, AS_OF)
    load.run_month(spark, YELLOW, [folder + "/good"], "2022-11-01", out, AS_OF)
    assert routes(spark, out) == [("202211", "clean", 1)]
    load.run_month(spark, YELLOW, [folder + "/other"], "2022-01-01", out, AS_OF)
    load.run_month(spark, YELLOW, [folder + "/other"], "2022-11-01", out, AS_OF)
    assert routes(spark, out) == [("202201", "clean", 1)]
    assert storage.partition_values(spark, out.summary, "part_month") == ["202201"]


def test_month_filter_reaches_the_files_before_the_cast(spark, folder):
    raw = trips(spark).withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    raw.write.parquet(folder + "/t")
    rows = load.month_input(spark.read.parquet(folder + "/t"), YELLOW, "2022-11-01")
    assert rows.count() == 1 and rows.schema["tpep_pickup_datetime"].dataType.simpleString() == "timestamp"
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2022-11-01T00:00)" in plan_of(rows)
    text = raw.withColumn("tpep_pickup_datetime", F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss"))
    assert load.month_input(text, YELLOW, "2022-11-01").count() == 1


def test_full_refresh_sums_a_key_over_schema_groups(spark, folder):
    out = outputs(folder)
    trips(spark, month(3)).write.parquet(folder + "/src/a")
    trips(spark, month(3)).drop("airport_fee").write.parquet(folder + "/src/b")
    trips(spark, month(3), month(3, fare_amount=1.0), month(1, 2020)).withColumn("mta_tax", F.lit(1).cast("long")).write.parquet(folder + "/src/c")
    for _ in range(2):
        load.run_full(spark, YELLOW, files.manifest(spark, folder + "/src"), out, as_of="2022-06-01")
        summary = tables.read_months(spark, out.summary)
        assert rows_of(summary.select("part_month", "trip_count")) == [("202001", 1), ("202203", 4)]
        assert routes(spark, out) == [("202203", "clean", 3), ("202203", "triage", 1)]


def test_incremental_build_equals_full_build(spark, folder):
    rows = trips(spark, month(1), month(2), month(3), month(3, fare_amount=9.0), month(4))
    features.build_features(spark, rows, zones(spark), folder + "/full")
    features.build_features(spark, rows.where(F.month("tpep_pickup_datetime") < 4), zones(spark), folder + "/inc")
    for _ in range(2):
        features.build_features(spark, rows, zones(spark), folder + "/inc", since="2022-03-20")
    assert rows_of(tables.read_months(spark, folder + "/inc")) == rows_of(tables.read_months(spark, folder + "/full"))
    features.build_features(spark, rows.where(F.month("tpep_pickup_datetime") < 4), zones(spark), folder + "/inc", since="2022-03-20")
    assert storage.partition_values(spark, folder + "/inc", "part_month") == ["202201", "202202", "202203"]


def test_retention_of_trips(spark, folder):
    out = outputs(folder)
    trips(spark, month(1), month(11)).write.parquet(folder + "/s")
    for m in ("2022-01-01", "2022-11-01"):
        load.run_month(spark, YELLOW, [folder + "/s"], m, out, AS_OF)
    assert load.retain(spark, out.trips, YELLOW, "2022-12-01") == ["202201"]


def messages_of(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_messages_round_trip(spark):
    df = trips(spark, {}, {"airport_fee": None, "store_and_fwd_flag": None})
    back = decode_messages(to_message(df), TRIP_COLUMNS)
    assert rows_of(back.select(*TRIP_COLUMNS)) == rows_of(df)
    assert back.where("error IS NOT NULL").count() == 0


@pytest.mark.parametrize(
    "text, error",
    [
        ('{"VendorID": 1}', None),
        ('{"vendorid": 1, "RATECODEID": 2.0}', None),
        ('{"passenger_count": NaN, "fare_amount": NaN}', None),
        ('{"VendorID": "x"}', "type:VendorID"),
        ('{"VendorID": 1.5, "fare_amount": "a"}', "type:VendorID; type:fare_amount"),
        ('{"tpep_pickup_datetime": "yesterday-ish"}', "type:tpep_pickup_datetime"),
        ('{"VendorID": 1, "color": "red"}', "unknown:color"),
        ('{"VendorID": ', "not a JSON object"),
        ("[1, 2]", "not a JSON object"),
        ("", "not a JSON object"),
        (None, "not a JSON object"),
    ],
)
def test_bad_messages_are_named(spark, text, error):
    row = decode_messages(messages_of(spark, text), TRIP_COLUMNS).first()
    assert row["error"] == error
    assert row["raw"] == text


def test_unknown_fields_can_be_ignored(spark):
    df = messages_of(spark, '{"VENDORID": 1, "color": "red"}')
    row = decode_messages(df, TRIP_COLUMNS, unknown_fields="ignore").first()
    assert (row["VendorID"], row["error"]) == (1, None)


def test_stream_resumes_without_repeats_and_keeps_bad_messages(spark, folder):
    inbox, out, state = (f"{folder}/{n}" for n in ("inbox", "out", "state"))

    def go():
        query = ingest.start_ingest(ingest.file_stream(spark, inbox), YELLOW, out, state, AS_OF, once=True)
        query.awaitTermination()

    ingest.publish_files(trips(spark, {}, {"fare_amount": 1.0}), inbox)
    go()
    go()
    assert rows_of(spark.read.parquet(out).groupBy("route").count()) == [("clean", 1), ("triage", 1)]
    ingest.publish_files(trips(spark, month(12)), inbox)
    with open(os.path.join(inbox, "bad.txt"), "w") as handle:
        handle.write('{"VendorID": "x"}\nnot json\n')
    go()
    assert rows_of(spark.read.parquet(out).groupBy("route").count()) == [("clean", 2), ("dead", 2), ("triage", 1)]
    assert rows_of(ingest.error_counts(spark, out)) == [("not a JSON object", 1), ("type:VendorID", 1)]
    dead = ingest.read_route(spark, out, "dead")
    assert sorted(r["raw"] for r in dead.collect()) == ["not json", '{"VendorID": "x"}']
    clean = ingest.read_route(spark, out, "clean")
    assert rows_of(clean.select("part_month", "raw")) == [("202211", None), ("202212", None)]


def test_stream_and_batch_route_alike(spark, folder, sf):
    from cabstand.catalog.bindings import trips as bound

    ingest.publish_files(bound(spark, sf), folder + "/inbox")
    query = ingest.start_ingest(
        ingest.file_stream(spark, folder + "/inbox"), YELLOW, folder + "/out", folder + "/state", "2001-06-01", once=True
    )
    query.awaitTermination()
    streamed = spark.read.parquet(folder + "/out").groupBy("route").count()
    batch = routing.with_route(bound(spark, sf), YELLOW.rules("2001-06-01")).groupBy("route").count()
    assert rows_of(streamed) == rows_of(batch)


def test_kafka_source_needs_its_connector_only_when_used(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.topic_stream(spark, "localhost:1", "trips")


def test_split_is_repeatable_and_disjoint(spark):
    df = spark.range(5000).withColumn("x", F.col("id") % 100)
    train, test = fare_model.split_rows(df)
    again, _ = fare_model.split_rows(df.repartition(5))
    assert rows_of(train) == rows_of(again)
    assert train.count() + test.count() == 5000 and train.join(test, "id", "left_semi").count() == 0
    assert 3300 < train.count() < 3700


def test_default_grid(spark):
    params = fare_model.param_grid(fare_model.estimator(["x"]))
    tried = {tuple(sorted((p.name, v) for p, v in setting.items())) for setting in params}
    assert len(tried) == 6
    assert (("maxDepth", 6), ("maxIter", 100), ("minInstancesPerNode", 7)) in tried


def test_staged_errors_equal_separate_fits(spark):
    """One long fit per fold gives what a fit for each number of trees gives."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    rows = [(float(i % 13), float(i * 7 % 11), 3.0 + i % 13 + (i * 7 % 11) * (i % 3), i % 3) for i in range(300)]
    table = spark.createDataFrame(rows, "distance double, passengers double, fare_amount double, fold int")
    grid = {"maxDepth": (2, 3), "maxIter": (2, 5), "minInstancesPerNode": (3, 30)}
    pipeline = fare_model.estimator(["distance", "passengers"])
    separate = CrossValidator(
        estimator=pipeline, estimatorParamMaps=fare_model.param_grid(pipeline, grid), numFolds=3, foldCol="fold", parallelism=4,
        evaluator=RegressionEvaluator(labelCol="fare_amount", metricName="mse"),
    ).fit(table)
    wanted = {
        tuple(sorted((p.name, v) for p, v in setting.items())): error
        for setting, error in zip(separate.getEstimatorParamMaps(), separate.avgMetrics)
    }
    folds = fare_model.stored_folds(table, pipeline.getStages()[0], "fare_amount")
    staged = fare_model.staged_search(folds, grid)
    assert len(staged) == len(wanted) == 8 and len({round(s.error, 6) for s in staged}) > 4
    for setting in staged:
        assert setting.error == pytest.approx(wanted[tuple(sorted(setting.params.items()))], rel=1e-9)


def test_empty_folds_are_left_out(spark):
    table = spark.createDataFrame([(float(i), float(i), i % 2) for i in range(40)], "x double, fare_amount double, fold int")
    grid = {"maxDepth": (2,), "maxIter": (1, 2)}
    folds = lambda rows: fare_model.stored_folds(rows, fare_model.estimator(["x"]).getStages()[0], "fare_amount")
    assert len(fare_model.staged_search(folds(table), grid)) == 2
    with pytest.raises(ValueError):
        fare_model.staged_search(folds(table.where("fold = 0")), grid)


def test_rows_without_a_feature_are_counted(spark):
    rows = [(float(i % 7), None if i % 10 == 0 else float(i % 5), None if i == 1 else 3.0 + i % 7) for i in range(60)]
    table = spark.createDataFrame(rows, "distance double, passengers double, fare_amount double")
    trained = fare_model.fit_fare_model(table, {"maxDepth": (2,), "maxIter": (1,), "minInstancesPerNode": (1,)}, folds=2)
    assert trained.n_dropped == 7


def test_train_record_pick_and_score(spark, folder):
    changes = [
        month(1 + i % 12, passenger_count=1 + i % 6, trip_distance=1.0 + i % 9, fare_amount=5.0 + 3 * (i % 9), payment_type=1 + i % 6)
        for i in range(240)
    ]
    places = zones(spark)
    features.build_features(spark, trips(spark, *changes), places, folder + "/f")
    samples = tables.read_months(spark, folder + "/f")
    grid = {"maxDepth": (3,), "maxIter": (3,), "minInstancesPerNode": (3, 80)}
    trained = fare_model.fit_fare_model(samples, grid, folds=2, model_folder=folder + "/m")
    trials = trained.trials.collect()
    nested = [t for t in trials if t["parent_run_id"]]
    parents = [t for t in trials if not t["parent_run_id"]]
    assert len(nested) == 2 and len(parents) == 1 and sorted(t["rank"] for t in nested) == [1, 2]
    best = min(nested, key=lambda t: t["rmse"])
    assert best["rank"] == 1 and parents[0]["min_leaf"] == best["min_leaf"] == 3
    assert {t["parent_run_id"] for t in nested} == {parents[0]["run_id"]}
    assert parents[0]["rmse"] < 8

    model = fare_model.load_best(spark, trained.trials)
    requests = spark.createDataFrame(
        [(1, "Lincoln Square East", "UN/Turtle Bay South", 9), (2, "nowhere", "UN/Turtle Bay South", 9)],
        "passenger_count int, pickup_zone string, dropoff_zone string, trip_duration bigint",
    )
    scored = {r["pickup_zone"]: r for r in fare_model.score_requests(requests, places, model, "2022-03-05 14:00:00").collect()}
    assert scored["nowhere"]["fare"] is None and scored["nowhere"]["fare_text"] is None
    assert scored["Lincoln Square East"]["fare"] > 0 and scored["Lincoln Square East"]["fare_text"].startswith("$")
    assert scored["nowhere"]["trip_distance"] is None
    assert fare_model.load_best(spark, trained.trials.limit(0)) is None


def test_training_from_a_table_keeps_every_run(spark, folder):
    changes = [month(1 + i % 12, passenger_count=1 + i % 6, trip_distance=1.0 + i % 9, fare_amount=5.0 + 3 * (i % 9)) for i in range(120)]
    features.build_features(spark, trips(spark, *changes), zones(spark), folder + "/f")
    for depth in (1, 3):
        grid = {"maxDepth": (depth,), "maxIter": (2,), "minInstancesPerNode": (3,)}
        fare_model.train_from_table(spark, folder + "/f", folder + "/runs", grid, folds=2, share=1.0)
    trials = spark.read.parquet(folder + "/runs/trials")
    assert trials.count() == 4 and trials.select("model_path").distinct().count() == 2
    model = fare_model.load_best(spark, trials)
    runs = trials.where("parent_run_id IS NULL").orderBy("rmse").collect()
    assert model.stages[-1].getMaxDepth() == runs[0]["max_depth"]


def test_scoring_a_training_trip_sees_the_same_features(spark):
    """Same names, same units, same calendar for the row that trains and the row that is scored."""
    places = zones(spark)
    trained = features.fare_features(trips(spark), places)
    when = GOOD_TRIP["tpep_pickup_datetime"]
    request = spark.createDataFrame(
        [(3, "Sutton Place/Turtle Bay North", "UN/Turtle Bay South", 2)],
        "passenger_count int, pickup_zone string, dropoff_zone string, trip_duration bigint",
    )
    scored = features.request_features(request, places, when)
    shared = [c for c in features.FEATURE_COLUMNS if c not in ("fare_amount", "trip_distance")]
    assert set(shared) <= set(scored.columns)
    assert tuple(scored.select(*shared).first()) == pytest.approx(tuple(trained.select(*shared).first()))


def test_request_with_a_repeated_zone_name_stays_one_row(spark):
    places = zones(spark, (56, "Queens", "Corona", -73.86, 40.74), (57, "Queens", "Corona", -73.84, 40.76))
    request = spark.createDataFrame([(1, "Corona", "Corona", 5)], "passenger_count int, pickup_zone string, dropoff_zone string, trip_duration int")
    row = features.request_features(request, places, "2022-03-06 14:00:00").collect()
    assert len(row) == 1 and row[0]["pickup_long"] == pytest.approx(-73.85) and row[0]["day_of_week"] == 1


def test_labels_of_jobs_are_removed_again(spark):
    with tables.labelled(spark, "load-1"):
        assert "load-1" in spark.getTags()
    assert "load-1" not in spark.getTags()


def test_airport_distances_are_not_worked_out_per_trip(spark, folder):
    """The trigonometry sits below the join, on the place side."""
    trips(spark).write.parquet(folder + "/t")
    zones(spark).write.parquet(folder + "/z")
    made = features.fare_features(spark.read.parquet(folder + "/t"), spark.read.parquet(folder + "/z"))
    top = plan_of(made).split("== Physical Plan ==")[1].split("BroadcastHashJoin")[0]
    assert "ASIN" not in top.upper()
    assert clock.DATE_PARTS[0] in top
    assert glob.glob(folder + "/t/*.parquet")


def test_published_files_are_small_and_hold_every_message(spark, folder, monkeypatch):
    monkeypatch.setattr(ingest, "MESSAGES_PER_FILE", 100)
    rows = trips(spark, *[{"fare_amount": float(i)} for i in range(400)]).coalesce(1)
    ingest.publish_files(rows, folder)
    files = [os.path.join(folder, name) for name in os.listdir(folder) if name.startswith("part-")]
    texts = [row["value"] for row in spark.read.text(folder).collect()]
    assert sorted(texts) == [at[0] for at in rows_of(ingest.to_message(rows))]
    assert len(files) == 4 and 5 * sum(map(os.path.getsize, files)) < sum(map(len, texts))
