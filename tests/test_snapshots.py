"""Tables that change in one step: readers, crashes, merging, positions."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from cabstand.functions.messages import to_message
from cabstand.operators import routing
from cabstand.plans import load
from cabstand.sources import snapshots, tables
from cabstand.specs import YELLOW
from cabstand.streaming import ingest
from tests.support import plan_of, rows_of, trips


AS_OF = "2023-06-01"


def month(number, **changes):
    return {"tpep_pickup_datetime": dt.datetime(2022, number, 1, 0, 3), "tpep_dropoff_datetime": dt.datetime(2022, number, 1, 0, 9), **changes}


def facts(spark, month_, value, n=3):
    return spark.createDataFrame([(dt.date(2022, month_, 1 + i), value, None) for i in range(n)], "day date, value string, gap int")


def values(df):
    return sorted((r["part_month"], r["value"]) for r in df.collect())


def test_reads_keep_the_state_they_began_with(spark, folder):
    path = folder + "/t"
    snapshots.replace_all(facts(spark, 1, "old").unionByName(facts(spark, 2, "old")), path, "day")
    before = snapshots.read(spark, path)
    snapshots.replace_all(facts(spark, 2, "new").unionByName(facts(spark, 3, "new")), path, "day")
    after = snapshots.read(spark, path)
    assert values(before) == [("202201", "old")] * 3 + [("202202", "old")] * 3
    assert values(after) == [("202202", "new")] * 3 + [("202203", "new")] * 3
    assert snapshots.vacuum(spark, path, keep=2, grace_seconds=0) == []
    assert len(values(before)) == 6
    assert len(snapshots.vacuum(spark, path, keep=1, grace_seconds=0)) == 2
    assert values(snapshots.read(spark, path)) == values(after)
    assert after.schema["gap"].dataType.typeName() == "integer" and after.columns[-1] == "part_month"


def test_months_are_replaced_in_one_step_and_empty_ones_go(spark, folder):
    path = folder + "/t"
    snapshots.replace_all(facts(spark, 1, "a").unionByName(facts(spark, 2, "a")).unionByName(facts(spark, 3, "a")), path, "day")
    snapshots.replace_months(facts(spark, 2, "b", 1), path, "day", months=["202203"])
    assert values(snapshots.read(spark, path)) == [("202201", "a")] * 3 + [("202202", "b")]
    window = snapshots.read(spark, path, "day", "2022-01-02", "2022-02-01")
    assert window.count() == 2 and all("202202" not in f for f in window.inputFiles())
    assert snapshots.expire(spark, path, "2022-03-15", 20) == ["202201"]
    assert values(snapshots.read(spark, path)) == [("202202", "b")]
    snapshots.expire(spark, path, "2023-03-15", 20)
    assert snapshots.read(spark, path).count() == 0 and "value" in snapshots.read(spark, path).columns


def test_a_write_that_dies_before_its_list_is_not_seen(spark, folder, monkeypatch):
    path = folder + "/t"
    snapshots.replace_all(facts(spark, 1, "a"), path, "day")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "switch", dies)
        with pytest.raises(RuntimeError):
            snapshots.replace_all(facts(spark, 1, "b"), path, "day")
    assert values(snapshots.read(spark, path)) == [("202201", "a")] * 3
    assert snapshots.vacuum(spark, path, grace_seconds=3600) == []
    assert len(snapshots.vacuum(spark, path, grace_seconds=0)) == 1
    assert values(snapshots.read(spark, path)) == [("202201", "a")] * 3


def test_writers_at_the_same_time_lose_nothing(spark, folder):
    path = folder + "/t"
    snapshots.replace_all(facts(spark, 1, "a"), path, "day")
    jobs = [threading.Thread(target=snapshots.replace_months, args=(facts(spark, m, "b"), path, "day")) for m in range(2, 8)]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert {m for m, _ in values(snapshots.read(spark, path))} == {f"2022{m:02d}" for m in range(1, 8)}
    assert snapshots.numbers(spark, path) == list(range(1, 8))


def test_a_taken_number_is_not_replaced(spark, folder):
    from cabstand.sources import storage

    assert storage.create_text(spark, folder + "/l/1", "é") and not storage.create_text(spark, folder + "/l/1", "b")
    assert storage.read_text(spark, folder + "/l/1") == "é" and storage.names(spark, folder + "/l") == ["1"]


def test_loads_into_snapshots_equal_plain_ones(spark, folder):
    trips(spark, {}, {"fare_amount": 1.0}, month(12)).write.parquet(folder + "/raw")
    plain = load.Outputs(folder + "/ps", folder + "/pt")
    atomic = load.Outputs(folder + "/ss", folder + "/st", snapshots=True)
    for out in (plain, atomic):
        for at in ("2022-11-01", "2022-12-01", "2022-11-01"):
            load.run_month(spark, YELLOW, [folder + "/raw"], at, out, AS_OF)
    for a, b in ((plain.summary, atomic.summary), (plain.trips, atomic.trips)):
        left, right = load.read_table(spark, a), load.read_table(spark, b)
        assert rows_of(left.select(sorted(left.columns))) == rows_of(right.select(sorted(left.columns)))
    assert load.trips(spark, atomic.trips, YELLOW).count() == load.trips(spark, plain.trips, YELLOW).count() == 2
    assert load.retain(spark, atomic.trips, YELLOW, "2023-06-15") == load.retain(spark, plain.trips, YELLOW, "2023-06-15")


def streamed(spark, folder, rows, table="/out", state="/state", merge_at=None):
    ingest.publish_files(rows, folder + "/inbox")
    go(spark, folder, table, state, merge_at)


def go(spark, folder, table="/out", state="/state", merge_at=None):
    messages = ingest.file_stream(spark, folder + "/inbox")
    ingest.start_snapshot_ingest(messages, YELLOW, folder + table, folder + state, AS_OF, once=True, merge_at=merge_at).awaitTermination()


def routes(spark, path):
    return rows_of(snapshots.read(spark, path).groupBy("part_month", "route").count())


def test_merging_between_batches_neither_loses_nor_repeats(spark, folder, monkeypatch):
    path = folder + "/out"
    for i in range(3):
        streamed(spark, folder, trips(spark, {}, {"fare_amount": 1.0}, {"VendorID": 1 + i % 2}))
    assert len(snapshots.present(spark, path).folders["202211"]) == 3
    whole = rows_of(snapshots.read(spark, path))

    # The job dies after the copy and before the switch.
    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "switch", dies)
        with pytest.raises(RuntimeError):
            ingest.merge_table(spark, YELLOW, path)
    assert rows_of(snapshots.read(spark, path)) == whole

    # A batch comes in between the copy and the switch.
    real = snapshots.switch

    def late(spark_, path_, change):
        monkeypatch.setattr(snapshots, "switch", real)
        streamed(spark, folder, trips(spark, {}))
        return real(spark_, path_, change)

    monkeypatch.setattr(snapshots, "switch", late)
    assert ingest.merge_table(spark, YELLOW, path) == {"202211": 3}
    assert len(snapshots.present(spark, path).folders["202211"]) == 2
    assert routes(spark, path) == [("202211", "clean", 7), ("202211", "triage", 3)]
    # The job that died has left a copy; it goes, and nothing else.
    snapshots.vacuum(spark, path, keep=1, grace_seconds=0)
    assert routes(spark, path) == [("202211", "clean", 7), ("202211", "triage", 3)]
    assert ingest.merge_table(spark, YELLOW, path, least=3) == {}
    streamed(spark, folder, trips(spark, {}), merge_at=3)
    assert len(snapshots.present(spark, path).folders["202211"]) == 1
    assert routes(spark, path) == [("202211", "clean", 8), ("202211", "triage", 3)]


def test_a_merge_gives_way_to_a_replaced_month(spark, folder):
    path = folder + "/t"
    snapshots.replace_all(facts(spark, 1, "a"), path, "day")
    _, months, schema = snapshots.stage(facts(spark, 1, "b"), path, "day")
    snapshots.switch(spark, path, lambda now: now.appended(months))
    real = snapshots.switch

    def late(spark_, path_, change):
        snapshots.switch = real
        snapshots.replace_months(facts(spark, 1, "new"), path, "day")
        return real(spark_, path_, change)

    snapshots.switch = late
    try:
        assert snapshots.merge(spark, path, "day") == {}
    finally:
        snapshots.switch = real
    assert values(snapshots.read(spark, path)) == [("202201", "new")] * 3


def test_a_batch_that_ran_again_is_taken_once(spark, folder):
    """The stream dies after the switch and before its own checkpoint knows."""
    streamed(spark, folder, trips(spark, {}))
    commits = os.path.join(folder, "state", "commits")
    for name in os.listdir(commits):
        os.remove(os.path.join(commits, name))
    go(spark, folder)
    assert routes(spark, folder + "/out") == [("202211", "clean", 1)]


def records(spark, folder, rows, topic, partition, first):
    """Messages in the connector's columns, with consecutive offsets."""
    made = to_message(rows).collect()
    records_ = [(topic, partition, first + i, bytearray(r["value"].encode()), None) for i, r in enumerate(made)]
    schema = "topic string, partition int, offset long, value binary, key binary"
    spark.createDataFrame(records_, schema).coalesce(1).write.mode("append").parquet(folder + "/topic")


def from_topic(spark, folder, state):
    schema = "topic string, partition int, offset long, value binary, key binary"
    stream = ingest.positioned(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/topic"))
    ingest.start_snapshot_ingest(stream, YELLOW, folder + "/out", folder + state, AS_OF, once=True).awaitTermination()


def test_positions_outlive_the_checkpoint(spark, folder):
    records(spark, folder, trips(spark, {}, {"fare_amount": 1.0}), "trips", 0, 0)
    records(spark, folder, trips(spark, {}), "trips", 1, 40)
    from_topic(spark, folder, "/state")
    wanted = [("202211", "clean", 2), ("202211", "triage", 1)]
    assert routes(spark, folder + "/out") == wanted
    assert rows_of(ingest.positions(spark, folder + "/out")) == [("trips", 0, 2), ("trips", 1, 41)]
    # Another checkpoint: the whole topic is read again, new messages after old ones.
    records(spark, folder, trips(spark, month(12), {}), "trips", 0, 2)
    from_topic(spark, folder, "/other")
    assert routes(spark, folder + "/out") == [("202211", "clean", 3), ("202211", "triage", 1), ("202212", "clean", 1)]
    from_topic(spark, folder, "/third")
    assert snapshots.read(spark, folder + "/out").count() == 5
    assert rows_of(ingest.positions(spark, folder + "/out")) == [("trips", 0, 4), ("trips", 1, 41)]
    ingest.merge_table(spark, YELLOW, folder + "/out")
    assert rows_of(ingest.positions(spark, folder + "/out")) == [("trips", 0, 4), ("trips", 1, 41)]


def test_merged_files_are_clustered_and_few(spark, folder):
    for i in range(4):
        streamed(spark, folder, trips(spark, {"PULocationID": 9 - i}, {"PULocationID": 3}))
    path = folder + "/out"
    ingest.merge_table(spark, YELLOW, path)
    table = snapshots.read(spark, path).where(F.col(routing.ROUTE) == "clean")
    assert len(table.inputFiles()) == 1
    order = [r["PULocationID"] for r in table.collect()]
    assert order == sorted(order) and len(order) == 8
    assert tables.PART in table.columns


def test_records_of_a_topic_are_numbered_without_gathering_a_partition(spark):
    from cabstand.catalog import lifecycle

    rows = trips(spark, *[{"fare_amount": float(i)} for i in range(60)]).repartition(6).localCheckpoint()
    records = lifecycle._records(rows)
    assert "Exchange" not in plan_of(records)
    found = rows_of(records.select("partition", "offset", "value"))
    assert len(found) == len({at[:2] for at in found}) == len({at[2] for at in found}) == 60
    assert {at[0] for at in found} == {0, 1, 2}


def test_a_merge_copies_whole_months_without_an_exchange(spark, folder, monkeypatch):
    path, seen = folder + "/t", []
    snapshots.replace_all(facts(spark, 1, "a"), path, "day")
    for text in ("b", "c"):
        _, months, schema = snapshots.stage(facts(spark, 1, text), path, "day")
        snapshots.switch(spark, path, lambda now: now.appended(months))
    whole, real = values(snapshots.read(spark, path)), tables.laid_out

    def spied(*args):
        seen.append(real(*args))
        return seen[-1]

    monkeypatch.setattr(tables, "laid_out", spied)
    state = snapshots.present(spark, path)
    assert snapshots.merge(spark, path, "day") == {m: 3 for m in state.folders}
    assert seen and not any("Exchange" in plan_of(df) for df in seen)
    assert values(snapshots.read(spark, path)) == whole
    assert all(len(of) == 1 for of in snapshots.present(spark, path).folders.values())


def test_months_are_grouped_by_bytes():
    mb = 1 << 20
    assert snapshots.month_groups({"a": 1, "b": 1, "c": 1, "d": 1}, 2) == [(["a", "b"], 1), (["c", "d"], 1)]
    assert snapshots.month_groups({"a": 100 * mb, "b": 10 * mb, "c": 30 * mb, "d": 5}, 4) == [(["a"], 4), (["b", "c"], 2), (["d"], 1)]
    assert snapshots.month_groups({"a": 0}, 4) == [(["a"], 1)]
