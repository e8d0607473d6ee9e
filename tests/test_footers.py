"""Ranges of row groups and files that one read can take together."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cabstand.plans import load
from cabstand.sources import files, footers
from cabstand.specs import TRIP_COLUMNS, YELLOW
from tests.support import plan_of, rows_of, trips


def at(month, day=3):
    return {"tpep_pickup_datetime": dt.datetime(2022, month, day, 5), "tpep_dropoff_datetime": dt.datetime(2022, month, day, 6)}


def test_ranges_per_row_group(spark, folder):
    times = pa.array([dt.datetime(2022, 1, 1 + i) for i in range(6)] + [None, None], pa.timestamp("us"))
    pq.write_table(pa.table({"At": times, "x": pa.array(range(8))}), folder + "/a.parquet", row_group_size=2)
    pq.write_table(pa.table({"x": pa.array([1])}), folder + "/b.parquet")
    pq.write_table(pa.table({"at": pa.array(["2022-01-01"])}), folder + "/c.parquet")
    pq.write_table(pa.table({"at": times[:2]}), folder + "/d.parquet", write_statistics=False)
    ranges = footers.row_group_ranges(files.manifest(spark, folder), "at")
    found = {(r["link"][-9:-8] + str(r["row_group"])): (r["rows"], r["low"], r["high"], r["known"]) for r in ranges.collect()}
    assert found["a0"] == (2, dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2), True)
    assert found["a3"] == (2, None, None, True) and found["b0"] == (1, None, None, True)
    assert found["c0"][3] is False and found["d0"][3] is False
    picked = lambda *window: sorted(r["link"][-9] for r in footers.files_between(ranges, *window).collect())
    assert picked("2022-01-04", "2022-01-05") == ["a", "c", "d"]
    assert picked("2022-01-07", None) == ["c", "d"] and picked(None, "2022-01-01") == ["c", "d"]


@pytest.mark.parametrize(
    "kinds,groups",
    [
        (["int32", "int64", "int16"], 1),
        (["int32", "float", "double"], 1),
        (["int64", "double"], 2),
        (["int64", "double", "int32"], 2),
        (["string", "int32"], 2),
        (["timestamp[us]", "timestamp[ms]"], 1),
        (["timestamp[us]", "timestamp[us, tz=UTC]"], 2),
        (["list<item: int32>", "int32"], 2),
    ],
)
def test_files_that_one_read_can_widen_are_one_group(spark, folder, kinds, groups):
    stored = {"timestamp[us]": pa.timestamp("us"), "timestamp[ms]": pa.timestamp("ms"), "timestamp[us, tz=UTC]": pa.timestamp("us", "UTC"), "list<item: int32>": pa.list_(pa.int32())}
    values = {"string": "7", "list<item: int32>": [7]}
    for i, kind in enumerate(kinds):
        value = values.get(kind, dt.datetime(2022, 1, 7) if kind.startswith("time") else 7)
        columns = {"X" if i % 2 else "x": pa.array([value], stored.get(kind) or pa.type_for_alias(kind)), f"other{i}": pa.array([i])}
        pq.write_table(pa.table(columns), f"{folder}/{i}.parquet")
    found = footers.compatible_groups(files.manifest(spark, folder), ["x", "absent"])
    assert len(found) == groups and sum(len(g.links) for g in found) == len(kinds)
    kind = "timestamp" if kinds[0].startswith("time") else "string" if "list" in kinds[0] else "double"
    rows = footers.read_compatible(spark, found, {"x": kind, "absent": "int"})
    got = [r["x"] for r in rows.collect()]
    assert len(got) == len(kinds)
    if kind == "double":
        assert got == [7.0] * len(kinds)


def drifting(spark, folder):
    """Four monthly files: complete, without a column, with narrower numbers, and with a real conflict."""
    trips(spark, at(1), at(2)).coalesce(1).write.parquet(folder + "/raw/1")
    trips(spark, at(3)).drop("airport_fee").coalesce(1).write.parquet(folder + "/raw/2")
    trips(spark, at(11)).selectExpr("* EXCEPT (fare_amount)", "CAST(fare_amount AS FLOAT) AS fare_amount").coalesce(1).write.parquet(folder + "/raw/3")
    trips(spark, at(12)).selectExpr("* EXCEPT (mta_tax)", "CAST(1 AS BIGINT) AS mta_tax").coalesce(1).write.parquet(folder + "/raw/4")
    return files.manifest(spark, folder + "/raw")


def test_drifting_files_take_fewer_scans_and_give_the_same_rows(spark, folder):
    found = drifting(spark, folder)
    exact = files.read_drifting(spark, found, TRIP_COLUMNS)
    few = footers.read_compatible(spark, footers.compatible_groups(found, list(TRIP_COLUMNS)), TRIP_COLUMNS)
    scans = lambda df: plan_of(df).split("== Physical Plan ==")[1].count("FileScan parquet")
    assert (scans(exact), scans(few)) == (4, 2)
    assert rows_of(exact) == rows_of(few) and len(rows_of(few)) == 5


def test_a_full_refresh_opens_recent_files_alone(spark, folder, monkeypatch):
    found, opened = drifting(spark, folder), []
    real = footers.read_group

    def counting(spark_, group):
        opened.append(len(group.links))
        return real(spark_, group)

    monkeypatch.setattr(footers, "read_group", counting)
    out = load.Outputs(folder + "/s", folder + "/t")
    load.run_full(spark, YELLOW, found, out, "2023-02-15")
    assert sum(opened) == 4 + 2  # all for the summary, two for the trips
    assert rows_of(load.read_table(spark, out.trips).groupBy("part_month").count()) == [("202211", 1), ("202212", 1)]
    assert load.read_table(spark, out.summary).count() == 5


def test_a_refresh_without_recent_files_gives_an_empty_trip_table(spark, folder):
    trips(spark, at(1)).write.parquet(folder + "/raw")
    out = load.Outputs(folder + "/s", folder + "/t")
    report = load.run_full(spark, YELLOW, files.manifest(spark, folder + "/raw"), out, "2025-01-01")
    assert (report.summary_rows, report.trip_rows) == (1, 0)


def test_extremes_come_from_footers(spark, folder):
    trips(spark, at(1), {**at(2), "fare_amount": 80.5, "passenger_count": None}, at(3)).repartition(2).write.parquet(folder + "/t")
    columns = ["fare_amount", "passenger_count", "PULocationID"]
    row, plan = footers.extremes(spark, [folder + "/t"], columns)
    assert "PushedAggregation: [" in plan and "MAX(fare_amount)" in plan and "FileScan" not in plan.split("== Physical Plan ==")[1]
    table = spark.read.parquet(folder + "/t")
    want = table.selectExpr("count(*) AS rows", *[f"{f}({c}) AS {label}_{c}" for c in columns for f, label in (("count", "n"), ("min", "low"), ("max", "high"))])
    assert row.columns == want.columns and row.first() == want.first()
    assert "FileScan parquet" in plan_of(table)  # the session reads as before


def test_extremes_of_other_types_are_read(spark, folder):
    trips(spark, at(1), at(3)).write.parquet(folder + "/t")
    row, plan = footers.extremes(spark, [folder + "/t"], ["tpep_pickup_datetime"])
    assert row.first()["high_tpep_pickup_datetime"] == at(3)["tpep_pickup_datetime"] and "PushedAggregation: []" in plan
