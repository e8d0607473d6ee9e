"""Contributions of months: merged results equal a full run, and only new months are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabstand import quality
from cabstand.catalog.bindings import AS_OF, trips as bound
from cabstand.quality import run, states, suites
from cabstand.quality.rules import Rule, Suite
from cabstand.sources import tables
from tests.support import rows_of, trips


def shown(results):
    return rows_of(results.select("suite", "rule_id", "kind", "target", "total", "failing", F.round("observed", 9).alias("observed"), "success", "severity"))


@pytest.mark.parametrize("suite", [suites.INGEST, suites.STAGING])
def test_merged_months_equal_a_full_run(spark, folder, sf, suite):
    rows = tables.with_month(bound(spark, sf), "tpep_pickup_datetime")
    states.keep(rows.where(F.col(tables.PART) < "199801"), suite, folder)
    states.keep(rows.where(F.col(tables.PART) >= "199801"), suite, folder)
    like = rows.drop(tables.PART)
    got = states.merged(states.read(spark, folder), like, suite, AS_OF)
    assert got.columns == list(run.RESULT_COLUMNS)
    assert shown(got) == shown(quality.evaluate(like, suite, AS_OF))


ODD = Suite(
    "odd",
    (
        Rule("unique", "VendorID"), Rule("unique_share", "store_and_fwd_flag", {"low": 0.1, "high": 1}), Rule("not_null", "absent"),
        Rule("within_stdevs", "fare_amount", {"sigmas": 1}, 0.5), Rule("max_between", "fare_amount", {"low": 0, "high": 50}),
        Rule("recent", "tpep_pickup_datetime", {"keys": ["VendorID"], "unit": "month", "interval": 3}), Rule("recent", "tpep_pickup_datetime", {"unit": "day", "interval": 400}),
        Rule("columns_set", None, {"columns": ["x"]}),
    ),
)


def months(spark, **fares):
    made = [
        {"tpep_pickup_datetime": dt.datetime(2022, int(m[1:]), 3 + i), "fare_amount": fare, "VendorID": int(fare) % 3 if fare else None}
        for m, of in fares.items() for i, fare in enumerate(of)
    ]
    return tables.with_month(trips(spark, *made), "tpep_pickup_datetime")


def test_updates_read_new_months_alone(spark, folder, monkeypatch):
    read = []
    real = states.keep

    def keep(df, suite, path):
        read.append(sorted(r[0] for r in df.select(tables.PART).distinct().collect()))
        real(df, suite, path)

    monkeypatch.setattr(states, "keep", keep)
    kept = months(spark, m1=[1.0, 2.0, None], m2=[7.0])
    wide = months(spark, m1=[1.0, 2.0, None], m2=[7.0], m4=[90.0, 0.0, 3.0])
    other = months(spark, m1=[1.0, 2.0, None], m2=[5.0, 5.0], m4=[90.0, 0.0, 3.0])
    later = other.where(F.col(tables.PART) > "202201")
    for table, again in ((kept, ()), (kept, ()), (wide, ()), (other, ["202202"]), (later, ())):
        got = states.update(spark, table, ODD, folder, "2022-06-01", again)
        want = quality.evaluate(table, ODD, "2022-06-01")
        assert shown(got) == shown(want)
    assert read == [["202201", "202202"], ["202204"], ["202202"]]


def test_nothing_has_contributed(spark, folder):
    empty = months(spark, m1=[1.0]).where("false")
    assert shown(states.update(spark, empty, ODD, folder, "2022-06-01")) == shown(quality.evaluate(empty, ODD, "2022-06-01"))
