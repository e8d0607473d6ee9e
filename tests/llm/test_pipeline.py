import corpus_pipeline
import pytest

import __spark_entry__ as entry
from cabstand.llm import neardup
from cabstand.llm.queries import QUERIES, SQL
from check_queries import compare, connect
from tests.llm.support import odd_rows, prose, table
from tests.llm.test_lines import brute as lines_left
from tests.llm.test_neardup import brute as classes
from tests.llm.test_packing import expected
from tests.llm.test_rules import signals

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_on_odd_rows(spark, folder):
    docs = table(spark, odd_rows())
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        rows[name] = [tuple(r) for r in docs.collect()]
        if name != "pack_sequences":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r[4] == len(r[1]) for r in rows[name])
    passed = [r for r in odd_rows() if not signals(r[1])[-1]]
    assert sorted((r[:2] for r in rows["quality_rules"]), key=repr) == sorted((r[:2] for r in passed), key=repr)
    left = {(i, text) for i, text, _ in lines_left(rows["quality_rules"])}
    assert {r[:2] for r in rows["line_dedup"]} <= left
    kept = classes(rows["line_dedup"])
    assert {r[0] for r in rows["near_dedup"]} - {None} == set(kept.values())
    pieces = sorted((r[:5] for r in rows["pack_sequences"]), key=repr)
    assert pieces == expected([(r[0], r[1]) for r in rows["mix_sources"]], 1024)


def test_short_lines_of_its_own_keep_a_document(spark):
    shared = prose(40, 12)
    verse = "\n".join(" ".join(f"w{i}x{k}" for k in range(5)) for i in range(60))
    rows = [(1, shared, "en", "a", len(shared)), (2, f"{verse}\n{shared}", "en", "a", 1), (3, f"{shared}\n \n", "en", "a", 1)]
    got = {r.doc_id: r for r in STAGES["line_dedup"](spark, table(spark, rows), "").collect()}
    assert {i: r.text for i, r in got.items()} == {1: shared, 2: verse}
    assert got[2].n_chars == len(verse)


def test_no_near_copies_are_left(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = STAGES["near_dedup"](spark, docs, sf)
    again = neardup.near_duplicates(kept).where("doc_id <> class_id")
    assert again.count() == 0


def test_run_is_registered(spark, sf):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_empty(spark):
    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, sf, name):
    _, differences = compare(QUERIES[name](spark, sf), connect(sf), SQL[name])
    assert differences == []


def test_thirteen_operators():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries())


def test_columns_of_any_name_pass_through_every_stage(spark, folder):
    from pyspark.sql import functions as F

    docs = table(spark, odd_rows())
    extra = ("n_removed", "n_lines", "removed", "signals", "kept", "shared_key", "_key", "own_id", "_again", "copy", "shuffle_key", "mix_count", "mix_source", "row", "k1", "class_id", "a.b")
    for name in extra:
        docs = docs.withColumn(name, F.lit("x"))
    names, rows = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, "").write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.columns == names
        rows = docs.collect()
        assert rows and all(r[column] == "x" for r in rows for column in extra)
