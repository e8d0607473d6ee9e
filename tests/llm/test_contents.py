import hashlib
import random
import re
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from cabstand.llm import contents
from check_queries import compare, connect
from tests.llm.support import clashing, odd_rows, prose, table


def brute(rows):
    """Sorted rows of the result, from plain Python."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for content, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0]))
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(doc_id, members[0][0], len(members), i == 0, sha) for i, (doc_id, _) in enumerate(members)]
    return sorted(out, key=repr)


def many_rows(seed=3, n=400):
    """A hot group, groups that differ in blanks alone, ids that repeat, long texts that share their beginning."""
    rng = random.Random(seed)
    base, long = prose(1, 40), prose(2, 9000)
    rows = []
    for i in range(n):
        kind = rng.random()
        text = base if kind < 0.4 else prose(rng.randint(10, 40), 30) if kind < 0.7 else long + str(rng.randint(0, 3)) if kind < 0.75 else prose(1000 + i, 5)
        if rng.random() < 0.5:
            text = text.replace(" ", rng.choice(["  ", "\t", "\x0b\r", "\n"]), rng.randint(1, 3))
        rows.append((rng.randint(0, n), text, "en", "a", 1))
    return rows + odd_rows() + [(None, base, "en", "a", 1)] * 2


@pytest.mark.parametrize("hold", [contents.HOLD, 3])
@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_groups_against_plain_python(spark, hold, partitions):
    rows = many_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = contents.exact_groups(clashing(table(spark, rows)), hold=hold).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_only_kept_rows_stay_with_all_columns(spark):
    rows = many_rows(5)
    docs = clashing(table(spark, rows))
    for name in ("content", "size", "row", "at", "sha", "edge", "part", "a.b"):
        docs = docs.withColumn(name, docs["doc_id"])
    got = contents.deduplicated(docs, hold=4)
    assert got.columns == docs.columns
    got = got.collect()
    assert len(got) == len({re.sub(r"\s", "", r[1] or "") for r in rows})
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in brute(rows) if r[3])
    assert all(r["a.b"] == r.doc_id for r in got)
    kept = {(r[0], r[4]) for r in brute(rows) if r[3]}
    assert {(r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", r.text or "").encode()).hexdigest()) for r in got} == kept


def test_a_hot_group_is_dealt_over_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = contents._sorted(spark.range(2000).selectExpr("id AS doc_id", "'same text' AS text"), *[contents.F.col(c) for c in ("doc_id", "text")], contents.F.lit(0))
        sizes = [r["count"] for r in ordered.groupBy(contents.F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 1200


def test_empty_table(spark):
    assert contents.exact_groups(table(spark, [])).count() == 0
    assert contents.deduplicated(table(spark, [])).count() == 0


def test_query_equals_its_sql(spark, sf):
    name = "op13_content_sort"
    _, differences = compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name])
    assert differences == []
