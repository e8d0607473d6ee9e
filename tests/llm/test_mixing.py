import hashlib
import math
from collections import Counter

from cabstand.llm import mixing
from tests.llm.support import clashing, odd_rows, prose, table


def brute_counts(rows, rates, seed=17):
    """{row number: copies}: the Poisson quantile of each row's number."""
    out = {}
    for n, r in enumerate(rows):
        u = int(hashlib.md5(f"{seed}|{'' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        rate, k = rates[r[3]], 0
        p = below = math.exp(-rate)
        while below <= u:
            k += 1
            p *= rate / k
            below += p
        out[n] = k
    return out


def rates(rows, exponent=0.5):
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1] or "")
    weight = sum(s**exponent for s in size.values() if s)
    return {k: (s**exponent / weight * sum(size.values()) / s if s else 1.0) for k, s in size.items()}


def test_counts_against_plain_python(spark):
    rows = odd_rows() + [(1000 + i, prose(i, 30), "en", f"s{i % 3}", 1) for i in range(200)]
    docs = clashing(table(spark, rows))
    mixed = mixing.mixed_copies(docs)
    assert mixed.columns == [*[c for c in docs.columns if c != "copy"], "copy", "shuffle_key"]
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    want = Counter()
    for n, k in brute_counts(rows, rates(rows)).items():
        want[rows[n][0], rows[n][3]] += k
    assert got == +want


def test_given_weights_and_order(spark):
    rows = [(i, "x" * 100, "en", "ab"[i % 2], 1) for i in range(4000)] + [(9000, "y", "en", "not named", 1)]
    weights = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, weight double")
    got = mixing.mixed_copies(table(spark, rows), weights).collect()
    share = Counter(r.source for r in got)
    assert abs(share["a"] - 3600) < 250 and abs(share["b"] - 400) < 100 and "not named" not in share
    assert [r.doc_id for r in got] != sorted(r.doc_id for r in got)
    again = mixing.mixed_copies(table(spark, rows), weights).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_shuffled_join_gives_the_same(spark):
    rows = odd_rows()
    one = mixing.mixed_copies(table(spark, rows)).collect()
    other = mixing.mixed_copies(table(spark, rows), broadcast_rows=0).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, other), key=repr)


def test_large_mean(spark):
    from pyspark.sql import functions as F

    table_ = spark.range(1).select(mixing.poisson_table(F.lit(900.0)).alias("t")).first().t
    assert table_ == sorted(table_) and abs(table_[-1] - 1) < 1e-9
    assert abs(next(i for i, p in enumerate(table_) if p > 0.5) - 900) <= 1


def test_empty(spark):
    assert mixing.mixed_copies(table(spark, [])).count() == 0


def test_columns_of_any_name_pass_through(spark):
    from pyspark.sql import functions as F

    docs = table(spark)
    for name in ("mix_source", "mix_table", "mix_count", "id", "origin", "row", "copy", "shuffle_key", "a.b"):
        docs = docs.withColumn(name, F.lit("x"))
    mixed = mixing.mixed_copies(docs)
    assert set(mixed.columns) == set(docs.columns)
    rows = mixed.collect()
    assert rows and all(r["mix_count"] == r["mix_source"] == r["a.b"] == "x" and r["copy"] >= 1 for r in rows)
    assert len(rows) == mixing.mixed_copies(table(spark)).count()
