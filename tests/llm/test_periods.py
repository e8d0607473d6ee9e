import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cabstand.llm import periods
from tests.llm.support import clashing, odd_rows, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """Every maximal stretch of every lag; a lag counts if no smaller one is a period of the whole stretch."""
    n, found = len(words), []
    for lag in range(1, n // times + 1):
        at = 0
        while at + lag < n:
            end = at
            while end + lag < n and words[end] == words[end + lag]:
                end += 1
            length = end - at + lag
            if end > at and length >= max(least, times * lag):
                stretch = words[at : at + length]
                if not any(stretch[p:] == stretch[:-p] for p in range(1, lag)):
                    found.append((at, length, lag))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts(seed):
    """Sequences with nested, adjacent, overlapping and broken runs."""
    rng = random.Random(seed)
    kinds = rng.choice([1, 2, 3, 5, 50])
    word = lambda: rng.randint(0, kinds)
    out = []
    for _ in range(rng.randint(1, 6)):
        block = [word() for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            inner = [word() for _ in range(rng.randint(1, 3))]
            block += inner * rng.randint(2, 14)
        if rng.random() < 0.3:
            block = block + block[: len(block) // 2] + block
        many = block * rng.randint(1, 6)
        out += many[: len(many) - rng.randint(0, len(block) - 1)]
        if rng.random() < 0.3:
            out[rng.randrange(len(out))] = 99
    return out[:700]


@pytest.mark.parametrize("seed", range(150))
def test_runs_against_brute_force(seed):
    words = texts(seed)
    assert periods.runs_of(np.array(words, dtype=np.int64)) == brute(words)


@pytest.mark.parametrize("least,times", [(6, 3), (10, 4), (40, 3), (8, 4)])
def test_other_limits(least, times):
    for seed in range(40):
        words = texts(1000 + seed)
        assert periods.runs_of(np.array(words, dtype=np.int64), least, times) == brute(words, least, times)


def test_classes_cover_every_lag_and_guarantee_their_overlap():
    classes, lag = list(periods.lag_classes(5000)), 1
    for low, high, width in classes:
        assert low == lag and width * 2 >= 3 * high
        assert all(max(24 - d, 2 * d) >= width for d in range(low, high + 1))
        lag = high + 1
    assert lag > 5000


def expected(doc_id, text):
    """The row of the query, in plain Python."""
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def rows():
    made = odd_rows()
    for i in range(60):
        words = [f"w{w}é" for w in texts(i)]
        made.append((100 + i, "\t" + " ".join(words[:300]) + "\n", "en", "a", 1))
    return made + [(i, prose(i, 70), "en", "a", 1) for i in range(200, 320)]


def test_query_on_a_fixture(spark, tmp_path):
    docs = clashing(table(spark, rows())).withColumn("runs", F.lit(1)).withColumn("a.b", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["op11_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [r for r in rows() if r[0] != 11]
    got = {tuple(r) for r in got.collect() if r.doc_id != 11}
    assert got == {expected(r[0], r[1]) for r in small}


def test_query_on_the_given_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in entry.queries()["op11_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len(r.text or "") < 4000:
            assert got[r.doc_id] == expected(r.doc_id, r.text)


def test_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "a b " * 20 + "c"), (2, None), (3, "x  y\tz")], "doc_id long, text string")
    got = {r.doc_id: r for r in periods.periodic_runs(docs).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 40, 2)] and got[1].collapsed == "a b c" and got[1].n_words == 41
    assert (got[2].runs, got[2].greatest, got[2].collapsed) == ([], None, "")
    assert got[3].collapsed == "x y z"


def test_long_text_of_one_word(spark):
    docs = spark.createDataFrame([(1, "again " * 300_000)], "doc_id long, text string")
    assert [tuple(r) for r in periods.periodic_runs(docs).first().runs] == [(0, 300_000, 1)]


def test_empty_table(spark):
    assert periods.periodic_runs(table(spark, [])).count() == 0
