import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from cabstand.llm import neardup
from cabstand.llm.common import components
from tests.llm.support import clashing, edited, odd_rows, prose, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def weighted(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(rows, threshold=0.8):
    """{id: class} over all pairs of documents."""
    sets = [(r[0], weighted(r[1])) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and sum((x & y).values()) >= threshold * sum((x | y).values()):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in parent}


def near_rows():
    rows = odd_rows()
    for i in range(40):
        text = prose(50 + i % 8, 100 + 10 * (i % 8))
        for k in range(i // 8):
            text = edited(text, (37 * k) % 90)
        rows.append((200 - i, text, "en", "a", 1))
    return rows


def test_classes_against_all_pairs(spark):
    rows = near_rows()
    got = neardup.near_duplicates(clashing(table(spark, rows))).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == brute(rows)


def family_rows(groups=60, size=3):
    """One template in versions below the threshold to each other, each version in near copies; ids don't follow versions."""
    template = prose(700, 200).replace("\n", " ")
    rows = []
    for g in range(groups):
        version = template
        for k in range(4):
            version = edited(version, (50 * k + 7 * g) % 200, f"version{g}x{k}")
        for i in range(size):
            rows.append((1000 * i + g * 37 % groups, edited(version, (31 * i + g) % 200, f"copy{g}x{i}"), "en", "a", 1))
    return rows


def test_versions_of_a_template_against_all_pairs(spark):
    rows = family_rows()
    want = brute(rows)
    assert 20 < len(set(want.values())) < len(rows) // 2
    got = neardup.near_duplicates(table(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    members = Counter(want.values())
    assert {r.doc_id: r.n_texts for r in got} == {i: members[c] for i, c in want.items()}


def skewed_rows(n=400):
    """A family around one text: most copies are near to it, a quarter is not, and some of those are near to each other."""
    base = prose(900, 150).replace("\n", " ")
    rng, rows = random.Random(4), [(n + 7, base, "en", "a", 1)]
    far = []
    for i in range(n):
        text = rng.choice(far) if far and rng.random() < 0.1 else base
        for k in range(rng.choice([1, 1, 1, 2, 3, 5, 8])):
            text = edited(text, rng.randrange(150), f"e{i}x{k}")
        far.append(text)
        rows.append((i, text, "en", "a", 1))
    return rows


def test_a_family_around_one_text_against_all_pairs(spark, monkeypatch):
    rows = skewed_rows()
    want = brute(rows)
    assert 20 < len(set(want.values())) < 200
    for tile in (neardup.TILE, 16):
        monkeypatch.setattr(neardup, "TILE", tile)
        monkeypatch.setattr(neardup, "FETCHED", 0 if tile == 16 else neardup.FETCHED)
        got = neardup.near_duplicates(table(spark, rows)).collect()
        assert {r.doc_id: r.class_id for r in got} == want


def test_texts_of_one_id_are_told_apart(spark):
    a, b, c = (prose(k, 80) for k in (31, 32, 33))
    rows = [(1, a, "en", "a", 1), (1, b, "en", "a", 1), (1, b, "en", "a", 1), (2, edited(b, 40), "en", "a", 1), (1, edited(a, 3), "en", "a", 1), (3, c, "en", "a", 1)]
    kept = neardup.deduplicated(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 1, 3]
    texts = [r.text for r in kept]
    assert b in texts and c in texts and (a in texts) != (edited(a, 3) in texts)


def test_columns_of_any_name_pass_through(spark):
    docs = clashing(table(spark, near_rows()))
    for name in ("own_id", "_again", "row", "row_id", "row_key", "gone_id", "class_id", "node_id", "band", "items", "a.b"):
        docs = docs.withColumn(name, F.lit(3))
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(r["a.b"] == 3 and r["own_id"] == 3 and r["k1"] == "x" for r in rows)
    assert len(rows) == neardup.deduplicated(table(spark, near_rows())).count()


def test_one_of_each_class_stays(spark):
    rows = near_rows()
    docs = table(spark, rows)
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(brute(rows).values()))
    assert ids.count(None) == 1


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(3)
    common, own = rng.integers(1, 2**63, 300, dtype=np.uint64), rng.integers(1, 2**63, 200, dtype=np.uint64)
    a = np.concatenate([common, own[:100]])
    b = np.concatenate([common, own[100:]])
    weights = rng.uniform(0.2, 3.0, 400)
    weights_b = np.concatenate([weights[:300], rng.uniform(0.2, 3.0, 100)])
    rows = np.repeat([0, 1], 400)
    parts = neardup.cells(rows, np.concatenate([a, b]), np.concatenate([weights, weights_b]))
    signature = neardup.signatures(2, *parts, size=2000)
    shared = weights[:300].sum()
    truth = shared / (weights.sum() + weights_b.sum() - shared)
    assert abs((signature[0] == signature[1]).mean() - truth) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 105), (105, 103), (200, 200)] + [(300, i) for i in range(301, 340)]
    found = {r.node: r["class"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(31)} | {100: 100, 103: 100, 105: 100} | {i: 300 for i in range(300, 340)}
    assert found == want


def test_empty(spark):
    assert neardup.near_duplicates(table(spark, [])).count() == 0
    assert neardup.deduplicated(table(spark, [])).count() == 0
