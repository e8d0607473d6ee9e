import hashlib
import random

import numpy as np
import pytest

from cabstand.llm import suffixes
from cabstand.llm.queries import QUERIES
from tests.llm.support import clashing, odd_rows, table


def brute(rows, length):
    """{(id, text): (n_bytes, spans, kept)} by a set of all windows seen so far."""
    seen, out = set(), {}
    texts = {(r[0], r[1] or "") for r in rows}
    for key in sorted(texts, key=lambda k: (k[0] is not None, k[0] or 0)):
        data = key[1].encode()
        mask = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                mask[i : i + length] = [True] * length
            seen.add(window)
        spans = [i for i in range(len(data)) if mask[i] and (i == 0 or not mask[i - 1])]
        out[key] = (len(data), len(spans), bytes(b for b, m in zip(data, mask) if not m))
    return out


def check(spark, rows, setting):
    got = suffixes.deduplicated(clashing(table(spark, rows)), setting).collect()
    want = brute(rows, setting.length)
    assert sorted((r.n_bytes, len(r.spans), bytes(r.kept)) for r in got) == sorted(want[r[0], r[1] or ""] for r in rows)


@pytest.mark.parametrize("frequent", [2, 8, 10**9])
def test_odd_rows_for_any_sample(spark, frequent):
    check(spark, odd_rows(), suffixes.Setting(frequent=frequent, block_bytes=500, stretch=2000))


def test_periodic_and_shared_texts(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        parts = [rng.choice(["ab" * 40, "xyz" * 30, "q" * 150, "common line of text that many have " * 2]) for _ in range(3)]
        rows.append((i, "".join(parts) + str(i), "en", "a", 1))
    check(spark, rows, suffixes.Setting(length=50, anchor=16, frequent=4, block_bytes=300))


def test_suffix_array_against_sorting():
    rng = random.Random(3)
    for _ in range(60):
        text = np.array([rng.randrange(rng.choice([2, 3, 200])) for _ in range(rng.randint(1, 300))], dtype=np.uint8)
        text = np.append(np.tile(text[:7], 20) if rng.random() < 0.3 else text, np.uint8(255))
        words = suffixes.words_of(text)
        order = suffixes.suffix_array(text, words, 104)
        cut = [bytes(text[i : i + 104]) for i in order]
        assert sorted(order) == list(range(len(text))) and cut == sorted(cut)
        shared = suffixes.common_prefixes(order, words, 100)
        for a, b, n in zip(cut, cut[1:], shared[1:]):
            a, b = a[:100].ljust(100, b"\0"), b[:100].ljust(100, b"\0")
            assert n == next((i for i in range(100) if a[i] != b[i]), 100)


def test_empty(spark):
    assert suffixes.deduplicated(table(spark, [])).count() == 0


def test_query_on_a_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute(rows, 100)
    got = QUERIES["op1_suffix_array_dedup"](spark, sf).collect()
    assert len(got) == len(rows)
    texts = {r.doc_id: r.text or "" for r in rows}
    for r in got:
        n_bytes, n_spans, kept = want[r.doc_id, texts[r.doc_id]]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n_bytes, n_bytes - len(kept), n_spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
