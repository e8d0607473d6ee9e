import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cabstand.llm import divergence
from check_queries import compare, connect
from tests.llm.support import clashing, odd_rows, table

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top):
    """Sorted rows of the result, word by word in plain Python."""
    held, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = {t for t, n in held[lang].items() if n >= least}
        v = len(kept)

        def shares(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 5) // (total + 5 * v) for t in kept}

        q = shares(sum((counts[lang, s] for s in names), Counter()))
        p = {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in names if o != s]
            marks = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", marks)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def rows(seed, n, n_sources, vocabulary):
    rng = random.Random(seed)
    words = [rng.choice(["ab", "Äß", "ÉA", "x", "日本"]) + "".join(rng.choice("abcXYé") for _ in range(rng.randint(1, 5))) for _ in range(vocabulary)]
    out = []
    for i in range(n):
        source = None if rng.random() < 0.03 else f"s{min(rng.randrange(n_sources), rng.randrange(n_sources))}"
        body = rng.choice([" ", "1", "-", "\n", "_", "\x00"]).join(words[min(rng.randrange(vocabulary), rng.randrange(vocabulary))] for _ in range(rng.randint(0, 60)))
        out.append((i // 2, rng.choice([body] * 20 + [None, "", "12 34"]), rng.choice(["en"] * 6 + ["de", None]), source, 1))
    return out + odd_rows() + [(1, "lone", "xx", "only", 1), (1, "", "yy", "a", 1), (1, None, "yy", "b", 1)]


@pytest.mark.parametrize("seed,n,n_sources,vocabulary,block,chunk,least", [(1, 300, 6, 300, 256, 64, 3), (2, 300, 12, 500, 64, 3, 2), (3, 200, 40, 40, 16, 8, 4), (4, 60, 3, 900, 200, 1, 1)])
def test_against_brute_force(spark, monkeypatch, seed, n, n_sources, vocabulary, block, chunk, least):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    if seed % 2:
        monkeypatch.setattr(divergence, "BESIDE", 0)
    made = rows(seed, n, n_sources, vocabulary)
    docs = clashing(table(spark, made))
    for name in ("term", "n", "docs", "all", "p", "q", "block", "slot", "chunk", "seat", "a.b"):
        docs = docs.withColumn(name, F.lit(1))
    got = sorted(map(tuple, divergence.audit(docs, least_docs=least, top=7).collect()))
    assert got == brute(made, least, 7)


def test_counts_do_not_depend_on_the_memory_of_a_task(spark):
    docs = table(spark, rows(5, 200, 5, 80))
    whole, parts = (divergence.term_counts(docs, "lang", "source", "text", memory).collect() for memory in (10**6, 3))
    assert sorted(whole) == sorted(parts) and len(whole) > 50


def test_empty_table(spark):
    assert divergence.audit(table(spark, [])).count() == 0


def test_query_equals_its_sql(spark, sf):
    name = "op12_source_divergence"
    _, differences = compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name])
    assert differences == []
