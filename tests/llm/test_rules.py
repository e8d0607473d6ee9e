import re
from collections import Counter

from pyspark.sql import functions as F

from cabstand.llm import rules
from tests.llm.support import clashing, odd_rows, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signals(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_signals(spark):
    rows = [*odd_rows(), (30, "#a *b\n#a *b\n\n😀 <tag> & | $ % x x x x x", "en", "a", 1)]
    got = rules.with_signals(clashing(table(spark, rows)).drop("signals")).select("text", "signals.*").collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(signals(r[1]) for r in rows)


def long_text(seed):
    from tests.llm.support import prose

    return prose(seed, 80)


def test_shared_lines_go_and_depleted_documents_too(spark):
    shared = "Subscribe  to our letter NUMBER 12 today and read it soon"
    rows = [(i, long_text(100 + i) + "\n" + shared.replace("12", str(i)), "en", "h", 1) for i in range(30)]
    rows += [(50, "\n".join([shared] * 9 + [long_text(7)[:40]]), "en", "h", 1), (51, long_text(200), "en", "h", 1)]
    rows += [(60 + i, long_text(300), "en", "h", 1) for i in range(40)]  # copies of one text are one text
    limits = rules.Limits(min_texts=20, min_share=0.1)
    kept = {r.doc_id: r.text for r in rules.cleaned(table(spark, rows), limits=limits).collect()}
    assert 50 not in kept
    assert kept[51] == long_text(200) and all(kept[60 + i] == long_text(300) for i in range(40))
    assert all(kept[i] == long_text(100 + i) for i in range(30))
    verdict = {r.doc_id: r for r in rules.verdicts(table(spark, rows), limits=limits).collect()}
    assert {i for i, r in verdict.items() if not r.kept} == {50}
    assert verdict[0].shared_words == 11 and verdict[50].shared_words == 99


def test_odd_rows_and_empty(spark):
    docs = clashing(table(spark))
    for name in ("shared_key", "shared_lines", "shared_host", "_key", "_body", "host", "row", "c0", "a.b"):
        docs = docs.withColumn(name, F.lit(3))
    kept = rules.cleaned(docs)
    assert kept.columns == docs.columns
    assert all(r["a.b"] == r["_key"] == 3 and r["signals"] == r["kept"] == "x" for r in kept.collect())
    judged = rules.verdicts(docs)
    assert set(judged.columns) == (set(docs.columns) - {"text"}) | {"signals", "shared_words", "kept"}
    assert {r["kept"] for r in judged.collect()} == {True, False}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (r[0] for r in odd_rows() if not signals(r[1])[-1]), key=str
    )
    assert rules.cleaned(table(spark, [])).count() == 0
    assert rules.verdicts(table(spark, [])).count() == 0
