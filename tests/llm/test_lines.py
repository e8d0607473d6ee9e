import random
import re

from pyspark.sql import functions as F

from cabstand.llm import lines
from tests.llm.support import clashing, odd_rows, prose, table


def near(a, b):
    """At most one word inserted, left out or exchanged."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, min_words=8):
    texts = sorted({(r[0], r[1]) for r in rows if r[1]}, key=lambda t: (t[0] is not None, t[0] or 0))
    earlier, gone = [], {}
    for text in texts:
        for no, line in enumerate(text[1].split("\n")):
            words = [w for w in re.split(r"[\x20\x09\x0B-\x0D]+", line) if w]
            if len(words) >= min_words:
                if any(near(words, other) for other in earlier):
                    gone.setdefault(text, set()).add(no)
                earlier.append(words)
    out = []
    for r in rows:
        parts = (r[1] or "").split("\n")
        cut = gone.get((r[0], r[1]), set())
        out.append((r[0], "\n".join(p for i, p in enumerate(parts) if i not in cut) if r[1] else r[1], len(cut)))
    return sorted(out, key=repr)


def check(spark, rows):
    docs = table(spark, rows)
    got = lines.deduplicated(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in got.collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    check(spark, odd_rows())


def test_edits_of_every_kind(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        made = []
        for line in prose(i % 6, 72, 9).split("\n"):
            words = line.split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(words))
                kind = rng.randrange(3)
                words[at : at + 1] = [[], ["new"], [words[at], "more"]][kind]
            made.append(" ".join(words))
        rows.append((100 - i, "\n".join(made), "en", "a", 1))
    check(spark, rows)


def test_short_lines_go_if_they_repeat(spark):
    footer = "All rights are reserved by them here"
    rows = [(i, f"{prose(60 + i, 12)}\n\n{footer}\nits own line {i}\n\nHome", "en", "a", 1) for i in range(3)]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduplicated(table(spark, rows), equal_words=1).collect()}
    want = {0: (rows[0][1], 0)} | {i: (f"{prose(60 + i, 12)}\n\nits own line {i}\n", 2) for i in (1, 2)}
    assert got == want


def test_blanks_of_every_kind_are_evened_out(spark):
    line = "one two three four five six seven eight"
    rows = [(1, line, "en", "a", 1), (2, "  one\ttwo\x0bthree   four\x0c five\rsix seven eight \r\nown", "en", "a", 1), (3, line.replace("six", "6"), "en", "a", 1)]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduplicated(table(spark, rows), equal_words=1).collect()}
    assert got == {1: (line, 0), 2: ("own", 1), 3: ("", 1)}


def test_columns_of_any_name_pass_through(spark):
    docs = clashing(table(spark, odd_rows()))
    for name in ("t_id", "t_text", "k2", "others", "removed", "g1", "parts", "id", "h1", "words", "a.b"):
        docs = docs.withColumn(name, F.lit(3))
    plain = {(r.doc_id, r.text) for r in lines.deduplicated(table(spark, odd_rows()), equal_words=1).collect()}
    left = lines.deduplicated(docs, equal_words=1)
    assert set(docs.columns) <= set(left.columns)
    rows = left.collect()
    assert {(r.doc_id, r.text) for r in rows} == plain and all(r["a.b"] == r["t_id"] == 3 and r["key"] == "x" for r in rows)


def test_empty(spark):
    assert lines.deduplicated(table(spark, [])).count() == 0


def test_lines_that_pairs_name_come_from_one_join_with_the_texts(spark):
    docs = spark.createDataFrame([(1, "a  b\nc d\ne f"), (None, "g h"), (3, "a b")], "doc_id long, text string")
    texts = lines._texts(docs, "doc_id", "text")
    place = lambda no: F.struct("t_id", "k1", "k2", F.lit(no).alias("no"))
    first = texts.where("t_id = 1")
    pairs = first.select(F.lit(0).alias("id"), place(1).alias("line"), place(0).alias("other")).unionByName(
        first.select(F.lit(1).alias("id"), place(2).alias("line"), place(0).alias("other"))
    ).unionByName(texts.where("t_id IS NULL").select(F.lit(2).alias("id"), place(0).alias("line"), place(0).alias("other")))
    named = lines._named_lines(pairs, texts)
    assert sorted(row["text"] for row in named.collect()) == ["a b", "c d", "e f", "g h"]
    met = lines._with_words(pairs, named, "line", "words").collect()
    assert sorted((row["id"], row["words"]) for row in met) == [(0, ["c", "d"]), (1, ["e", "f"]), (2, ["g", "h"])]


def test_halves_are_stretches_of_the_line_and_even_texts_are_looked_at_once(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d x f g h"), (3, "a b c d f g h i j")], "doc_id long, text string")
    rows = lines._lines(lines._texts(docs, "doc_id", "text"), 1, 8)
    # No list of words for each half, and no text searched for each blank twice over.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and plan.count("replace(") - plan.count("regexp_replace(") == len(lines.OTHER_BLANKS)
    half = {row["t_id"]: row for row in rows.collect()}
    assert half[1]["half0"] == half[2]["half0"] and half[1]["half1"] != half[2]["half1"]
    assert half[1]["half0"] == half[3]["half2"] and half[1]["half1"] != half[3]["half3"]
    halves = spark.sql("SELECT 'a' AS line UNION ALL SELECT 'a b' UNION ALL SELECT 'b a'").select(
        "line", *[key["key"].alias(f"k{i}") for i, key in enumerate(lines.halves(F.col("line"), F.size(F.split("line", " "))))]
    )
    one = {row["line"]: row for row in halves.collect()}
    assert one["a"]["k1"] == one["b a"]["k3"] != one["a b"]["k3"] and one["a"]["k0"] == one["a b"]["k2"]
    odd = ["a\tb", "a\x0bb", "a\x0cb", "a\rb", "a  b", "a b", " a b ", " \ta \x0b b\x0c\r"]
    even = spark.createDataFrame([(text + "\n" + text,) for text in odd] + [(None,), ("",)], "text string").select(lines.even_lines(F.col("text")).alias("l"))
    assert [row["l"] for row in even.collect()] == [["a b", "a b"]] * len(odd) + [None, [""]]
