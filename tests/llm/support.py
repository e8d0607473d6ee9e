"""Small document tables with every odd case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ("on", "er", "the", "ing", "schen", "heit", "é", "ción", "ra", "mo", "ti", "ul")


def prose(seed, words, per_line=12):
    rng = random.Random(seed)
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(made[i : i + per_line]) for i in range(0, words, per_line))


def edited(text, at, word="CHANGED"):
    words = text.split(" ")
    words[at] = word
    return " ".join(words)


def odd_rows():
    """Null and empty texts, null ids and sources, ties, repeated rows, copies and a long text."""
    base = prose(1, 120)
    return [
        (1, base, "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", "en", None, 0),
        (4, " \t\n\x0b \r\n", "en", "a", 7),
        (5, base, "en", "b", 1),
        (6, prose(2, 90), None, None, 1),
        (6, prose(2, 90), None, None, 1),
        (7, prose(3, 60) + "\n" + base, "de", "a", 1),
        (None, prose(4, 80), "fr", "b", 1),
        (8, "word " * 300, "en", "a", 1500),
        (9, edited(base, 50), "en", "b", 1),
        (10, "one two", "en", "a", 7),
        (11, prose(5, 6000), "en", "b", 1),
        (12, base[: len(base) // 2] + prose(6, 70), "es", "a", 1),
    ]


def table(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(odd_rows() if rows is None else rows, schema)


def clashing(df):
    """With columns named like those that operators use or add."""
    from pyspark.sql import functions as F

    for name in ("k1", "key", "copy", "signals", "kept", "removed", "n_removed", "found", "node", "line", "words", "rank"):
        df = df.withColumn(name, F.lit("x"))
    return df
