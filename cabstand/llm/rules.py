"""Quality rules: signals of a text by itself, and lines that too many documents of a host share.

Everything is built from SQL functions. A text's own signals never leave its row. For the lines, each distinct text of
a host sends its distinct normalised lines as hashes; they are counted before they are shuffled, so a line that
every document has costs one row per task. Copies of a text count as one document: what many copies share with each
other alone is not boilerplate. A line is above its limit from ``min_texts`` texts of the host on, if those are also at
least ``min_share`` of the host's texts. A document is depleted if such lines hold more than ``max_removed`` of its words.

Nulls and ties: a NULL text has no words and fails the base rules; a NULL host is a host of its own; rows that repeat
are judged alike and each returned; only the named columns are read, all others pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstand.llm.common import text_key

WORDS = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
INNER_BLANKS = r"[\x20\x09\x0B-\x0D]+"


@dataclass(frozen=True)
class Limits:
    """Limits of the base rules and of the rule on shared lines."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_texts: int = 20
    min_share: float = 0.01
    max_removed: float = 0.5


def without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def with_signals(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with a struct ``signals`` of what its text shows by itself."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = [*docs.columns]
    step = docs.withColumn("_body", body)
    step = step.withColumn("_words", F.regexp_extract_all("_body", F.lit(WORDS), F.lit(0)))
    step = step.withColumn("_n", F.size("_words"))
    step = step.withColumn(
        "_hashes",
        F.when(
            F.col("_n") > 2,
            F.transform(
                F.slice("_words", F.lit(1), F.greatest(F.col("_n") - 2, F.lit(0))),
                lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    step = step.withColumn("_again", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
    step = step.withColumn(
        "_spots",
        F.when(
            F.col("_again"), F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ),
    )
    same = lambda spot, i: F.get("_spots", i)["h"] == spot["h"]
    step = step.withColumn(
        "_starts",
        F.transform(
            F.filter("_spots", lambda spot, i: F.coalesce(same(spot, i - 1), F.lit(False)) | F.coalesce(same(spot, i + 1), F.lit(False))),
            lambda spot: spot["i"],
        ),
    )
    step = step.withColumn(
        "_covered",
        F.coalesce(
            F.size(F.array_distinct(F.concat("_starts", F.transform("_starts", lambda i: i + 1), F.transform("_starts", lambda i: i + 2)))),
            F.lit(0),
        ),
    )
    step = step.withColumn("_lines", F.filter(F.split("_body", "\n"), lambda line: line.rlike(WORDS)))
    n_words = F.col("_n").cast("long")
    repeated = F.when(F.col("_again"), F.col("_covered")).otherwise(0).cast("long")
    blanks = F.octet_length("_body") - F.octet_length(without(F.col("_body"), BLANKS))
    return step.select(
        *names,
        F.struct(
            n_words.alias("n_words"),
            (F.char_length("_body") - blanks).cast("long").alias("word_chars"),
            (F.octet_length("_body") - F.octet_length(without(F.col("_body"), SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            ((n_words < limits.min_words) | (100 * repeated > limits.max_repeat_percent * n_words)).alias("base_failed"),
        ).alias("signals"),
    )


def normal_lines(body: Column) -> Column:
    """The lines of a text in lower case, blanks and numbers evened out. As many as the text has, in the same order."""
    even = F.regexp_replace(F.regexp_replace(F.lower(body), INNER_BLANKS, " "), "[0-9]+", "0")
    return F.transform(F.split(even, "\n"), lambda line: F.trim(line))


def shared_lines(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """(host, text key, hashes of its lines above the limit, words in them), for the texts that have such lines."""
    body, origin = F.col(f"`{text}`").cast("string"), F.col(f"`{host}`")
    texts = docs.where(body.isNotNull()).select(
        origin.alias("host"), text_key(body).alias("key"), normal_lines(body).alias("lines")
    )
    lines = texts.select("host", "key", F.explode(F.filter("lines", lambda line: line != "")).alias("line")).select(
        "host", "key", F.xxhash64("line").alias("line"), F.size(F.split("line", " ")).alias("words")
    )
    # One row per text and line, with all words that the line has in this text.
    lines = lines.groupBy("host", "line", "key").agg(F.sum("words").alias("words"), F.count("*").alias("times"))
    # Copies of a text share a key and are one text; their rows were added up and are divided again.
    copies = docs.where(body.isNotNull()).groupBy(origin.alias("host"), text_key(body).alias("key")).agg(F.count("*").alias("copies"))
    hosts = copies.groupBy("host").agg(F.count("*").alias("texts"))
    counted = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= limits.min_texts)
    above = (
        counted.alias("c")
        .join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
        .where(F.col("n") >= F.col("texts") * limits.min_share)
        .select(F.col("c.host").alias("a_host"), F.col("line").alias("a_line"))
    )
    hit = lines.join(above, F.col("host").eqNullSafe(F.col("a_host")) & (F.col("line") == F.col("a_line")))
    found = hit.groupBy("host", "key").agg(F.collect_list("line").alias("lines"), F.sum("words").alias("words"))
    return (
        found.alias("f")
        .join(copies.alias("c"), F.col("f.host").eqNullSafe(F.col("c.host")) & (F.col("f.key") == F.col("c.key")))
        .select(
            F.col("f.host").alias("shared_host"),
            F.col("f.key").alias("shared_key"),
            F.col("lines").alias("shared_lines"),
            (F.col("words") / F.col("copies")).cast("long").alias("shared_words"),
        )
    )


def _held(docs: DataFrame, host: str, text: str, without_text: bool) -> tuple[DataFrame, list[str]]:
    """Host and text under names of their own, all other columns in one struct, whatever they are called."""
    names = [name for name in docs.columns if not (without_text and name == text)]
    row = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names) if name != text] or [F.lit(0).alias("none")])
    return docs.select(row.alias("row"), F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text")), names


def _joined(held: DataFrame, shared: DataFrame) -> DataFrame:
    return held.join(
        shared, F.col("host").eqNullSafe(F.col("shared_host")) & (F.col("_key") == F.col("shared_key")), "left"
    ).drop("shared_host", "shared_key", "_key")


def _kept(limits: Limits) -> Column:
    # One comparison over both sides of the join: a rule on the signals alone would be moved below it and worked out anew there.
    most = F.when(F.col("signals.base_failed"), F.lit(-1.0)).otherwise(F.col("signals.n_words") * F.lit(limits.max_removed))
    return F.coalesce("shared_words", F.lit(0)) <= most


#: What :func:`verdicts` adds; older columns of these names give way.
ADDED = ("signals", "shared_words", "kept")


def verdicts(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` without its text, with the signals, the words in shared lines and ``kept``."""
    held, names = _held(docs, host, text, True)
    slim = with_signals(held, "text", limits).withColumn("_key", text_key(F.col("text").cast("string"))).drop("text")
    judged = _joined(slim, shared_lines(docs, host, text, limits)).withColumn("kept", _kept(limits))
    return judged.select(
        *[F.col(f"row.c{i}").alias(name) for i, name in enumerate(names) if name not in ADDED],
        "signals",
        F.coalesce("shared_words", F.lit(0)).alias("shared_words"),
        "kept",
    )


def cleaned(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, without the lines above the limit."""
    held, names = _held(docs, host, text, False)
    keyed = with_signals(held, "text", limits).withColumn("_key", text_key(F.col("text").cast("string")))
    kept = _joined(keyed, shared_lines(docs, host, text, limits)).where(_kept(limits))
    # Lines and their hashes are zipped, not indexed: an array that a lambda names is worked out again for each element.
    hashes = F.transform(normal_lines(F.col("text")), lambda line: F.xxhash64(line))
    own = F.zip_with(F.split(F.col("text"), "\n"), hashes, lambda line, h: F.when(~F.array_contains("shared_lines", h), line))
    left = F.filter(own, lambda line: line.isNotNull())
    body = F.when(F.col("shared_lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return kept.select(*[body.alias(text) if name == text else F.col(f"row.c{i}").alias(name) for i, name in enumerate(names)])
