"""From raw documents to packed training sequences, in five stages.

Each stage is a function of the documents that the stage before it has kept; :func:`run` writes what a stage returns to the shared
folder and reads it again for the next one, so a lost executor never repeats more than one stage. All stages but the last
return the columns of ``documents``.

Nulls and ties are those of the operators: a NULL or empty text fails the quality rules; rows without an id pass all
stages; rows that repeat are one document for the near-duplicate stage; an empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstand.llm import lines, mixing, neardup, packing, rules
from cabstand.llm.queries import byte_bpe
from cabstand.session import scratch

MIN_WORDS, EQUAL_WORDS = 8, 1


def _counted(docs: DataFrame) -> DataFrame:
    """The number of characters follows the text."""
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    return docs.withColumn("n_chars", F.char_length("text").cast(kind)) if kind else docs


def _folded(docs: DataFrame, *named: str) -> DataFrame:
    """The named columns, all others in one struct: what an operator adds can't meet one of theirs."""
    others = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns) if name not in named]
    return docs.select(*named, F.struct(*others or [F.lit(0).alias("none")]).alias("row"))


def _unfolded(df: DataFrame, docs: DataFrame, *named: str) -> DataFrame:
    """The columns of ``docs`` again, in their order; the named ones as the operator left them."""
    own = [F.col(name) if name in named else F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns)]
    return df.select(*own)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that too many texts of their source share."""
    return _counted(rules.cleaned(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; a document goes if only blank lines are left of it."""
    left = lines.deduplicated(_folded(docs, "doc_id", "text"), MIN_WORDS, equal_words=EQUAL_WORDS)
    own = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _counted(_unfolded(left.where(own), docs, "doc_id", "text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn, sources weighed by the square root of their size, in random order."""
    named = ("doc_id", "text", "source")
    return _unfolded(mixing.mixed_copies(_folded(docs, *named)), docs, *named)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence of 1024 tokens and its place there."""
    return packing.pack(packing.token_pieces(docs, *byte_bpe()))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Packing, tokens and the similarity classes can't be said in SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
