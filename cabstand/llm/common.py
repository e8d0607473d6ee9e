"""What several operators share: reading the tables, cutting lineage, word lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstand.session import cut_lineage, scratch

#: A word is a run of characters that are none of the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that no later loss repeats it."""
    return cut_lineage(df)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: smaller than a checkpoint, for rows that several later steps read."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_key(text: Column) -> Column:
    """Sixteen bytes that name a text; equal texts only have equal keys."""
    return F.unhex(F.md5(text))


def row_keys(*columns: Column) -> tuple[Column, Column]:
    """Two hashes, never NULL, that name a row together: rows meet on them by plain equality, NULL ids included."""
    return F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit(1), *reversed(columns)).alias("k2")


def utf8(text: Column) -> Column:
    """The bytes of a text, none for NULL."""
    return F.coalesce(text, F.lit("")).cast("binary")


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


#: Odd multipliers and one random number per byte, fixed by a rule.
STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64. A task keeps those of the longest stretch up to four million."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 18), base, dtype=np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 22:
            _POWERS[base] = known
    return known[:n]


class Rolling:
    """Polynomial hashes of any stretch of a byte array, from one running sum."""

    def __init__(self, data: np.ndarray, base: int = STEP):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTES[data] * powers(base, len(data)), out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64), len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of stretches of rows with about ``most`` bytes; a longer row is a stretch of its own."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        end = min(end, len(column))
        yield row, data[offsets[row] : offsets[end]], (offsets[row : end + 1] - offsets[row]).astype(np.int64)
        row = end


IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every word of the rows that lie in ``data`` one after another."""
    inside = ~IS_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1][offsets[1:-1] < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = cuts[cuts > 0]
    last[cuts - 1] = inside[cuts - 1]
    ends = np.flatnonzero(last) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(row, hash) of every run of ``width`` words, and the words' spans. A shorter text is one run of all its words."""
    rows, starts, ends = word_spans(data, offsets)
    hashes = mixed(Rolling(data).of(starts, ends) + (ends - starts).astype(np.uint64))
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    begins = np.concatenate([[0], counts.cumsum()])
    at = np.flatnonzero(np.arange(len(rows)) + width <= begins[rows + 1])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(WORD_STEP) + hashes[at + k]
    short = np.flatnonzero((counts > 0) & (counts < width))
    few = np.zeros(len(short), dtype=np.uint64)
    for k in range(width - 1):
        has = counts[short] > k
        few[has] = few[has] * np.uint64(WORD_STEP) + hashes[begins[short[has]] + k]
    all_rows = np.concatenate([rows[at], short])
    values = mixed(np.concatenate([total, few ^ np.uint64(STEP)]))
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], values[order], (rows, starts, ends)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, class) for the nodes of the edges (a, b): ``class`` is the smallest node that a node is linked to.

    Large-star and small-star steps by turns; every round is kept in the checkpoint folder. Groups only meet as minima,
    and the joins are plain, so a node with very many links is split like any hot key.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        down = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(down, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(small.where(F.col("a") != F.col("b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("class")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
    )
