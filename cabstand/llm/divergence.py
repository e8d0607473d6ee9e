"""How the sources of each language differ in their words: distances of all pairs, and the words that mark a source.

Words are runs of letters (ASCII, lower-cased, or any character beyond ASCII). A language keeps the words that occur in
``least_docs`` of its documents. Over those, every source of the language has smoothed frequencies in whole billionths, ``p = 1 +
floor(10**9 * (count + 5) / (N + 5 V))``, and two sources are as far apart as the sum of ``|p - q|`` over all kept words.

A frequency depends on a word through its count alone, so a pair needs only the number of words for each pair of
counts, its joint cells. Words have numbers in blocks of about ``BLOCK``; per block, a bitset of word numbers is stored for
every (source, count). Anding two bitsets and counting bits gives a joint cell, which is multiplied by ``|p - q|`` at once; cells in
which one side or both have no occurrence come as complements. Blocks are summed per pair. Sources are dealt over chunks of
about ``CHUNK``, so a task never holds more than two chunks' bitsets of one block, however many sources there are.

Counts are summed in each task before they are shuffled. Tables of languages and of sources are broadcast up to ``BESIDE`` rows and
joined by shuffle beyond.

Nulls and ties: a NULL text, language or source counts as empty; a row is a document, rows that repeat count each; a
source without words, or a language that keeps none, still has its pairs (distance 0 where nothing is kept); equal values are
ranked by the bytes of the item; an empty table gives an empty result. Other columns are ignored. Arithmetic is exact
(decimals before the division, 64-bit integers after it).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstand.llm.common import utf8, written

LEAST_DOCS, TOP = 30, 50
BLOCK, CHUNK, BESIDE = 256, 64, 50_000
#: Entries that a task counts before it passes them on.
MEMORY = 700_000

_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_counts(docs: DataFrame, lang: str, source: str, text: str, memory: int = MEMORY) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, docs_of = defaultdict(Counter), defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (language, origin), counts in n.items():
                terms, held = list(counts), docs_of[language, origin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(language, len(terms)), pa.repeat(origin, len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(counts.values(), pa.int64()), pa.array([held[t] for t in terms], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
            n.clear()
            docs_of.clear()

        for batch in batches:
            size = sum(map(len, n.values()))
            for language, origin, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = body.as_py().translate(_LETTERS).split()
                counts = n[language, origin]
                before = len(counts)
                counts.update(words)
                docs_of[language, origin].update(set(words))
                size += len(counts) - before
                if size > memory:
                    yield from flush()
                    size = 0
        yield from flush()

    named = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    chosen = docs.select(named(lang), named(source), utf8(F.col(f"`{text}`").cast("string")))
    counted = chosen.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _beside(small: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it has no more than ``BESIDE`` rows."""
    return F.broadcast(small) if small.count() <= BESIDE else small


def _share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed frequency in billionths. Decimals hold the product; the quotient is a whole number."""
    above = (n + F.lit(5)).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = total.cast("decimal(19,0)") + terms.cast("decimal(18,0)") * F.lit(5).cast("decimal(1,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


class Audit:
    """The stored tables from which both results are read."""

    def __init__(self, docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS):
        counted = written(term_counts(docs, lang, source, text), "terms")
        totals = counted.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        totals = written(totals.where(F.col("docs") >= least_docs).select("lang", "term", "total"), "kept")
        langs = written(totals.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("all")), "langs")
        self.langs = _beside(langs)
        numbered = totals.join(self.langs, "lang").select(
            "lang",
            "term",
            _share(F.col("total"), F.col("all"), F.col("terms")).alias("q"),
            F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / BLOCK)).cast("int").alias("block"),
        )
        in_block = Window.partitionBy("lang", "block").orderBy("term")
        self.terms = written(numbered.withColumn("slot", (F.row_number().over(in_block) - 1).cast("int")), "numbers")
        kept = counted.select("lang", "source", "term", "n").join(self.terms, ["lang", "term"])
        self.kept = written(kept, "counts")
        self.groups = _beside(written(self._groups(docs, lang, source), "groups"))
        self.cells = self.kept.join(self.groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("all"), F.col("terms")))

    def _groups(self, docs: DataFrame, lang: str, source: str) -> DataFrame:
        """Every occurring source of a language: its words, the frequency of a word it lacks, chunk and seat."""
        named = lambda c, to: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(to)
        present = docs.select(named(lang, "lang"), named(source, "source")).distinct()
        sums = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("all"))
        groups = present.join(sums, ["lang", "source"], "left").join(self.langs.select("lang", "terms"), "lang", "left")
        groups = groups.select("lang", "source", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("all", "terms")])
        many = present.groupBy("lang").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
        none = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("all"), F.col("terms"))).otherwise(F.lit(0))
        chunk = F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int")
        seat = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("source")) - 1
        return groups.join(many, "lang").withColumns({"p0": none, "chunk": chunk}).drop("chunks").withColumn("seat", seat.cast("int"))

    def bitsets(self) -> DataFrame:
        """(lang, block, chunk, cells): for every (source, count) the words with that count, as 64-bit pieces of a bitset."""
        piece = F.floor(F.col("slot") / 64).cast("int").alias("piece")
        bit = F.expr("shiftleft(1L, slot % 64)")
        rows = self.cells.groupBy("lang", "block", "chunk", "seat", "n", "p", piece).agg(F.bit_or(bit).alias("bits"))
        return rows.groupBy("lang", "block", "chunk").agg(F.collect_list(F.struct("seat", "p", "piece", "bits")).alias("cells"))

    def distances(self) -> DataFrame:
        """(lang, source, other, value) for every ordered pair of sources of a language."""
        seats = self.groups.groupBy("lang", "chunk").agg(F.sort_array(F.collect_list(F.struct("seat", "p0"))).alias("seats"))
        blocks = self.terms.groupBy("lang", "block").agg(F.count("*").alias("size"))
        frame = blocks.join(seats, "lang").join(self.bitsets(), ["lang", "block", "chunk"], "left")
        frame = written(frame, "bitsets")
        a = frame.select("lang", "block", "size", F.col("chunk").alias("chunk_a"), F.col("seats").alias("seats_a"), F.col("cells").alias("cells_a"))
        b = frame.select("lang", "block", F.col("chunk").alias("chunk_b"), F.col("seats").alias("seats_b"), F.col("cells").alias("cells_b"))
        met = a.join(b, ["lang", "block"]).where(F.col("chunk_a") <= F.col("chunk_b"))
        parts = met.select("lang", "size", "chunk_a", "seats_a", "cells_a", "chunk_b", "seats_b", "cells_b").mapInArrow(
            _joint, "lang string, chunk_a int, seat_a int, chunk_b int, seat_b int, value long"
        )
        sums = parts.groupBy("lang", "chunk_a", "seat_a", "chunk_b", "seat_b").agg(F.sum("value").alias("value"))
        both = sums.unionByName(
            sums.select("lang", F.col("chunk_a").alias("chunk_b"), F.col("seat_a").alias("seat_b"), F.col("chunk_b").alias("chunk_a"), F.col("seat_b").alias("seat_a"), "value")
        )
        names = lambda side, to: self.groups.select("lang", F.col("source").alias(to), F.col("chunk").alias(f"chunk_{side}"), F.col("seat").alias(f"seat_{side}"))
        pairs = names("a", "source").join(names("b", "other"), "lang").where(F.col("source") != F.col("other"))
        joined = pairs.join(both, ["lang", "chunk_a", "seat_a", "chunk_b", "seat_b"], "left")
        return joined.select("lang", "source", "other", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    def markers(self) -> DataFrame:
        """(lang, source, term, value): words more frequent in a source than in its language, and by how much."""
        return self.cells.where(F.col("p") > F.col("q")).select("lang", "source", "term", (F.col("p") - F.col("q")).alias("value"))


def _levels(cells: pa.StructScalar, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seat, p, bitset) of every (source, count) of a block, by seat."""
    if cells is None or not len(cells):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, pieces), np.uint64)
    seat, p, piece, bits = (cells.field(k).to_numpy(zero_copy_only=False) for k in range(4))
    order = np.lexsort((p, seat))
    seat, p, piece, bits = seat[order].astype(np.int64), p[order], piece[order], bits[order].view(np.uint64)
    fresh = np.ones(len(seat), dtype=bool)
    fresh[1:] = (seat[1:] != seat[:-1]) | (p[1:] != p[:-1])
    level = fresh.cumsum() - 1
    sets = np.zeros((int(level[-1]) + 1, pieces), dtype=np.uint64)
    np.bitwise_or.at(sets, (level, piece), bits)
    return seat[fresh], p[fresh], sets


def _by_seat(seats: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, seats, values)
    return out


def _joint(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joint cells of all pairs of sources of a block, each multiplied by the distance of its frequencies."""
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            lang, size, chunk_a, seats_a, cells_a, chunk_b, seats_b, cells_b = (c[row] for c in batch.columns)
            size, chunk_a, chunk_b = size.as_py(), chunk_a.as_py(), chunk_b.as_py()
            none_a, none_b = (s.values.field(1).to_numpy(zero_copy_only=False) for s in (seats_a, seats_b))
            pieces = -(-size // 64)
            at_a, p_a, sets_a = _levels(cells_a.values, pieces)
            at_b, p_b, sets_b = (at_a, p_a, sets_a) if chunk_a == chunk_b else _levels(cells_b.values, pieces)
            size_b = np.bitwise_count(sets_b).sum(axis=1, dtype=np.int64)
            all_b = _by_seat(at_b, size_b, len(none_b))
            starts = np.searchsorted(at_b, np.arange(len(none_b)))
            held = np.flatnonzero(np.diff(np.append(starts, len(at_b))))
            for seat in range(len(none_a)):
                mine = slice(*np.searchsorted(at_a, [seat, seat + 1]))
                own, p, zero = sets_a[mine], p_a[mine], int(none_a[seat])
                cells = np.zeros((len(own), len(sets_b)), dtype=np.int64)
                for k in range(pieces):
                    cells += np.bitwise_count(own[:, k, None] & sets_b[None, :, k])
                both = np.zeros((len(own), len(none_b)), dtype=np.int64)
                if len(held) and len(own):
                    both[:, held] = np.add.reduceat(cells, starts[held], axis=1)
                value = _by_seat(at_b, (cells * np.abs(p[:, None] - p_b[None, :])).sum(axis=0), len(none_b))
                value += _by_seat(at_b, (size_b - cells.sum(axis=0)) * np.abs(p_b - zero), len(none_b))
                alone = np.bitwise_count(own).sum(axis=1, dtype=np.int64)
                value += ((alone[:, None] - both) * np.abs(p[:, None] - none_b[None, :])).sum(axis=0)
                value += (size - alone.sum() - all_b + both.sum(axis=0)) * np.abs(zero - none_b)
                first = seat + 1 if chunk_a == chunk_b else 0
                out += [(lang.as_py(), chunk_a, seat, chunk_b, other, int(value[other])) for other in range(first, len(none_b))]
        columns = list(zip(*out)) or [()] * 6
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "chunk_a", "seat_a", "chunk_b", "seat_b", "value"]
        )


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: all other sources by distance, and the ``top`` words that mark a source."""
    made = Audit(docs, lang, source, text, least_docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    pairs = made.distances().select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = made.markers().select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = [pairs.select("*", rank), terms.select("*", rank).where(F.col("rank") <= top)]
    return reduce(DataFrame.unionByName, ranked)
