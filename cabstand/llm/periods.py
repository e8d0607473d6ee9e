"""Periodic runs of words, found by seeds that are extended along diagonals, and texts without the repeats.

A run is a stretch of consecutive words with smallest period ``q`` whose length is at least ``least`` and at least
``times * q``, and which no neighbouring word extends with the same period. Words at lag ``q`` agree on the
diagonal of that lag for ``length - q`` places: the overlap that is guaranteed. So every run holds two equal k-grams at
lag ``q`` if ``k`` is at most that overlap. Lags are taken in classes. For each, ``k`` is the smallest overlap that a lag of the
class guarantees, and the class ends where ``k`` falls below 1.5 lags. Within such a class the pairs that have to be
enumerated are each occurrence of a k-gram and the next one, never all pairs: an occurrence strictly between the two ends of a
lag ``q`` would give the k-gram two periods whose sum is at most ``k``, hence their greatest common divisor as a period (Fine and
Wilf), and the run a smaller period than its smallest. For the same reason the lag of a seed is the smallest period of what it
grows to. Seeds are extended word by word on exact word numbers in both directions; a table per lag keeps how far a diagonal is
covered, so a stretch is extended once however many seeds lie in it.

Texts without any repeated k-gram of the shortest class hold no run; that is settled by hashes for many texts at once, and
equal grams always have equal hashes. A text is one row and nothing is shuffled: work grows with the words, times the number of
lag classes (logarithmic in the length) for texts that repeat something.

Nulls and ties: NULL, empty and blank texts have no words, no runs and an empty collapsed text; rows that repeat give equal rows;
ids, NULL or not, pass through; of runs with equal exponents the one that starts first is the greatest, then the one with
the smaller period. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstand.llm.common import STEP, Rolling, mixed, powers, slices, utf8, word_spans

LEAST, TIMES = 24, 3
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def lag_classes(longest: int, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, int]]:
    """(first lag, last lag, guaranteed overlap) of the classes up to the lag ``longest``."""
    low, turn = 1, -(-least // times)
    while low <= longest:
        overlap = min(max(least - lag, (times - 1) * lag) for lag in range(low, max(low, turn) + 1))
        high = max(low, overlap * 2 // 3)
        yield low, high, overlap
        low = high + 1


class Grams:
    """Hashes of all stretches of a sequence of words, from one running sum."""

    def __init__(self, words: np.ndarray, base: int = STEP):
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * powers(base, len(words)), out=self.sums[1:])
        self.back = powers(pow(base, -1, 1 << 64), len(words) + 1)

    def of(self, starts: np.ndarray, width: int) -> np.ndarray:
        return mixed((self.sums[starts + width] - self.sums[starts]) * self.back[starts])


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of two sequences agree, looked at in growing stretches."""
    n, at, size = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + size)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, size = end, size * 2
    return n


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start and period."""
    n, found = len(words), []
    grams = Grams(mixed(words.astype(np.uint64) + np.uint64(1)))
    open_ = np.arange(n)
    for low, high, width in lag_classes(n // times, least, times):
        # A longer gram repeats only where the shorter one does.
        open_ = open_[open_ + width <= n]
        if len(open_) < 2:
            break
        hashes = grams.of(open_, width)
        order = np.argsort(hashes, kind="stable")
        again = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        first, second = open_[order[again]], open_[order[again + 1]]
        open_ = np.union1d(first, second)
        lags = second - first
        seeds = (lags >= low) & (lags <= high)
        first, lags = first[seeds], lags[seeds]
        order = np.lexsort((first, lags))
        first, lags = first[order], lags[order]
        # Neighbouring seeds of one lag lie in one stretch.
        fresh = np.ones(len(first), dtype=bool)
        fresh[1:] = (lags[1:] != lags[:-1]) | (first[1:] != first[:-1] + 1)
        covered: dict[int, int] = {}
        for at, lag in zip(first[fresh].tolist(), lags[fresh].tolist()):
            if at < covered.get(lag, 0):
                continue
            right = _agreeing(words[at : n - lag], words[at + lag :])
            left = _agreeing(words[:at][::-1], words[lag : at + lag][::-1])
            covered[lag] = at + right + 1
            length = left + right + lag
            if right and length >= max(least, times * lag):
                found.append((at - left, length, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period, compared exactly."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(edges[:-1].cumsum() == 0).tolist()]


def _repeating(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Whether a text of the stretch holds some run of ``width`` words twice."""
    rows, starts, ends = word_spans(data, offsets)
    hashes = mixed(Rolling(data).of(starts, ends) + (ends - starts).astype(np.uint64))
    at = np.arange(max(0, len(rows) - width + 1))
    at = at[rows[at] == rows[at + width - 1]]
    keys = Grams(hashes).of(at, width) ^ mixed(rows[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    again = order[1:][keys[order[1:]] == keys[order[:-1]]]
    repeats = np.zeros(len(offsets) - 1, dtype=bool)
    repeats[rows[at[again]]] = True
    return repeats


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, greatest, collapsed``: all runs by start and period, the one with the greatest exponent, and
    the words that are left, joined by one space."""
    if times < 3 or least < 2 * times:
        raise ValueError("runs need three periods or more, and a least length of two times that number")
    shortest = next(lag_classes(1, least, times))[2]
    schema = T.StructType([docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema["doc_id"]]).add("n_words", T.LongType())
    for name, kind in (("runs", f"array<{RUN}>"), ("greatest", RUN), ("collapsed", "string")):
        schema = schema.add(name, T.DataType.fromDDL(kind))
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    as_run = lambda run: run and dict(zip(("start", "length", "period"), run))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column(1)):
                counts, runs, best, left = [], [], [], []
                for k, repeats in enumerate(_repeating(data, offsets, shortest).tolist()):
                    words = data[offsets[k] : offsets[k + 1]].tobytes().split()
                    own = []
                    if repeats:
                        numbers: dict[bytes, int] = {}
                        own = runs_of(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)), least, times)
                    counts.append(len(words))
                    runs.append([as_run(run) for run in own])
                    best.append(as_run(greatest(own)))
                    left.append(b" ".join(collapsed_words(words, own)))
                texts = pa.array(left, pa.binary()).cast(pa.string())
                ids = batch.column(0).slice(row, len(counts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run_type)), pa.array(best, run_type), texts], schema.names
                )

    return docs.select(F.col(f"`{doc_id}`"), utf8(F.col(f"`{text}`").cast("string"))).mapInArrow(find, schema)
