"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are tokenised once; from then on only lengths move. Pieces are dealt at random over tasks and packed in
blocks of at most ``block`` pieces: a best-fit start, then a local search between the bins that are not full. The search
empties the bin with the least in it first, by moving a piece into another bin, by exchanging one piece for one, or by
exchanging two for one, and takes a step only if it raises the sum of the squared fills. Bins that are still not full
afterwards go, whatever task they come from, through the same search again in fewer blocks.

Nulls and ties: a NULL text counts as empty (its end token alone makes a piece); rows that repeat are packed as often as
they occur; documents with equal lengths are placed in the order of a hash of their ids. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstand.llm.common import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
END_ID = 2


@lru_cache(maxsize=2)
def encoder(ranks: str, vocabulary: str, pattern: str):
    """A function from text to token ids.

    The rank file states the same vocabulary as the tokenizer file and is read by a library that is about eight times
    as fast. Where that one gives up (a run of white space too long for its matcher), and for texts that spell out one of the
    tokens added to the vocabulary, the tokenizer file decides.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    slow = Tokenizer.from_file(vocabulary)
    added = re.compile("|".join(re.escape(token.content) for token in slow.get_added_tokens_decoder().values()) or "(?!)")

    def encode(text: str) -> np.ndarray:
        if not added.search(text):
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass
        return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def piece_bounds(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than the capacity."""
    first = total % capacity or capacity
    yield 0, min(first, total)
    for start in range(first, total, capacity):
        yield start, capacity


def token_pieces(docs: DataFrame, ranks: str, vocabulary: str, pattern: str, capacity: int = 1024) -> DataFrame:
    """One row per piece of each document, with the checksum of its ids."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, vocabulary, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), END_ID).astype("<u4")
                for piece, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the bin it fills best. Open bins are found by their free space in a bit mask."""
    free_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = free_bins[free].pop()
            if not free_bins[free]:
                mask &= ~(1 << free)
            bins[bin_].append(item)
        else:
            free, bin_ = capacity, len(bins)
            bins.append([item])
        free_bins[free - size].append(bin_)
        if free > size:
            mask |= 1 << (free - size)
    return bins


class Search:
    """Swap-based local search over bins that are not full."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        #: By free space: bins. By reach (free space plus a piece of the bin) and length of that piece: (bin, piece).
        self.by_free: list[dict[int, None]] = [{} for _ in range(capacity + 1)]
        self.by_reach: list[dict[int, dict[tuple[int, int], None]]] = [{} for _ in range(capacity + 1)]
        self.frees = self.reaches = 0

    def enter(self, bin_: int) -> None:
        free = self.capacity - self.fill[bin_]
        if free == 0 or not self.bins[bin_]:
            return
        self.by_free[free][bin_] = None
        self.frees |= 1 << free
        for item in self.bins[bin_]:
            size = self.lengths[item]
            self.by_reach[free + size].setdefault(size, {})[bin_, item] = None
            self.reaches |= 1 << (free + size)

    def leave(self, bin_: int) -> None:
        free = self.capacity - self.fill[bin_]
        if bin_ not in self.by_free[free]:
            return
        del self.by_free[free][bin_]
        if not self.by_free[free]:
            self.frees &= ~(1 << free)
        for item in self.bins[bin_]:
            size = self.lengths[item]
            at = self.by_reach[free + size]
            del at[size][bin_, item]
            if not at[size]:
                del at[size]
            if not at:
                self.reaches &= ~(1 << (free + size))

    def partner(self, size: int) -> tuple[int, int, int] | None:
        """(bin, piece, gain) for bringing ``size`` into a bin in exchange for a shorter piece, the fullest result first."""
        mask = self.reaches >> size
        reach = size
        while mask:
            step = (mask & -mask).bit_length() - 1
            reach, mask = reach + step, mask >> step
            for length, held in self.by_reach[reach].items():
                if length < size:
                    return *next(iter(held)), size - length
            reach, mask = reach + 1, mask >> 1
        return None

    def exchange(self, donor: int, give: list[int], bin_: int, take: list[int]) -> None:
        self.leave(bin_)
        for item in give:
            self.bins[donor].remove(item)
        for item in take:
            self.bins[bin_].remove(item)
        self.bins[bin_] += give
        self.bins[donor] += take
        moved = sum(self.lengths[i] for i in give) - sum(self.lengths[i] for i in take)
        self.fill[bin_] += moved
        self.fill[donor] -= moved
        self.enter(bin_)

    def step(self, donor: int) -> bool:
        """One improving exchange out of the donor, if there is one."""
        size, seen = self.lengths, set()
        order = sorted(self.bins[donor], key=lambda i: (-size[i], i))
        for item in order:
            mask = self.frees >> size[item]
            if mask:
                bin_ = next(iter(self.by_free[size[item] + (mask & -mask).bit_length() - 1]))
                if self.fill[bin_] + size[item] > self.fill[donor]:
                    self.exchange(donor, [item], bin_, [])
                    return True
        for give in [[i] for i in order] + [[a, b] for n, a in enumerate(order) for b in order[n + 1 :]]:
            total = sum(size[i] for i in give)
            if total > self.capacity or total in seen:
                continue
            seen.add(total)
            found = self.partner(total)
            # The squared fill grows if the receiving bin ends above where the donor began.
            if found and self.fill[found[0]] + found[2] > self.fill[donor]:
                self.exchange(donor, give, found[0], [found[1]])
                return True
        return False

    def run(self) -> list[list[int]]:
        """Every step raises the sum of the squared fills, so the search ends; the bound on steps keeps it short."""
        for bin_ in range(len(self.bins)):
            self.enter(bin_)
        steps = 4 * sum(map(len, self.bins)) + 64
        for donor in sorted(range(len(self.bins)), key=lambda b: (self.fill[b], b)):
            self.leave(donor)
            while self.bins[donor] and steps and self.step(donor):
                steps -= 1
            self.enter(donor)
        return [b for b in self.bins if b]


def packed_bins(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    bins, sizes = best_fit(lengths, capacity), lengths.tolist()
    fills = [sum(sizes[i] for i in b) for b in bins]
    full = [b for b, f in zip(bins, fills) if f == capacity]
    return full + Search([b for b, f in zip(bins, fills) if f < capacity], sizes, capacity).run()


def _packed(pieces: DataFrame, capacity: int, block: int, round_: int) -> DataFrame:
    """Packs what each task holds, block by block."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, sequence = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal sequence, waiting
            rows = pa.Table.from_batches(waiting).combine_chunks()
            waiting = []
            lengths = rows["length"].to_numpy().astype(np.int64)
            ids, offsets, fills = (np.empty(len(lengths), dtype=np.int64) for _ in range(3))
            for bin_ in packed_bins(lengths, capacity):
                ids[bin_] = (round_ << 60) | (task << 36) | sequence
                ends = lengths[bin_].cumsum()
                offsets[bin_], fills[bin_] = ends - lengths[bin_], ends[-1]
                sequence += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            arrays = [rows[n].combine_chunks() if rows[n].num_chunks != 1 else rows[n].chunk(0) for n in names]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(ids), pa.array(offsets), pa.array(fills)], [*names, "sequence_id", "offset", "fill"]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                if sum(b.num_rows for b in waiting) + part.num_rows > block:
                    yield flush()
                waiting.append(part)
        if sum(b.num_rows for b in waiting):
            yield flush()

    # Rows that repeat share their hash, but a task may hold any number of them: nothing is grouped.
    order = [F.xxhash64("doc_id", "piece", "ids_crc32"), "doc_id", "piece", "start", "length", "ids_crc32"]
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32").sortWithinPartitions(*order).mapInArrow(
        pack, PACKED + ", fill long"
    )


def pack(pieces: DataFrame, capacity: int = 1024, block: int = 65_536) -> DataFrame:
    """``pieces`` with the sequence each one lies in and its place there.

    A block leaves a bin or so that isn't full, so two rounds leave about one for every ``block`` short pieces. Full
    pieces are sequences of their own and need no search.
    """
    pieces = stored(pieces)
    spark = pieces.sparkSession
    whole = F.col("length") == capacity
    alone = pieces.where(whole).select(
        "*", (F.lit(3 << 60) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = pieces.where(~whole)
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    first = stored(_packed(short.repartition(tasks), capacity, block, 1))
    open_ = F.col("fill") < capacity
    rest = first.where(open_)
    second = _packed(rest.repartition(-(-max(rest.count(), 1) // block)), capacity, block, 2)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return alone.select(columns).unionByName(first.where(~open_).select(columns)).unionByName(second.select(columns))
