"""Repeated byte strings across all documents, by suffix arrays over the places where texts can repeat.

A string of ``length`` bytes is removed wherever it also starts earlier: at a smaller id, or further up in the same document.
Strings are judged on the input.

Every window of ``length`` bytes is named by the smallest hash among its anchors, its substrings of ``anchor`` bytes. Equal windows have
equal names, so windows can only repeat within a name, whatever documents they lie in. Neighbouring windows with one name
form a chunk; a chunk is a row of two hashes, its place and its size. Chunks with equal bytes are told apart by place alone:
the first one stands for all, within a batch already before anything is shuffled. Only names that lead to chunks of different
bytes, or to a chunk that can repeat within itself, need their bytes; these chunks are fetched from the texts, gathered by name and
sorted as suffixes: suffixes smaller than their successors are sorted directly, all others follow by bucket scans, and common
prefixes of neighbours that reach ``length`` show equal windows. All but the earliest of them are removed.

An anchor that very many texts hold would gather all its surroundings under one name. A bounded sample of the texts tells
which anchors are that frequent; they give way to any other anchor of a window. Then only windows made of frequent anchors alone
keep a frequent name, and their chunks have equal bytes. The sample steers the dealing out of work; results are
the same for any sample.

Nulls and ties: a NULL text has no bytes; a NULL id comes before all others; rows that repeat an id and a text are one document, and each is
returned with the same result; if an id has several texts, a hash of the text decides their order. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstand.llm.common import STEP, WORD_STEP, Rolling, mixed, slices, utf8

END = 0xFF  # no byte of UTF-8


@dataclass(frozen=True)
class Setting:
    """``length`` of a repeat and of an ``anchor`` in bytes; an anchor is frequent from ``frequent`` times on in a
    sample of about ``sample_bytes``; a block of suffixes has about ``block_bytes``."""

    length: int = 100
    anchor: int = 24
    sample_bytes: int = 8 << 20
    frequent: int = 6
    block_bytes: int = 1 << 20
    stretch: int = 1 << 17

    @property
    def anchors(self) -> int:
        return self.length - self.anchor + 1


def anchor_hashes(rolling: Rolling, n: int, setting: Setting) -> np.ndarray:
    starts = np.arange(max(0, n - setting.anchor + 1))
    return mixed(rolling.of(starts, starts + setting.anchor))


class Frequent:
    """Membership in a sorted array of hashes, through a table of their first 20 bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def demoted(self, values: np.ndarray) -> np.ndarray:
        """Values without their last bit; those of frequent anchors come after all others."""
        out = values >> np.uint64(1)
        if len(self.hashes):
            maybe = np.flatnonzero(self.table[(values >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, values[maybe]), len(self.hashes) - 1)
            hit = maybe[self.hashes[at] == values[maybe]]
            out[hit] |= np.uint64(1 << 63)
        return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def chunks(data: np.ndarray, offsets: np.ndarray, frequent: Frequent, setting: Setting):
    """(row, start in the row, windows, name, hash of the bytes, whether it may repeat within itself) of the chunks of
    rows that lie one after another. Equal windows hold their name's anchor at the same place, so a chunk can only repeat within
    itself if it holds that anchor twice."""
    n, length = len(data), setting.length
    if n < length:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    rolling = Rolling(data)
    anchors = frequent.demoted(anchor_hashes(rolling, n, setting))
    names = sliding_least(anchors, setting.anchors)
    new = np.zeros(len(names), dtype=bool)
    new[1:] = names[1:] != names[:-1]
    new[offsets[:-1][offsets[:-1] < len(names)]] = True
    starts = np.flatnonzero(new)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(names)), offsets[rows + 1] - length + 1)
    good = ends > starts
    starts, ends, rows = starts[good], ends[good], rows[good]
    to = ends + length - 1
    bodies = mixed(Rolling(data, WORD_STEP).of(starts, to) + (to - starts).astype(np.uint64) * np.uint64(STEP))
    spans = ends - starts + setting.anchors - 1
    firsts = spans.cumsum() - spans
    held = anchors[np.repeat(starts - firsts, spans) + np.arange(spans.sum())] == np.repeat(names[starts], spans)
    again = np.add.reduceat(held, firsts, dtype=np.int64) > 1 if len(firsts) else np.empty(0, dtype=bool)
    return rows, starts - offsets[rows], ends - starts, names[starts], bodies, again


def stretches(column: pa.Array, setting: Setting) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, positions in the rows, bytes, offsets); a very long row comes in overlapping parts."""
    for row, data, offsets in slices(column, setting.stretch):
        if len(offsets) > 2 or len(data) <= 2 * setting.stretch:
            rows = np.arange(row, row + len(offsets) - 1)
            yield rows, np.zeros(len(rows), dtype=np.int64), data, offsets
            continue
        for at in range(0, len(data) - setting.length + 1, setting.stretch):
            part = data[at : at + setting.stretch + setting.length - 1]
            yield np.array([row]), np.array([at]), part, np.array([0, len(part)])


def ranks(ids: pa.Array, keys: pa.Array) -> np.ndarray:
    """The rank of each row in the order of documents, NULL ids first; equal documents share a rank."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers, keys = ids.fill_null(0).to_numpy(zero_copy_only=False), keys.to_numpy(zero_copy_only=False)
    order = np.lexsort((keys, numbers, known))
    new = np.zeros(len(order), dtype=np.int64)
    for column in (keys, numbers, known):
        new[1:] |= column[order][1:] != column[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = new.cumsum()
    return out


def joined(rank: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document without overlaps; intervals that touch are one."""
    if not len(rank):
        return rank, starts, ends
    order = np.lexsort((ends, starts, rank))
    rank, starts, ends = rank[order], starts[order], ends[order]
    base = rank * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(base + ends)
    new = np.ones(len(rank), dtype=bool)
    new[1:] = (rank[1:] != rank[:-1]) | (base[1:] + starts[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rank)) - 1
    return rank[first], starts[first], reach[last] - base[last]


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = utf8(F.col(text).cast("string"))
    number = F.col(doc_id).cast("long")
    # The number for joins is never NULL; the key tells a NULL id from the number that stands for it.
    return docs.select(
        number.alias("d_id"), F.hash(body, number.isNull()).alias("d_key"), body.alias("body"), _number(number).alias("d_number")
    )


def _number(doc_id):
    return F.coalesce(doc_id, F.lit(0).cast("long"))


CHUNK = "d_id long, d_key int, start long, windows long, name long, body_hash long, again boolean, gone boolean"


def frequent_anchors(texts: DataFrame, setting: Setting) -> np.ndarray:
    """Hashes of the anchors that a sample of about ``sample_bytes`` holds too often. One task counts that sample."""
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    share = min(1.0, setting.sample_bytes / max(size, 1))
    drawn = texts.where(F.pmod(F.col("d_key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("body")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for _, _, data, _ in stretches(batch.column(0), setting):
                found.append(np.unique(anchor_hashes(Rolling(data), len(data), setting), return_counts=True))
        values, counts = (np.concatenate(p) for p in zip(*found)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
        order = np.argsort(values)
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, dtype=np.int64)
        total = np.add.reduceat(counts, first) if len(first) else counts
        yield pa.RecordBatch.from_arrays([pa.array(values[first][total >= setting.frequent].view(np.int64))], ["anchor"])

    rows = drawn.repartition(1).mapInArrow(count, "anchor long").toPandas()
    return rows["anchor"].to_numpy(dtype=np.int64).view(np.uint64)


def _chunk_rows(texts: DataFrame, frequent: np.ndarray, setting: Setting) -> DataFrame:
    hashes = texts.sparkSession.sparkContext.broadcast(frequent)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Frequent(hashes.value)
        for batch in batches:
            parts = []
            for rows, at, data, offsets in stretches(batch.column(2), setting):
                r, start, windows, name, body, again = chunks(data, offsets, common, setting)
                parts.append((rows[r], start + at[r], windows, name, body, again))
            if not parts:
                continue
            rows, start, windows, name, body, again = (np.concatenate(p) for p in zip(*parts))
            rank = ranks(batch.column(0), batch.column(1))
            # Of equal chunks in the batch the first place goes on; the others are known to repeat it.
            order = np.lexsort((start, rank[rows], body, name))
            rows, start, windows, name, body, again = (x[order] for x in (rows, start, windows, name, body, again))
            place = rank[rows]
            same = (name[1:] == name[:-1]) & (body[1:] == body[:-1])
            head = np.flatnonzero(np.append(True, ~same)) if len(rows) else np.empty(0, dtype=np.int64)
            lead = np.repeat(head, np.diff(np.append(head, len(rows))))
            gone = (place != place[lead]) | (start != start[lead])
            row_of = np.zeros(len(rank) + 1, dtype=np.int64)
            row_of[rank] = np.arange(len(rank))
            g_rank, g_start, g_end = joined(place[gone], start[gone], start[gone] + windows[gone] + setting.length - 1)
            g_rows = row_of[g_rank]
            stay = ~gone
            stay[stay] = np.append(True, (place[stay][1:] != place[stay][:-1]) | (start[stay][1:] != start[stay][:-1])) if stay.any() else True
            take = pa.array(np.concatenate([rows[stay], g_rows]))
            # Known repeats only pass through: their name spreads them.
            spread = mixed(g_rows.astype(np.uint64) * np.uint64(STEP) + g_start.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(np.concatenate([start[stay], g_start])),
                    pa.array(np.concatenate([windows[stay], g_end - g_start - setting.length + 1])),
                    pa.array(np.concatenate([name[stay], spread]).view(np.int64)),
                    pa.array(np.concatenate([body[stay], spread]).view(np.int64)),
                    pa.array(np.concatenate([again[stay], np.zeros(len(g_rows), dtype=bool)])),
                    pa.array(np.concatenate([np.zeros(stay.sum(), dtype=bool), np.ones(len(g_rows), dtype=bool)])),
                ],
                ["d_id", "d_key", "start", "windows", "name", "body_hash", "again", "gone"],
            )

    return texts.select("d_id", "d_key", "body").mapInArrow(cut, CHUNK)


def words_of(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place on as one number that sorts like them."""
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it. The end of the text is smaller than any byte."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[-1] = -1
    # In a run of equal bytes the first change decides.
    change = np.where(step != 0, np.arange(n), n)
    change = np.minimum.accumulate(change[::-1])[::-1]
    return step[change] > 0


def sorted_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes, compared up to ``depth`` bytes, eight at a time."""
    zero = np.append(words, np.zeros(depth + 8, dtype=np.uint64))
    order = np.argsort(zero[places], kind="stable")
    places = places[order]
    key = zero[places]
    group = np.append(0, (key[1:] != key[:-1]).cumsum()) if len(places) else np.empty(0, dtype=np.int64)
    for at in range(8, depth, 8):
        sizes = np.bincount(group) if len(group) else np.empty(0, dtype=np.int64)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
        key = zero[places[open_] + at]
        order = np.lexsort((key, group[open_]))
        places[open_] = places[open_][order]
        key, held = key[order], group[open_]
        # Slots of a group stay together; a new number starts wherever group or key changes.
        new = np.zeros(len(group), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        inner = np.zeros(len(open_), dtype=bool)
        inner[1:] = (held[1:] == held[:-1]) & (key[1:] != key[:-1])
        new[open_] |= inner
        group = new.cumsum()
    return places


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order, exact for the first ``depth`` bytes, by two-stage sorting."""
    n = len(text)
    small = smaller_than_next(text)
    direct = sorted_directly(np.flatnonzero(small), words, depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The end of the text comes first of all suffixes and brings in the last one.
    waiting[text[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        held = waiting[byte]
        fresh = np.concatenate(held) if held else np.empty(0, dtype=np.int64)
        held = [fresh]
        while len(fresh):
            before = fresh[fresh > 0] - 1
            fresh = before[text[before] == byte]
            held.append(fresh)
        bucket = np.concatenate([*held, direct[cuts[byte] : cuts[byte + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = text[before]
        before, first = before[first > byte], first[first > byte]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        where = np.flatnonzero(np.append(True, first[1:] != first[:-1])) if len(first) else []
        for part, value in zip(np.split(before, where[1:]) if len(first) else [], first[where] if len(first) else []):
            waiting[value].append(part)
        waiting[byte] = []
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """How many bytes each suffix shares with the one before it in the order, up to ``most``."""
    padded = np.append(words, np.zeros(most + 8, dtype=np.uint64))
    shared = np.zeros(len(order), dtype=np.int64)
    going = np.arange(1, len(order))
    for at in range(0, most, 8):
        if not len(going):
            break
        differ = padded[order[going] + at] ^ padded[order[going - 1] + at]
        equal = differ == 0
        shared[going[equal]] += 8
        rest, differ = going[~equal], differ[~equal]
        for k in range(7):
            shared[rest] += (differ >> np.uint64(56 - 8 * k)) == 0
        going = going[equal]
    return np.minimum(shared, most)


def repeats(strings: list[bytes], rank: np.ndarray, starts: np.ndarray, length: int):
    """(rank, start, end) of the bytes of the strings' documents that an earlier equal window covers."""
    sizes = np.array([len(s) for s in strings])
    text = np.frombuffer(bytes([END]).join(strings) + bytes([END]), dtype=np.uint8)
    begins = np.concatenate([[0], (sizes + 1).cumsum()[:-1]])
    words = words_of(text)
    order = suffix_array(text, words, length + 4)
    shared = common_prefixes(order, words, length)
    owner = np.searchsorted(begins, order, side="right") - 1
    whole = order - begins[owner] + length <= sizes[owner]
    tied = shared >= length
    group = (~tied).cumsum()
    member = whole & (tied | np.append(tied[1:], False))
    order, owner, group = order[member], owner[member], group[member]
    at = starts[owner] + order - begins[owner]
    place = rank[owner]
    by = np.lexsort((at, place, group))
    group, at, place = group[by], at[by], place[by]
    lead = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, dtype=np.int64)
    lead = np.repeat(lead, np.diff(np.append(lead, len(group))))
    later = (place != place[lead]) | (at != at[lead])
    return joined(place[later], at[later], at[later] + length)


def _from_suffixes(wanted: DataFrame, setting: Setting) -> DataFrame:
    """Intervals to remove, from chunks with their bytes that are gathered by name."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            ids, keys = rows["d_id"].combine_chunks(), rows["d_key"].combine_chunks()
            rank = ranks(ids, keys)
            row_of = np.zeros(len(rank) + 1, dtype=np.int64)
            row_of[rank] = np.arange(len(rank))
            place, start, end = repeats(rows["bytes"].to_pylist(), rank, rows["start"].to_numpy(), setting.length)
            take = pa.array(row_of[place])
            return pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), pa.array(start), pa.array(end)], ["d_id", "d_key", "start", "end"])

        for batch in batches:
            at = 0
            names = batch.column(0).to_numpy()
            ends = np.append(np.flatnonzero(names[1:] != names[:-1]) + 1, len(names))
            sizes = np.concatenate([[0], pa.compute.binary_length(batch.column(4)).to_numpy().cumsum()])
            for end in ends.tolist():
                # Cut between names once a block is full; the first name of a batch may continue the last one.
                begins_new = at > 0 or not waiting or waiting[-1].column(0)[-1].as_py() != names[0]
                if begins_new and size >= setting.block_bytes:
                    yield flush(pa.Table.from_batches(waiting))
                    waiting, size = [], 0
                waiting.append(batch.slice(at, end - at))
                size += int(sizes[end] - sizes[at])
                at = end
        if waiting:
            yield flush(pa.Table.from_batches(waiting))

    gathered = wanted.repartition("name").sortWithinPartitions("name", "d_id", "d_key", "start")
    return gathered.mapInArrow(find, "d_id long, d_key int, start long, end long")


def repeated_spans(docs: DataFrame, setting: Setting = Setting(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d_id, body, chunks, spans) of every row: chunks known to repeat an earlier one, spans found by sorting suffixes.

    All of it is one plan, in which chunks are worked out once and the texts are dealt out once.
    """
    source = _texts(docs, doc_id, text)
    rows = _chunk_rows(source, frequent_anchors(source, setting), setting)
    by_name = Window.partitionBy("name")
    by_bytes = Window.partitionBy("name", "body_hash").orderBy("d_id", "d_key", "start")
    told = rows.withColumn("rank", F.rank().over(by_bytes)).withColumn("several", F.min("body_hash").over(by_name) != F.max("body_hash").over(by_name))
    told = told.withColumn("gone", F.col("gone") | (F.col("rank") > 1))
    told = told.where(F.col("gone") | F.col("several") | F.col("again"))
    per_text = told.groupBy(_number(F.col("d_id")).alias("c_number"), F.col("d_key").alias("c_key")).agg(
        F.collect_list(F.struct("name", "start", "windows", "gone")).alias("chunks")
    )
    dealt = source.join(per_text, (F.col("d_number") == F.col("c_number")) & (F.col("d_key") == F.col("c_key")), "left")
    fetched = (
        dealt.select("d_id", "d_key", "body", F.explode(F.filter("chunks", lambda c: ~c["gone"])).alias("c"))
        .select(
            F.col("c.name").alias("name"),
            "d_id",
            "d_key",
            F.col("c.start").alias("start"),
            F.substring("body", (F.col("c.start") + 1).cast("int"), (F.col("c.windows") + setting.length - 1).cast("int")).alias("bytes"),
        )
    )
    sorted_out = _from_suffixes(fetched, setting).groupBy(_number(F.col("d_id")).alias("r_number"), F.col("d_key").alias("r_key"))
    sorted_out = sorted_out.agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    whole = dealt.join(sorted_out, (F.col("d_number") == F.col("r_number")) & (F.col("d_key") == F.col("r_key")), "left")
    return whole.select("d_id", "body", "chunks", "spans")


def deduplicated(docs: DataFrame, setting: Setting = Setting(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, kept, spans) per row: the bytes left and the removed stretches, in order."""
    whole = repeated_spans(docs, setting, doc_id, text)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            kept, removed = [], []
            for body, chunked, sorted_out in zip(batch.column(1), batch.column(2), batch.column(3)):
                data = body.as_buffer()
                starts, ends = [], []
                if chunked.is_valid and len(chunked):
                    _, start, windows, gone = (f.to_numpy(zero_copy_only=False) for f in chunked.values.flatten())
                    starts.append(start[gone])
                    ends.append(start[gone] + windows[gone] + setting.length - 1)
                if sorted_out.is_valid and len(sorted_out):
                    start, end = (f.to_numpy() for f in sorted_out.values.flatten())
                    starts.append(start)
                    ends.append(end)
                if not sum(map(len, starts)):
                    kept.append(data.to_pybytes())
                    removed.append([])
                    continue
                starts, ends = np.concatenate(starts), np.concatenate(ends)
                _, starts, ends = joined(np.zeros(len(starts), dtype=np.int64), starts, ends)
                mask = np.ones(data.size, dtype=bool)
                for a, b in zip(starts.tolist(), ends.tolist()):
                    mask[a:b] = False
                kept.append(np.frombuffer(data, dtype=np.uint8)[mask].tobytes())
                removed.append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.compute.binary_length(batch.column(1)).cast(pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, kind)],
                [doc_id, "n_bytes", "kept", "spans"],
            )

    return whole.mapInArrow(cut, f"{doc_id} long, n_bytes long, kept binary, spans array<struct<start:bigint,end:bigint>>")
