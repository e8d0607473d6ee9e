"""Exact dedup by sorting contents.

Texts are equal if they are identical once the six ASCII white-space characters are deleted. Sampled splitters deal the
normalised bytes out by ranges, every range is sorted externally, so that equal texts stand next to each other, and each text is
compared in full with the one before it. A splitter holds a bounded piece of content: the leading bytes, then a digest of all of
them, then the order within a group (length, id), so a group of any size may reach over several ranges and none of them gets
more than its share; the ranges are sorted in the same order. A group that lies inside one range is complete there. Only the first and the last group of a range can go
on in another one, and a group of more than ``hold`` rows is passed on in parts: those few are put together by
their SHA-256, at most two and the number of such parts for each range, which is what bounds the one broadcast.

Of a group the row with the most code points in the original text stays, then the smallest id.

Nulls and ties: a NULL text counts as empty, and all texts without content are equal; a NULL id comes after all others; of
rows that repeat an id and a text exactly one stays; an empty table gives an empty table. Columns of any name pass through
:func:`deduplicated` untouched; :func:`exact_groups` takes none but the id and the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstand.llm.common import written

#: Content bytes in a splitter.
LEADING = 32
#: Rows of one group that a task keeps before it passes them on as a part.
HOLD = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The bytes of a text without white space; none for NULL."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    for blank in BLANKS:
        body = F.replace(body, F.lit(blank), F.lit(""))
    return body.cast("binary")


def _sorted(docs: DataFrame, doc_id: Column, text: Column, row: Column) -> DataFrame:
    """(content, id, row), dealt out by ranges of content and sorted there; of a group the row that stays comes first."""
    keyed = docs.select(normalised(text).alias("content"), text.alias("text"), doc_id.alias("id"), row.alias("row")).select(
        "content",
        F.substring("content", 1, LEADING).alias("leading"),
        F.md5("content").alias("digest"),
        F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).alias("size"),
        "id",
        "row",
        # Rows that repeat in everything else are still told apart.
        F.monotonically_increasing_id().alias("at"),
    )
    within = [F.desc("size"), F.asc_nulls_last("id"), F.asc("at")]
    dealt = keyed.repartitionByRange("leading", "digest", *within)
    return dealt.sortWithinPartitions("leading", "digest", "content", *within).select("content", "id", "row")


class _Groups:
    """The rows of one range, group by group, as batches of the outgoing columns."""

    def __init__(self, schema: pa.Schema, part: int, hold: int):
        self.schema, self.part, self.hold = schema, part, hold
        self.last: pa.Scalar | None = None
        #: Of the group that is still open: its first id, its name, its rows so far.
        self.keep, self.sha, self.waiting, self.rows = None, b"", [], 0
        self.first_of_range, self.opened = True, False

    def out(self, ids: pa.Array, row: pa.Array, first: bool, size: int, edge: bool) -> pa.RecordBatch:
        n = len(ids)
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
        is_first = pa.array([first] + [False] * (n - 1), pa.bool_())
        keep = same(self.keep, self.schema.field("keep_id").type)
        columns = [ids, row, keep, same(size, pa.int64()), is_first, same(self.sha, pa.binary()), same(edge, pa.bool_()), same(self.part, pa.int32())]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.schema)], schema=self.schema)

    def close(self, whole: bool, last: bool) -> Iterator[pa.RecordBatch]:
        """What is waiting of the open group; ``whole`` if the group ends here, ``last`` at the end of the range."""
        edge = self.first_of_range or last or self.opened or not whole
        first = not self.opened
        for ids, row in self.waiting:
            yield self.out(ids, row, first, self.rows, edge)
            first = False
        self.waiting, self.rows, self.opened = [], 0, not whole
        if whole:
            self.first_of_range = False

    def feed(self, content: pa.Array, ids: pa.Array, row: pa.Array) -> Iterator[pa.RecordBatch]:
        n = len(content)
        starts = (pc.indices_nonzero(pc.not_equal(content[1:], content[:-1])).to_numpy() + 1).tolist() if n > 1 else []
        if self.last is None or self.last != content[0]:
            starts = [0, *starts]
        bounds = [*starts, n]
        if bounds[0]:
            self.waiting.append((ids[: bounds[0]], row[: bounds[0]]))
            self.rows += bounds[0]
        singles: list[int] = []
        for start, end in zip(bounds, bounds[1:]):
            if self.waiting or self.opened:
                yield from self.close(True, False)
            self.keep, self.sha = ids[start].as_py(), hashlib.sha256(content[start].as_buffer()).digest()
            if end < n and end - start == 1 and not self.first_of_range:
                singles.append((start, self.sha))
                continue
            self.waiting, self.rows = [(ids[start:end], row[start:end])], end - start
        if singles:
            yield self.alone(ids, row, singles)
        self.last = content[n - 1]
        if self.rows > self.hold:
            yield from self.close(False, False)

    def alone(self, ids: pa.Array, row: pa.Array, singles: list) -> pa.RecordBatch:
        """Groups of one row inside a batch, all at once."""
        at = pa.array([s[0] for s in singles], pa.int64())
        n, ids = len(at), ids.take(at)
        columns = [
            ids, row.take(at), ids, pa.repeat(pa.scalar(1, pa.int64()), n), pa.repeat(pa.scalar(True), n),
            pa.array([s[1] for s in singles], pa.binary()), pa.repeat(pa.scalar(False), n), pa.repeat(pa.scalar(self.part, pa.int32()), n),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _compared(ordered: DataFrame, only_first: bool, hold: int) -> DataFrame:
    """One row per text (or per group and range): who stays, how many there are, and whether that is the whole group."""
    id_type, row_type = ordered.schema["id"].dataType, ordered.schema["row"].dataType
    fields = [("id", id_type), ("row", row_type), ("keep_id", id_type), ("size", T.LongType()), ("first", T.BooleanType()),
              ("sha", T.BinaryType()), ("edge", T.BooleanType()), ("part", T.IntegerType())]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = None
        for batch in batches:
            if not batch.num_rows:
                continue
            content, ids, row = batch.columns
            if groups is None:
                kinds = [ids.type, row.type, ids.type, pa.int64(), pa.bool_(), pa.binary(), pa.bool_(), pa.int32()]
                schema = pa.schema([pa.field(name, kind) for (name, _), kind in zip(fields, kinds)])
                groups = _Groups(schema, TaskContext.get().partitionId(), hold)
            yield from trimmed(groups.feed(content, ids, row))
        if groups is not None:
            yield from trimmed(groups.close(True, True))

    def trimmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(batch.column("first")) if only_first else batch

    return ordered.mapInArrow(compare, T.StructType([T.StructField(name, kind) for name, kind in fields]))


def _joined(rows: DataFrame, size: Column) -> DataFrame:
    """``rows`` with what the parts of a group at the edges of ranges say together."""
    parts = rows.where("edge").groupBy(F.col("sha").alias("whole"))
    edges = parts.agg(size.alias("whole_size"), F.min("part").alias("whole_part"), F.min_by("keep_id", "part").alias("whole_id"))
    both = rows.join(F.broadcast(edges), F.col("edge") & (F.col("sha") == F.col("whole")), "left")
    return both.select(
        "id",
        "row",
        F.when(F.col("edge"), F.col("whole_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("whole_size")).otherwise(F.col("size")).alias("size"),
        (F.col("first") & (~F.col("edge") | (F.col("part") == F.col("whole_part")))).alias("kept"),
        "sha",
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hold: int = HOLD) -> DataFrame:
    """Every row's group of equal texts: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    ordered = _sorted(docs, F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.lit(0))
    rows = written(_compared(ordered, False, hold), "contents")
    return _joined(rows, F.count("*")).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("size").alias("group_size"), "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hold: int = HOLD) -> DataFrame:
    """The rows that stay, with all their columns."""
    columns = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]
    ordered = _sorted(docs, F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.struct(*columns))
    rows = written(_compared(ordered, True, hold), "contents")
    kept = _joined(rows, F.sum("size")).where("kept")
    return kept.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns)])
