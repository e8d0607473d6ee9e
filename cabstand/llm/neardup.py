"""Near-duplicate documents by DartMinHash over weighted five-word shingles.

The weight of a shingle is how often a text has it. Darts fall on the plane of (weight, rank) of every shingle as a Poisson
process that the shingle's hash fixes; those below the shingle's weight hit. A dart belongs to one of ``size``
coordinates, and the earliest hit of each coordinate makes the signature; two texts agree in a coordinate with the
probability of their weighted similarity. Only darts up to a rank are thrown that leaves few coordinates empty; for texts where
one stays empty the rank is doubled. A unit of weight throws its darts one after another, so most shingles of a
long text throw none.

Texts that agree in a band of coordinates are candidates. Equal texts are one node. In a band's bucket each node is first
compared with the bucket's centre: the node whose own buckets are the most crowded, which in a family of near copies is the one
that the others were made from. Where that leaves nodes of several classes in a bucket, its largest class is set against the others
and those among each other, in tiles of a bounded number of nodes that hold the shingles themselves; a tile gives back at most one
link per node and joins what it has found as it goes, so no pairs are written out. A pair of a bucket is thus either compared or
in one class already. Similarity is always computed exactly, from all shingles; candidates of the first step whose signatures agree
too little are set aside. Classes are the connected components of the links.

Nulls and ties: texts without a word, NULL among them, are alike to nothing and are classes of their own; texts of fewer than
five words count as one shingle; a class is named by its smallest id; an id that stands for several texts is in the class of each,
row by row; rows with a NULL id have a NULL class and take no part. :func:`near_duplicates` ignores other columns,
:func:`deduplicated` passes them through, whatever their names; it treats rows that repeat an id and a text as one document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstand.llm.common import STEP, components, mixed, shingles, slices, stored, utf8

SIZE, BANDS = 100, 20
#: Nodes on each side of a tile.
TILE = 256


def counted(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight) of the distinct shingles of each row."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return rows[at], values[at], np.diff(np.append(at, len(rows)))


def cells(rows: np.ndarray, values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, share) of the units of weight of each element; the last unit may be a fraction."""
    whole = np.ceil(weights).astype(np.int64)
    which = np.repeat(np.arange(len(rows)), whole)
    unit = np.arange(len(which)) - np.repeat(whole.cumsum() - whole, whole)
    return rows[which], mixed(values[which] + unit.astype(np.uint64) * np.uint64(STEP)), np.minimum(1.0, weights[which] - unit)


def uniform(values: np.ndarray) -> np.ndarray:
    return (mixed(values) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(n: int, rows: np.ndarray, units: np.ndarray, shares: np.ndarray, size: int = SIZE) -> np.ndarray:
    """[n, size] earliest darts; rows without units stay zero."""
    out = np.zeros((n, size), dtype=np.uint64)
    weight = np.bincount(rows, weights=shares, minlength=n)
    reach = (size * math.log(size) + 2 * size) / np.maximum(weight, 1e-9)
    pending = weight > 0
    while pending.any():
        held = pending[rows]
        r, u, share, rank = rows[held], units[held], shares[held], np.zeros(held.sum())
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        throw = 0
        while len(r):
            throw += 1
            dart = mixed(u + np.uint64((2 * throw * STEP) & (2**64 - 1)))
            rank = rank - np.log1p(-uniform(dart))
            near = rank <= reach[r]
            r, u, share, rank, dart = r[near], u[near], share[near], rank[near], dart[near]
            hit = uniform(dart + np.uint64(1)) <= share
            coordinate = (mixed(dart + np.uint64(2)) % np.uint64(size)).astype(np.int64)
            found.append((r[hit] * size + coordinate[hit], rank[hit], dart[hit]))
        slot, rank, dart = (np.concatenate(part) for part in zip(*found))
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), dtype=bool)
        first[1:] = slot[1:] != slot[:-1]
        filled = np.bincount(slot[first] // size, minlength=n) == size
        good = first & filled[slot // size]
        out.reshape(-1)[slot[good]] = dart[good]
        pending &= ~filled
        reach[pending] *= 2
    return out


def bands(signature: np.ndarray, count: int = BANDS) -> np.ndarray:
    """[n, count] one hash per band."""
    n, size = signature.shape
    parts = signature.reshape(n, count, size // count)
    out = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(STEP), (n, count)).copy()
    for k in range(parts.shape[2]):
        out = mixed(out ^ parts[:, :, k]) * np.uint64(STEP)
    return out


def signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node_id, key, bands, sketch) of every row: a key for the text and a byte per coordinate, NULL without a word."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in slices(batch.column(2)):
                n = len(offsets) - 1
                rows, values, _ = shingles(data, offsets)
                signature = signatures(n, *cells(*counted(rows, values)))
                some = np.bincount(rows, minlength=n) > 0
                hashes = bands(signature[some]).view(np.int64)
                sketch = (signature & np.uint64(255)).astype(np.uint8)
                ends = np.concatenate([[0], some.cumsum()]).astype(np.int32) * BANDS
                keys = batch.column(1).slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        pa.array([key.as_py() if has else None for key, has in zip(keys, some.tolist())], pa.binary()),
                        pa.ListArray.from_arrays(ends, hashes.ravel()),
                        pa.array([row.tobytes() if has else None for row, has in zip(sketch, some.tolist())], pa.binary()),
                    ],
                    ["node_id", "key", "bands", "sketch"],
                )

    body = utf8(F.col(f"`{text}`").cast("string"))
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("node_id"), F.unhex(F.md5(body)).alias("key"), body.alias("body"))
    return chosen.mapInArrow(sign, "node_id long, key binary, bands array<long>, sketch binary")


def nodes_of(rows: DataFrame) -> DataFrame:
    """(node, key, least_id, bands, sketch): one node per text. Its number is a hash of the key; should two keys
    share a hash, the later one gets another."""
    texts = rows.where(F.col("key").isNotNull() & F.col("node_id").isNotNull()).groupBy("key").agg(
        F.min("node_id").alias("least_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    number = F.xxhash64("key")
    place = F.row_number().over(Window.partitionBy(number).orderBy("key"))
    return texts.withColumn("place", place).select(
        F.when(F.col("place") == 1, number).otherwise(F.xxhash64("key", "place")).alias("node"), "key", "least_id", "bands", "sketch"
    )


def candidates(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes that share a band with its centre, a > b."""
    spread = nodes.select("node", F.explode("bands").alias("band"))
    sizes = spread.groupBy(F.col("band").alias("w_band")).agg(F.count("*").alias("size")).where(F.col("size") > 1)
    crowded = spread.join(sizes, F.col("band") == F.col("w_band")).select("node", "band", "size")
    crowd = crowded.groupBy(F.col("node").alias("c_node")).agg(F.sum("size").alias("crowd"))
    ranked = crowded.join(crowd, F.col("node") == F.col("c_node")).select("node", "band", "crowd")
    centres = ranked.groupBy(F.col("band").alias("b_band")).agg(F.max_by("node", F.struct("crowd", -F.col("node"))).alias("centre"))
    met = crowded.join(centres, F.col("band") == F.col("b_band")).where(F.col("node") != F.col("centre"))
    return met.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct()


def agreement(left: str, right: str):
    """How many bytes of two sketches agree, counted on the executors' Python side in whole batches."""

    @F.pandas_udf("int")
    def agree(a, b):
        import pandas as pd

        one, two = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(-1, SIZE) for s in (a, b))
        return pd.Series((one == two).sum(axis=1))

    return agree(F.col(left), F.col(right))


def _shingle_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(end, body) to (end, items): the sorted hashes of a text's weighted shingles."""
    for batch in batches:
        out: list[bytes] = []
        for _, data, offsets in slices(batch.column(1)):
            rows, values, _ = shingles(data, offsets)
            rows, units, _ = cells(*counted(rows, values))
            order = np.lexsort((units, rows))
            starts = np.searchsorted(rows[order], np.arange(len(offsets)))
            units = units[order]
            out += [units[a:b].tobytes() for a, b in zip(starts, starts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["end", "items"])


#: Rows of texts to be fetched up to which their keys are broadcast; beyond, texts are shuffled to them.
FETCHED = 500_000


def shingle_sets(docs: DataFrame, nodes: DataFrame, ends: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(end, items) of the named nodes; ``ends`` has a column ``end`` without repeats."""
    wanted = stored(ends.join(nodes, F.col("end") == F.col("node")).select("end", F.col("least_id").alias("end_id"), F.col("key").alias("end_key")))
    if wanted.count() <= FETCHED:
        wanted = F.broadcast(wanted)
    body = utf8(F.col(f"`{text}`").cast("string"))
    bodies = docs.select(F.col(f"`{doc_id}`").cast("long").alias("body_id"), body.alias("body")).withColumn("body_key", F.unhex(F.md5("body")))
    named = bodies.join(wanted, (F.col("body_id") == F.col("end_id")) & (F.col("body_key") == F.col("end_key")))
    return named.select("end", "body").mapInArrow(_shingle_sets, "end long, items binary")


def enough(one: np.ndarray, two: np.ndarray, threshold: float) -> bool:
    """Whether two sorted sets reach the similarity."""
    if min(len(one), len(two)) < threshold * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common >= threshold * (len(one) + len(two) - common)


def open_rows(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, node, label, main) of the buckets whose nodes are in several classes; ``main`` marks the largest class."""
    labelled = nodes.join(classes, F.col("node") == F.col("c_node"), "left").select("node", F.coalesce("class", "node").alias("label"), "bands")
    spread = labelled.select("node", "label", F.explode("bands").alias("band"))
    sizes = spread.groupBy("band", "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy(F.col("band").alias("o_band")).agg(
        F.count("*").alias("several"), F.max_by("label", F.struct("n", -F.col("label"))).alias("largest"),
        F.sum("n").alias("all"), F.max("n").alias("most"),
    ).where(F.col("several") > 1)
    met = spread.join(open_, F.col("band") == F.col("o_band"))
    return met.select("band", "node", "label", (F.col("label") == F.col("largest")).alias("main"), "most", (F.col("all") - F.col("most")).alias("others"))


TILED = "band long, row_tile int, column_tile int, side int, node long, label long, items binary"


def crossing(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links between nodes of different classes of a bucket, at least enough of them to connect what belongs together.

    Nodes outside the largest class of a bucket are dealt over tiles of about ``TILE``; each tile meets every other
    tile of such nodes and every tile of the largest class once. Only nodes outside it are copied as often as there are tiles of
    it, and the other way round.
    """
    tiles = lambda n: F.ceil(F.col(n) / TILE).cast("int")
    own = F.when(F.col("main"), F.pmod(F.xxhash64("node"), tiles("most"))).otherwise(F.pmod(F.xxhash64("node"), tiles("others")))
    held = rows.join(sets, F.col("node") == F.col("end")).withColumn("own", own.cast("int"))
    spread = lambda n: F.sequence(F.lit(0), tiles(n) - 1)
    # Side 0 are nodes outside the largest class, side 1 are nodes of it, at tiles numbered below zero.
    meeting = F.when(
        F.col("main"),
        F.transform(spread("others"), lambda j: F.struct(j.alias("r"), (-F.col("own") - 1).alias("c"), F.lit(1).alias("s"))),
    ).otherwise(
        F.concat(
            F.transform(spread("others"), lambda j: F.struct(F.greatest(j, F.col("own")).alias("r"), F.least(j, F.col("own")).alias("c"), F.lit(0).alias("s"))),
            F.transform(spread("most"), lambda j: F.struct(F.col("own").alias("r"), (-j - 1).alias("c"), F.lit(0).alias("s"))),
        )
    )
    dealt = held.select("band", F.explode(meeting).alias("at"), "node", "label", "items")
    dealt = dealt.select("band", F.col("at.r").alias("row_tile"), F.col("at.c").alias("column_tile"), F.col("at.s").alias("side"), "node", "label", "items")

    def compare(tile: pa.Table) -> pa.Table:
        side, node, label = (tile.column(name).to_numpy() for name in ("side", "node", "label"))
        items = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for chunk in tile.column("items").chunks for x in chunk]
        sizes = np.array([len(x) for x in items])
        starts = np.concatenate([[0], sizes.cumsum()[:-1]])
        known, codes = np.unique(np.concatenate(items), return_inverse=True)
        root = {int(x): int(x) for x in label}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        found, mark = [], np.zeros(len(known), dtype=bool)
        for i in np.flatnonzero(side == 0).tolist():
            own = codes[starts[i] : starts[i] + sizes[i]]
            mark[own] = True
            common = np.add.reduceat(mark[codes], starts, dtype=np.int64)
            mark[own] = False
            near = common >= threshold * (sizes[i] + sizes - common)
            for j in np.flatnonzero(near).tolist():
                one, two = find(int(label[i])), find(int(label[j]))
                if one != two:
                    root[max(one, two)] = min(one, two)
                    found.append((int(node[i]), int(node[j])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("band", "row_tile", "column_tile").applyInArrow(compare, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose weighted similarity reaches the threshold, computed from all shingles of both texts."""
    first = sets.select(F.col("end").alias("end_a"), F.col("items").alias("items_a"))
    second = sets.select(F.col("end").alias("end_b"), F.col("items").alias("items_b"))
    both = pairs.join(first, F.col("a") == F.col("end_a")).join(second, F.col("b") == F.col("end_b"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = ((np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(k)) for k in (2, 3))
            keep = [enough(one, two, threshold) for one, two in zip(*sides)]
            some = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1)], ["a", "b"])

    return both.select("a", "b", "items_a", "items_b").mapInArrow(compare, "a long, b long")


def _classes(docs: DataFrame, rows: DataFrame, threshold: float, doc_id: str, text: str) -> DataFrame:
    """(key, class_id, n_texts, kept_key): the class of every text, its smallest id, its size and the text that stands for it."""
    nodes = stored(nodes_of(rows))
    sketches = nodes.select(F.col("node").alias("s_node"), "sketch")
    pairs = (
        candidates(nodes)
        .join(sketches.withColumnsRenamed({"s_node": "node_a", "sketch": "sketch_a"}), F.col("a") == F.col("node_a"))
        .join(sketches.withColumnsRenamed({"s_node": "node_b", "sketch": "sketch_b"}), F.col("b") == F.col("node_b"))
    )
    # Five standard deviations below the threshold: no pair that reaches it is set aside.
    least = int(SIZE * threshold - 5 * math.sqrt(SIZE * threshold * (1 - threshold)))
    pairs = stored(pairs.where(agreement("sketch_a", "sketch_b") >= least).select("a", "b").distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct()
    links = stored(verified(pairs, shingle_sets(docs, nodes, ends, doc_id, text), threshold))
    met = components(links).select(F.col("node").alias("c_node"), "class")
    left = stored(open_rows(nodes, met))
    rest = crossing(left, shingle_sets(docs, nodes, left.select(F.col("node").alias("end")).distinct(), doc_id, text), threshold)
    edges = met.select(F.col("c_node").alias("a"), F.col("class").alias("b")).unionByName(rest)
    classes = components(edges).select(F.col("node").alias("c_node"), "class")
    labelled = nodes.join(classes, F.col("node") == F.col("c_node"), "left").select("key", "least_id", F.coalesce("class", "node").alias("label"))
    of_label = labelled.groupBy(F.col("label").alias("o_label")).agg(
        F.min(F.struct("least_id", "key")).alias("first"), F.count("*").alias("n_texts")
    )
    return labelled.join(of_label, F.col("label") == F.col("o_label")).select(
        F.col("key").alias("k_key"), F.col("first.least_id").alias("class_id"), "n_texts", F.col("first.key").alias("kept_key")
    )


def near_duplicates(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_texts) for every row of ``docs``; ``n_texts`` counts the different texts of the class."""
    rows = stored(signed(docs, doc_id, text))
    classes = _classes(docs, rows, threshold, doc_id, text)
    named = F.when(F.col("node_id").isNotNull(), F.col("key"))
    return rows.join(classes, named == F.col("k_key"), "left").select(
        F.col("node_id").alias(doc_id),
        F.coalesce("class_id", "node_id").alias("class_id"),
        F.when(F.col("node_id").isNotNull(), F.coalesce("n_texts", F.lit(1))).cast("long").alias("n_texts"),
    )


def deduplicated(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that with the smallest id. Rows without an id stay."""
    rows = stored(signed(docs, doc_id, text))
    classes = _classes(docs, rows, threshold, doc_id, text)
    own = rows.select("node_id", "key").where(F.col("node_id").isNotNull() & F.col("key").isNotNull()).distinct()
    met = own.join(classes, F.col("key") == F.col("k_key"))
    gone = met.where((F.col("node_id") != F.col("class_id")) | (F.col("key") != F.col("kept_key"))).select(
        F.col("node_id").alias("gone_id"), F.col("key").alias("gone_key")
    )
    columns = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]
    body = utf8(F.col(f"`{text}`").cast("string"))
    whole = docs.select(F.col(f"`{doc_id}`").cast("long").alias("row_id"), F.unhex(F.md5(body)).alias("row_key"), F.struct(*columns).alias("row"))
    placed = whole.where(F.col("row_id").isNotNull())
    left = placed.join(gone, (F.col("row_id") == F.col("gone_id")) & (F.col("row_key") == F.col("gone_key")), "left_anti")
    again = F.row_number().over(Window.partitionBy("row_id", "row_key").orderBy("row_id"))
    once = left.withColumn("again", again).where(F.col("again") == 1).drop("again")
    kept = once.unionByName(whole.where(F.col("row_id").isNull()))
    return kept.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(docs.columns)])
