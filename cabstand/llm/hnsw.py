"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard, results merged.

Equal vectors are one node of a graph; a node carries its smallest ids, as many as a result can ask for. Nodes are dealt to
shards of about ``shard_rows`` by a hash of the vector. Each shard builds its layers from the top down: nodes of a layer
enter in growing batches, each batch searches the graph so far with a beam, keeps diverse neighbours and is linked back.
A layer is stored as one flat array of neighbour numbers. Inner products become cosines by one more component that brings
all vectors of a shard to one length. Queries go in blocks to every shard; exact scores in double precision are
computed for what the beams found, and the best of all shards are merged per query.

Nulls and ties: vectors that are NULL, zero, or hold NULL or non-finite components, or whose id is NULL, take no part, and
neither do vectors of another length than the most frequent one; rows that repeat count once; equal scores are
ordered by id. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabstand.llm.common import mixed, stored

INDEX = (
    "shard int, n int, dim int, vectors binary, scaled binary, id_counts binary, ids binary, "
    "layer_sizes array<int>, nodes array<binary>, links array<binary>"
)


@dataclass(frozen=True)
class Graph:
    """Settings: links per node (twice as many in the lowest layer) and widths of the beams."""

    links: int = 16
    build_beam: int = 64
    search_beam: int = 160
    expand: int = 4
    seed: int = 5


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int, expand: int):
    """The ``beam`` best nodes that each query reaches: (numbers, similarities), best first, -1 where there are fewer.

    All queries step together; a step follows the links of the ``expand`` best nodes that a query hasn't followed yet.
    """
    rows = np.arange(len(queries))[:, None]
    seen = np.zeros((len(queries), len(points) + 1), dtype=bool)
    seen[:, -1] = True
    ids = np.full((len(queries), beam), -1, dtype=np.int32)
    sims = np.full((len(queries), beam), -np.inf, dtype=np.float32)
    done = np.ones((len(queries), beam), dtype=bool)
    width = min(entries.shape[1], beam)
    ids[:, :width] = entries[:, :width]
    known = ids[:, :width] >= 0
    sims[:, :width] = np.where(known, np.einsum("qed,qd->qe", points[ids[:, :width]], queries), -np.inf)
    done[:, :width] = ~known
    seen[rows, ids[:, :width]] = True
    active = np.arange(len(queries))
    while len(active):
        ready = np.where(done[active], -np.inf, sims[active])
        pick = np.argpartition(-ready, min(expand, beam - 1), axis=1)[:, :expand]
        usable = np.take_along_axis(ready, pick, 1) > -np.inf
        going = usable.any(axis=1)
        active, pick, usable = active[going], pick[going], usable[going]
        if not len(active):
            break
        at = active[:, None]
        done[at, pick] = True
        near = np.where(usable[:, :, None], links[ids[at, pick]], -1).reshape(len(active), -1)
        near[seen[at, near]] = -1
        # A node that two followed nodes share counts once.
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[at, near] = True
        new = np.einsum("qed,qd->qe", points[near], queries[active])
        new[near < 0] = -np.inf
        all_ids = np.concatenate([ids[active], near], axis=1)
        all_sims = np.concatenate([sims[active], new], axis=1)
        all_done = np.concatenate([done[active], near < 0], axis=1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        sims[active] = np.take_along_axis(all_sims, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    ids[sims == -np.inf] = -1
    return ids, sims


def _diverse(points: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the candidates of each row (best first): those nearer to the row than to one already
    taken, then the best of the rest."""
    near = points[ids]
    between = np.matmul(near, near.transpose(0, 2, 1))
    valid = ids >= 0
    taken = np.zeros(ids.shape, dtype=bool)
    count = np.zeros(len(ids), dtype=int)
    for i in range(ids.shape[1]):
        covered = (np.where(taken, between[:, i, :], -np.inf) > sims[:, i : i + 1]).any(axis=1)
        take = valid[:, i] & ~covered & (count < most)
        taken[:, i] = take
        count += take
    rank = np.where(taken, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.full((len(ids), most), -1, dtype=np.int32)
    chosen = np.take_along_axis(ids, order, 1)
    out[:, : chosen.shape[1]] = chosen
    return out


def _candidates(points: np.ndarray, rows: np.ndarray, ids: np.ndarray):
    """Candidates of each row without repeats and the row itself, best first."""
    ids = np.sort(np.where(ids == rows[:, None], -1, ids), axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    sims = np.einsum("qed,qd->qe", points[ids], points[rows])
    sims[ids < 0] = -np.inf
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _connect(points: np.ndarray, links: np.ndarray, rows: np.ndarray, found: np.ndarray) -> None:
    """Gives each row its neighbours and links these back; a full list keeps its diverse part."""
    most = links.shape[1]
    for at in range(0, len(rows), 512):
        part = rows[at : at + 512]
        links[part] = _diverse(points, *_candidates(points, part, found[at : at + 512]), most)
    targets, sources = links[rows].ravel(), np.repeat(rows, most)
    targets, sources = targets[targets >= 0], sources[targets >= 0]
    order = np.argsort(targets, kind="stable")
    targets, sources = targets[order], sources[order]
    nodes, starts, counts = np.unique(targets, return_index=True, return_counts=True)
    # Nodes by how many links they get, so that one with many doesn't widen the table of all others.
    for width in (2 ** np.arange(0, 32)).tolist():
        pick = (counts <= width) & (counts > width // 2)
        if not pick.any():
            continue
        for at in range(0, pick.sum(), max(1, 2**14 // (width + most))):
            some = np.flatnonzero(pick)[at : at + max(1, 2**14 // (width + most))]
            given = np.full((len(some), width), -1, dtype=np.int32)
            spread = np.arange(width)[None, :] < counts[some][:, None]
            given[spread] = sources[(starts[some][:, None] + np.arange(width))[spread]]
            ids, sims = _candidates(points, nodes[some], np.concatenate([links[nodes[some]], given], axis=1))
            keep = min(ids.shape[1], 4 * most)
            links[nodes[some]] = _diverse(points, ids[:, :keep], sims[:, :keep], most)


def levels(n: int, settings: Graph) -> np.ndarray:
    """The highest layer of each node; a node is in all layers below. Fixed by number and seed."""
    u = (mixed(np.arange(n, dtype=np.uint64) + np.uint64(settings.seed << 32)) >> np.uint64(11)).astype(float) / 2**53
    return np.floor(-np.log(np.maximum(u, 1e-18)) / math.log(settings.links)).astype(int)


def build_graph(points: np.ndarray, settings: Graph = Graph()) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the lowest: (nodes, links), links as numbers of nodes in all layers."""
    n = len(points)
    # One more row, so that a missing link (-1) points at zeros.
    points = np.concatenate([points, np.zeros((1, points.shape[1]), dtype=points.dtype)])
    level = levels(n, settings)
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    upper: list[np.ndarray] = []
    for layer in range(int(level.max(initial=0)), -1, -1):
        nodes = np.flatnonzero(level >= layer)
        # Nodes of the layers above come first, so that a descent always has a way in.
        nodes = nodes[np.argsort(-np.minimum(level[nodes], layer + 1), kind="stable")]
        links = np.full((n + 1, settings.links * (2 if layer == 0 else 1)), -1, dtype=np.int32)
        at = min(len(nodes), 2 * settings.links)
        first = nodes[:at]
        _connect(points, links, first, np.broadcast_to(first.astype(np.int32), (at, at)).copy())
        while at < len(nodes):
            batch = nodes[at : at + min(max(32, at // 3), 1024)]
            entries = descend(points, upper, points[batch], nodes[0])
            found, _ = _beam(points, links, points[batch], entries, min(settings.build_beam, at), settings.expand)
            among = points[batch] @ points[batch].T
            near = np.argpartition(-among, min(16, len(batch) - 1), axis=1)[:, :17]
            _connect(points, links, batch, np.concatenate([found, batch[near].astype(np.int32)], axis=1))
            at += len(batch)
        upper.append(links)
        layers.append((nodes, links[nodes]))
    return layers[::-1]


def descend(points: np.ndarray, upper: list[np.ndarray], queries: np.ndarray, start: int) -> np.ndarray:
    """Entry nodes for the layer below the ``upper`` ones (highest first)."""
    entries = np.full((len(queries), 1), start, dtype=np.int32)
    for links in upper:
        entries = _beam(points, links, queries, entries, 8, 2)[0][:, :2]
        entries = np.where(entries < 0, entries[:, :1], entries)
        entries[:, 1:][entries[:, 1:] == entries[:, :1]] = -1
    return entries


def _vectors(df: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    numbers = F.col("vector").cast("array<double>")
    sound = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    kept = df.select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("vector"))
    return kept.where(F.col("vec_id").isNotNull() & sound & F.exists(numbers, lambda x: x != 0)).distinct()


def build(vectors: DataFrame, most: int = 64, shard_rows: int = 8192, settings: Graph = Graph()) -> DataFrame:
    """One row per shard: its vectors, ids and flat neighbour arrays. ``most`` bounds the k of later searches."""
    rows = _vectors(vectors)
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    named = rows.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= most + 1)
    nodes = stored(named.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    usual = nodes.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim, n = (usual["dim"], usual["count"]) if usual else (0, 0)
    shards = max(1, -(-n // shard_rows))

    def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(pdf["vector"].tolist(), dtype=np.float64)
        order = np.lexsort(vectors.T[::-1])
        vectors, ids = vectors[order], [pdf["ids"].iloc[i] for i in order]
        norms = np.linalg.norm(vectors, axis=1)
        scaled = vectors / norms.max()
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        scaled = np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)
        layers = build_graph(scaled, settings)
        return pd.DataFrame(
            {
                "shard": [int(pdf["shard"].iloc[0])],
                "n": [len(vectors)],
                "dim": [vectors.shape[1]],
                "vectors": [vectors.tobytes()],
                "scaled": [scaled.tobytes()],
                "id_counts": [np.array([len(i) for i in ids], dtype=np.int32).tobytes()],
                "ids": [np.concatenate([np.asarray(i, dtype=np.int64) for i in ids]).tobytes()],
                "layer_sizes": [[len(nodes) for nodes, _ in layers]],
                "nodes": [[nodes.astype(np.int32).tobytes() for nodes, _ in layers]],
                "links": [[links.astype(np.int32).tobytes() for _, links in layers]],
            }
        )

    dealt = nodes.where(F.size("vector") == dim).withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(build_shard, INDEX))


def _search_shard(index: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, settings: Graph) -> tuple:
    n, dim = index["n"], index["dim"]
    vectors = np.frombuffer(index["vectors"], dtype=np.float64).reshape(n, dim)
    scaled = np.frombuffer(index["scaled"], dtype=np.float32).reshape(n, dim + 1)
    scaled = np.concatenate([scaled, np.zeros((1, dim + 1), dtype=np.float32)])
    counts = np.frombuffer(index["id_counts"], dtype=np.int32)
    starts = np.concatenate([[0], counts.cumsum()])
    ids = np.frombuffer(index["ids"], dtype=np.int64)
    layers = []
    for size, nodes, links in zip(index["layer_sizes"], index["nodes"], index["links"]):
        full = np.full((n + 1, len(links) // 4 // size), -1, dtype=np.int32)
        full[np.frombuffer(nodes, dtype=np.int32)] = np.frombuffer(links, dtype=np.int32).reshape(size, -1)
        layers.append(full)
    top = np.frombuffer(index["nodes"][0], dtype=np.int32)[0]
    out_query, out_id, out_score = [], [], []
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    unit = np.concatenate([unit, np.zeros((len(unit), 1))], axis=1).astype(np.float32)
    beam = min(n, max(settings.search_beam, 2 * k))
    for at in range(0, len(queries), 512):
        some = unit[at : at + 512]
        entries = descend(scaled, layers[:0:-1], some, int(top))
        found, _ = _beam(scaled, layers[0], some, entries, beam, settings.expand)
        for row, nodes in enumerate(found):
            nodes = nodes[nodes >= 0]
            scores = (vectors[nodes] * queries[at + row]).sum(axis=1)
            best = np.argsort(-scores, kind="stable")[: k + 1]
            # Nodes as good as the last one stay, for ties go by id.
            best = np.flatnonzero(scores >= scores[best[-1]])
            each = counts[nodes[best]]
            members = np.concatenate([ids[starts[v] : starts[v + 1]] for v in nodes[best]])
            values = np.repeat(scores[best], each)
            other = members != query_ids[at + row]
            members, values = members[other], values[other]
            order = np.lexsort((members, -values))[:k]
            out_query.append(np.full(len(order), query_ids[at + row]))
            out_id.append(members[order])
            out_score.append(values[order])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, dtype=kind)
    return join(out_query, np.int64), join(out_id, np.int64), join(out_score, np.float64)


def search(index: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = 4096, settings: Graph = Graph()) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each query, its own row left out.

    ``k`` may be at most the ``most`` of the index.
    """
    rows = _vectors(queries)
    shape = index.agg(F.max("dim").alias("dim"), F.max("shard").alias("last")).first()
    dim, last = (shape["dim"] or 0), (shape["last"] or 0)
    rows = rows.where(F.size("vector") == dim)
    blocks = max(1, -(-rows.count() // block_rows))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        return pd.DataFrame(
            {
                "query_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                "queries": [np.array(pdf["vector"].tolist(), dtype=np.float64).tobytes()],
            }
        )

    grouped = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy("block")
    packed = stored(grouped.applyInPandas(gather, "query_ids binary, queries binary"))
    asked = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ids = np.frombuffer(one["query_ids"], dtype=np.int64)
                vectors = np.frombuffer(one["queries"], dtype=np.float64).reshape(len(ids), -1)
                columns = _search_shard(one, ids, vectors, k, settings)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    found = index.join(asked, "shard").mapInArrow(find, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
