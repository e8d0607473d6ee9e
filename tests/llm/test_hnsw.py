import numpy as np

from cabstand.llm import hnsw
from cabstand.llm.queries import QUERIES

SCHEMA = "vec_id long, vector array<float>, extra string"


def exact(ids, vectors, query, k):
    scores = (vectors * vectors[query]).sum(axis=1)
    scores[ids == ids[query]] = -np.inf
    order = np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]
    return list(zip(ids[order].tolist(), scores[order].tolist()))


def test_recall_over_shards_and_lengths(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1))).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    index = hnsw.build(df, shard_rows=400)
    assert index.count() >= 3
    got = hnsw.search(index, df.where("vec_id % 20 = 0"), k=20, block_rows=30).collect()
    ids, wide, hits = np.arange(1500), vectors.astype(np.float64), 0
    for q in range(0, 1500, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        for r in mine:
            assert abs(r.score - float((wide[q] * wide[r.vec_id]).sum())) < 1e-12
        hits += len({r.vec_id for r in mine} & {i for i, _ in exact(ids, wide, q, 20)})
    assert hits / (75 * 20) >= 0.98


def test_odd_vectors_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0], "x") for i in range(0, 60)]
    rows += [(100, [0.0, 0.0], "x"), (101, None, "x"), (102, [1.0, None], "x"), (103, [float("nan"), 1.0], "x")]
    rows += [(104, [float("inf"), 1.0], "x"), (105, [1.0, 2.0, 3.0], "x"), (None, [1.0, 1.0], "x"), (7, [1.0, 0.0], "x")]
    rows += [(200, [2.0, 1.0], "x"), (220, [0.5, 0.5], "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hnsw.search(hnsw.build(df, most=5), df, k=5).collect()
    of = lambda q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
    assert of(59) == [200, 0, 1, 2, 3] and of(0) == [200, 1, 2, 3, 4] and of(200) == [0, 1, 2, 3, 4]
    assert {r.query_id for r in got} == {*range(60), 200, 220}


def test_few_and_none(spark):
    one = spark.createDataFrame([(1, [1.0], "x"), (2, [3.0], "x")], SCHEMA)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in hnsw.search(hnsw.build(one), one).collect()] in (
        [(1, 1, 2, 3.0), (2, 1, 1, 3.0)],
        [(2, 1, 1, 3.0), (1, 1, 2, 3.0)],
    )
    none = spark.createDataFrame([], SCHEMA)
    assert hnsw.search(hnsw.build(none), none).count() == 0


def test_query_recall(spark, sf):
    got = QUERIES["op10_nearest_neighbours"](spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want = {i for i, _ in exact(ids, vectors, q, 20)}
        hits += len(want & {r.vec_id for r in got if r.query_id == ids[q]})
        total += len(want)
    assert hits / total >= 0.95
