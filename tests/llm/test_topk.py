import numpy as np
import pytest

from msgstream.llm import registry, topk
from msgstream.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows, every, k=10):
    """Best rows of each query among rows of its length; every row but the query's own."""
    usable = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            usable.append((vec_id, [int(np.floor(float(np.float32(x)) * 1024)) for x in vector]))
    result = []
    for q, (query_id, query) in enumerate(usable):
        if query_id is None or query_id % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(query, v, strict=True)), vec_id is None, vec_id or 0, vec_id)
            for i, (vec_id, v) in enumerate(usable)
            if i != q and len(v) == len(query)
        ]
        result += [(query_id, rank, vec_id, -s) for rank, (s, _, _, vec_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(result, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding").collect()]
    assert found(registry.op5_ball_tree_top_k(spark, SF)) == brute(rows, 100)


@pytest.mark.parametrize("shard_rows, query_rows", [(1000, 1000), (37, 5)])
def test_odd_rows_in_any_number_of_shards(spark, shard_rows, query_rows):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(200)]
    rows += [(200, [0.5] * 6)] * 20 + [(7, None), (10, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (20, [float("nan")] * 6)]
    rows += [(30, [float("inf")] * 6), (None, [0.5] * 6), (40, [1.0, 2.0]), (50, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, row string")
    assert found(topk.top_k(df, query_every=10, shard_rows=shard_rows, query_rows=query_rows)) == brute(rows, 10)


def test_large_ids_beside_a_missing_one(spark):
    """Ids that floating point cannot hold."""
    rows = [(2**53 + 1 + i, [float(i % 7), 1.0]) for i in range(60)] + [(None, [6.0, 1.0])] * 2 + [(-(2**63), [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(topk.top_k(df, query_every=5)) == brute(rows, 5)
    assert found(topk.top_k(df, query_every=5, shard_rows=20, query_rows=4)) == brute(rows, 5)


def test_scores_that_would_not_fit(spark):
    schema = "vec_id long, embedding array<float>"
    with pytest.raises(ValueError, match="62 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e14]), (1, [1.0])], schema))
    assert found(topk.top_k(spark.createDataFrame([(0, [1e6]), (1, [1.0])], schema))) == [(0, 1, 1, 1024 * 1024 * 10**6)]


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    assert found(topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [1.0])], schema))) == [(0, 1, 1, 1024 * 1024)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(2000, 8)) * 1000).astype(np.int64)
    tree = topk.BallTree(vectors)
    for node in range(0, len(tree.spans), 7):
        a, b = tree.spans[node]
        query = rng.normal(size=(1, 8)) * 1000
        assert (query @ tree.floats[a:b].T).max() <= tree.bounds(query, node)[0]
