"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgstream.scratch import stored

LEAF = 64
# Below any score; its negative is a number as well.
NONE = -(2**62)
# Vectors a tree holds, and queries that are searched together in it.
SHARD_ROWS = 32_768
QUERY_ROWS = 16_384

# Stands for a missing id on the way through pandas, which would read ids beside a NULL as floating point.
NO_ID = 2**63 - 1

HITS = "query_row long, query_id long, row long, vec_id long, known boolean, score long"


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, row, vector``: components as floor(scale * x), of rows whose components are all finite."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    usable = F.col("embedding").isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    rows = vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))
    return rows.withColumn("row", F.monotonically_increasing_id())


class BallTree:
    """Nodes over slices of the reordered vectors, each with its centre and radius."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.spans, self.children = [], []
        self._split(vectors.astype(np.float64), 0, len(vectors), leaf)
        self.vectors = vectors[self.order]
        self.floats = self.vectors.astype(np.float64)
        self.centres = np.array([self.floats[a:b].mean(axis=0) for a, b in self.spans])
        self.radii = np.array(
            [np.sqrt(((self.floats[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(self.spans, self.centres, strict=True)]
        )

    def _split(self, floats: np.ndarray, start: int, end: int, leaf: int) -> None:
        """Halves at the median along the axis of widest spread; equal vectors are halved as well."""
        waiting = [(start, end, -1, 0)]
        while waiting:
            a, b, parent, side = waiting.pop()
            node = len(self.spans)
            self.spans.append((a, b))
            self.children.append([-1, -1])
            if parent >= 0:
                self.children[parent][side] = node
            if b - a > leaf:
                part = floats[self.order[a:b]]
                axis = int((part.max(axis=0) - part.min(axis=0)).argmax())
                middle = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], middle)]
                waiting += [(a, a + middle, node, 0), (a + middle, b, node, 1)]

    def bounds(self, queries: np.ndarray, node: int) -> np.ndarray:
        """No vector in the node scores higher; a little is added for rounding in floating point."""
        length = np.sqrt((queries**2).sum(axis=1))
        upper = queries @ self.centres[node] + length * self.radii[node]
        return upper + 1e-6 * (1 + np.abs(upper) + length)


class Best:
    """The k best hits of each query so far, best first; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), NONE)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.rows = np.full((queries, k), -1)

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        all_scores = np.hstack([self.scores[which], scores])
        all_ids = np.hstack([self.ids[which], np.broadcast_to(ids, scores.shape)])
        all_rows = np.hstack([self.rows[which], np.broadcast_to(rows, scores.shape)])
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[which] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[which] = np.take_along_axis(all_ids, order, axis=1)
        self.rows[which] = np.take_along_axis(all_rows, order, axis=1)

    @property
    def kth(self) -> np.ndarray:
        return self.scores[:, -1]


def search(
    tree: BallTree, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray,
    leaves: int | None = None,
) -> Best:
    """Branch and bound for many queries at once.

    The open nodes are visited in order of their highest upper bound. A query follows a node only while its
    bound reaches the query's kth score, the better of its own so far and ``floor``, what other shards have
    found. ``leaves`` ends the search early after so many leaves, for a first floor. Scores are exact integers.
    """
    import heapq

    floats, best = queries.astype(np.float64), Best(len(queries), k)
    start = tree.bounds(floats, 0)
    open_nodes = [(-start.max(), 0, np.arange(len(queries)), start)] if len(queries) else []
    while open_nodes and leaves != 0:
        _, node, which, upper = heapq.heappop(open_nodes)
        alive = upper >= np.maximum(best.kth, floor)[which]
        which = which[alive]
        if not len(which):
            continue
        a, b = tree.spans[node]
        if tree.children[node][0] < 0:
            scores = queries[which] @ tree.vectors[a:b].T
            at = tree.order[a:b]
            scores[own[which][:, None] == rows[at][None, :]] = NONE
            best.offer(which, scores, ids[at], rows[at])
            leaves = None if leaves is None else leaves - 1
        else:
            for child in tree.children[node]:
                upper = tree.bounds(floats[which], child)
                heapq.heappush(open_nodes, (-upper.max(), child, which, upper))
    return best


def top_k(
    vectors: DataFrame, k: int = 10, query_every: int = 100, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each query, the rows with ``vec_id`` divisible
    by ``query_every``. The result is exact.

    Vectors are dealt over shards of about ``shard_rows`` rows whatever their ids, and every query goes to
    every shard, in blocks of at most ``query_rows``. In the first round a shard searches only the few leaves
    of best bound; the kth best score over all shards is then shared with the second round, in which each
    shard searches its tree with that score as the bound to beat. A (shard, block) group is bounded; what
    leaves it is at most k rows a query.

    Vectors that are NULL or hold a NULL or non-finite component take no part, nor does a NULL ``vec_id`` as a
    query; as a candidate it comes after equal scores with an id. A row is a candidate for all queries but
    itself: rows that repeat a ``vec_id`` are candidates for each other and queries of their own. Vectors of
    another length than the query's are no candidates. Empty vectors score 0 against each other. Fewer rows
    than k give all of them; no rows give none. Extra columns are not read. Components so large that a score could
    pass 62 bits are an error.
    """
    numbered = quantized(vectors).withColumns({"dims": F.size("vector"), "known": F.col("vec_id").isNotNull()})
    rows = stored(numbered.withColumn("vec_id", F.coalesce("vec_id", F.lit(NO_ID))), "topk-vectors")
    is_query = F.col("known") & (F.col("vec_id") % query_every == 0)
    size = F.array_max(F.transform("vector", lambda v: F.abs(v.cast("double"))))
    n, asked, largest = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.col("dims") * size * size)).first()
    if largest is not None and largest >= -NONE:
        raise ValueError("components are too large for scores of 62 bits")
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-(asked or 0) // query_rows))
    place = F.xxhash64("row")
    candidates = rows.select(
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "dims", "row", "vec_id", "known", "vector",
    )
    queries = stored(rows.where(is_query), "topk-queries").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("row", F.lit(7)), F.lit(blocks)).cast("int").alias("block"),
        "dims", "row", "vec_id", "vector",
    )

    def hits(first: bool):
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                names = [field.split()[0] for field in HITS.split(", ")]
                return pd.DataFrame({name: [] for name in names}, dtype="int64").astype({"known": bool})
            dims = int(left["dims"].iloc[0])
            matrix = lambda x: np.array(x.tolist(), np.int64).reshape(len(x), dims)
            ids, nameless = left["vec_id"].to_numpy(), left["row"][~left["known"]].to_numpy()
            own = right["row"].to_numpy()
            floor = np.full(len(right), NONE) if first else right["floor"].to_numpy(np.int64)
            tree = BallTree(matrix(left["vector"]))
            best = search(
                tree, ids, left["row"].to_numpy(), matrix(right["vector"]), own, k, floor, leaves=4 if first else None
            )
            q, j = np.nonzero((best.rows >= 0) & (best.scores > NONE))
            return pd.DataFrame(
                {
                    "query_row": own[q],
                    "query_id": right["vec_id"].to_numpy(np.int64)[q],
                    "row": best.rows[q, j],
                    "vec_id": best.ids[q, j],
                    "known": ~np.isin(best.rows[q, j], nameless),
                    "score": best.scores[q, j],
                }
            )

        return run

    def best_of(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_row").orderBy(
            F.desc("score"), F.desc("known"), F.col("vec_id"), F.col("row")
        )
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    keys = ["shard", "block", "dims"]

    def searched(asked: DataFrame, first: bool) -> DataFrame:
        return candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(hits(first), HITS)

    if shards > 1:
        kth = best_of(searched(queries, True)).where(F.col("rank") == k)
        kth = stored(kth.select(F.col("query_row").alias("row"), F.col("score").alias("floor")), "topk-floors")
        queries = queries.join(kth, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    else:
        queries = queries.withColumn("floor", F.lit(NONE))
    vec_id = F.when(F.col("known"), F.col("vec_id")).alias("vec_id")
    return best_of(searched(queries, False)).select("query_id", F.col("rank").cast("int"), vec_id, "score")
