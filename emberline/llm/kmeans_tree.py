"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (`SAMPLE_ROWS`, by a digest of the id) and has a bounded number of leaves;
every row is assigned to a leaf. A query walks the tree with a priority queue of bins by the distance to their
centres and so gets an order of all leaves. Calibration compares some queries with every row, and doubles the
number of leaves to visit until these queries find `recall` of their true neighbours. Queries then meet
the rows of their leaves; distances are computed in double precision on the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import stored
from emberline.llm.hnsw_dedup import usable

SAMPLE_ROWS = 10_000
LEAF_SAMPLE = 40  # sampled rows below which a node is not split again
BRANCHES = 8
CALIBRATION_QUERIES = 48
ROWS_PER_PART = 4_000
QUERIES_PER_PART = 1_000


class Tree:
    """Nodes with their centres; `children` is empty for a leaf, and `leaf` numbers the leaves."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        self.centres, self.children, self.leaf = [np.zeros(sample.shape[1])], [[]], [-1]
        self.leaves = 0
        self._split(0, sample, np.random.default_rng(seed))

    def _split(self, node: int, rows: np.ndarray, draw) -> None:
        if len(rows) >= 2 * LEAF_SAMPLE:
            centres = rows[draw.choice(len(rows), BRANCHES, replace=False)]
            for _ in range(8):
                near = ((centres**2).sum(1)[None] - 2 * rows @ centres.T).argmin(1)
                centres = np.stack([rows[near == c].mean(0) if (near == c).any() else centres[c] for c in range(BRANCHES)])
            near = ((centres**2).sum(1)[None] - 2 * rows @ centres.T).argmin(1)
            kept = [c for c in range(BRANCHES) if (near == c).any()]
            if len(kept) > 1:
                for c in kept:
                    self.centres.append(centres[c])
                    self.children.append([])
                    self.leaf.append(-1)
                    self.children[node].append(len(self.centres) - 1)
                for child, c in zip(list(self.children[node]), kept, strict=True):
                    self._split(child, rows[near == c], draw)
                return
        self.leaf[node] = self.leaves
        self.leaves += 1

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf each row falls into, going to the nearest centre at every level."""
        out, work = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while work:
            node, some = work.pop()
            if not len(some):
                continue
            if not self.children[node]:
                out[some] = self.leaf[node]
                continue
            centres = np.stack([self.centres[c] for c in self.children[node]])
            near = ((centres**2).sum(1)[None] - 2 * rows[some] @ centres.T).argmin(1)
            work += [(c, some[near == i]) for i, c in enumerate(self.children[node])]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, the most promising first: the nearest open bin is taken from a priority queue and opened."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                centres = np.stack([self.centres[c] for c in self.children[node]])
                gaps = ((centres - query) ** 2).sum(1)
                best = int(gaps.argmin())
                for i, c in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (float(gaps[i]), c))
                node = self.children[node][best]
            yield self.leaf[node]


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    gap = rows - query
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def smallest(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, k - 1)[k - 1]
        some = np.flatnonzero(scores <= limit)
        return some[np.lexsort((ids[some], scores[some]))][:k]
    return np.lexsort((ids, scores))[:k]


def calibrate(tree: Tree, rows: DataFrame, queries: pd.DataFrame, k: int, recall: float) -> int:
    """Leaves to visit so that the given queries find `recall` of their true neighbours; all rows are compared with them."""
    ids = queries["vec_id"].to_numpy(np.int64)
    vectors = np.stack(queries["vector"].to_numpy()).astype(float)
    sent = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = sent.value
        for frame in frames:
            if len(frame):
                x, of = np.stack(frame["vector"].to_numpy()), frame["vec_id"].to_numpy(np.int64)
                for i, q in zip(ids, vectors, strict=True):
                    some = np.flatnonzero(of != i)
                    score = distances(x[some], q)
                    best = smallest(of[some], score, k)
                    yield pd.DataFrame({"query_id": i, "leaf": frame["leaf"].to_numpy()[some[best]], "vec_id": of[some[best]], "score": score[best]})

    near = rows.select("vec_id", "leaf", "vector").mapInPandas(compare, "query_id bigint, leaf bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    true = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "leaf").toPandas()
    sent.unpersist()
    place = {i: {leaf: n for n, leaf in enumerate(tree.visits(q))} for i, q in zip(ids, vectors, strict=True)}
    needed = np.array([place[i][leaf] for i, leaf in zip(true["query_id"], true["leaf"], strict=True)])
    visits = 1
    while visits < tree.leaves and len(needed) and (needed < visits).mean() < recall:
        visits *= 2
    return min(visits, tree.leaves)


def nearest(
    embeddings: DataFrame,
    queries: DataFrame,
    k: int = 10,
    recall: float = 0.97,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each row of `queries` its k nearest rows of `embeddings` by Euclidean distance.

    The row with the query's own id is no candidate; ties go to the smaller id; fewer than k candidates give
    all of them. Vectors that are null, zero or hold null or non-finite components take no part, on either
    side, nor do rows with a null id; of rows with the same id the first by content counts. Only vectors as long
    as the queries' are compared. Other columns are not read; without rows or queries there are no rows.
    """
    rows = usable(embeddings).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = stored(rows.withColumn("dim", F.size("vector")))
    asked = usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stored(asked.withColumn("dim", F.size("vector")))
    answers = [_nearest(rows.where(F.col("dim") == d), asked.where(F.col("dim") == d), k, recall, sample_rows) for d in sorted(r["dim"] for r in asked.select("dim").distinct().collect())]
    out = None
    for one in answers:
        out = one if out is None else out.unionByName(one)
    if out is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return out


def _nearest(rows: DataFrame, queries: DataFrame, k: int, recall: float, sample_rows: int) -> DataFrame:
    spark = rows.sparkSession
    digest = F.xxhash64("vec_id")
    sample = rows.orderBy(digest, "vec_id").limit(sample_rows).select(digest.alias("digest"), "vec_id", "vector").toPandas()
    tree = Tree(np.stack(sample["vector"].to_numpy())) if len(sample) else Tree(np.zeros((1, 1)))
    trees = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column("vector").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, 1))
            leaf = trees.value.assign(x) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(leaf)], ["vec_id", "vector", "leaf"])

    placed = stored(rows.select("vec_id", "vector").mapInArrow(place, "vec_id bigint, vector array<double>, leaf bigint"))
    # Rows that the tree was fitted on come last, and others in an order of their own.
    last = [F.lit(int(sample[c].iloc[-1])).alias(c) for c in ("digest", "vec_id")] if len(sample) else None
    fitted = F.struct(digest.alias("digest"), "vec_id") <= F.struct(*last) if last else F.lit(False)
    probes = queries.orderBy(fitted, F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(CALIBRATION_QUERIES).select("vec_id", "vector").toPandas()
    visits = calibrate(tree, placed, probes, k, recall)
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    held = np.zeros(tree.leaves, np.int64)  # one number per leaf, and the tree bounds the leaves
    for r in sizes.collect():
        held[r["leaf"]] = r["n"]

    # Neighbouring leaves share a block, so that a query gets one short list per block and not one per leaf.
    block_of = (np.cumsum(held) - held) // ROWS_PER_PART
    blocks = spark.createDataFrame([(int(i), int(b)) for i, b in enumerate(block_of)], "leaf bigint, block bigint")
    placed = placed.join(F.broadcast(blocks), "leaf")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found, leaves = [], [], []
            for i, q in enumerate(batch.column("vector").to_numpy(zero_copy_only=False)):
                seen, of_block = 0, {}
                for n, leaf in enumerate(trees.value.visits(np.asarray(q))):
                    if n >= visits and seen > k:
                        break
                    if held[leaf]:
                        of_block.setdefault(int(block_of[leaf]), []).append(leaf)
                        seen += int(held[leaf])
                for block, some in of_block.items():
                    at.append(i), found.append(block), leaves.append(some)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("vector"), pa.array(found, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))],
                ["query_id", "vector", "block", "leaves"],
            )

    walked = stored(queries.select("vec_id", "vector").mapInArrow(walk, "query_id bigint, vector array<double>, block bigint, leaves array<bigint>"))
    sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    asked = walked.groupBy("block").agg(F.count(F.lit(1)).alias("q"))
    grid = sizes.join(asked, "block").select(
        "block",
        F.ceil(F.col("n") / (2 * ROWS_PER_PART)).cast("bigint").alias("row_parts"),
        F.ceil(F.col("q") / QUERIES_PER_PART).cast("bigint").alias("query_parts"),
    )
    # A block with a leaf of many rows, or with many queries, is cut on both sides; every part of the rows meets every part of the queries.
    spread = lambda column, parts: F.pmod(F.xxhash64(column), F.col(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))
    left = placed.join(grid, "block").withColumn("r", spread("vec_id", "row_parts")).withColumn("q", each("query_parts"))
    right = walked.join(grid, "block").withColumn("q", spread("query_id", "query_parts")).withColumn("r", each("row_parts"))

    def meet(_, some: pd.DataFrame, those: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(some) and len(those):
            some = some.sort_values("leaf")
            x, ids, leaf = np.stack(some["vector"].to_numpy()), some["vec_id"].to_numpy(np.int64), some["leaf"].to_numpy()
            for i, q, leaves in zip(those["query_id"], those["vector"], those["leaves"], strict=True):
                at = np.flatnonzero(np.isin(leaf, leaves) & (ids != i))
                if len(at):
                    score = distances(x[at], np.asarray(q))
                    best = smallest(ids[at], score, k)
                    out.append(pd.DataFrame({"query_id": i, "vec_id": ids[at[best]], "score": score[best]}))
        return pd.concat(out)

    keys = ["block", "r", "q"]
    found = left.select(*keys, "leaf", "vec_id", "vector").groupBy(*keys).cogroup(right.select(*keys, "query_id", "vector", "leaves").groupBy(*keys))
    found = found.applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
