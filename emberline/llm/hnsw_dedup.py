"""Near-duplicate embeddings: a hierarchical navigable small-world graph per shard, every shard queried.

The vectors of a label are dealt to shards by a digest of the id. A task builds the graph of a shard; a task
takes a block of queries through the graph of one shard. There the beam widens until it holds something that
is no link for every query, and until an audit finds what a comparison of some queries with the whole
shard finds; a beam as wide as the shard ends in that comparison for all. Cosines of what the beams hold
are then computed in double precision on the stored vectors. A task returns the number of links per query and
a spanning forest of its links, never the pairs themselves; forests are united to components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import components, stored

SHARD_ROWS = 20_000
BLOCK_ROWS = 1_000
LINKS = 12  # per vertex on upper layers; twice as many on the lowest
BUILD_BEAM = 48
BEAM = 48
AUDITS = 64
BATCH = 256


def usable(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding", *others: str) -> DataFrame:
    """Rows whose vector has only finite components and is not zero, the vector as doubles."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.select(F.col(id_column).cast("bigint").alias(id_column), *others, x.alias("vector"))
    some = F.exists("vector", lambda v: v != 0)
    return rows.where(F.col(id_column).isNotNull() & F.col("vector").isNotNull() & ~bad & some)


class Graph:
    """The layers of one shard; vectors have length one. Vertices are numbered in the order of their ids."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        n = len(vectors)
        draws = np.random.default_rng(11).random(n)
        level = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(LINKS)).astype(int), 6)
        order = np.argsort(-level, kind="stable")  # upper layers first: an entry point is always there
        top = int(level.max())
        links = [np.full((n, LINKS * (2 if layer == 0 else 1)), -1, np.int32) for layer in range(top + 1)]
        graph = cls(vectors, links, int(order[0]))
        for start in range(1, n, BATCH):
            size = min(BATCH, start)  # a first batch no larger than the graph it searches
            for lo in range(start, min(start + BATCH, n), size):
                graph._insert(order[lo : min(lo + size, start + BATCH, n)], level)
        return graph

    def _insert(self, new: np.ndarray, level: np.ndarray) -> None:
        queries = self.vectors[new]
        entry = np.full((len(new), 1), self.entry)
        among = queries @ queries.T
        np.fill_diagonal(among, -2)
        for layer in range(len(self.links) - 1, -1, -1):
            ids, sims = self.search(queries, entry, layer, BUILD_BEAM)
            entry = ids[:, :4]
            here = np.flatnonzero(level[new] >= layer)
            if not len(here):
                continue
            near = np.argsort(-among[np.ix_(here, here)], axis=1)[:, : LINKS * 2]
            for row, i in enumerate(here):
                peers = here[near[row]]
                found = np.concatenate([ids[i], new[peers]])
                sim = np.concatenate([sims[i], among[i, peers]])
                ok = (found >= 0) & (sim > -2) & (found != new[i])
                picked = self._diverse(found[ok], sim[ok], LINKS)
                self.links[layer][new[i], : len(picked)] = picked
                for other in picked:
                    self._link_back(int(other), int(new[i]), layer)

    def _diverse(self, found: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Nearest candidates that are nearer to the vertex than to one already picked, then the nearest of the rest."""
        found, first = np.unique(found, return_index=True)
        order = np.argsort(-sim[first], kind="stable")[: 4 * most]
        found, sim = found[order], sim[first][order]
        between = self.vectors[found] @ self.vectors[found].T
        picked: list[int] = []
        crowd = np.full(len(found), -2.0)
        for k in range(len(found)):
            if len(picked) == most:
                break
            if crowd[k] < sim[k]:
                picked.append(k)
                crowd = np.maximum(crowd, between[k])
        rest = [k for k in range(len(found)) if k not in picked]
        return found[[*picked, *rest[: most - len(picked)]]]

    def _link_back(self, at: int, new: int, layer: int) -> None:
        row = self.links[layer][at]
        if (row == new).any():
            return
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = new
            return
        found = np.append(row, new)
        kept = self._diverse(found, self.vectors[found] @ self.vectors[at], len(row))
        row[:] = -1
        row[: len(kept)] = kept

    def search(self, queries: np.ndarray, entry: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries in step; `(ids, similarities)` sorted by similarity, -1 where there is none."""
        q, n, links = len(queries), len(self.vectors), self.links[layer]
        step = max(4, beam // 16)
        ids, sims = np.full((q, beam), -1), np.full((q, beam), -2.0)
        opened = np.ones((q, beam), bool)
        seen = np.zeros(q * n, bool)
        rows, fresh = np.repeat(np.arange(q), entry.shape[1]), entry.ravel()
        live = fresh >= 0
        rows, fresh = rows[live], fresh[live]
        while len(rows):
            key = np.unique(rows * n + fresh)
            key = key[~seen[key]]
            seen[key] = True
            rows, fresh = key // n, key % n
            if not len(rows):
                break
            sim = np.einsum("ij,ij->i", self.vectors[fresh], queries[rows])
            count = np.bincount(rows, minlength=q)
            place = np.arange(len(rows)) - (np.cumsum(count) - count)[rows]
            width = int(count.max())
            more, more_sim = np.full((q, width), -1), np.full((q, width), -2.0)
            more[rows, place], more_sim[rows, place] = fresh, sim
            ids, sims = np.concatenate([ids, more], 1), np.concatenate([sims, more_sim], 1)
            opened = np.concatenate([opened, more < 0], 1)
            best = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
            ids, sims, opened = (np.take_along_axis(a, best, 1) for a in (ids, sims, opened))
            turn = ~opened & (np.cumsum(~opened, 1) <= step)
            opened |= turn
            rows, at = np.nonzero(turn)
            nodes = links[ids[rows, at]]
            rows = np.repeat(rows, links.shape[1])
            fresh = nodes.ravel()
            live = fresh >= 0
            rows, fresh = rows[live], fresh[live].astype(np.int64)
        return ids, sims

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            entry = self.search(queries, entry, layer, 4)[0]
        return self.search(queries, entry, 0, beam)

    def pack(self) -> bytes:
        import io

        out = io.BytesIO()
        np.savez(out, entry=self.entry, **{f"links{i}": x for i, x in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def unpack(cls, vectors: np.ndarray, data: bytes) -> Graph:
        import io

        found = np.load(io.BytesIO(data))
        return cls(vectors, [found[f"links{i}"] for i in range(len(found.files) - 1)], int(found["entry"]))


def links_to_shard(graph: Graph, queries: np.ndarray, threshold: float, margin: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """`(query, vertex)` candidates whose single-precision cosine reaches the threshold less a margin."""
    n, low = len(graph.vectors), threshold - margin
    open_, beam = np.arange(len(queries)), min(BEAM, n)
    audits = np.linspace(0, len(queries) - 1, min(AUDITS, len(queries))).astype(int)
    truth = (queries[audits] @ graph.vectors.T >= low).sum(1)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(open_):
        if beam >= n:
            for lo in range(0, len(open_), BATCH):
                rows, at = np.nonzero(queries[open_[lo : lo + BATCH]] @ graph.vectors.T >= low)
                done.append((open_[lo + rows], at))
            break
        chunk = max(8, min(BATCH, 20_000_000 // n))
        parts = [graph.nearest(queries[open_[lo : lo + chunk]], beam) for lo in range(0, len(open_), chunk)]
        ids, sims = (np.concatenate(x) for x in zip(*parts, strict=True))
        link = (sims >= low) & (ids >= 0)
        full = link.all(1)
        audited = np.isin(open_, audits)
        missed = link.sum(1)[audited] < truth[np.searchsorted(audits, open_[audited])]
        if (missed & ~full[audited]).any():
            full[:] = True  # the audit failed: every query again with a wider beam
        rows, at = np.nonzero(link & ~full[:, None])
        done.append((open_[rows], ids[rows, at]))
        open_, beam = open_[full], min(beam * 4, n)
    rows, at = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, int), np.zeros(0, int))
    return rows, at


def roots(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node number of each node's component, by spreading minima and jumping to them."""
    root = np.arange(nodes)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = np.minimum(root, root[root])
        if (root == before).all():
            return root


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]).astype(np.float32)


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = 0.93,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`(vec_id, n_links, component_id, kept)`: links of cosine `threshold` or more between vectors of the same label.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null label, have no links.
    Rows with the same id are one vector, the first by content; a null id has a null component and is not kept.
    Vectors of different length never link. Other columns are not read; an empty table gives no rows.
    """
    rows = usable(embeddings, "vec_id", "embedding", "label").where("label is not null")
    rows = rows.withColumn("dim", F.size("vector")).groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vector")).alias("row"))
    rows = stored(rows.select("vec_id", F.col("row.label").alias("label"), F.col("row.dim").alias("dim"), F.col("row.vector").alias("vector")))
    place = F.xxhash64("vec_id").bitwiseAND(0x3FFFFFFF)
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("label", "dim", F.ceil(F.col("n") / shard_rows).alias("shards"), F.ceil(F.col("n") / block_rows).alias("blocks"))
    dealt = stored(rows.join(sizes, ["label", "dim"]).withColumn("shard", place % F.col("shards")).withColumn("block", F.shiftright(place * F.col("blocks"), 30)))
    dealt_key = [F.col("label").cast("string").alias("label"), "dim"]
    dealt = dealt.select(*dealt_key, "shard", "block", "vec_id", "vector")

    def packed(frame: pd.DataFrame, built: bool) -> dict:
        frame = frame.sort_values("vec_id")
        vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
        out = {"ids": [frame["vec_id"].to_numpy("<i8").tobytes()], "vectors": [vectors.astype("<f8").tobytes()]}
        if built:
            out["graph"] = [Graph.build(unit(vectors)).pack()]
        return out

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "shard": [key[2]], **packed(frame, True)})

    def block(key, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "block": [key[2]], **packed(frame, False)})

    graphs = stored(dealt.groupBy("label", "dim", "shard").applyInPandas(build, "label string, dim int, shard bigint, ids binary, vectors binary, graph binary"))
    blocks = stored(dealt.groupBy("label", "dim", "block").applyInPandas(block, "label string, dim int, block bigint, ids binary, vectors binary"))
    asked = blocks.select("label", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    met = asked.join(graphs, ["label", "dim"]).repartition(F.xxhash64("q_ids", "shard"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                x = np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1)
                q = np.frombuffer(row["q_vectors"], "<f8").reshape(len(q_ids), -1)
                a, b = links_to_shard(Graph.unpack(unit(x), row["graph"]), unit(q), threshold)
                norm_x, norm_q = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", q, q))
                true = np.zeros(len(a), bool)
                for lo in range(0, len(a), 50_000):
                    s = slice(lo, lo + 50_000)
                    true[s] = np.einsum("ij,ij->i", q[a[s]], x[b[s]]) / (norm_q[a[s]] * norm_x[b[s]]) >= threshold
                true &= q_ids[a] != ids[b]
                a, b = a[true], b[true]
                nodes, at = np.unique(np.concatenate([q_ids, ids]), return_inverse=True)
                root = roots(len(nodes), at[: len(q_ids)][a], at[len(q_ids) :][b])
                links = np.zeros(len(nodes), np.int64)
                np.add.at(links, at[: len(q_ids)][a], 1)
                told = (links > 0) | (root != np.arange(len(nodes)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[told]), pa.array(nodes[root[told]]), pa.array(links[told])], ["a", "b", "links"])

    found = stored(met.mapInArrow(search, "a bigint, b bigint, links bigint"))
    counts = found.groupBy(F.col("a").alias("vec_id")).agg(F.sum("links").alias("n_links"))
    of = components(found.select("a", "b")).withColumnRenamed("id", "vec_id")
    out = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id")).join(counts, "vec_id", "left").join(of, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
