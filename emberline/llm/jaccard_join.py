"""Near-duplicate documents by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles. Shingles have one global order, the rare ones first. If two sets
are similar enough, the first `n - ceil(t * n) + k` shingles of each share at least k, for any k of 1 or more. Every
document picks its own k: a longer prefix costs more index rows but asks for more shared shingles, so k grows
while the estimated work for the candidates falls. The smaller set of a pair must have more of its shingles in the
intersection than the larger one, so of its prefix the first `n - ceil(2 * t * n / (1 + t)) + k` are enough to meet. A
pair is verified only if sketches of its prefixes allow as many shared shingles as the smaller k of the two, and as many
as its similarity leaves to the prefixes, and if sketches of its whole sets allow the similarity.

Equal sets are joined first and stand for one another. What is asked for is the components of the links, so
a document first tries the one partner with which it shares most prefix shingles among the least ids of its
shingles; after that only pairs of different components can matter, and all of those are verified. A group of
thousands of near copies so costs a number of checks in proportion to its size, not to its square.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import components, released, stored, trimmed
from emberline.llm.piece_bpe import slices
from emberline.session import shuffle_width, shuffles_dropped
from emberline.sources.bucketed import BucketedTable

COUNT_BITS = 20
BLOCKS = 64
MOST_MATCHES = 4
BROADCAST_IDS = 1_000_000
DOCS_PER_PART = 2_000
SKETCH_BITS = 2_048
DOCS_PER_BUCKET = 5_000
SMALLER_PER_BLOCK = 500
PAIRS_PER_BLOCK = 50_000
CACHED_WORDS = 150_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Shingler:
    """Sorted distinct shingle hashes of texts; keeps the hashes of the words it has met."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        # On bytes, lower() changes A-Z alone and split() cuts at the six ASCII white-space bytes.
        lists = [(t or "").encode().lower().split() for t in texts]
        flat = [w for words in lists for w in words]
        missing = set(flat).difference(self.known)
        if len(missing) + len(self.known) > CACHED_WORDS:
            self.known.clear()
            missing = set(flat)
        for w in missing:
            self.known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        codes = np.fromiter(map(self.known.__getitem__, flat), np.uint64, len(flat))
        end = np.cumsum([len(words) for words in lists], dtype=np.int64)
        return [self._set(codes[lo:hi]) for lo, hi in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]

    def _set(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return codes
        width = min(self.size, len(codes))
        mixed = np.full(len(codes) - width + 1, width, np.uint64)
        for step in range(width):
            mixed = (mixed ^ codes[step : len(codes) - width + 1 + step]) * _A
            mixed ^= mixed >> np.uint64(32)
        mixed = np.sort(mixed * _B ^ mixed >> np.uint64(29))
        return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def overlap_needed(n: int, percent: int) -> int:
    """The least intersection with which a set of n can reach the similarity."""
    return -(-percent * n // 100)


def narrow(counts: np.ndarray) -> bytes:
    """Non-negative counts in the fewest of 1, 2 or 4 bytes each that hold the largest."""
    return counts.astype(np.min_scalar_type(counts.max(initial=0)).newbyteorder("<")).tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The n counts that `narrow` gave."""
    return np.frombuffer(data, f"<u{len(data) // n}")


def shingle_counts(docs: DataFrame, id_column: str, size: int) -> tuple[DataFrame, np.ndarray]:
    """`(id, n_shingles, print)` of every document, and hashed document counts of all shingles as powers of two.

    The counts have a fixed number of slots whatever the data, in a task's rows of as few bytes as its largest takes;
    they order the shingles and estimate costs, and decide no result. `released` takes the table.
    """
    spark = docs.sparkSession
    schema = f"{id_column} bigint, n_shingles bigint, print binary, block int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(size), np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler.sets(part.column("text").to_pylist())
                joined = np.concatenate(sets)
                counts += np.bincount((joined >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_column), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())],
                    [id_column, "n_shingles", "print", "block", "counts"],
                )
        cut = [narrow(c) for c in np.split(np.minimum(counts, np.iinfo(np.int32).max), BLOCKS)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.int64()), pa.nulls(BLOCKS, pa.binary()), pa.array(range(BLOCKS), pa.int32()), pa.array(cut, pa.binary())],
            [id_column, "n_shingles", "print", "block", "counts"],
        )

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << COUNT_BITS) // BLOCKS, np.int64)
        for c in frame["counts"]:
            total += widened(c, len(total))
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "level": [np.log2(total + 1).astype(np.uint8).tobytes()], "total": [int(total.sum())]})

    found = stored(docs.select(F.col(id_column).cast("bigint").alias(id_column), "text").mapInArrow(trimmed(run), schema))
    sums = found.where("block is not null").select("block", "counts").groupBy("block").applyInPandas(added, "block int, level binary, total bigint")
    levels = {r["block"]: np.frombuffer(r["level"], np.uint8) for r in sums.collect()}
    empty = np.zeros((1 << COUNT_BITS) // BLOCKS, np.uint8)
    rows = found.where("block is null").select(id_column, "n_shingles", "print")
    rows.stored_at = found.stored_at
    return rows, np.concatenate([levels.get(b, empty) for b in range(BLOCKS)])


def prefix_of(shingles: np.ndarray, levels: np.ndarray, percent: int, most: int) -> tuple[int, np.ndarray]:
    """`(matches asked for, prefix)` of a sorted set: the prefix grows while the estimated work falls."""
    n = len(shingles)
    level = levels[(shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    base = n - overlap_needed(n, percent)
    short = n - -(-2 * percent * n // (100 + percent))  # where it meets larger sets
    order = np.argsort(level, kind="stable")[: base + most]  # the shingles come sorted
    partners = np.cumsum(np.exp2(level[order], dtype=float))
    best, cost = 1, np.inf
    for k in range(1, min(most, overlap_needed(n, percent)) + 1):
        rows = partners[short + k - 1]
        work = rows + rows / k * n / 16  # reading the index, and comparing the candidates
        if work < cost:
            best, cost = k, work
    return best, shingles[order[: base + best]]


def prefixes(docs: DataFrame, id_column: str, size: int, percent: int, levels: np.ndarray, most: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, sizes, asked, tokens, sketches, wholes = [], [], [], [], [], []
                for i, s in zip(part.column(id_column).to_pylist(), shingler.sets(part.column("text").to_pylist()), strict=True):
                    if len(s):
                        k, prefix = prefix_of(s, sent.value, percent, most)
                        ids.append(i), sizes.append(len(s)), asked.append(k), tokens.append(prefix.view(np.int64))
                        sketches.append(sketch(prefix)), wholes.append(sketch(s, max(SKETCH_BITS, 1 << (4 * len(s)).bit_length())))
                columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(asked, pa.int32()), pa.array(tokens, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(wholes, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "k", "prefix", "sketch", "whole"])

    rows = docs.select(F.col(id_column).cast("bigint").alias(id_column), "text")
    return rows.mapInArrow(trimmed(run), "id bigint, n int, k int, prefix array<bigint>, sketch binary, whole binary")


def may_link(x: bytes, n_x: int, y: bytes, n_y: int, percent: int) -> bool:
    """Whether two sets of `n_x` and `n_y` with these sketches can be similar enough; never false for sets that are.

    Both share at most the common bits, and the shingles that fell on a bit already set in either of them. The
    larger sketch is folded to the size of the smaller.
    """
    bits = [np.unpackbits(np.frombuffer(b, np.uint8)) for b in (x, y)]
    size = min(map(len, bits))
    a, b = (each.reshape(size, -1).max(1) for each in bits)
    shared = min(np.count_nonzero(a & b) + min(n_x - np.count_nonzero(a), n_y - np.count_nonzero(b)), n_x, n_y)
    return 100 * shared >= percent * (n_x + n_y - shared)


def possible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Of the pairs `(a, b)`, a stored table, those whose whole sets may be similar enough, by `(id, n, whole)`; stored."""
    left = pairs.join(sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("whole").alias("x")), "a")
    both = left.join(sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("whole").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("x", "n_a", "y", "n_b")), strict=True)
            good = pa.array([may_link(*row, percent) for row in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(good)

    return stored(both.select("a", "b", "x", "n_a", "y", "n_b").mapInArrow(trimmed(run), "a bigint, b bigint").distinct())


def verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, id_column: str, size: int, percent: int) -> DataFrame:
    """Of the distinct pairs `(a, b)`, a stored table, those whose whole shingle sets are similar enough."""
    pairs = possible(pairs, sketches, percent)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    if ids.count() <= BROADCAST_IDS:  # 8 MB of ids at most; beyond that Spark shuffles both sides
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingler.sets(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "grams"])

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), "text").join(ids, "id", "left_semi")
    sets = stored(texts.mapInArrow(trimmed(run), "id bigint, grams array<bigint>"))
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    judged = both.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y")).alias("sum"))
    linked = stored(judged.where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.col("sum") - F.col("i"))).select("a", "b"))
    released(sets, pairs)
    return linked


def matches_needed(percent: int) -> Column:
    """Shared prefix shingles that a pair with columns `n_a, k_a, n_b, k_b` must have.

    Both prefixes share at least the smaller k. And of the two prefixes one ends first in the global order: what the
    pair shares beyond its own prefix is no more than the rest of that set, so the prefixes must hold the rest
    of the intersection that the similarity asks for.
    """
    whole = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    rest = [F.ceil(F.lit(percent) * F.col(f"n_{x}") / F.lit(100)) - F.col(f"k_{x}") for x in "ab"]
    return F.greatest(F.least("k_a", "k_b"), whole - F.greatest(*rest))


def sketch(shingles: np.ndarray, size: int = SKETCH_BITS) -> bytes:
    """The shingles as a bitmap of `size` bits, a power of two."""
    bits = np.zeros(size, np.uint8)
    bits[(shingles * _C >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def meeting_pairs(rows: pd.DataFrame, percent: int, across: bool) -> pd.DataFrame:
    """Distinct pairs `(a, b)` of `rows` that meet in a shingle, lie in different components and may share enough.

    Two prefixes share at most the common bits of their sketches, and the shingles that fell on a bit already set in
    either of them. With `across`, only pairs of different parts count. Blocks of pairs bound the memory.
    """
    rows = rows.sort_values("token", kind="stable")
    token, ids, n, k, of, early, part = (rows[c].to_numpy() for c in ("token", "id", "n", "k", "component_id", "early", "part"))
    n, k = n.astype(np.int64), k.astype(np.int64)
    bits = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(rows), -1)
    least = -(-percent * n // 100)
    merged = n - least + k - np.bitwise_count(bits).sum(1)
    cuts = np.flatnonzero(np.diff(token)) + 1
    found = [np.zeros((0, 2), np.int64)]
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)], strict=True):
        smaller, all_ = lo + np.flatnonzero(early[lo:hi]), slice(lo, hi)
        for start in range(0, len(smaller), SMALLER_PER_BLOCK):
            x = smaller[start : start + SMALLER_PER_BLOCK, None]
            good = (of[x] != of[all_]) & (100 * n[x] >= percent * n[all_])
            good &= (n[x] < n[all_]) | (n[x] == n[all_]) & (ids[x] < ids[all_])
            if across:
                good &= part[x] != part[all_]
            i, j = np.nonzero(good)
            i, j = x[i, 0], j + lo
            for at in range(0, len(i), PAIRS_PER_BLOCK):
                s, t = i[at : at + PAIRS_PER_BLOCK], j[at : at + PAIRS_PER_BLOCK]
                whole = -(-percent * (n[s] + n[t]) // (100 + percent))
                needed = np.maximum(np.minimum(k[s], k[t]), whole - np.maximum(least[s] - k[s], least[t] - k[t]))
                ok = np.bitwise_count(bits[s] & bits[t]).sum(1) + np.minimum(merged[s], merged[t]) >= needed
                if ok.any():
                    found.append(np.stack([ids[s[ok]], ids[t[ok]]], 1))
    return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])


def candidates(open_: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs `(a, b)` of different components that meet in a shingle and whose prefixes may share enough.

    `open_` says with `docs` how many rows have the same shingle. Shingles with few documents are dealt into cells of
    some thousand rows. A shingle with many is cut into parts;
    a cell holds two of them, and every part meets every other in one cell. A row has the same size whatever its prefix,
    and meets its sketch once its cell is known, so sketches move to the cells only.
    """
    cells = -(-open_.count() // (2 * DOCS_PER_PART)) or 1
    parts = F.ceil(F.col("docs") / DOCS_PER_PART).cast("bigint").alias("parts")
    rows = open_.select("*", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    cell = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("token"), F.lit(cells).cast("bigint"))).otherwise(F.col("token"))
    rows = rows.select(
        cell.alias("cell"), F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        "token", "part", "id", "n", "k", "component_id", "early",
    ).join(sketches.select("id", "sketch"), "id")

    def meet(key, frame: pd.DataFrame) -> pd.DataFrame:
        return meeting_pairs(frame, percent, across=key[1] != key[2])

    return rows.groupBy("cell", "p", "q").applyInPandas(meet, "a bigint, b bigint").distinct()


def jaccard_components(
    docs: DataFrame, size: int = 3, percent: int = 90, most_matches: int = MOST_MATCHES, id_column: str = "doc_id"
) -> DataFrame:
    """`(id, n_shingles, component_id)` of every row: components of the links `100 * intersection >= percent * union`.

    Words are runs of non-white-space ASCII-lower-cased; a set holds the distinct runs of `size` words, or all words
    as one if there are fewer. Rows without words or with null text have 0 shingles and are components of
    their own. Rows with the same id are one vertex with the links of all their texts; a null id has a null component. Other columns are not read; an empty table gives no rows.
    """
    rows, levels = shingle_counts(docs, id_column, size)
    least = rows.where("print is not null").groupBy("print").agg(F.min(id_column).alias("rep"))
    least = stored(least)
    equal = stored(rows.join(least, "print").select(F.col(id_column).alias("a"), F.col("rep").alias("b")).where("a <> b").distinct())
    reps = least.select(F.col("rep").alias("id")).distinct()
    # Prefixes and sketches move once, into buckets by id; every join by id reads them there. With fewer buckets
    # than shuffle partitions, Spark would shuffle them again.
    buckets = max(shuffle_width(docs.sparkSession), -(-rows.count() // DOCS_PER_BUCKET))
    with shuffles_dropped(docs.sparkSession):
        lasting = BucketedTable.write(prefixes(docs, id_column, size, percent, levels, most_matches), ["id"], buckets)
    indexed = lasting.rows
    index = indexed.join(reps, "id", "left_semi").select("id", "n", "k", F.posexplode("prefix").alias("place", "token"))
    early = F.col("place") < F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / F.lit(100 + percent)) + F.col("k")
    index = index.select("id", "n", "k", "token", early.alias("early"))

    same = Window.partitionBy("token")  # the index moves once: counts and leads come from the rows themselves
    groups = index.select("*", F.count(F.lit(1)).over(same).alias("docs"), F.min(F.struct("id", "n", "k")).over(same).alias("lead"))
    shared = stored(groups.where("docs > 1"))
    stars = shared.where("id <> lead.id").groupBy("id", F.col("lead.id").alias("lead")).agg(
        F.count(F.lit(1)).alias("common"), *[F.first(c).alias(f"{c}_a") for c in ("n", "k")], *[F.first(f"lead.{c}").alias(f"{c}_b") for c in ("n", "k")]
    ).where(F.col("common") >= matches_needed(percent))
    tried = stars.groupBy("id").agg(F.max(F.struct("common", (-F.col("lead")).alias("least"))).alias("best"))
    tried = stored(tried.select(F.col("id").alias("a"), (-F.col("best.least")).alias("b")))
    links = verified(tried, indexed, docs, id_column, size, percent)
    released(tried)

    # What is left to find are links between components; a shingle whose documents are all of one has none.
    found = components(links)
    placed = shared.drop("lead").join(found, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    mixed = placed.select(
        "*", F.min("component_id").over(same).alias("low"), F.max("component_id").over(same).alias("high"), F.max("early").over(same).alias("met")
    )
    open_ = stored(mixed.where("low < high and met").drop("low", "high", "met"))
    released(shared, least, found)
    pairs = stored(candidates(open_, indexed, percent))
    released(open_)
    more = verified(pairs, indexed, docs, id_column, size, percent)
    of = components(links.unionByName(more).unionByName(equal))
    released(links, equal, pairs, more)
    lasting.remove()
    out = rows.select(id_column, "n_shingles").join(of.withColumnRenamed("id", id_column), id_column, "left").select(
        id_column, "n_shingles", F.coalesce("component_id", id_column).alias("component_id")
    )
    out = stored(out)
    released(rows, of)
    return out
