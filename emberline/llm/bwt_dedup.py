"""Removal of byte strings that repeat across or inside documents, by merging Burrows-Wheeler transforms.

A string of `width` bytes has one representative inside it: the leftmost of its k-grams with the least hash. Equal
strings have the same one at the same place, so the strings of a document fall into runs with one
representative each, a run's bytes are a segment, and only segments with equal representatives can share strings.

1. Segments with equal bytes are counted by 128 bits of hash. All strings of a segment that occurs twice repeat.
2. The other segments whose representative is not unique meet, with one copy of the counted ones, in buckets by
   representative. A bucket's segments are dealt to shards, and each shard builds its transform over the alphabet
   of `STRIDE`-byte blocks (every position is followed by the position a stride behind it). The transforms are
   merged by interleave refinement: a round reads the merged transform in the present order and deals its rows
   stably by their symbol, which gives the interleave of all suffixes by one symbol more, and new boundaries
   wherever the common prefix has ended. After `width / STRIDE` rounds the intervals between boundaries
   are the strings that are equal, and no suffix has been sorted again. As segments of different representatives
   share no string, a task takes a bucket in portions, and holds the transforms of one.
3. A representative with more than `hot_segments` different segments would fill one bucket; its strings are
   counted one by one by their hash, which spreads them over all tasks.

What is removed is the union of the repeated strings, judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import released, stored, trimmed
from emberline.llm.piece_bpe import slices

WIDTH = 400
GRAM = 100
STRIDE = 50
SHARDS = 4
HOT_SEGMENTS = 4_096
BUCKET_BYTES = 2_000_000
MERGED_BYTES = 125_000
BROADCAST_BYTES = 24_000_000
_CHUNK = 1 << 22
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        factors = [np.full(size, b, np.uint64) for b in (_BASE, _INVERSE)]
        for f in factors:
            f[0] = 1
        _powers = tuple(np.multiply.accumulate(f) for f in factors)
    return _powers


class Hashes:
    """Hashes of all substrings of a text from one pass over it."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        code = (self.sums[end] - self.sums[start]) * self.down[start]
        code ^= code >> np.uint64(32)
        code *= _MIX
        code ^= code >> np.uint64(29)
        return code


def runs(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray]:
    """`(hashes, representative, first, last)`: which string starts share each representative position."""
    hashes, n = Hashes(data), len(data)
    window, starts = width - gram + 1, n - width + 1
    if starts < 1:
        return hashes, *(np.zeros(0, np.int64) for _ in range(3))
    code = hashes.of(slice(0, n - gram + 1), slice(gram, n + 1))
    found = []
    for lo in range(0, starts, _CHUNK):
        hi = min(starts, lo + _CHUNK)
        part = code[lo : hi + window - 1]
        # The hash above, the place below: the least value is the leftmost of the least hashes.
        part = part & np.uint64(~0xFFFFFF & 0xFFFFFFFFFFFFFFFF) | np.arange(len(part), dtype=np.uint64)
        padded = np.full(-(-len(part) // window) * window, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(part)] = part
        blocks = padded.reshape(-1, window)
        after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        before = np.minimum.accumulate(blocks, 1).ravel()
        least = np.minimum(after[: hi - lo], before[window - 1 : window - 1 + hi - lo])
        found.append((least & np.uint64(0xFFFFFF)).astype(np.int64) + lo)
    at = np.concatenate(found)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return hashes, at[first], first, np.append(first[1:], starts) - 1


def segments(data: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """`(hashes, first, last, representative's hash, segment's hash)` of a document's runs."""
    hashes, at, first, last = runs(data, width, gram)
    return hashes, first, last, hashes.of(at, at + gram).view(np.int64), hashes.of(first, last + width).view(np.int64)


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def stable_order(symbols: np.ndarray) -> np.ndarray:
    """Stable sorting order of non-negative 32-bit numbers: a counting sort by the lower half, then by the upper."""
    low = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    return low if symbols.max(initial=0) < 1 << 16 else low[np.argsort((symbols >> 16).astype(np.uint16)[low], kind="stable")]


class Shard:
    """The transform of some segments over stride blocks: rows in suffix order, each with the symbol a stride before."""

    def __init__(self, symbol: np.ndarray, ahead: np.ndarray, back: np.ndarray, rounds: int):
        # symbol: of each position, -1 where less than a block is left; ahead/back: the position a stride on, or -1.
        rank, hop, step = symbol.astype(np.int64) + 1, ahead, 2
        while True:  # order by 2, 4, ... symbols
            key = rank << 32 | np.where(hop >= 0, rank[hop], 0)
            self.rows = np.argsort(key)  # suffixes that agree in all symbols may stand in any order
            if step >= rounds:
                break
            key = key[self.rows]
            rank[self.rows] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            hop = np.where(hop >= 0, hop[hop], -1)
            step *= 2
        before = back[self.rows]
        self.transform = np.where(before >= 0, symbol[before], -1)
        self.empty = int((symbol < 0).sum())  # rows of suffixes without a symbol, which come first


def interleave(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """`(shard of each merged row, interval of each merged row)` after `rounds` refinements."""
    size = [len(s.rows) for s in shards]
    empty = np.repeat(np.arange(len(shards)), [s.empty for s in shards])
    empty = empty.astype(np.uint8)
    order, block = np.repeat(np.arange(len(shards), dtype=np.uint8), size), np.zeros(sum(size), np.int32)
    for _ in range(rounds):
        symbol = np.empty(len(order), np.int32)
        for k, shard in enumerate(shards):
            symbol[order == k] = shard.transform
        has = np.flatnonzero(symbol >= 0)
        dealt = has[stable_order(symbol[has])]
        symbol, block = symbol[dealt], block[dealt]
        change = np.ones(len(dealt), bool)
        change[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        order = np.concatenate([empty, order[dealt]])
        block = np.concatenate([np.zeros(len(empty), np.int32), np.cumsum(change, dtype=np.int32)])
    return order, block


def repeated_starts(texts: list[bytes], weights: np.ndarray, width: int = WIDTH, stride: int = STRIDE, shards: int = SHARDS) -> list[np.ndarray]:
    """For each segment, which of its string starts begin a string that occurs twice among the (weighted) segments."""
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)  # the byte behind a segment is its empty suffix
    size = np.fromiter(map(len, texts), np.int32, len(texts)) + 1
    start = np.cumsum(size, dtype=np.int32) - size
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    index = np.arange(len(data), dtype=np.int32)
    place = index - start[owner]
    left = size[owner] - place - 1
    whole = np.flatnonzero(left >= stride)
    symbol = np.full(len(data), -1, np.int32)
    symbol[whole] = np.unique(Hashes(data).of(whole, whole + stride), return_inverse=True)[1]
    ahead = np.where(left >= stride, index + stride, -1)
    back = np.where(place >= stride, index - stride, -1)
    shards = max(1, min(shards, len(texts)))
    cuts = np.searchsorted(np.cumsum(size), np.arange(1, shards) * len(data) / shards)
    edges = [0, *(start[np.minimum(cuts, len(texts) - 1)]).tolist(), len(data)]
    rounds = width // stride
    parts, origin = [], []
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi > lo:
            shift = lambda x: np.where(x >= 0, x - lo, -1)  # noqa: B023, E731
            parts.append(Shard(symbol[lo:hi], shift(ahead[lo:hi]), shift(back[lo:hi]), rounds))
            origin.append(parts[-1].rows + lo)
    merged, block = interleave(parts, rounds)
    position = np.empty(len(merged), np.int32)
    for k, rows in enumerate(origin):
        position[merged == k] = rows
    valid = left[position] >= width
    weight = np.bincount(block, np.where(valid, weights[owner[position]], 0))
    hit = np.zeros(len(data), bool)
    hit[position[valid & (weight[block] >= 2)]] = True
    return [hit[s : s + max(n - width, 0)] for s, n in zip(start.tolist(), size.tolist(), strict=True)]


def portions(grams: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut sorted segments between representatives, so that a portion holds about `MERGED_BYTES`, or one representative."""
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    part = (np.cumsum(sizes) - sizes)[first] // MERGED_BYTES
    edges = [*first[np.flatnonzero(np.diff(part, prepend=-1))].tolist(), len(grams)]
    yield from zip(edges, edges[1:], strict=False)


def met_by_key(docs: DataFrame, side: DataFrame, size: str, how: str) -> DataFrame:
    """Join the texts with a table by text key: it is broadcast if its size is checked to be small, else both are shuffled."""
    total = side.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    return docs.join(F.broadcast(side) if total.bytes + 32 * total.n <= BROADCAST_BYTES else side, "key", how)


def removals(
    docs: DataFrame, id_column: str = "doc_id", width: int = WIDTH, hot_segments: int = HOT_SEGMENTS, keep: Sequence[str] = ()
) -> DataFrame:
    """`(id, *keep, n_bytes, spans, kept)` of every row: the removed byte spans `(start, end)` and the remaining bytes.

    Every byte covered by a string of `width` bytes that starts at another place too, in any row, goes. Null text
    counts as empty; texts shorter than `width` keep all; repeated rows are copies of each other and so lose
    all strings; ids may be null or repeat; other columns are not read; an empty table gives no rows.
    """
    carried = [id_column, *keep]
    rows = docs.select(*carried, "text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("key"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            keys, grams, codes, times = [], [], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                _, _, _, gram, code = segments(as_bytes(text.as_py()), width)
                if len(gram):
                    pair, first, n = np.unique(np.stack([gram, code]), axis=1, return_index=True, return_counts=True) if len(gram) > 1 else (None, np.zeros(1, int), np.ones(1, int))
                    keys.append(key), grams.append(gram[first]), codes.append(code[first]), times.append(n.astype(np.int32))
            long, whole = pa.list_(pa.int64()), pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(grams, long), pa.array(codes, long), pa.array(times, whole)], ["key", "grams", "codes", "times"])

    lists = stored(rows.select("key", "text").mapInArrow(trimmed(listed), "key binary, grams array<bigint>, codes array<bigint>, times array<int>"))
    copies = stored(lists.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    once = lists.dropDuplicates(["key"]).select("key", F.explode(F.arrays_zip("grams", "codes", "times")).alias("s"))
    once = once.select("key", F.col("s.grams").alias("gram"), F.col("s.codes").alias("code"), F.col("s.times").alias("times"))
    # A text that occurs twice loses everything; its segments still stand for one place, as two would change nothing for others.
    counted = stored(once.groupBy("gram", "code").agg(F.sum("times").cast("bigint").alias("weight"), F.min("key").alias("key")))
    shared = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("weight").alias("least")).where("kinds > 1 and least = 1")
    wanted = stored(counted.join(shared.select("gram", "kinds"), "gram").withColumn("hot", F.col("kinds") > hot_segments))

    # Texts of the segments that have to be compared, from one document each.
    asked = stored(wanted.groupBy("key").agg(F.collect_list(F.struct("gram", "code", "weight", "hot")).alias("asked")).withColumn("size", F.size("asked") * 32))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            out: list[tuple] = []
            for key, text, asked in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("asked").to_pylist(), strict=True):
                data = as_bytes(text.as_py())
                hashes, first, last, gram, code = segments(data, width)
                place = {pair: i for i, pair in enumerate(zip(gram.tolist(), code.tolist(), strict=True))}
                for a in asked:
                    i = place[a["gram"], a["code"]]
                    lo, hi = int(first[i]), int(last[i])
                    if a["hot"]:
                        at = np.arange(lo, hi + 1)
                        out.append((a["gram"], a["code"], key, a["weight"], None, hashes.of(at, at + width).view(np.int64)))
                    else:
                        out.append((a["gram"], a["code"], key, a["weight"], data[lo : hi + width].tobytes(), None))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)], ["gram", "code", "key", "weight", "bytes", "strings"])

    texts = met_by_key(rows.select("key", "text"), asked.select("key", "asked", "size"), "size", "inner")
    units = texts.mapInArrow(trimmed(cut), "gram bigint, code bigint, key binary, weight bigint, bytes binary, strings array<bigint>")
    units = stored(units.dropDuplicates(["gram", "code"]))
    released(wanted, asked)

    total = units.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0)).alias("bytes")).first().bytes
    bucket = F.pmod(F.xxhash64("gram"), F.lit(max(1, -(-total // BUCKET_BYTES)))).alias("bucket")

    def compared(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["gram", "code"])
        texts, weights = frame["bytes"].tolist(), frame["weight"].to_numpy(float)
        flags: list[np.ndarray] = []
        for lo, hi in portions(frame["gram"].to_numpy(), np.fromiter(map(len, texts), np.int64, len(texts))):
            flags += repeated_starts(texts[lo:hi], weights[lo:hi], width)
        open_ = (frame["weight"] < 2).to_numpy() & np.array([f.any() for f in flags])
        packed = [np.packbits(f).tobytes() for f, o in zip(flags, open_, strict=True) if o]
        return frame.loc[open_, ["key", "gram", "code"]].assign(flags=packed)

    cold = units.where("bytes is not null").select(bucket, "gram", "code", "key", "weight", "bytes")
    partly = cold.groupBy("bucket").applyInPandas(compared, "key binary, gram bigint, code bigint, flags binary")

    hot = units.where("strings is not null").select("key", "gram", "code", "weight", F.posexplode("strings").alias("place", "string"))
    twice = hot.groupBy("gram", "string").agg(F.sum("weight").alias("n")).where("n > 1").select("gram", "string")
    spots = hot.where("weight = 1").join(twice, ["gram", "string"]).groupBy("key", "gram", "code").agg(F.collect_list("place").alias("places"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for places in batch.column("places").to_pylist():
                bits = np.zeros(max(places) + 1, bool)
                bits[places] = True
                flags.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "gram", "code")] + [pa.array(flags, pa.binary())], ["key", "gram", "code", "flags"])

    spots = spots.mapInArrow(trimmed(packed), "key binary, gram bigint, code bigint, flags binary")
    whole = once.join(counted.where("weight > 1").select("gram", "code"), ["gram", "code"]).select("key", "gram", "code", F.lit(None).cast("binary").alias("flags"))
    alone = copies.select("key", F.lit(None).cast("bigint").alias("gram"), F.lit(None).cast("bigint").alias("code"), F.lit(None).cast("binary").alias("flags"))
    told = partly.unionByName(spots).unionByName(whole).unionByName(alone)
    marks = told.groupBy("key").agg(
        F.collect_list(F.struct("gram", "code", "flags")).alias("marks"), F.sum(F.lit(20) + F.coalesce(F.octet_length("flags"), F.lit(0))).alias("size")
    )
    marks = stored(marks)
    released(lists, copies, counted, units)

    def spans_of(data: np.ndarray, marks: list[dict]) -> np.ndarray:
        starts = np.zeros(max(len(data) - width + 1, 0), bool)
        if any(m["code"] is None for m in marks):
            starts[:] = True
        else:
            _, first, last, gram, code = segments(data, width)
            known = {(m["gram"], m["code"]): m["flags"] for m in marks}
            for lo, hi, pair in zip(first.tolist(), last.tolist(), zip(gram.tolist(), code.tolist(), strict=True), strict=True):
                if pair in known:
                    bits = known[pair]
                    n = hi + 1 - lo
                    starts[lo : hi + 1] = True if bits is None else np.pad(np.unpackbits(np.frombuffer(bits, np.uint8))[:n], (0, max(0, n - 8 * len(bits)))).astype(bool)
        step = np.zeros(len(data) + 1, np.int64)
        hit = np.flatnonzero(starts)
        step[hit] += 1
        step[hit + width] -= 1
        gone = np.concatenate([[False], np.cumsum(step[:-1]) > 0, [False]])
        return np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            spans, kept, sizes = [], [], []
            for text, marks in zip(batch.column("text"), batch.column("marks").to_pylist(), strict=True):
                data = as_bytes(text.as_py())
                found = spans_of(data, marks) if marks else np.zeros((0, 2), np.int64)
                edges = [0, *found.ravel().tolist(), len(data)]
                sizes.append(len(data))
                spans.append([{"start": int(a), "end": int(b)} for a, b in found])
                kept.append(b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            found = [pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *found], [*carried, "n_bytes", "spans", "kept"])

    met = met_by_key(rows, marks, "size", "left").select(*carried, "text", "marks")
    types = dict(rows.dtypes)
    return met.mapInArrow(trimmed(removed), ", ".join(f"{c} {types[c]}" for c in carried) + ", n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
