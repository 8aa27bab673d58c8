"""Benchmark passages in training texts, found by an FM-index per training shard.

A shard is a slice of a partition's texts. Its words become symbols, numbered by the benchmark's vocabulary; a word that no
benchmark item has can be part of no match, so it ends a run, and runs shorter than the shortest window are left
out. The runs' suffixes are sorted, their Burrows-Wheeler transform goes into a wavelet matrix, and every window is searched
backwards, all windows in step. Rows of the matches are walked back to sampled suffix positions; the words they cover are
merged to spans.

The benchmark travels to the executors in blocks of `BLOCK_BYTES` of text, one pass over the documents for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import stored

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
SAMPLE_RATE = 8
_BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # of text whose A-Z are lower-cased
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


class Bits:
    """A bit vector that counts its ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.ones = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.ones[1:])

    def before(self, at: np.ndarray) -> np.ndarray:
        word, low = at >> 6, (at & 63).astype(np.uint64)
        return self.ones[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for b in range(self.bits - 1, -1, -1):
            one = (symbols >> b & 1).astype(bool)
            self.levels.append((Bits(one), int(len(one) - one.sum())))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        every = np.arange(n_symbols)
        self.bottom = self._down(every, np.zeros(n_symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for b, (bits, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            ones = bits.before(at)
            at = np.where(symbol >> b & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often `symbol` stands before place `at`."""
        return self._down(symbol, at) - self.bottom[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`(symbol at the place, how often it stands before)`."""
        symbol = np.zeros(len(at), np.int64)
        for bits, zeros in self.levels:
            one, ones = bits.get(at), bits.before(at)
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - self.bottom[symbol]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the sorted suffixes of runs that end in symbol 0; equal runs sort by place. By prefix doubling."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, ends.sum() + symbols)
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1 or step >= n:
            return order


class FmIndex:
    """Search index of a text of runs of symbols 1, 2, ..., each run ended by symbol 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, rate: int = SAMPLE_RATE):
        order = suffix_order(symbols)
        self.transform = WaveletMatrix(symbols[order - 1], n_symbols)
        self.first = np.zeros(n_symbols + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=n_symbols), out=self.first[1:])
        run_start = np.concatenate([[0], np.flatnonzero(symbols == 0)[:-1] + 1])
        place = np.arange(len(symbols)) - np.repeat(run_start, np.diff(np.append(run_start, len(symbols))))
        sampled = (place % rate == 0)[order]  # a run's start is always sampled, so no walk leaves its run
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`(pattern, first row, row behind the last)` of every pattern that occurs; a row of `patterns` is one."""
        which = np.arange(len(patterns))
        last = patterns[:, -1]
        lo, hi = self.first[last], self.first[last + 1]
        for c in range(patterns.shape[1] - 2, -1, -1):
            alive = lo < hi
            which, lo, hi = which[alive], lo[alive], hi[alive]
            symbol = patterns[which, c]
            start = self.first[symbol]
            lo, hi = start + self.transform.rank(symbol, lo), start + self.transform.rank(symbol, hi)
        alive = lo < hi
        return which[alive], lo[alive], hi[alive]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to the next sampled one."""
        out = np.empty(len(rows), np.int64)
        at, walked = np.arange(len(rows)), 0
        while len(at):
            known = self.sampled.get(rows)
            out[at[known]] = self.positions[self.sampled.before(rows[known])] + walked
            at, rows = at[~known], rows[~known]
            symbol, before = self.transform.access(rows)
            rows = self.first[symbol] + before
            walked += 1
        return out


@dataclass
class Block:
    """Distinct windows of some benchmark items, by length, over the words of those items."""

    words: pa.Array
    patterns: dict[int, np.ndarray]
    """Per window length, one row of symbols per window; symbol i + 1 is word i."""
    items: dict[int, tuple[np.ndarray, np.ndarray]]
    """Per window length, where each window's items start, and the items."""
    names: pa.Array
    """Item ids as text, distinct and sorted as strings."""


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and the text each one is in."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), _BREAKS)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    some = np.asarray(pc.binary_length(words)) > 0
    return words.filter(pa.array(some)), owner[some]


def make_block(names: list[str], texts: list[str | None], window: int = WINDOW) -> Block:
    sorted_names = sorted(set(names))
    number = {name: i for i, name in enumerate(sorted_names)}
    words, owner = words_of(pa.array(texts, pa.string()))
    coded = words.dictionary_encode()
    symbols = coded.indices.to_numpy().astype(np.int32) + 1
    size = np.bincount(owner, minlength=len(texts))
    start = np.cumsum(size) - size
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for i in np.flatnonzero(size):
        length = int(min(size[i], window))
        rows = np.lib.stride_tricks.sliding_window_view(symbols[start[i] : start[i] + size[i]], length)
        found.setdefault(length, []).append((rows, np.full(len(rows), number[names[i]])))
    patterns, items = {}, {}
    for length, parts in found.items():
        rows, which = np.unique(np.concatenate([r for r, _ in parts]), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.ravel(), np.concatenate([n for _, n in parts])]), axis=1)
        patterns[length] = rows.astype(np.int64)
        items[length] = np.searchsorted(pairs[0], np.arange(len(rows) + 1)), pairs[1]
    return Block(coded.dictionary, patterns, items, pa.array(sorted_names, pa.string()))


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers `start, start + 1, ...`, `size` of them, of every pair in a row."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def occurrences(block: Block, words: pa.Array, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per window length, `(length, window, first word)` of every occurrence in a shard's words."""
    if not block.patterns or not len(words):
        return
    symbols = np.nan_to_num(np.asarray(pc.index_in(words, block.words).to_pandas(), float), nan=-1).astype(np.int64) + 1
    known = symbols > 0
    head = known & (np.diff(owner, prepend=-1) != 0) | known & ~np.concatenate([[False], known[:-1]])
    run = np.cumsum(head) - 1
    size = np.bincount(run[known], minlength=int(head.sum()))
    long = size >= min(block.patterns)
    word = np.flatnonzero(known)
    word = word[long[run[word]]]
    if not len(word):
        return
    end = np.append(np.diff(run[word]) != 0, True)
    place = np.arange(len(word)) + np.cumsum(end) - end
    text = np.zeros(len(word) + int(end.sum()), np.int64)
    text[place] = symbols[word]
    word_at = np.zeros(len(text), np.int64)
    word_at[place] = word
    index = FmIndex(text, len(block.words) + 1)
    for length, patterns in block.patterns.items():
        window, lo, hi = index.search(patterns)
        if len(window):
            yield length, np.repeat(window, hi - lo), word_at[index.locate(ragged(lo, hi - lo))]


def list_array(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def shard_rows(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into shards of about `limit` bytes of text, or one row."""
    size = np.nan_to_num(np.asarray(pc.binary_length(batch.column(column)).to_pandas(), float))
    part = (np.cumsum(size) // limit).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def searched(batch: pa.RecordBatch, block: Block, last: bool) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """`(n_words, n_hit, items, spans)` of a shard; spans count words, after the last block characters."""
    n = batch.num_rows
    words, owner = words_of(batch.column("text"))
    size = np.bincount(owner, minlength=n)
    start = np.cumsum(size) - size
    cover = np.zeros(len(words) + 1, np.int64)
    old = batch.column("spans")
    inside = np.repeat(start, np.diff(old.offsets.to_numpy()))
    for name, sign in (("start", 1), ("end", -1)):
        np.add.at(cover, inside + old.flatten().field(name).to_numpy(), sign)
    pairs = []
    for length, window, at in occurrences(block, words, owner):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        first, items = block.items[length]
        many = first[window + 1] - first[window]
        pairs.append(np.repeat(owner[at], many) * len(block.names) + items[ragged(first[window], many)])
    found = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    row, item = np.divmod(found, max(1, len(block.names)))
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.diff(owner, prepend=-1) != 0
    begins = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
    ends = np.flatnonzero(hit & np.concatenate([edge[1:] | ~hit[1:], [True]])[: len(hit)]) + 1
    of = owner[begins]
    lo, hi = begins - start[of], ends - start[of]
    if last:
        for i in np.unique(of):
            mine = slice(*np.searchsorted(of, [i, i + 1]))
            places = [m.span() for m in _WORD.finditer(batch.column("text")[int(i)].as_py())]
            lo[mine], hi[mine] = [places[a][0] for a in lo[mine]], [places[b - 1][1] for b in hi[mine]]
    spans = pa.StructArray.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], fields=list(SPAN))
    earlier = batch.column("items")
    names = list_array(block.names.take(pa.array(item)), np.bincount(row, minlength=n))
    if len(earlier.flatten()):
        names = pa.array([sorted({*a, *b}) for a, b in zip(earlier.to_pylist(), names.to_pylist(), strict=True)], pa.list_(pa.string()))
    n_hit = np.bincount(owner[hit], minlength=n)
    return pa.array(size, pa.int64()), pa.array(n_hit, pa.int64()), names, list_array(spans, np.bincount(of, minlength=n))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """`(id, n_words, n_hit, items, spans)` of every row: its words, those inside an occurrence of a benchmark window, the ids of
    the items with occurring windows (as text, sorted as strings), and the merged spans of those words (characters
    from `start` up to `end`).

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. `window` consecutive words of an item
    are a window; an item with fewer words, but not none, is one. Null or empty text has no words; an item id may
    repeat and counts once, a null one counts as empty text; repeated rows stay, ids of documents may be null or repeat; other
    columns are not read; without documents there are no rows, without benchmark no hits.

    Each block of the benchmark holds about `block_bytes` of text, or one item, and is the only thing broadcast. With more
    than one block the texts are stored in between.
    """
    length = F.coalesce(F.octet_length("text"), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("name"), F.col("text")).where(length > 0)
    total = items.agg(F.coalesce(F.sum(length), F.lit(0)).alias("bytes")).first().bytes
    blocks = max(1, -(-total // block_bytes))
    parts = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    if blocks > 1:
        parts = stored(parts)
    rows = docs.select(
        F.col(id_column), "text", F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"),
        F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )
    kind = dict(rows.dtypes)[id_column]
    counted = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"
    for b in range(blocks):
        here = parts.where(F.col("block") == b).collect()
        sent = docs.sparkSession.sparkContext.broadcast(make_block([r.name for r in here], [r.text for r in here], window))
        last = b == blocks - 1

        def search(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in shard_rows(batch, "text", shard_bytes):
                    found = searched(shard, sent.value, last)
                    kept = [id_column] if last else [id_column, "text"]
                    yield pa.RecordBatch.from_arrays([*(shard.column(c) for c in kept), *found], [*kept, "n_words", "n_hit", "items", "spans"])

        rows = rows.mapInArrow(search, f"`{id_column}` {kind}, {counted}" if last else f"`{id_column}` {kind}, text string, {counted}")
        if not last:
            rows = stored(rows)
    return rows


def without_spans(docs: DataFrame, found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents of unique ids with the characters of their spans cut out of `text`, in all other columns as they are."""
    spans = found.select(id_column, "spans").where(F.size("spans") > 0)
    joined = docs.join(spans, id_column, "left")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.char_length("text").cast("bigint")))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    return joined.withColumn("text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))).select(*docs.columns)
