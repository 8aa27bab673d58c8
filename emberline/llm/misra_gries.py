"""Frequent phrases and their collocation scores: Misra-Gries summaries per hash partition, then an exact second pass.

1. Words are counted per language, and the occurrences of phrases per cell of their hash. A phrase with a rarer word than the
   threshold cannot be frequent itself; a bitmap of fixed size keeps those words out (a clash only lets one in).
2. Phrases are hashed and summed per task, and their hashes go to hash partitions, each a run of cells. A
   partition's summary holds more counters than its mass divided by the threshold: when it overflows, all counters drop by the
   largest one beyond the capacity, which costs a phrase less than the threshold in all. So every frequent phrase survives.
   Summaries of one partition can be merged and keep that bound. This is done for pairs of words first, then for the longer
   phrases all of whose pairs survived.
3. Survivors set bits in bitmaps of fixed size. The second pass counts the phrases they let through, as texts, exactly.

Only the bitmaps and a number per cell come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import stored
from emberline.llm.fm_decontam import list_array, shard_rows
from emberline.session import shuffle_width

MOST_WORDS = 5
THRESHOLD = 100
TOP = 2_000
CELL_BITS = 14
WORD_BITS = 24
PHRASE_BITS = 27
PARTITION_MASS = 25_000_000
SPARE = 8
"""Counters per mass divided by the threshold; the guarantee needs 1, more of them let fewer rare phrases through."""
SLICE_BYTES = 4 << 20
FLUSH_ENTRIES = 1 << 21
ROW_ENTRIES = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ code >> np.uint64(31)) * _STEP
    return (code ^ code >> np.uint64(29)) * _MIX


class Words:
    """The words of a slice of documents, in a row."""

    def __init__(self, batch: pa.RecordBatch):
        text = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
        text = pc.replace_substring_regex(text, "[.,;:!?\\x0A-\\x0D]+", " \n ")
        lists = pc.split_pattern_regex(text, "[\\x20\\x09]+")
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        tokens = lists.flatten()
        some = np.asarray(pc.binary_length(tokens)) > 0
        coded, owner = tokens.filter(pa.array(some)).dictionary_encode(), owner[some]
        self.names: pa.Array = coded.dictionary
        token = coded.indices.to_numpy()
        stop = self.names.index("\n").as_py()
        stops = token == stop
        piece = (np.cumsum(stops) + owner)[~stops]
        self.word = token[~stops]
        langs = pc.fill_null(batch.column("lang").cast(pa.string()), "und").dictionary_encode()
        self.lang_names: list[str] = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[owner[~stops]]
        end = np.append(piece[1:] != piece[:-1], True) if len(piece) else np.zeros(0, bool)
        last = np.flatnonzero(end)
        #: How many words of the piece are left from each word on.
        self.left = np.repeat(last + 1, np.diff(np.concatenate([[-1], last]))) - np.arange(len(piece))
        code, lang_code = text_codes(self.names.to_pylist()), text_codes(self.lang_names)
        self.code = mixed(code[self.word] + lang_code[self.lang] * _MIX) if len(self.word) else np.zeros(0, np.uint64)

    def phrases(self, most: int, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """`(words, first word, hash)` of all phrases of 2 to `most` words that lie in what `left` allows."""
        start = np.arange(len(self.word))
        code = self.code
        for words in range(2, most + 1):
            fits = left[start] >= words
            start, code = start[fits], code[fits]
            code = mixed(code * _MIX + self.code[start + words - 1])
            yield words, start, code

    def up_to(self, stops: np.ndarray) -> np.ndarray:
        """How many places there are from each word to the next stop."""
        every = np.arange(len(self.word))
        return np.append(stops, len(self.word))[np.searchsorted(stops, every)] - every

    def frequent_left(self, bitmap: np.ndarray) -> np.ndarray:
        """How many words of the piece are left up to the first one that the bitmap does not hold."""
        return np.minimum(self.left, self.up_to(np.flatnonzero(~in_bitmap(bitmap, self.code))))

    def paired_left(self, frequent: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """How many are left up to the first pair that the second bitmap does not hold, its first word included."""
        (_, start, code) = next(self.phrases(2, self.frequent_left(frequent)))
        alone = np.ones(len(self.word), bool)
        alone[start[in_bitmap(pairs, code)]] = False
        return self.up_to(np.flatnonzero(alone)) + 1


def text_codes(texts: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(texts, object), categorize=False)


def in_bitmap(bitmap: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set; its highest bits number the bit."""
    at = code >> np.uint64(64 - (len(bitmap) * 64).bit_length() + 1)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(codes: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of 2^bits bits of a table of hashes `code`: the driver gets one row per 64 bits at most."""
    place = F.shiftrightunsigned("code", 64 - bits)
    words = codes.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(code, {64 - bits}) & 63 as int))")).alias("word"))
    found = words.toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return out.view(np.uint64)


class Summary:
    """A Misra-Gries summary: at most `capacity` hashes with counters, each at most `lost` below its true count."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        over = len(self.keys) - self.capacity
        if over > 0:
            drop = int(np.partition(self.counts, over - 1)[over - 1])  # the largest counter beyond the capacity
            stays = self.counts > drop
            self.keys, self.counts = self.keys[stays], self.counts[stays] - drop
            self.lost += drop

    def merge(self, other: Summary) -> None:
        self.add(other.keys, other.counts)
        self.lost += other.lost

    def frequent(self, threshold: int) -> np.ndarray:
        """All hashes that can have `threshold` occurrences."""
        return self.keys[self.counts + self.lost >= threshold]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for part in shard_rows(batch, "text", SLICE_BYTES):
            yield Words(part)


def count_words(docs: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """`(lang, word, cell, n)`: words per language, and in rows without a word the phrases per cell of their hash: first the
    cells of pairs, then those of longer phrases."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << CELL_BITS
        mass = np.zeros(2 * cells, np.int64)
        names = ["lang", "word", "cell", "n"]
        for words in slices(batches):
            pair = words.lang.astype(np.int64) * max(1, len(words.names)) + words.word
            _, at, n = np.unique(pair, return_index=True, return_counts=True)
            langs = pa.array(words.lang_names, pa.string()).take(pa.array(words.lang[at]))
            yield pa.RecordBatch.from_arrays([langs, words.names.take(pa.array(words.word[at])), pa.nulls(len(at), pa.int32()), pa.array(n, pa.int64())], names)
            for size, _, code in words.phrases(most_words, words.left):
                mass += np.bincount((code >> np.uint64(64 - CELL_BITS)).astype(np.int64) + (size > 2) * cells, minlength=len(mass))
        some = np.flatnonzero(mass)
        none = pa.nulls(len(some), pa.string())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(some, pa.int32()), pa.array(mass[some], pa.int64())], names)

    found = docs.select("text", "lang").mapInArrow(counted, "lang string, word string, cell int, n bigint")
    return found.groupBy("lang", "word", "cell").agg(F.sum("n").alias("n"))


def word_codes(words: DataFrame) -> DataFrame:
    """`(code)`: the hash of each `(lang, word)`, as in the texts."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = mixed(text_codes(batch.column("word").to_pylist()) + text_codes(batch.column("lang").to_pylist()) * _MIX)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64), pa.int64())], ["code"])

    return words.select("lang", "word").mapInArrow(coded, "code bigint")


KEY_BITS = 48


def packed(part_of: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, bytes, bytes]]:
    """Sorted keys of `KEY_BITS` bits as rows `(part, first key, gaps, counts)` of `ROW_ENTRIES` keys of one part at most.

    Gaps take 32 bits each; a row with a wider one has its keys whole, 64 bits each.
    """
    part = part_of[(keys >> np.uint64(KEY_BITS - CELL_BITS)).astype(np.int64)]
    place = np.arange(len(part)) - np.searchsorted(part, part)
    cuts = np.append(np.flatnonzero(place % ROW_ENTRIES == 0), len(part))
    gaps = np.diff(keys, prepend=np.uint64(0))
    gaps[cuts[:-1]] = 0
    wide = np.add.reduceat((gaps >> np.uint64(32)).astype(np.int64), cuts[:-1]) > 0
    short, counts = gaps.astype(np.uint32), counts.astype(np.int32)
    return [
        (int(part[a]), int(keys[a]), keys[a:b].tobytes() if w else short[a:b].tobytes(), counts[a:b].tobytes())
        for a, b, w in zip(cuts, cuts[1:], wide, strict=False)
    ]


def unpacked(first: int, gaps: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(counts, np.int32).astype(np.int64)
    if len(gaps) == 8 * len(n):
        return np.frombuffer(gaps, np.uint64), n
    return np.cumsum(np.frombuffer(gaps, np.uint32), dtype=np.uint64) + np.uint64(first), n


def partitions(docs: DataFrame, mass: np.ndarray, partition_mass: int = PARTITION_MASS) -> int:
    return int(min(len(mass), max(shuffle_width(docs.sparkSession), -(-int(mass.sum()) // partition_mass))))


def survivors(docs: DataFrame, mass: np.ndarray, threshold: int, phrase_codes, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """`(code)`: the hash, cut to `KEY_BITS` bits, of all phrases that can have `threshold` occurrences, and of some others.

    `phrase_codes` gives the hashes of a slice's phrases, `mass` at least how many fall into each cell.
    """
    parts = partitions(docs, mass, partition_mass)
    part_of = np.arange(len(mass)) * parts // len(mass)
    capacity = SPARE * np.bincount(part_of, mass, parts).astype(np.int64) // threshold + 1
    cut = np.uint64(64 - KEY_BITS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows = packed(part_of, *summed(*(np.concatenate(c) for c in zip(*pending, strict=True))))
            pending.clear()
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], ["part", "first", "gaps", "counts"])

        for words in slices(batches):
            code = phrase_codes(words) >> cut
            if len(code):
                pending.append(summed(code, np.ones(len(code), np.int64)))
            if sum(len(k) for k, _ in pending) > FLUSH_ENTRIES:
                yield flush()
        if pending:
            yield flush()

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Summary] = {}
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def add(part: int) -> None:
            found.setdefault(part, Summary(int(capacity[part]))).add(*(np.concatenate(c) for c in zip(*waiting.pop(part), strict=True)))

        for batch in batches:
            for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "gaps", "counts")), strict=True):
                waiting.setdefault(part, []).append(unpacked(*row))
                if len(waiting[part]) * ROW_ENTRIES > FLUSH_ENTRIES // 2:
                    add(part)
        for part in list(waiting):
            add(part)
        for summary in found.values():
            yield pa.RecordBatch.from_arrays([pa.array((summary.frequent(threshold) << cut).view(np.int64), pa.int64())], ["code"])

    rows = docs.select("text", "lang").mapInArrow(hashed, "part int, first bigint, gaps binary, counts binary")
    return rows.repartition(parts, "part").mapInArrow(summarised, "code bigint")


def merged(tables: list[pa.Table]) -> pa.Table:
    """`(lang, phrase, n)` with one row per phrase."""
    found = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
    return found.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"]).combine_chunks()


def blocks(table: pa.Table, parts: int) -> pa.RecordBatch:
    """The rows packed by part and language: `(part, lang, phrases, counts)`, `ROW_ENTRIES` phrases in a block at most."""
    part = (text_codes(table.column("phrase").to_pylist()) % np.uint64(parts)).astype(np.int64)
    lang = table.column("lang").combine_chunks().dictionary_encode()
    group = part * max(1, len(lang.dictionary)) + lang.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    group = group[order]
    place = np.arange(len(group)) - np.searchsorted(group, group)
    first = np.flatnonzero(place % ROW_ENTRIES == 0)
    sizes = np.diff(np.append(first, len(group)))
    rows = table.take(pa.array(order)).combine_chunks()
    phrases, counts = (list_array(rows.column(c).combine_chunks(), sizes) for c in ("phrase", "n"))
    return pa.RecordBatch.from_arrays([pa.array(part[order][first], pa.int32()), rows.column("lang").combine_chunks().take(pa.array(first)), phrases, counts], ["part", "lang", "phrases", "counts"])


def exact_counts(docs: DataFrame, frequent, wanted, most_words: int, threshold: int = 1, parts: int = 1) -> DataFrame:
    """`(lang, phrase, a)`: all occurrences of every phrase that the bitmaps of words and of phrases let through, if there are
    `threshold` of them.

    Tasks send their sums in blocks; a task that receives them holds one row per phrase of its parts, no more than those
    parts' mass divided by the threshold but for the rare ones that the bitmaps let in.
    """
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []
        for words in slices(batches):
            names = words.names
            for size, start, code in words.phrases(most_words, words.frequent_left(frequent.value)):
                some = in_bitmap(wanted.value, code)
                start, code = start[some], code[some]
                if not len(start):
                    continue
                _, first, which, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                first = start[first]
                other = words.lang[start] != words.lang[first[which]]
                for j in range(size):
                    other |= words.word[start + j] != words.word[first[which] + j]
                if other.any():  # another phrase of the same hash counts by itself
                    n = n - np.bincount(which[other], minlength=len(n))
                    first, n = np.concatenate([first, start[other]]), np.concatenate([n, np.ones(int(other.sum()), n.dtype)])
                texts = pc.binary_join_element_wise(*(names.take(pa.array(words.word[first + j])) for j in range(size)), " ")
                langs = pa.array(words.lang_names, pa.string()).take(pa.array(words.lang[first]))
                pending.append(pa.Table.from_arrays([langs, texts, pa.array(n, pa.int64())], schema=schema))
            if sum(map(len, pending)) > FLUSH_ENTRIES // 4:
                pending = [merged(pending)]
                if len(pending[0]) > FLUSH_ENTRIES // 8:
                    yield blocks(pending.pop(), parts)
        if pending:
            yield blocks(merged(pending), parts)

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        new = 0
        for batch in batches:
            phrases, counts = batch.column("phrases"), batch.column("counts")
            langs = batch.column("lang").take(pa.array(np.repeat(np.arange(len(phrases)), np.diff(phrases.offsets.to_numpy()))))
            held.append(pa.Table.from_arrays([langs, phrases.flatten(), counts.flatten()], schema=schema))
            new += len(langs)
            if new > FLUSH_ENTRIES // 2:
                held, new = [merged(held)], 0
        if held:
            rows = merged(held)
            yield from rows.filter(pc.greater_equal(rows.column("n"), threshold)).rename_columns(["lang", "phrase", "a"]).to_batches()

    found = docs.select("text", "lang").mapInArrow(counted, "part int, lang string, phrases array<string>, counts array<bigint>")
    return found.repartition(parts, "part").mapInArrow(collected, "lang string, phrase string, a bigint")


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`((lang, phrase, a), (lang, phrase, a), (lang, n))`: phrases of 2 to `most_words` words with at least `threshold`
    occurrences, such words, and all word occurrences per language."""
    context = docs.sparkSession.sparkContext
    counts = stored(count_words(docs, most_words))
    words = counts.where("word is not null")
    mass = np.zeros(2 << CELL_BITS, np.int64)
    for r in counts.where("word is null").select("cell", "n").collect():
        mass[r.cell] = r.n
    common = words.where(F.col("n") >= threshold)
    frequent = context.broadcast(bitmap_of(word_codes(common), WORD_BITS))

    def pair_codes(words: Words) -> np.ndarray:
        return next(words.phrases(2, words.frequent_left(frequent.value)))[2]

    def longer_codes(words: Words) -> np.ndarray:
        left = words.paired_left(frequent.value, pairs.value)
        return np.concatenate([np.zeros(0, np.uint64), *(code for size, _, code in words.phrases(most_words, left) if size > 2)])

    some = bitmap_of(survivors(docs, mass[: 1 << CELL_BITS], threshold, pair_codes), PHRASE_BITS)
    pairs = context.broadcast(some)
    more = bitmap_of(survivors(docs, mass[1 << CELL_BITS :], threshold, longer_codes), PHRASE_BITS)
    wanted = context.broadcast(some | more)
    phrases = stored(exact_counts(docs, frequent, wanted, most_words, threshold, partitions(docs, mass)))
    return phrases, common.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")), words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, most_words: int = MOST_WORDS, top: int = TOP) -> DataFrame:
    """The `top` phrases of each language by score: `(lang, rank, phrase, a, l, r, n, score)`.

    Text is lower-cased (A-Z), cut at `.,;:!?` and line breaks into pieces, and these at blanks and tabs into words; a phrase is 2 to
    `most_words` neighbouring words of a piece that occur `threshold` times in the language. Its score is the least
    `floor(1000 * a * n / (l * r))` over its cuts in two (ties to the shorter first part), in exact decimals: `a` its
    occurrences, `l` and `r` those of the parts, `n` all words. A phrase that lies in a longer one with as many occurrences is
    left out. Equal scores order by `a`, then by the phrase's bytes.

    Null text is empty, a null language `und`; repeated rows count each time; ids and other columns are not read; empty tables and
    languages without frequent phrases give no rows.
    """
    phrases, words, totals = frequent_phrases(docs, threshold, most_words)
    parts = F.split("phrase", " ")
    counted = phrases.unionByName(words)

    def part(name: str, at: str, size: str):
        return F.expr(f"array_join(slice(w, {at}, {size}), ' ')").alias(name)

    cuts = phrases.withColumn("w", parts).select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part("first", "1", "k"), part("rest", "k + 1", "size(w) - k"))
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    exact = "cast(1000 * cast(a as decimal(38,0)) * n as decimal(38,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    longer = phrases.withColumn("w", parts).where("size(w) > 2")
    inner = longer.select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("at"))
    covers = inner.select("lang", part("phrase", "at", "size"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    open_ = best.join(covers, ["lang", "phrase"], "left").where("cover is null or cover < a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = open_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
