"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The BPE pieces of a word are the one sequence in which every piece, encoded alone, stays itself, and every two
neighbours, encoded together, stay as they are. So the last piece of each prefix is the one piece that ends
there and agrees with the last piece of the shorter prefix before it, and the count is that prefix's count plus
one: one pass over the characters of a word. Counts of a text are those of its words added up. Truncation and
budget questions then read the stored counts and never encode again.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.piece_bpe import PairMap, PieceModel, WordTable, batch_words, model, slices

CACHED_PAIRS = 2_000_000


class PrefixCounter:
    """Piece counts of all prefixes of words, for one model. Shared prefixes of a batch are solved once."""

    def __init__(self, tables: PieceModel):
        self.tables = tables
        names = list(tables.pieces)
        whole, _ = tables.encode_words(names)
        # Pieces that encode to themselves, the only ones an encoding can hold, spelled from their last character.
        self.child, self.piece = PairMap(18), [-1]
        nodes: dict[tuple[int, int], int] = {}
        for name, n in zip(names, whole.tolist(), strict=True):
            at = 0
            for c in reversed(name) if n == 1 else ():
                step = (at, ord(c))
                if step not in nodes:
                    nodes[step] = len(self.piece)
                    self.piece.append(-1)
                at = nodes[step]
            if n == 1:
                self.piece[at] = tables.pieces[name]
        self.piece = np.array(self.piece, np.int32)
        steps = np.array([at << 21 | c for at, c in nodes], np.int64)
        self.child.put(steps, np.array(list(nodes.values()), np.int32))
        self.text = {i: name for name, i in tables.pieces.items()}
        self.agree = PairMap()

    def agrees(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two pieces stay apart when their texts are encoded together."""
        keys = left.astype(np.int64) << 21 | right
        known = self.agree.get(keys)
        if (known < 0).any():
            new = np.unique(keys[known < 0])
            if self.agree.used + len(new) > CACHED_PAIRS:
                self.agree.clear(16)
                new = np.unique(keys)
            l, r = new >> 21, new & (1 << 21) - 1
            size, ids = self.tables.encode_words([self.text[a] + self.text[b] for a, b in zip(l.tolist(), r.tolist(), strict=True)])
            start = np.cumsum(size) - size
            end = start + size - 1
            self.agree.put(new, ((size == 2) & (ids[start] == l) & (ids[end] == r)).astype(np.int32))
            known = self.agree.get(keys)
        return known == 1

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`(lengths, counts)`: the counts of the prefixes of 1, 2, ... characters of each word, laid end to end."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        start = np.cumsum(size) - size
        total = len(flat) + 1
        parent, char = np.zeros(total, np.int64), np.zeros(total, np.int64)
        last, count = np.full(total, -1, np.int64), np.zeros(total, np.int32)
        out = np.zeros(len(flat), np.int32)
        made, live, node = 1, np.arange(len(words)), np.zeros(len(words), np.int64)
        for depth in range(int(size.max()) if len(words) else 0):
            on = size[live] > depth
            live, node = live[on], node[on]
            steps, node = np.unique(node << 21 | flat[start[live] + depth], return_inverse=True)
            new = np.arange(made, made + len(steps))
            parent[new], char[new] = steps >> 21, steps & (1 << 21) - 1
            self._extend(new, parent, char, last, count)
            node = node + made
            made += len(steps)
            out[start[live] + depth] = count[node]
        return size, out

    def _extend(self, new, parent, char, last, count) -> None:
        """Find the last piece of each new prefix among the pieces that end there, the shortest first."""
        open_, at, state = new, new, np.zeros(len(new), np.int64)
        while len(open_):
            state = self.child.get(state << 21 | char[at])
            on = state >= 0
            open_, at, state = open_[on], parent[at[on]], state[on].astype(np.int64)
            piece = self.piece[state].astype(np.int64)
            ends = piece >= 0
            fits = ends & (last[at] < 0)
            ask = np.flatnonzero(ends & ~fits)
            if len(ask):
                fits[ask] = self.agrees(last[at[ask]], piece[ask])
            last[open_[fits]], count[open_[fits]] = piece[fits], count[at[fits]] + 1
            on = ~fits & (at > 0)
            open_, at, state = open_[on], at[on], state[on]
        # A character without a piece: as many byte pieces as it has bytes, and nothing merges with it.
        rest = new[last[new] < 0]
        c = char[rest]
        count[rest] = count[parent[rest]] + 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(model(path))


@functools.lru_cache(maxsize=4)
def counted_words(path: str) -> WordTable:
    """The words whose prefixes a Python worker has counted so far; a full table starts anew."""
    return WordTable(counter(path).solve)


def prefix_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(id, n_bytes, prefix_tokens)`: entry i of the array is the token count of the first i characters.

    The array has one entry more than the text has characters (code points); its last entry counts the whole
    text. No begin, end or added tokens. A null or empty text has the array [0]; ids may be null or repeat;
    other columns are not read; an empty table gives no rows. `path` must be readable on every executor.
    """
    source = docs.select(id_column, text_column)
    schema = f"{id_column} {dict(source.dtypes)[id_column]}, n_bytes bigint, prefix_tokens array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counted_words(path)
        for batch in batches:
            for part in slices(batch, text_column):
                texts = part.column(text_column).to_pylist()
                flat, of_text = batch_words(texts)
                size, values = words.gather(words.look_up(flat)) if flat else (np.zeros(0, np.int64), np.zeros(0, np.int32))
                # The count before a word: what all words up to it add up to, less what earlier texts had.
                ends = np.cumsum(size)
                totals = np.concatenate([[0], np.cumsum(values[ends - 1].astype(np.int64) if len(ends) else [])]).astype(np.int64)
                first = np.cumsum(of_text) - of_text
                before = totals[:-1] - np.repeat(totals[first], of_text)
                values = values + np.repeat(before, size).astype(np.int32)
                chars = np.concatenate([[0], ends])[np.cumsum(of_text)] - np.concatenate([[0], ends])[first]
                chars = np.maximum(chars, 1)  # an empty text keeps its entry for the empty prefix
                out = np.zeros(int(chars.sum()), np.int32)
                filled = np.repeat(of_text > 0, chars)
                out[filled] = values
                starts = np.cumsum(chars) - chars
                out[starts] = 0  # the empty prefix, where the first word's mark alone stands
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(out)).astype(np.int32)), pa.array(out))
                n_bytes = pa.array([len((t or "").encode()) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(id_column), n_bytes, lists], [id_column, "n_bytes", "prefix_tokens"])

    return source.mapInArrow(run, schema)


def tokens_in(prefix_tokens: Column | str = "prefix_tokens", chars: Column | None = None) -> Column:
    """Token count of the whole text, or of its first `chars` characters (no more than it has)."""
    counts = F.col(prefix_tokens) if isinstance(prefix_tokens, str) else prefix_tokens
    last = F.size(counts)
    return F.element_at(counts, last if chars is None else F.least(chars + 1, last)).cast("bigint")


def longest_prefix(budget: Column | int, prefix_tokens: str = "prefix_tokens") -> Column:
    """Characters of the longest prefix with at most `budget` tokens (counts may fall when a character completes a piece)."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    return F.aggregate(
        prefix_tokens,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("best")),
        lambda state, n: F.struct((state["at"] + 1).alias("at"), F.when(n <= limit, state["at"]).otherwise(state["best"]).alias("best")),
        lambda state: state["best"],
    )
