"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A batch of texts is cut into words (a run of the space mark and what follows up to the next one; no piece
holds a mark behind another character, so nothing merges across). The distinct words become one flat array of
symbols. A round finds the least pair rank of every word, merges the leftmost non-overlapping pairs of that
rank in all words at once, compacts the array and sets finished words aside; rounds end when no pair is left.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from emberline.llm.common import trimmed

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_NONE = np.iinfo(np.int32).max
CACHED_WORDS = 150_000
SLICE_BYTES = 512 << 10


class PairMap:
    """Open-addressing map from non-negative 64-bit keys to 32-bit values, looked up and filled by arrays."""

    def __init__(self, bits: int = 16):
        self.clear(bits)

    def clear(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Value per key, -1 where it is unknown."""
        out = np.full(len(keys), -1, np.int32)
        slot, at = self._slot(keys), np.arange(len(keys))
        while len(at):
            found = self.keys[slot]
            hit = found == keys
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (found != -1)
            at, keys, slot = at[on], keys[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not yet there."""
        if (self.used + len(keys)) * 2 > 1 << self.bits:
            old, kept = self.keys[self.keys != -1], self.values[self.keys != -1]
            self.clear(int(np.ceil(np.log2(4 * (len(old) + len(keys))))))
            self.put(old, kept)
        self.used += len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]  # of keys that want the same slot, one stays
            mine = self.keys[slot] == keys
            self.values[slot[mine]] = values[mine]
            keys, values, slot = keys[~mine], values[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)


class PieceModel:
    """Tables of a sentencepiece BPE model: pieces, pair ranks, byte pieces.

    Supported are models that keep the text as it is (identity normaliser, space mark put in front, no white
    space removed) and fall back to bytes; anything else raises an error.
    """

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = size = lib.get_piece_size()
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        probe = " a ﬁ  b "
        if lib.normalize(probe) != MARK + probe.replace(" ", MARK) or lib.encode("\U000e0fff", out_type=str)[-1] != "<0xBF>":
            raise ValueError("only identity-normalised BPE models with byte fallback are supported")
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(size)]
        names = [lib.id_to_piece(i) for i in range(size)]
        self.pieces = {names[i]: i for i in range(size) if not special[i]}
        if any(MARK in name.lstrip(MARK) for name in self.pieces):
            raise ValueError("a piece holds the space mark behind another character")
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        scores = np.array([lib.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)

        pairs: dict[tuple[int, int], int] = {}
        early: set[int] = set()  # pieces that can grow at once into a piece of the same or a better rank
        for name, i in self.pieces.items():
            for cut in range(1, len(name)):
                left, right = self.pieces.get(name[:cut]), self.pieces.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = i
                    early.update(p for p in (left, right) if self.rank[i] <= self.rank[p])
        keys = np.array([left << 21 | right for left, right in pairs], np.int64)
        self.pairs = PairMap(18)
        self.pairs.put(keys, np.array(list(pairs.values()), np.int32))
        self.early = np.zeros(size, bool)
        self.early[list(early)] = True

        # Characters without a piece get numbers behind the pieces; they never merge.
        self.of_char = np.arange(size, size + 0x110000, dtype=np.int32)
        for name, i in self.pieces.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i

        surface = [b"" if lib.is_control(i) else b" \xe2\x81\x87 " if lib.is_unknown(i) else names[i].replace(MARK, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            surface[i] = bytes([b])
        self.surface_at = np.concatenate([[0], np.cumsum([len(s) for s in surface])]).astype(np.int64)
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.is_byte = np.zeros(size, bool)
        self.is_byte[self.byte_ids] = True
        self.is_control = np.array([lib.is_control(i) for i in range(size)])
        self.starts_blank = np.array([n.startswith(MARK) and not s for n, s in zip(names, special, strict=True)])

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair of symbols; `_NONE` where the pair makes no piece."""
        made = self.pairs.get(left.astype(np.int64) << 21 | right)
        return np.where(made >= 0, self.rank[made], _NONE), made

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`(lengths, ids)` of the words laid end to end; every word starts with the space mark."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sym, word, size = self.of_char[flat], np.arange(len(words)), lengths
        first = np.cumsum(size) - size
        rank, made = np.full(len(sym), _NONE, np.int32), np.full(len(sym), -1, np.int32)
        self._refresh(sym, rank, made, np.arange(len(sym)), first, size)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(word):
            least = np.minimum.reduceat(rank, first)
            live = least != _NONE
            if not live.all():
                of_sym = np.repeat(live, size)
                done.append((word[~live], size[~live], sym[~of_sym]))
                sym, rank, made = sym[of_sym], rank[of_sym], made[of_sym]
                word, size, least = word[live], size[live], least[live]
                if not len(word):
                    break
                first = np.cumsum(size) - size
            at = np.flatnonzero(rank == np.repeat(least, size))
            # Neighbouring matches overlap: of a run of them, every other one merges, from the left.
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            inside = np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))
            owner = np.searchsorted(first, at, side="right") - 1
            one = np.zeros(len(word), bool)
            one[owner[self.early[made[at]]]] = True  # here only the leftmost pair is sure to come next
            chosen = np.where(one[owner], np.diff(owner, prepend=-1) != 0, inside % 2 == 0)
            at, owner = at[chosen], owner[chosen]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))
            sym, rank, made = sym[keep], rank[keep], made[keep]
            size = size - np.bincount(owner, minlength=len(word))
            first = np.cumsum(size) - size
            near = np.zeros(len(sym), bool)
            near[moved] = near[np.maximum(moved - 1, 0)] = True
            self._refresh(sym, rank, made, np.flatnonzero(near), first, size)
        return self._in_order(len(words), done)

    def _refresh(self, sym, rank, made, near, first, size) -> None:
        """Look up the pairs that begin at the symbols `near`; the last symbol of a word begins none."""
        last = np.zeros(len(sym), bool)
        last[first + size - 1] = True
        inner = near[~last[near]]
        rank[near], made[near] = _NONE, -1
        rank[inner], made[inner] = self.ranks_of(sym[inner], sym[inner + 1])

    def _in_order(self, words: int, done) -> tuple[np.ndarray, np.ndarray]:
        """The finished words in their order, characters without a piece as byte pieces."""
        number, size, sym = (np.concatenate(x) for x in zip(*done, strict=True))
        start = np.cumsum(size) - size
        order = np.argsort(number, kind="stable")
        size = size[order]
        flat = np.repeat(start[order] - (np.cumsum(size) - size), size) + np.arange(len(sym))
        sym = sym[flat]
        unknown = np.flatnonzero(sym >= self.size)
        if len(unknown):
            chars = sym[unknown] - self.size
            wide = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
            spread = np.ones(len(sym), np.int64)
            spread[unknown] = wide
            owner = np.repeat(np.arange(words), size)
            place = (np.cumsum(spread) - spread)[unknown]
            sym, size = np.repeat(sym, spread), np.bincount(np.repeat(owner, spread), minlength=words)
            for step in range(4):
                some = wide > step
                c, w, p = chars[some], wide[some], place[some] + step
                tail = 0x80 | c >> 6 * (w - 1 - step) & 0x3F
                lead = np.where(w == 1, c, np.array([0, 0, 0xC0, 0xE0, 0xF0])[w] | c >> 6 * (w - 1)) if step == 0 else tail
                sym[p] = self.byte_ids[lead]
        return size.astype(np.int64), sym.astype(np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids, as the library's decode gives it; an id out of range raises."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("id out of range")
        inner = np.flatnonzero(~self.is_control[ids])
        if not len(inner):
            return ""
        whole = not self.is_control[ids[inner[0] : inner[-1] + 1]].any()
        ids = ids[inner[0] : inner[-1] + 1]
        size = (self.surface_at[ids + 1] - self.surface_at[ids]).astype(np.int64)
        flat = np.repeat(self.surface_at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        data = self.surface[flat].tobytes()[1 if self.starts_blank[ids[0]] else 0 :]
        if whole:
            try:
                return data.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_slowly(ids)

    def _decode_slowly(self, ids: np.ndarray) -> str:
        """Byte pieces that form no character become U+FFFD each; runs of byte pieces are judged one by one."""
        out, run, begun = [], bytearray(), False
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.surface[self.surface_at[i] : self.surface_at[i + 1]].tobytes()
                continue
            while run:
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:width]).decode())
                        del run[:width]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    del run[:1]
                begun = True
            if i < 0 or self.is_control[i]:
                continue
            text = self.surface[self.surface_at[i] : self.surface_at[i + 1]].tobytes().decode()
            out.append(text[1:] if not begun and self.starts_blank[i] else text)
            begun = True
        return "".join(out)


@functools.lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    """The tables of a model file, loaded once per Python worker."""
    return PieceModel(path)


def words_of(text: str) -> list[str]:
    """The words of a text, each without its first space mark; none for an empty text."""
    if not text:
        return []
    parts = text.split(" ")
    if MARK not in text and "" not in parts[:-1]:
        return parts
    return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]


class WordTable:
    """Results per distinct word, kept over batches: `solve(words)` gives `(lengths, values)`."""

    def __init__(self, solve):
        self.solve = solve
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.size, self.values = np.zeros(0, np.int64), np.zeros(0)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words; words not met before are solved together."""
        missing = list(set(words).difference(self.index))
        if len(missing) + len(self.index) > CACHED_WORDS and self.index:
            self.clear()
            missing = list(set(words))
        if missing:
            size, values = self.solve([MARK + w for w in missing])
            self.index.update(zip(missing, range(len(self.index), len(self.index) + len(missing)), strict=True))
            self.size = np.concatenate([self.size, size])
            self.values = np.concatenate([self.values, values]) if len(self.values) else values
            self.start = np.cumsum(self.size) - self.size
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`(lengths, values)` of rows laid end to end."""
        size = self.size[rows]
        flat = np.repeat(self.start[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return size, self.values[flat]


@functools.lru_cache(maxsize=4)
def encoded_words(path: str) -> WordTable:
    """The words a Python worker has encoded so far; a full table starts anew."""
    return WordTable(model(path).encode_words)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about `SLICE_BYTES` of text, or one row."""
    texts = batch.column(column)
    size = np.nan_to_num(np.asarray(pc.binary_length(texts).to_pandas(), float))
    part = (np.cumsum(size) // SLICE_BYTES).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def batch_words(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """All words of the texts in a row, and how many each text has."""
    lists = [words_of(t or "") for t in texts]
    return [w for words in lists for w in words], np.fromiter(map(len, lists), np.int64, len(lists))


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, id_column: str, text_column: str) -> Iterator[pa.RecordBatch]:
    tables = model(path)
    words = encoded_words(path)
    for batch in batches:
        for part in slices(batch, text_column):
            flat, counts = batch_words(part.column(text_column).to_pylist())
            size, ids = words.gather(words.look_up(flat)) if flat else (np.zeros(0, np.int64), np.zeros(0, np.int32))
            end = np.cumsum(sums(size, counts))
            data = ids.astype("<u4", copy=False)
            bos, eos = (np.array([i], "<u4").tobytes() for i in (tables.bos, tables.eos))
            rows = [b"".join((bos, data[lo:hi].tobytes(), eos)) for lo, hi in zip([0, *end[:-1].tolist()], end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(id_column), pa.array(rows, pa.binary())], [id_column, "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, id_column: str) -> Iterator[pa.RecordBatch]:
    tables = model(path)
    for batch in batches:
        for part in slices(batch, "ids"):
            texts = [tables.decode(np.frombuffer(ids or b"", "<u4").astype(np.int64)) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [id_column, "ids", "text"])


def encode_pieces(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(id, ids)`: the piece ids of each whole text with begin and end ids, as little-endian unsigned 32-bit integers.

    A null or empty text has the begin and end ids alone; the id column may hold nulls and repeats; other columns
    are not read; an empty table gives no rows. `path` must be readable on every executor.
    """
    source = docs.select(id_column, text_column)
    schema = f"{id_column} {dict(source.dtypes)[id_column]}, ids binary"
    return source.mapInArrow(trimmed(lambda batches: _encoded(batches, path, id_column, text_column)), schema)


def decode_pieces(encoded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """`(id, ids, text)`: the text of each row of `ids`; begin, end and other control ids leave no text, null ids give ''."""
    source = encoded.select(id_column, "ids")
    schema = f"{id_column} {dict(source.dtypes)[id_column]}, ids binary, text string"
    return source.mapInArrow(trimmed(lambda batches: _decoded(batches, path, id_column)), schema)


def encode_and_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`decode_pieces` of `encode_pieces` in one Python worker per task, not two that hold the tables and the ids each."""
    source = docs.select(id_column, text_column)
    schema = f"{id_column} {dict(source.dtypes)[id_column]}, ids binary, text string"
    return source.mapInArrow(trimmed(lambda batches: _decoded(_encoded(batches, path, id_column, text_column), path, id_column)), schema)
