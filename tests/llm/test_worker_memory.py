import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from emberline.llm import bwt_dedup, common, jaccard_join, nbsvm, piece_bpe, queries


def held() -> int:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4


def test_freed_memory_goes_back():
    """Blocks freed between blocks still in use stay with the allocator until they are handed back."""
    blocks = [bytes(4_000) for _ in range(40_000)]
    del blocks[::2], blocks[: len(blocks) // 2]
    kept = blocks[::50]
    del blocks
    before = held()
    common.hand_back()
    assert held() < before - 20_000 and len(kept)


@pytest.mark.parametrize("name", ["quality", "prefixes", "passages", "tokens"])
def test_workers_hand_back_when_a_task_ends(spark, documents, monkeypatch, name):
    docs, functions, calls = documents([(1, "some words of a text"), (2, None)]), [], []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: functions.append(run) or plain(df, run, schema))
    model = np.zeros(2 * (1 << nbsvm.BITS) + 3, np.float32)
    {
        "quality": lambda: nbsvm.score(docs, model),
        "prefixes": lambda: jaccard_join.prefixes(docs, "doc_id", 5, 80, np.zeros(1 << jaccard_join.COUNT_BITS, np.uint8), 4),
        "passages": lambda: bwt_dedup.removals(docs, width=corpus_pipeline.PASSAGE_BYTES),
        "tokens": lambda: piece_bpe.encode_and_decode(docs, queries.piece_model()),
    }[name]()
    monkeypatch.setattr(common, "hand_back", lambda: calls.append(1))
    assert functions
    for run in functions:
        assert not list(run(iter(()))) and calls.pop() == 1
    batch = pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "some words", "key": b"k", "marks": None, "asked": []}])
    for run in functions[:1]:
        assert list(run(iter([batch]))) and calls == [1]
