"""Tokens, repeated strings, near copies and mixing against plain programs."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

from emberline.llm import bwt_dedup, jaccard_join, piece_bpe, queries, source_mix, token_counts

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


def odd_texts(n=4_000):
    draw = random.Random(3)
    parts = ["a", "the", " ", "  ", "▁", "\n", "é", "梦", "\U0001f600", "<s>", "aaaa", " the", "ing", "000", "▁▁▁", "     ", "\t", "----", "\x00", "ﬁ"]
    return ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(n)] + ["a" * 3_000, " " * 333, "-" * 700, "ab" * 900]


def test_pieces_equal_the_library():
    model, texts = piece_bpe.model(queries.piece_model()), odd_texts()
    table = piece_bpe.WordTable(model.encode_words)
    flat, counts = piece_bpe.batch_words(texts)
    size, ids = table.gather(table.look_up(flat))
    end = np.cumsum(piece_bpe.sums(size, counts))
    for text, lo, hi in zip(texts, [0, *end[:-1].tolist()], end.tolist(), strict=True):
        assert ids[lo:hi].tolist() == LIBRARY.encode(text), text[:80]


def test_decoding_equals_the_library_for_any_ids():
    model, draw = piece_bpe.model(queries.piece_model()), random.Random(4)
    some = [0, 1, 2, 3 + 0xE2, 3 + 0x82, 3 + 0xAC, 3 + 0xF0, 264, 259, 28705, 300, 3 + 65]
    for _ in range(3_000):
        ids = [draw.choice(some) for _ in range(draw.randint(0, 8))]
        assert model.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids), ids


def test_encoded_and_decoded_rows(odd_documents, no_documents):
    path = queries.piece_model()
    rows = piece_bpe.decode_pieces(piece_bpe.encode_pieces(odd_documents, path), path).collect()
    texts = Counter((r.doc_id, r.text or "") for r in odd_documents.collect())
    assert Counter((r.doc_id, LIBRARY.decode(LIBRARY.encode(r.text))) for r in rows) == Counter({(i, LIBRARY.decode(LIBRARY.encode(t))): n for (i, t), n in texts.items()})
    expected = Counter((i, tuple([1, *LIBRARY.encode(t), 2])) for (i, t), n in texts.items() for _ in range(n))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == expected
    assert piece_bpe.encode_pieces(no_documents, path).count() == 0


def test_counts_at_every_prefix(documents):
    texts = odd_texts(150)[:150] + ["", None]
    rows = token_counts.prefix_counts(documents(list(enumerate(texts))), queries.piece_model()).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.prefix_tokens == [len(LIBRARY.encode(text[:i])) for i in range(len(text) + 1)]
        assert r.n_bytes == len(text.encode())


def test_budgets_are_answered_from_the_stored_counts(documents):
    text = "the quick brown fox jumps over the lazy dog again and again"
    counted = token_counts.prefix_counts(documents([(1, text)]), queries.piece_model())
    row = counted.select(token_counts.longest_prefix(5).alias("five"), token_counts.tokens_in(chars=F.lit(9)).alias("nine"), token_counts.tokens_in().alias("all")).first()
    assert row.five == max(i for i in range(len(text) + 1) if len(LIBRARY.encode(text[:i])) <= 5)
    assert (row.nine, row["all"]) == (len(LIBRARY.encode(text[:9])), len(LIBRARY.encode(text)))


def test_counts_of_odd_rows(odd_documents, no_documents):
    rows = token_counts.prefix_counts(odd_documents, queries.piece_model()).select("doc_id", token_counts.tokens_in().alias("n")).collect()
    assert Counter((r.doc_id, r.n) for r in rows) == Counter((r.doc_id, len(LIBRARY.encode(r.text or ""))) for r in odd_documents.collect())
    assert token_counts.prefix_counts(no_documents, queries.piece_model()).count() == 0


def repeats(texts, width):
    """Remaining bytes of each text, by counting every string of `width` bytes."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = True
        out.append(np.frombuffer(d, np.uint8)[~gone].tobytes())
    return out


def passages(seed=5, n=60):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghé", k=draw.randint(1, 9)))
    shared = [" ".join(word() for _ in range(draw.randint(60, 200))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(draw.randint(0, 120)))]
        for _ in range(draw.randint(0, 3)):
            s = draw.choice(shared)
            lo = draw.randint(0, len(s) // 3)
            parts += [s[lo : draw.randint(lo, len(s))], " ".join(word() for _ in range(draw.randint(0, 60)))]
        texts.append(draw.choice(["", " "]).join(parts))
    return [*texts, texts[0], "ab " * 500, "xyzab " + "ab " * 150, "", None, shared[0]]


@pytest.mark.parametrize("hot", [4_096, 1])
def test_repeated_strings_equal_brute_force(documents, hot):
    texts = passages()
    rows = bwt_dedup.removals(documents(list(enumerate(texts))), hot_segments=hot).collect()
    expected = repeats(texts, bwt_dedup.WIDTH)
    for r in rows:
        assert bytes(r.kept) == expected[r.doc_id]
        assert r.n_bytes - sum(s.end - s.start for s in r.spans) == len(r.kept)
    assert any(len(expected[i]) < len((t or "").encode()) for i, t in enumerate(texts))


def test_merged_transforms_equal_one_sorted_list():
    draw = random.Random(6)
    texts = ["".join(draw.choices("ab", k=draw.randint(8, 40))).encode() for _ in range(30)]
    seen = Counter(t[i : i + 8] for t in texts for i in range(len(t) - 7))
    for shards in (1, 3, 7):
        flags = bwt_dedup.repeated_starts(texts, np.ones(len(texts)), width=8, stride=2, shards=shards)
        assert [f.tolist() for f in flags] == [[seen[t[i : i + 8]] > 1 for i in range(len(t) - 7)] for t in texts]


@pytest.mark.parametrize("most", [1, 40, 100, 10_000])
def test_portions_keep_representatives_whole(monkeypatch, most):
    monkeypatch.setattr(bwt_dedup, "MERGED_BYTES", most)
    draw = np.random.default_rng(most)
    grams = np.sort(draw.choice([-(1 << 63), -5, 0, 7, 9, (1 << 63) - 1], 40))
    sizes = draw.integers(1, 20, 40)
    parts = list(bwt_dedup.portions(grams, sizes))
    assert [i for lo, hi in parts for i in range(lo, hi)] == list(range(40))
    assert all(grams[hi - 1] != grams[hi] for _, hi in parts[:-1])
    largest = max(sizes[grams == g].sum() for g in grams)
    assert all(sizes[lo:hi].sum() <= most + largest for lo, hi in parts)


def test_merge_of_one_portion_is_bounded():
    """A representative with the most segments that a transform takes: 2.9 MB in one merge."""
    draw = np.random.default_rng(8)
    base = draw.integers(97, 123, 700, dtype=np.uint8)
    texts = []
    for i in range(bwt_dedup.HOT_SEGMENTS):
        text = base.copy()
        text[[0, 1, 698, 699]] = 65 + i % 26, 65 + i // 26 % 26, 65 + i // 676, 65
        texts.append(text.tobytes())
    tracemalloc.start()
    flags = bwt_dedup.repeated_starts(texts, np.ones(len(texts)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = Counter(t[i : i + 400] for t in texts for i in (0, 1, 150, 299))
    assert [f[[0, 1, 150, 299]].tolist() for f in flags] == [[seen[t[i : i + 400]] > 1 for i in (0, 1, 150, 299)] for t in texts]
    assert peak < 350 << 20


def test_repeated_strings_of_odd_rows(odd_documents, no_documents):
    texts = [r.text for r in odd_documents.collect()]
    rows = bwt_dedup.removals(odd_documents).collect()
    assert Counter(bytes(r.kept) for r in rows) == Counter(repeats(texts[:-4] + texts[-2:], 400)) + Counter(repeats(texts[-4:-2], 400))
    assert bwt_dedup.removals(no_documents).count() == 0


def shingle_components(rows, size, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
        sets[i] = grams
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size,percent,docs_per_part", [(3, 90, 2_000), (5, 80, 2_000), (3, 90, 3), (5, 80, 2)])
def test_jaccard_components_equal_brute_force(documents, monkeypatch, size, percent, docs_per_part):
    monkeypatch.setattr(jaccard_join, "DOCS_PER_PART", docs_per_part)
    draw = random.Random(8)
    base = [[f"w{draw.randint(0, 400)}" for _ in range(draw.randint(1, 150))] for _ in range(12)]
    rows = []
    for i in range(160):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = draw.choice(["Zeta", f"n{i}", "w7"])
        rows.append((i, " ".join(words)))
    rows += [(500, "A b"), (501, "a  B"), (502, None), (503, ""), (504, " \n")]
    found = jaccard_join.jaccard_components(documents(rows), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == shingle_components(rows, size, percent)


def test_jaccard_components_of_odd_rows(odd_documents, no_documents):
    rows = jaccard_join.jaccard_components(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    of = {r.doc_id: r.component_id for r in rows}
    assert (of[4], of[5], of[1], of[None]) == (4, 4, 1, None)
    assert jaccard_join.jaccard_components(no_documents).count() == 0


def prefix_rows(sets, percent, k, seed=0):
    """Rows as they meet, one for every shingle of a document's prefix, and the prefixes."""
    order = {t: i for i, t in enumerate(np.random.default_rng(seed).permutation(max(map(max, sets)) + 1).tolist())}
    prefixes, rows = {}, []
    for i, s in enumerate(sets):
        ranked = sorted(s, key=order.get)
        prefixes[i] = ranked[: len(s) + percent * len(s) // -100 + k]
        early = len(s) + 2 * percent * len(s) // -(100 + percent) + k
        bits = jaccard_join.sketch(np.array(prefixes[i], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rows += [(t, i, len(s), k, i % 50, place < early, i % 2, bits) for place, t in enumerate(prefixes[i])]
    return pd.DataFrame(rows, columns=["token", "id", "n", "k", "component_id", "early", "part", "sketch"]), prefixes


@pytest.mark.parametrize("across", [False, True])
def test_meeting_pairs_lose_no_similar_pair(across):
    draw = random.Random(12)
    base = [draw.sample(range(4_000), draw.choice([5, 60, 900])) for _ in range(15)]
    sets = []
    for i in range(120):
        words = list(base[i % 15])
        for _ in range(draw.randint(0, len(words) // 12)):
            words[draw.randrange(len(words))] = 4_000 + draw.randint(0, 500)
        sets.append(set(words))
    rows, prefixes = prefix_rows(sets, 80, 2)
    found = set(jaccard_join.meeting_pairs(rows, 80, across).itertuples(index=False, name=None))
    allowed = {(a, b) for a in prefixes for b in prefixes if a % 50 != b % 50 and (not across or a % 2 != b % 2) and (len(sets[a]), a) < (len(sets[b]), b)}
    similar = {(a, b) for a, b in allowed if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert similar and similar <= found <= allowed
    assert len(found) < 2 * len(similar)


def test_long_prefixes_that_meet_in_one_shingle_need_little_memory():
    draw = np.random.default_rng(2)
    bits = [jaccard_join.sketch(draw.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(2_000)]
    rows = pd.DataFrame({"token": 0, "id": range(2_000), "n": 1_900, "k": 10, "component_id": range(2_000), "early": True, "part": 0, "sketch": bits})
    tracemalloc.start()
    assert len(jaccard_join.meeting_pairs(rows, 90, False)) == 0
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("bits", [2_048, 256])
def test_sketches_of_whole_sets_lose_no_link(bits):
    draw = np.random.default_rng(bits)
    refused = 0
    for _ in range(600):
        n, percent = int(draw.integers(1, 700)), int(draw.choice([50, 80, 90]))
        pool = np.unique(draw.integers(0, 1 << 63, n + 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = draw.permutation(pool)[:n]
        y = np.concatenate([x[: int(n * draw.random()) if draw.random() < 0.5 else n - int(draw.integers(0, n // 8 + 1))], draw.permutation(np.setdiff1d(pool, x))[: int(draw.integers(0, n // 4 + 2))]])
        if not len(y):
            continue
        shared = len(np.intersect1d(x, y))
        link = 100 * shared >= percent * (len(x) + len(y) - shared)
        sides = [jaccard_join.sketch(s, max(bits, 1 << (4 * len(s)).bit_length())) for s in (x, y)]
        may = jaccard_join.may_link(sides[0], len(x), sides[1], len(y), percent)
        assert may or not link
        refused += not may
    assert refused > 100


def test_prefixes_ask_for_as_many_matches_as_they_are_longer():
    levels = np.full(1 << jaccard_join.COUNT_BITS, 3, np.uint8)
    shingles = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 200, dtype=np.uint64))
    k, prefix = jaccard_join.prefix_of(shingles, levels, 90, 4)
    assert len(prefix) == 200 - 180 + k and 1 <= k <= 4


def test_mix_reaches_its_targets(documents):
    draw = random.Random(9)
    rows = [(i, "w " * draw.randint(0, 30), draw.choice(["a", "b", "c", "dd", None])) for i in range(300)]
    mixed = source_mix.mix_sources(documents(rows), rows_per_bucket=16).collect()
    assert len(mixed) == 300
    total = sum(r.size for r in mixed)
    for source in {r.source for r in mixed}:
        some = [r for r in mixed if r.source == source]
        assert some[0].source_size == sum(r.size for r in some)
        assert abs(sum(r.taken for r in some) - some[0].target) <= 1
        assert all(r.taken <= 3 * r.size for r in some) and some[0].target <= 3 * some[0].source_size
    assert abs(sum({r.source: r.target for r in mixed}.values()) - total) < 1e-6
    again = source_mix.mix_sources(documents(rows), rows_per_bucket=1_000).collect()
    assert Counter(mixed) == Counter(again)


def test_mix_of_odd_rows(odd_documents, no_documents):
    rows = source_mix.mix_sources(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.taken <= 3 * r.size for r in rows)
    assert source_mix.mix_sources(no_documents).count() == 0


def test_digests_of_the_token_query(spark):
    rows = queries.QUERIES["op2_piece_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        ids = [1, *LIBRARY.encode(texts[r.doc_id]), 2]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_tokens_take_one_python_worker_per_task(spark, odd_documents):
    """Idle workers keep their tables and add to an executor's memory in the stages that follow."""
    path = queries.piece_model()
    apart = piece_bpe.decode_pieces(piece_bpe.encode_pieces(odd_documents, path), path)
    at_once = piece_bpe.encode_and_decode(odd_documents, path)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(at_once) == rows(apart)
    docs = odd_documents.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "0L as n_chars")
    plan = corpus_pipeline.tokens(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
