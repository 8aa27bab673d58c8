"""Benchmark passages, phrase collocations and centroid clusters against plain programs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from emberline.llm import fm_decontam, hadamard_kmeans, misra_gries

BENCHMARK = "item_id bigint, text string, spans string, items string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def word_list(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def plain_contamination(texts, items, window):
    windows = {}
    for name, text in items:
        w = word_list(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + window]), set()).add("" if name is None else str(name))
    out = []
    for text in texts:
        w, hit, found = word_list(text), set(), set()
        for length in {len(p) for p in windows}:
            for i in range(len(w) - length + 1):
                if tuple(w[i : i + length]) in windows:
                    hit |= set(range(i, i + length))
                    found |= windows[tuple(w[i : i + length])]
        out.append((len(w), len(hit), sorted(found), sorted(hit)))
    return out


def texts_and_items(seed=3, vocabulary=25):
    draw = random.Random(seed)
    words = [*(f"w{i}" for i in range(vocabulary)), "É", "naïve", "A1"]
    some = lambda n: "".join(draw.choice(words) + draw.choice([" ", ", ", "\n", "-", "\x00"]) for _ in range(n))
    texts = [some(draw.randint(0, 120)) for _ in range(80)]
    items = [(i, some(draw.randint(0, 9))) for i in range(25)] + [(77, texts[5][30:200].upper()), (77, "w1"), (None, "w2 w3"), (80, None), (81, ""), (81, "absent word")]
    return [*texts, *texts[:5], None, "", "Absent   WORD!", "w1 " * 5_000], items


@pytest.mark.parametrize(("window", "block_bytes", "shard_bytes"), [(4, 1 << 20, 1 << 20), (10, 1 << 20, 300), (4, 200, 2_000)])
def test_contamination_equals_a_plain_search(spark, documents, window, block_bytes, shard_bytes):
    texts, items = texts_and_items()
    docs = documents([(i, t) for i, t in enumerate(texts)]).withColumn("items", F.lit("odd"))
    bench = spark.createDataFrame([(i, t, "odd", "odd") for i, t in items], BENCHMARK)
    rows = fm_decontam.contamination(docs, bench, window=window, block_bytes=block_bytes, shard_bytes=shard_bytes).collect()
    expected = plain_contamination(texts, items, window)
    assert len(rows) == len(texts)
    for r in rows:
        n_words, n_hit, names, hit = expected[r.doc_id]
        assert (r.n_words, r.n_hit, list(r["items"])) == (n_words, n_hit, names), r.doc_id
        text = texts[r.doc_id] or ""
        places = [m.span() for m in fm_decontam._WORD.finditer(text)]
        covered = [i for i, (a, b) in enumerate(places) if any(s["start"] <= a and b <= s["end"] for s in r.spans)]
        assert covered == hit and len(r.spans) == sum(h - 1 not in hit for h in hit)


def test_texts_without_their_spans(documents, spark):
    bench = spark.createDataFrame([(1, "one two three", "", "")], BENCHMARK)
    docs = documents([(1, "Say: One two, THREE times"), (2, None), (3, "nothing here"), (4, "one two three")])
    found = fm_decontam.contamination(docs, bench)
    left = fm_decontam.without_spans(docs, found)
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "Say:  times", 2: None, 3: "nothing here", 4: ""}


def test_contamination_of_odd_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "one", "", ""), (2, "text WITHOUT an", "", "")], BENCHMARK)
    rows = fm_decontam.contamination(odd_documents, bench).collect()
    given = odd_documents.collect()
    expected = plain_contamination([r.text for r in given], [(1, "one"), (2, "text without an")], 10)
    assert Counter((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in rows) == Counter(
        (g.doc_id, n, h, ",".join(names)) for g, (n, h, names, _) in zip(given, expected, strict=True)
    )
    assert fm_decontam.contamination(no_documents, bench).count() == 0
    assert fm_decontam.contamination(odd_documents, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_index_finds_every_place():
    draw = np.random.default_rng(5)
    runs = [draw.integers(1, 7, draw.integers(1, 60)) for _ in range(40)]
    runs += runs[:6] + [np.full(200, 3)]
    text = np.concatenate([np.append(r, 0) for r in runs])
    index = fm_decontam.FmIndex(text, 7)
    joined = "".join(map(str, text))
    for length in (1, 2, 3, 9):
        patterns = np.unique(draw.integers(1, 7, (50, length)), axis=0)
        which, lo, hi = index.search(patterns)
        found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi, strict=True)}
        expected = {}
        for i, p in enumerate(patterns):
            places = [m.start() for m in re.finditer(f"(?={''.join(map(str, p))})", joined)]
            if places:
                expected[i] = places
        assert found == expected


def phrase_counts(rows, most=5):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, most + 1):
                counts.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    return counts, n


def plain_collocations(rows, threshold, top):
    counts, n = phrase_counts(rows)
    found = {}
    cand = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= threshold}
    cover = {}
    for (lang, w), a in cand.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                cover[lang, w[i : i + size]] = max(a, cover.get((lang, w[i : i + size]), 0))
    for (lang, w), a in cand.items():
        score, k = min((1000 * a * n[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        if 100 * cover.get((lang, w), 0) < 100 * a:
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in found.items() for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def speech(n=300, seed=4):
    draw = random.Random(seed)
    fixed = ["New York city", "a, b", "ÉTÉ là", "x x x x x x", "the end. of the", "tab\tword\nline", "? !", "of the"]
    make = lambda: " ".join(draw.choice(fixed) if draw.random() < 0.5 else f"r{draw.randrange(9) ** 3}" for _ in range(draw.randint(0, 30)))
    return [(make(), draw.choice(["en", "en", None, "fr"])) for _ in range(n)] + [(None, "en"), ("", None), ("of the " * 4_000, "de"), ("lonely", "xx")]


@pytest.mark.parametrize(("threshold", "top"), [(20, 2_000), (100, 7), (3, 40)])
def test_collocations_equal_a_plain_count(spark, threshold, top):
    rows = speech()
    docs = spark.createDataFrame([(i, t, lang, "odd", "odd") for i, (t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string, word string, n string")
    found = misra_gries.collocations(docs.repartition(5), threshold=threshold, top=top).collect()
    expected = plain_collocations(rows, threshold, top)
    assert expected and sorted((r["lang"], r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == expected


def test_collocations_of_odd_rows(odd_documents, no_documents):
    assert misra_gries.collocations(no_documents).collect() == []
    rows = [(r.text, r.lang) for r in odd_documents.collect()]
    found = misra_gries.collocations(odd_documents, threshold=2).collect()
    assert sorted((r["lang"], r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == plain_collocations(rows, 2, 2_000)


def test_no_frequent_phrase_is_lost_by_full_summaries():
    draw = np.random.default_rng(6)
    keys = np.concatenate([np.repeat(np.arange(1, 40, dtype=np.uint64), 100), draw.integers(1_000, 10**9, 60_000).astype(np.uint64)])
    draw.shuffle(keys)
    summaries = []
    for part in np.array_split(keys, 4):
        summaries.append(misra_gries.Summary(len(keys) // 100 + 1))
        for some in np.array_split(part, 30):
            summaries[-1].add(*misra_gries.summed(some, np.ones(len(some), np.int64)))
    whole = summaries[0]
    for other in summaries[1:]:
        whole.merge(other)
    assert len(whole.keys) <= whole.capacity and 0 < whole.lost < 100
    assert set(range(1, 40)) <= set(whole.frequent(100).tolist())
    assert len(whole.frequent(100)) < 2_000


def test_phrases_of_one_hash_are_counted_apart(spark, monkeypatch):
    rows = speech(60)
    docs = spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string").coalesce(1)
    words = misra_gries.Words(pa.RecordBatch.from_pydict({"text": [t for t, _ in rows], "lang": [lang for _, lang in rows]}))
    full = np.full(1 << 4, -1, np.int64).view(np.uint64)
    same = lambda self, most, left: ((m, s, np.zeros(len(s), np.uint64)) for m, s, _ in phrases(self, most, left))
    phrases = misra_gries.Words.phrases
    sizes = {m: len(s) for m, s, _ in words.phrases(5, words.frequent_left(full))}
    counts, _ = phrase_counts(rows)
    assert sizes == {m: sum(a for (_, w), a in counts.items() if len(w) == m) for m in range(2, 6)}
    sent = spark.sparkContext.broadcast(full)
    monkeypatch.setattr(misra_gries.Words, "phrases", same)
    found = misra_gries.exact_counts(docs, sent, sent, 5)
    assert found.groupBy().agg(F.sum("a")).first()[0] == sum(sizes.values())


VECTOR = "vec_id bigint, embedding array<float>, cluster string, distance string"


def plain_clusters(rows, k, rounds, size):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == size and None not in v and np.isfinite(v).all()]
    digest = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: digest(r[0]))[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, at, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return Counter((i, *nearest(v)[::-1]) for i, v in kept), centroids


def test_clusters_equal_plain_rounds(spark):
    draw, nan, inf = np.random.default_rng(8), float("nan"), float("inf")
    rows = [(i, [float(x) for x in draw.normal(size=16).astype(np.float32) + (i % 5)]) for i in range(150)]
    rows += [(200, None), (201, [nan] * 16), (202, [inf] + [0.0] * 15), (203, [None] + [1.0] * 15), (204, [1.0] * 15), (205, [0.0] * 16), (None, [0.5] * 16), (7, rows[7][1]), (206, [16_000.0] * 16)]
    df = spark.createDataFrame([(*r, "odd", "odd") for r in rows], VECTOR)
    found = hadamard_kmeans.cluster(df.repartition(3), k=6, rounds=4, size=16)
    expected, centroids = plain_clusters(rows, 6, 4, 16)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in found.rows.collect()) == expected
    assert found.centroids == centroids


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], "", ""), (2, [1.0, 2.0, 3.0, 4.0], "", "")], VECTOR)
    found = hadamard_kmeans.cluster(df, size=4)
    first = min((hashlib.sha256(f"3:{i}".encode()).hexdigest(), i) for i in (1, 2))
    assert first and {(r.cluster, r.distance) for r in found.rows.collect()} == {(0, 0)} and len(found.centroids) == 2
    none = hadamard_kmeans.cluster(df.limit(0), size=4)
    assert none.rows.count() == 0 and none.centroids == []
    with pytest.raises(Exception, match="beyond"):
        hadamard_kmeans.cluster(spark.createDataFrame([(1, [1e9] * 4, "", "")], VECTOR), size=4)


def test_progressive_search_is_exact_and_saves_work():
    draw = np.random.default_rng(9)
    smooth = draw.normal(size=(40, 8)).repeat(8, 1) * 400
    centroids = smooth.astype(np.int64)
    vectors = (smooth[draw.integers(0, 40, 500)] + draw.normal(size=(500, 64)) * 20).astype(np.int64)
    vectors[:5] = centroids[3]
    centroids[7] = centroids[3]  # a tie
    at, far, work = hadamard_kmeans.nearest(hadamard_kmeans.transform(vectors), hadamard_kmeans.transform(centroids))
    exact = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (at == exact.argmin(1)).all() and (far == exact.min(1)).all()
    assert work < 0.2 * exact.size * 64
    assert (hadamard_kmeans.inverse(hadamard_kmeans.transform(vectors)) == 64 * vectors).all()


def test_packed_keys_come_back():
    draw = np.random.default_rng(12)
    part_of = np.arange(1 << misra_gries.CELL_BITS) // 5
    for n, spread in ((3, 48), (2_000, 48), (200_000, 48), (5_000, 20)):
        keys = np.unique(draw.integers(0, 1 << spread, n).astype(np.uint64))
        counts = draw.integers(1, 1 << 20, len(keys))
        rows = misra_gries.packed(part_of, keys, counts)
        back = [misra_gries.unpacked(*r[1:]) for r in rows]
        assert (np.concatenate([k for k, _ in back]) == keys).all() and (np.concatenate([c for _, c in back]) == counts).all()
        assert all((part_of[(k >> np.uint64(34)).astype(int)] == r[0]).all() and len(k) <= misra_gries.ROW_ENTRIES for r, (k, _) in zip(rows, back, strict=True))
