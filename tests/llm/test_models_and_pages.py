"""Classifiers by held-out accuracy, vectors and pages against brute force, and the pipeline's contract."""

import hashlib
import json
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from emberline.llm import bwt_dedup, common, hnsw_dedup, kmeans_tree, kneser_ney, nbsvm, page_text, queries
from tests.llm.test_text_operators import repeats, shingle_components

FOLDER = "/root/testdata/sf0.01"
VECTOR = "vec_id bigint, embedding array<float>, label int, component_id string"


def vectors(seed=1, n=400, d=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = draw.normal(size=d) if i % 3 else centres[draw.integers(12)] + 0.1 * draw.normal(size=d)
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 2), "odd"))
    nan, inf = float("nan"), float("inf")
    return rows + [
        (n, None, 0, "odd"), (n + 1, [0.0] * d, 0, "odd"), (n + 2, [nan] * d, 0, "odd"), (n + 3, [inf] + [1.0] * (d - 1), 1, "odd"),
        (n + 4, rows[0][1], None, "odd"), (n + 5, rows[0][1], 0, "odd"), (None, rows[0][1], 0, "odd"), (n + 6, [None] + [1.0] * (d - 1), 1, "odd"),
    ]


def usable(rows):
    return {r[0]: r for r in rows if r[0] is not None and r[1] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])}


@pytest.mark.parametrize("shard_rows,block_rows", [(20_000, 1_000), (60, 50)])
def test_near_duplicate_vectors_equal_brute_force(spark, shard_rows, block_rows):
    rows = vectors()
    found = hnsw_dedup.near_duplicates(spark.createDataFrame(rows, VECTOR), shard_rows=shard_rows, block_rows=block_rows).collect()
    assert len(found) == len(rows)
    good = {i: (np.array(r[1], float) / np.linalg.norm(r[1]), r[2]) for i, r in usable(rows).items() if r[2] is not None}
    links = {i: [j for j in good if j != i and good[j][1] == good[i][1] and good[i][0] @ good[j][0] >= 0.93] for i in good}
    assert sum(map(len, links.values())) > 100
    root = {i: i for i in good}
    for _ in range(len(good)):
        after = {i: min([root[i], *(root[j] for j in links[i])]) for i in good}
        if after == root:
            break
        root = after
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            component = root.get(r.vec_id, r.vec_id)
            assert (r.n_links, r.component_id, r.kept) == (len(links.get(r.vec_id, [])), component, component == r.vec_id)


def test_a_beam_full_of_links_is_widened():
    draw = np.random.default_rng(2)
    x = hnsw_dedup.unit(np.concatenate([np.ones((300, 8)) + 0.01 * draw.normal(size=(300, 8)), draw.normal(size=(300, 8))]))
    a, _ = hnsw_dedup.links_to_shard(hnsw_dedup.Graph.build(x), x, 0.93, 0.0)
    assert len(a) == int((x @ x.T >= 0.93).sum())


def test_no_vectors(spark):
    none = spark.createDataFrame([], VECTOR)
    assert hnsw_dedup.near_duplicates(none).count() == 0
    assert kmeans_tree.nearest(none, none).count() == 0


def brute_nearest(rows, queries_, k):
    good = usable(rows)
    out = {}
    for q in queries_:
        x = np.array(good[q][1], float)
        far = sorted((float(np.sqrt(((np.array(r[1], float) - x) ** 2).sum())), i) for i, r in good.items() if i != q)
        out[q] = far[:k]
    return out


def test_tree_search_finds_most_neighbours_and_exact_distances(spark):
    rows = vectors(seed=3, n=1_500)
    df = spark.createDataFrame(rows, VECTOR)
    found = kmeans_tree.nearest(df, df.where("vec_id % 100 = 0")).collect()
    true = brute_nearest(rows, [i for i in usable(rows) if i % 100 == 0], 10)
    hits = 0
    for q, expected in true.items():
        some = sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in some] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in some] == sorted((r.score, r.vec_id) for r in some)
        hits += len({r.vec_id for r in some} & {i for _, i in expected})
    assert hits >= 0.9 * 10 * len(true)


def test_calibration_leaves_out_rows_the_tree_was_fitted_on(spark, monkeypatch):
    df = spark.createDataFrame(vectors(seed=3, n=1_500), VECTOR)
    asked, calibrate = [], kmeans_tree.calibrate
    monkeypatch.setattr(kmeans_tree, "calibrate", lambda tree, rows, queries, *a: asked.append(set(queries["vec_id"])) or calibrate(tree, rows, queries, *a))
    kmeans_tree.nearest(df, df.where("vec_id % 5 = 0"), sample_rows=300)
    kmeans_tree.nearest(df, df.where("vec_id % 100 = 0"))
    fitted = {r.vec_id for r in kmeans_tree.usable(df).select("vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(300).collect()}
    assert len(asked[0]) == kmeans_tree.CALIBRATION_QUERIES and not asked[0] & fitted
    assert asked[1]  # all rows are fitted, so fitted ones are asked


def test_few_candidates_are_all_returned(spark):
    rows = [(0, [1.0, 0.0], 0, ""), (1, [1.0, 0.0], 0, ""), (2, [0.0, 2.0], 0, ""), (3, None, 0, "")]
    df = spark.createDataFrame(rows, VECTOR)
    found = kmeans_tree.nearest(df, df.where("vec_id in (0, 3)")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2)] and found[0].score == 0.0


@pytest.mark.parametrize("name,label,least", [("op9_nbsvm_quality", "quality", 0.97), ("op10_kneser_ney_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.QUERIES[name](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)


def test_toxic_words_are_learned(documents, spark):
    ordinary = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(30))) for i in range(400)]
    rows = [(i, t + (" nasty awful" if i % 5 == 0 else "")) for i, t in ordinary]
    docs = documents(rows)
    known = docs.select("doc_id", "text", (F.col("doc_id") % 5 == 0).cast("int").alias("label"))
    data = kneser_ney.fit(known, docs)
    scores = {r.doc_id: r.score for r in kneser_ney.score(docs, data).collect()}
    assert all((scores[i] >= 0.5) == (i % 5 == 0) for i in scores)


def test_scores_of_odd_rows(odd_documents, no_documents, spark):
    known = odd_documents.select("doc_id", "text", F.lit(1).alias("label"))
    model, data = nbsvm.fit(known), kneser_ney.fit(known, odd_documents)
    for scored in (nbsvm.score(odd_documents, model), kneser_ney.score(odd_documents, data)):
        rows = scored.collect()
        assert len(rows) == odd_documents.count() and all(0.5 < r.score <= 1 for r in rows)
    nothing = no_documents.select("doc_id", "text", F.lit(1).alias("label"))
    assert nbsvm.score(no_documents, nbsvm.fit(nothing)).count() == 0
    assert kneser_ney.score(no_documents, kneser_ney.fit(nothing, no_documents)).count() == 0


def test_dual_descent_separates():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 1]), np.array([3, 2])]
    weight = nbsvm.descend(rows, [np.ones(2)] * 4, np.array([1.0, 1.0, -1.0, -1.0]), bits=2, passes=50)
    assert weight[0] > 0 > weight[3]


def test_lines_of_a_page():
    page = "<title>T</title><nav>m</nav><div>Fi<b>rs</b>t&amp; line<br>next</div><script>a<b</script><div class='user-comments'><div>c</div>d</div><p>last <"
    assert page_text.lines_of(page) == [("m", -1), ("First& line", 0), ("next", 0), ("c", -1), ("d", -1), ("last <", 0)]
    assert page_text.lines_of(None) == []


def kept(page):
    lines = page_text.lines_of(page)
    best = max((w for _, w in lines), default=0)
    return " ".join(t for t, w in lines if w == best != -1)


def test_names_drop_an_element_only_as_whole_tokens_or_their_last_part():
    for name in ("has-sidebar", "no-ads", "post-social-science", "search-results", "with-menu", "hasSidebar", "formal", "social-science"):
        assert kept(f"<p>Top</p><div class='wide {name}'>Text</div>") == "Top Text", name
        assert kept(f"<p>Top</p><div id={name}>Text</div>") == "Top Text", name
    for name in ("sidebar", "left-sidebar", "userComments", "user-comments", "comment-list", "ad-123", "div-gpt-ad-7", "share_buttons", "cookie-notice", "menu-item-4"):
        assert kept(f"<p>The longer text of this page</p><div class='wide {name}'>Apart</div>") == "The longer text of this page", name
    assert kept("<p>Top</p><div data-id='menu'>Text</div>") == "Top Text"


def test_articles_and_wrappers_inside_dropped_elements_stay():
    assert kept("<form id=aspnetForm><nav>m</nav><p>All of the text</p><div class=ads>buy</div></form>") == "All of the text"
    assert kept("<div class=sidebar><div class=widget><p>All of the text</p></div><footer>f</footer></div>") == "All of the text"
    assert kept("<form><article>Story</article><p>other</p></form>") == "Story"
    assert kept("<form><p>All of the text</p><aside><article>Teaser</article></aside></form>") == "All of the text"
    assert kept("<body class='comments has-comments'><p>All of the text</p>") == "All of the text"
    assert kept("<div class=sidebar><main>Story</main></div>") == "Story"
    assert kept("<div class=comments><article>Said one</article></div>") == ""
    assert kept("<p>Short</p><section id=comments><p>A much longer comment than the text</p><article>And more</article></section>") == "Short"
    assert kept("<p>A text without an article of its own</p><aside><article>Teaser</article></aside>") == "A text without an article of its own"
    assert kept("<article>Story</article><aside class=related><article>Teaser of more text than the story</article></aside>") == "Story"
    assert kept("<p>Short</p><div class=menu><a href=x>One long link</a> <a href=y>Another long link</a></div>") == "Short"
    assert kept("<p>The text to read</p><form>Name <input> Your address</form>") == "The text to read"


def lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = np.random.default_rng(7)
    for _ in range(200):
        a, b = (draw.integers(0, 5, draw.integers(0, 12)).tolist() for _ in range(2))
        found = page_text.shared_lines(a, b)
        rest = iter(b)
        assert len(found) == lcs(a, b) and all(a[i] in rest for i in found)


def test_pages_lose_what_their_neighbours_share(spark):
    frame = "<div>Site of all things</div>{}<div>Legal words</div>"
    bodies = [f"<p>Story number {i} tells of something long and new {i * 37}.</p>" for i in range(8)]
    rows = [(i, f"http://h{i % 2}.org/en/{i}", frame.format(bodies[i]), "odd") for i in range(8)]
    rows += [(20, "http://alone.org/x", "<p>Only one</p>", ""), (21, None, None, ""), (22, "http://c.org/a", "<article><p>Same</p></article>", ""), (23, "http://c.org/b", "<article><p>Same</p></article>", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, row string")
    found = {r.page_id: r.text for r in page_text.main_text(pages).collect()}
    assert all(found[i] == f"Story number {i} tells of something long and new {i * 37}." for i in range(8))
    assert (found[20], found[21], found[22], found[23]) == ("Only one", "", "Same", "Same")
    assert page_text.main_text(pages.limit(0)).count() == 0


def texts_of(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in page_text.main_text(pages).collect()}


WORDS = ["amber", "birch", "cedar", "delta", "ember", "frost", "grove", "heath"]


def test_templates_inside_articles_go_and_copies_of_content_stay(spark):
    article = "<article><p>{} is told of here at length.</p><div class='x1'>Pass this on to your friends</div></article>"
    rows = [(i, f"http://a.org/{i}", article.format(w)) for i, w in enumerate(WORDS)]
    copy = "<article><p>One long story that lies at two addresses of the host.</p><p>{}</p></article>"
    rows += [(20, "http://a.org/z/1", copy.format("By Ann")), (21, "http://a.org/z/2", copy.format("By Bob"))]
    rows += [(30 + i, f"http://mirror.org/{i}", f"<article><p>The same story everywhere.</p><p>Seen {i} times</p></article>") for i in range(4)]
    rows += [(40 + i, f"http://b.org/{'s' if i < 9 else 'z'}/{i}", article.format(WORDS[i % 8] * (1 + i)) if i < 9 else f"<article>Page {WORDS[i % 8] * i}</article>") for i in range(30)]
    rows += [(80 + i, f"http://c.org/{i}", f"<article><p>{WORDS[i % 8] * (1 + i)}</p>{'<p>Of.</p>' if 3 < i < 8 else ''}</article>") for i in range(20)]
    found = texts_of(spark, rows)
    assert all(found[i] == f"{w} is told of here at length." for i, w in enumerate(WORDS))
    assert found[40] == "amber is told of here at length." and "friends" not in found[48]  # a part of the host
    assert all(found[80 + i].endswith(" Of.") for i in range(4, 8))  # a line that some texts of the host have in common
    assert found[20] == "One long story that lies at two addresses of the host. By Ann"
    assert all(found[30 + i] == f"The same story everywhere. Seen {i} times" for i in range(4))


def test_short_texts_under_long_templates_lose_the_template(spark):
    page = "<div>All of the many things that this site has on offer, listed at length</div><p>{} is short.</p><div>And a long notice about the law that holds for every page</div>"
    rows = [(i, f"http://a.org/{i}", page.format(w)) for i, w in enumerate(WORDS)]
    copy = "<div>One long story that lies at two addresses of the host, in full.</div><p>{}</p>"
    rows += [(20, "http://a.org/z/1", copy.format("By Ann")), (21, "http://a.org/z/2", copy.format("By Bob"))]
    found = texts_of(spark, rows)
    assert all(found[i] == f"{w} is short." for i, w in enumerate(WORDS))
    assert found[21] == "One long story that lies at two addresses of the host, in full. By Bob"


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = {r.id: r.component_id for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_ranks_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert all(r.x == r.place for r in common.ranked(df, ["x"], "place").collect())


def test_pipeline_stages(spark, odd_documents, no_documents):
    docs, columns = odd_documents, list(corpus_pipeline.COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "repeated_passages", "mixture", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, FOLDER).count() == 0, name
        after = common.stored(stage(spark, docs, FOLDER))
        if name != "tokens":
            assert after.columns == columns, name
            docs = after if after.count() else odd_documents


def plain_mix(rows):
    """The mixed copies `(doc_id, text, source)` of `(doc_id, text, source)` rows with unique ids."""
    sources = sorted({s for *_, s in rows})
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sources}
    weight = {s: 1 + n % 3 for n, s in enumerate(sources)}
    budget, capped, level = sum(size.values()), set(), 0.0
    while len(capped) < len(sources):
        level = (budget - sum(3 * size[s] for s in capped)) / sum(weight[s] for s in sources if s not in capped)
        more = {s for s in sources if 3 * size[s] <= level * weight[s]}
        if more == capped:
            break
        capped = more
    out = []
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for s in sources:
        target, start = min(3.0 * size[s], level * weight[s]), 0
        digest = lambda r: md5(md5(json.dumps({"doc_id": r[0], "text": r[1], "lang": "en", "source": r[2]}, separators=(",", ":"))))
        for i, text, _ in sorted((r for r in rows if r[2] == s), key=digest) * 3:
            words = text.split()
            take = int(max(np.floor(min(start + len(words), target)) - start, 0))
            start += len(words)
            if take:
                out.append((i, text if take == len(words) else " ".join(words[:take]), s))
    return sorted(out)


def test_stages_equal_plain_programs(spark, documents):
    draw = random.Random(4)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    passage = words(90)
    rows = [(i, words(draw.randint(1, 60)) + (f" {passage} {words(9)}" if i % 9 == 0 else ""), "abc"[i % 3 * (i % 5 > 0)]) for i in range(60)]
    rows += [(100 + i, rows[i][1] + (" end" if i % 2 else ""), rows[i][2]) for i in range(20)]
    docs = documents(rows)
    texts = lambda found: sorted((r.doc_id, r.text, r.source) for r in found.collect() if r.lang == "en" and r.n_chars == len(r.text))

    model = queries.quality_model(docs, common.table(spark, FOLDER, "labels"))
    good = {r.doc_id for r in nbsvm.score(docs, model).collect() if r.score >= 0.5}
    assert texts(corpus_pipeline.quality(spark, docs, FOLDER)) == [r for r in sorted(rows) if r[0] in good]

    groups = shingle_components([r[:2] for r in rows], 5, 80)
    single = [r for r in sorted(rows) if groups[r[0]][1] == r[0]]
    assert 40 < len(single) < len(rows) and texts(corpus_pipeline.near_copies(spark, docs, FOLDER)) == single

    docs = documents(single)
    left = [(i, b.decode(errors="replace"), s) for (i, t, s), b in zip(single, repeats([r[1] for r in single], bwt_dedup.WIDTH), strict=True) if b or not t]
    assert left != single and texts(corpus_pipeline.repeated_passages(spark, docs, FOLDER)) == left

    docs, mixed = documents(left), plain_mix(left)
    ids = [r[0] for r in mixed]
    assert len(set(ids)) < len(ids) and any(m not in left for m in mixed)
    assert texts(corpus_pipeline.mixture(spark, docs, FOLDER)) == mixed

    pieces = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    coded = {i: pieces.encode(t, add_bos=True, add_eos=True) for i, t, _ in left}
    found = corpus_pipeline.tokens(spark, docs, FOLDER).collect()
    assert {r.doc_id: (np.frombuffer(r.ids, "<i4").tolist(), r.n_tokens) for r in found} == {i: (c, len(c)) for i, c in coded.items()}
    assert {r.doc_id: r.decoded_sha256 for r in found} == {i: hashlib.sha256(pieces.decode(c).encode()).hexdigest() for i, c in coded.items()}


def test_rows_with_one_id_go_only_as_near_copies(spark, documents):
    one, two = (" ".join(f"{name}{i}" for i in range(60)) for name in ("left", "right"))
    rows = [(1, one), (1, two), (2, one + " more"), (3, two), (3, "something else altogether, in a row of the same id"), (4, ""), (4, ""), (None, one), (None, one)]
    found = corpus_pipeline.near_copies(spark, documents(rows), FOLDER).collect()
    expected = [(1, one), (1, two), (3, rows[4][1]), (4, ""), (4, ""), (None, one), (None, one)]
    assert sorted((r.doc_id or 0, r.text) for r in found) == sorted((i or 0, t) for i, t in expected)


def test_pipeline_result(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.n_tokens * 4 == len(r.ids) for r in rows)
