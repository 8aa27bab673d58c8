"""The registered queries of the subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import (
    bwt_dedup, fm_decontam, hadamard_kmeans, hnsw_dedup, jaccard_join, kmeans_tree, kneser_ney, misra_gries, nbsvm, page_text, piece_bpe,
    source_mix, token_counts,
)
from emberline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


def piece_model() -> str:
    """The model file of the contracts, found where the tokenizers' package is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_hnsw_dedup")
def op1_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op1_hnsw_dedup"] = """
with recursive vectors as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.label = b.label and a.vec_id <> b.vec_id
    where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93),
reach as (select a as v, a as r from links union select b, r from reach join links on v = a),
least as (select v, min(r) as component_id from reach group by v),
counts as (select a, count(*) as n_links from links group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
    vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join counts on a = vec_id left join least on v = vec_id
"""


@query("op2_piece_bpe")
def op2_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_bpe.encode_pieces(table(spark, sf_dir, "documents"), piece_model())
    decoded = piece_bpe.decode_pieces(encoded, piece_model())
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op3_bwt_dedup")
def op3_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_dedup.removals(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), piece_model())
    n_tokens = token_counts.tokens_in()
    return counted.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > 4096).alias("over_limit"))


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


ORACLE["op5_jaccard_join"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents),
grams as (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as gram from words),
sets as (select distinct doc_id, hash(gram) as g from grams),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as i from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
    select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * i >= 90 * (x.n + y.n - i)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select a as v, a as r from both_ways union select b, r from reach join both_ways on v = a),
least as (select v, min(r) as component_id from reach group by v)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join least l on l.v = d.doc_id
"""


@query("op6_source_mix")
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op6_source_mix"] = r"""
with sizes as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
per_source as (select source, sum(size)::bigint as source_size from sizes group by source),
numbered as (
    select *, 3 * source_size as most, ((row_number() over (order by source is null, source) - 1) % 3 + 1)::bigint as weight from per_source),
steps as (
    select *, sum(source_size) over () as budget,
        coalesce(sum(most) over (order by most / weight, source rows between unbounded preceding and 1 preceding), 0) as given,
        sum(weight) over (order by most / weight, source rows between current row and unbounded following) as open
    from numbered),
level as (select max((budget - given) / open) as level from steps where (budget - given) / open <= most / weight),
targets as (
    select source, source_size, least(most::double, coalesce(level.level, 0) * weight) as target from numbered, level),
served as (
    select doc_id, s.source, size, source_size, target, md5(doc_id::varchar) as digest,
        sum(size) over (partition by s.source order by md5(doc_id::varchar), doc_id, size rows unbounded preceding) - size as start
    from sizes s join targets t on s.source is not distinct from t.source),
copies as (
    select doc_id, size, source_size, target, start + pass * source_size as start from served, (select unnest([0, 1, 2]) as pass))
select doc_id, size, source_size, target, sum(greatest(floor(least((start + size)::double, target)) - start, 0))::bigint as taken
from copies group by doc_id, size, source_size, target
"""


def fold(parts: int) -> Column:
    """Remainder of the CRC of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, learned: Column, rows: int) -> DataFrame:
    """A bounded sample `(doc_id, text, label)` of the documents that `labels` marks and that may be learned from."""
    marks = labels.where(F.col(label).isin(0, 1) & learned).select("doc_id", F.col(label).cast("int").alias("label"))
    return nbsvm.sample_labelled(docs, marks, rows)


def judged(scores: DataFrame, held_out: Column) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_model(docs: DataFrame, labels: DataFrame):
    return nbsvm.fit(labelled_rows(docs, labels, "quality", fold(3) != 1, nbsvm.SAMPLE_ROWS))


@query("op7_kmeans_tree")
def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return kmeans_tree.nearest(rows, rows.where(F.col("vec_id") % 100 == 0))


@query("op8_page_text")
def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = page_text.main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op9_nbsvm_quality")
def op9_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(nbsvm.score(docs, quality_model(docs, table(spark, sf_dir, "labels"))), fold(3) == 1)


@query("op10_kneser_ney_toxicity")
def op10_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = labelled_rows(docs, table(spark, sf_dir, "labels"), "toxic", fold(5) != 0, kneser_ney.SAMPLE_ROWS)
    return judged(kneser_ney.score(docs, kneser_ney.fit(known, docs)), fold(5) == 0)


@query("op11_fm_decontam")
def op11_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op11_fm_decontam"] = r"""
with items as (
    select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
    select distinct item, least(len(w), 10) as k, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) as win
    from items where len(w) > 0),
docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
grams as (
    select r, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: {'i': i, 'win': array_to_string(w[i:i + k - 1], ' ')})) as g
    from docs, (select distinct k from windows) lengths where len(w) >= k),
hits as (select r, grams.k, g.i as i, item from grams join windows on windows.win = g.win and windows.k = grams.k),
covered as (select r, count(distinct place) as n_hit from (select r, unnest(range(i, i + k)) as place from hits) group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from hits) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join named using (r)
"""


@query("op12_misra_gries")
def op12_misra_gries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return misra_gries.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_misra_gries"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
    from words, (select unnest([1, 2, 3, 4, 5]) as m) sizes where len(w) >= m),
f as materialized (select lang, m, phrase, count(*) as a from grams group by lang, m, phrase),
totals as (select lang, sum(a)::hugeint as n from f where m = 1 group by lang),
cand as materialized (select lang, m, phrase, a, string_split(phrase, ' ') as w from f where m > 1 and a >= 100),
cuts as (
    select lang, m, phrase, a, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail
    from cand, (select unnest([1, 2, 3, 4]) as k) ks where k < m),
scored as (
    select c.lang, c.m, c.phrase, c.a, k, x.a as l, y.a as r, n, (1000 * c.a::hugeint * n) // (x.a::hugeint * y.a::hugeint) as score
    from cuts c join f x on x.lang = c.lang and x.phrase = c.head and x.m = c.k
    join f y on y.lang = c.lang and y.phrase = c.tail and y.m = c.m - c.k join totals t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select distinct c.lang, array_to_string(w[i:i + s - 1], ' ') as phrase, a
    from cand c, (select unnest([2, 3, 4]) as s) ss, (select unnest([1, 2, 3, 4]) as i) ii where s < m and i + s - 1 <= m),
covers as (select lang, phrase, max(a) as cover from inside group by lang, phrase)
select b.lang, (row_number() over (partition by b.lang order by score desc, a desc, encode(b.phrase)))::int as rank, b.phrase, a, l, r,
    n::bigint as n, score::bigint as score
from best b left join covers c on c.lang = b.lang and c.phrase = b.phrase where cover is null or 100 * cover < 100 * a
qualify rank <= 2000
"""


@query("op13_hadamard_kmeans")
def op13_hadamard_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hadamard_kmeans.cluster(table(spark, sf_dir, "embeddings"))
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("bigint").alias("inertia")).collect()  # a row per centroid
    per_cluster = {r.cluster: r.inertia for r in sums}
    facts = [(i, per_cluster.get(i, 0), sum(per_cluster.values()), ",".join(map(str, c))) for i, c in enumerate(found.centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid string")
    joined = found.rows.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256"))


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds written out one after another; whole numbers stay exact in doubles and 128-bit sums."""
    steps = [
        f"""kept as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding::double[], lambda x: floor(1024 * x)::bigint) as v,
        sha256('3:' || coalesce(vec_id::varchar, '')) as digest
    from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"c0 as materialized (select row_number() over (order by digest, v) - 1 as c, v as m from kept order by digest, v limit {k})",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} as materialized (
    select r, vec_id, v, c, m, list_sum(list_transform(range(1, 65), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::bigint as d
    from kept, c{i} qualify row_number() over (partition by r order by d, c) = 1)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} as materialized (
    select c, j, sum(x) as s, count(*) as n from (select c, unnest(v) as x, unnest(range(1, 65)) as j from a{i}) group by c, j),
c{i + 1} as materialized (
    select c{i}.c, coalesce(moved.m, c{i}.m) as m from c{i} left join (
        select c, list(((s - ((s % n) + n) % n) // n)::bigint order by j) as m from s{i} group by c) moved on moved.c = c{i}.c)"""
            )
    return (
        "with " + ",\n".join(steps) + f""" select vec_id, c::int as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia,
    (sum(d) over ())::bigint as inertia, sha256(array_to_string(m, ',')) as centroid_sha256 from a{rounds}"""
    )


ORACLE["op13_hadamard_kmeans"] = _lloyd_sql()
