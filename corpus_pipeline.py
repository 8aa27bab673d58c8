"""The training-data pipeline over `documents`: quality, near copies, repeated passages, mixing, tokens.

Each stage takes `(spark, docs, sf_dir)` and works on all rows of `docs`; all but the last return the columns of
`documents`. `run` writes every stage's rows to the shared folder and reads them back for the next. Every stage
gives an empty table for an empty one and reads no columns but those of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import bwt_dedup, jaccard_join, nbsvm, piece_bpe, queries, source_mix
from emberline.llm.common import WORD, ranked, released, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
PASSAGE_BYTES = 250  # fixed value: 51 words are shorter in about one of a hundred runs of the given documents


def documents(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null texts are judged as empty ones, repeated rows alike."""
    docs = docs.select(*COLUMNS)
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return documents(nbsvm.score(docs, model, keep=COLUMNS).where("score >= 0.5"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of every group linked by five-word shingles with a similarity of 0.8 or more.

    Documents without words or id stay. Rows that share an id are documents of their own, which go only as near
    copies; among those the one with the least digest stays.
    """
    docs = docs.select(*COLUMNS)
    named, nameless = docs.where("doc_id is not null"), docs.where("doc_id is null")
    if named.groupBy("doc_id").count().where("count > 1").limit(1).count():
        digest = F.md5(F.to_json(F.struct("doc_id", "text", "lang", "source")).cast("binary"))
        placed = ranked(named.withColumn("digest", digest), ["doc_id", "digest"], "row")
        keyed = stored(placed)
        released(placed)
    else:
        keyed = named.withColumn("row", F.col("doc_id"))
    groups = jaccard_join.jaccard_components(keyed, size=5, percent=80, id_column="row")
    gone = groups.where("component_id <> row").select("row")  # texts stay where they are if these ids fit a broadcast
    kept = keyed.join(F.broadcast(gone) if gone.count() <= jaccard_join.BROADCAST_IDS else gone, "row", "left_anti")
    return documents(kept.unionByName(nameless, allowMissingColumns=True))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 250 bytes that occur elsewhere, some 40 words; texts that lose everything go.

    Where a removal cuts through a character, the rest of it shows as U+FFFD. Empty and null texts stay as they are.
    """
    removed = bwt_dedup.removals(docs.select(*COLUMNS), width=PASSAGE_BYTES, keep=("lang", "source", "n_chars"))
    left = removed.where((F.octet_length("kept") > 0) | (F.col("n_bytes") == 0))
    text = F.when(F.col("n_chars").isNull() & (F.col("n_bytes") == 0), None).otherwise(F.make_valid_utf8(F.col("kept").cast("string")))
    return documents(left.select("doc_id", text.alias("text"), "lang", "source"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a document once per copy that the mix takes, the last copy cut to the words taken.

    A cut copy has its words joined by single spaces. Documents without words take no part in a mix of words.
    """
    docs = docs.select(*COLUMNS).withColumn("row", F.md5(F.to_json(F.struct("doc_id", "text", "lang", "source")).cast("binary")))
    mixed = source_mix.mix_sources(docs.select(F.col("row").alias("doc_id"), "source", "text"))
    taken = stored(mixed.where("taken > 0").groupBy(F.col("doc_id").alias("row"), "size").agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows")))
    released(mixed)
    if taken.where("rows > 1").limit(1).count():  # equal rows: their copies are counted together
        docs = docs.dropDuplicates(["row"])
    full = F.floor(F.col("taken") / F.col("size"))
    copies = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("taken") / F.col("size")) - 1)
    played = docs.join(taken.select("row", "size", "taken"), "row").withColumn("copy", F.explode(copies))
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), (F.col("taken") - full * F.col("size")).cast("int"))
    text = F.when(F.col("copy") < full, F.col("text")).otherwise(F.array_join(words, " "))
    return documents(played.withColumn("text", text))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: the piece ids of every text with begin and end, their number, and a digest of what they decode to."""
    model = queries.piece_model()
    decoded = piece_bpe.encode_and_decode(docs.select(*COLUMNS), model)
    return decoded.select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("mixture", mixture), ("tokens", tokens)]

# Learned scores, repeated strings and piece encoding have no SQL form; tests hold the stages against plain programs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for place, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        if place:
            released(before)
    return STAGES[-1][1](spark, docs, sf_dir)
