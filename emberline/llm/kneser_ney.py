"""Toxicity by two class-conditional Kneser-Ney models over shared backoff counts.

Expressions are the lower-cased words of a text and their stems (the first `STEM` characters). As Kneser-Ney
counts do, an expression counts once per context it occurs in; the context is the document. Each class has
discounted counts from a bounded sample of the labelled rows; a word backs off to its stem, and a stem to the
shared counts, which come from all documents of the corpus. Class 1 is discounted by a small share of its
documents, class 0 so that both give the same mass to their backoff: an expression that is rare in both then
has the same probability in both, whatever the sizes of the classes. A toxic text also says ordinary things, so
a word that the ordinary model explains better gets that likelihood from both. The score is the difference
of the log-likelihoods divided by the number of words, put through a logistic curve fitted on sample rows that
the models did not see.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import stored
from emberline.llm.nbsvm import logistic
from emberline.llm.piece_bpe import WordTable, slices

STEM = 4
OWN_WEIGHT = 0.1  # of a class's own counts; the rest of its mass goes to the backoff
CUT_SHARE = 0.01  # discount of class 1, as a share of its sampled documents; 2 at least
SAMPLE_ROWS = 12_000
HELD_WORDS = 300_000
_WORDS = re.compile(r"\w+")


def words_in(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def expressions(words: list[str]) -> set[str]:
    """A document's distinct words, and its distinct stems marked by a star."""
    found = set(words)
    return found | {w[:STEM] + "*" for w in found}


def document_counts(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """`(*by, item, n)`: in how many rows of `text` each expression occurs, over whole texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        kinds = 0

        def flush():
            for key, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(counts), pa.int32()) for k in key] + [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    [*by, "item", "n"],
                )
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                keys = list(zip(*(part.column(c).to_pylist() for c in by), strict=True)) if by else [()] * part.num_rows
                for key, text in zip(keys, part.column("text").to_pylist(), strict=True):
                    held.setdefault(key, Counter()).update(expressions(words_in(text)))
                kinds = sum(map(len, held.values()))
                if kinds > HELD_WORDS:  # partial counts; the aggregate adds them up
                    yield from flush()
        yield from flush()

    schema = "".join(f"{c} int, " for c in by) + "item string, n bigint"
    return rows.select(*by, "text").mapInArrow(counted, schema).groupBy(*by, "item").agg(F.sum("n").alias("n"))


def levels(counts: list[tuple[np.ndarray, np.ndarray]], cut: float) -> list[tuple[float, float, float]]:
    """`(total, discount, backoff mass)` of class 0 and 1 from how many expressions have each count; class 0's
    discount gives both the same backoff mass."""
    total = [max(float(n @ times), 1.0) for n, times in counts]
    (n0, times0), (n1, times1) = counts
    mass = float(np.minimum(n1, cut) @ times1) / total[1] if len(n1) else 1.0
    low, high = 0.0, float(n0.max()) if len(n0) else 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if np.minimum(n0, middle) @ times0 < mass * total[0]:
            low = middle
        else:
            high = middle
    return [(total[0], high, mass), (total[1], cut, mass)]


class TwoModels:
    """The two class models; `solve` gives the log-likelihood differences of words."""

    def __init__(self, data: dict):
        self.data = data
        self.slope, self.offset = data.get("curve", (1.0, 0.0))

    def own(self, kind: str, item: str, label: int) -> float:
        total, cut, _ = self.data[kind][label]
        return OWN_WEIGHT * max(self.data["counts"][label].get(item, 0) - cut, 0.0) / total

    def gain(self, word: str) -> float:
        stem = word[:STEM] + "*"
        share = self.data["shared"].get(stem, 1) / self.data["stems"]
        inside = min(1.0, self.data["shared"].get(word, 1) / self.data["words"] / share)
        p = []
        for label in (0, 1):
            of_stem = self.own("stem", stem, label) + (1 - OWN_WEIGHT * (1 - self.data["stem"][label][2])) * share
            p.append(self.own("word", word, label) + (1 - OWN_WEIGHT * (1 - self.data["word"][label][2])) * of_stem * inside)
        return max(np.log(p[1] / p[0]), 0.0)

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For a `WordTable`, whose words carry a mark in front."""
        return np.ones(len(words), np.int64), np.array([self.gain(w[1:]) for w in words])

    def margins(self, texts: list[str | None], words: WordTable) -> np.ndarray:
        """Log-likelihood difference per word of each text; 0 without words."""
        lists = [words_in(t) for t in texts]
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        rows = words.look_up([w for one in lists for w in one])
        total = np.concatenate([[0.0], np.cumsum(words.values[rows])])
        end = np.cumsum(count)
        return (total[end] - total[end - count]) / np.maximum(count, 1)


def fit(labelled: DataFrame, docs: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Fit on `(doc_id, text, label)`, label 0 or 1, with shared counts from all of `docs`; the model as plain data.

    At most `rows` labelled rows take part, the first by a digest of the id. Of the bounded sample's counts
    those above the discounts come to the driver, and the shared counts of the same expressions. One row in five
    of the sample is kept from the counts for the logistic curve. Without rows of both classes every text
    scores the share of class 1.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = labelled.select("doc_id", "text", "label").where("label is not null").withColumn("digest", digest)
    sample = stored(chosen.orderBy("digest", "doc_id").limit(rows))
    held = F.pmod(F.conv(F.substring("digest", 1, 4), 16, 10).cast("int"), F.lit(5)) == 0

    seen = sample.where(~held).select("label", "text").dropDuplicates()
    found = stored(document_counts(seen, ("label",)))
    toxic = seen.where("label = 1").count()
    cut = max(2.0, CUT_SHARE * toxic)
    data: dict = {"counts": {}}
    is_stem = F.col("item").endswith("*")
    spread = found.groupBy("label", is_stem.alias("stem"), "n").agg(F.count(F.lit(1)).alias("times")).toPandas()
    for kind, stem in (("stem", True), ("word", False)):
        some = [spread[(spread["label"] == label) & (spread["stem"] == stem)] for label in (0, 1)]
        data[kind] = levels([(x["n"].to_numpy(float), x["times"].to_numpy(float)) for x in some], cut)
    for label in (0, 1):
        least = F.when(is_stem, F.lit(float(data["stem"][label][1]))).otherwise(F.lit(float(data["word"][label][1])))
        kept = found.where((F.col("label") == label) & (F.col("n") > least)).select("item", "n").collect()
        data["counts"][label] = {r["item"]: float(r["n"]) for r in kept}

    # Shared counts of all documents; those of expressions without own counts cancel and stay where they are.
    shared = stored(document_counts(docs))
    spark = docs.sparkSession
    items = sorted(set(data["counts"][0]) | set(data["counts"][1]))
    wanted = spark.createDataFrame([(i,) for i in items], "item string")
    data["shared"] = {r["item"]: r["n"] for r in shared.join(F.broadcast(wanted), "item", "left_semi").collect()}
    totals = shared.agg(F.sum(F.when(is_stem, F.col("n"))).alias("stems"), F.sum(F.when(~is_stem, F.col("n"))).alias("words")).first()
    data["stems"], data["words"] = float(totals.stems or 1), float(totals.words or 1)

    models = spark.sparkContext.broadcast(data)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        two = TwoModels(models.value)
        words = WordTable(two.solve)
        for frame in batches:
            yield pd.DataFrame({"label": frame["label"], "margin": two.margins(frame["text"].tolist(), words)})

    known = sample.where(held).select("label", "text").mapInPandas(judged, "label int, margin double").toPandas()
    labels = known["label"].to_numpy(float)
    if len(set(labels)) == 2:
        data["curve"] = logistic(known["margin"].to_numpy(float), labels)
    else:
        share = sample.agg(F.avg("label").alias("share")).first().share
        share = min(max(share if share is not None else 0.5, 0.01), 0.99)
        data["curve"] = (0.0, float(np.log(share / (1 - share))))
    models.unpersist()
    return data


def score(docs: DataFrame, data: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(id, margin, score)` of each whole text; a text without words has margin 0.

    The model is bounded by the labelled sample it was fitted on and goes out as a broadcast. Null text counts as
    empty; ids may be null or repeat; other columns are not read; an empty table gives no rows.
    """
    source = docs.select(id_column, text_column)
    sent = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = TwoModels(sent.value)
        words = WordTable(two.solve)
        for batch in batches:
            for part in slices(batch, text_column):
                margin = two.margins(part.column(text_column).to_pylist(), words)
                value = 1 / (1 + np.exp(-np.clip(two.slope * margin + two.offset, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(id_column), pa.array(margin), pa.array(value)], [id_column, "margin", "score"])

    return source.mapInArrow(run, f"{id_column} {dict(source.dtypes)[id_column]}, margin double, score double")
