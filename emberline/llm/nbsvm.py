"""Text quality by naive Bayes support vectors.

A text is the set of its hashed n-grams. Each n-gram indicator is scaled by the log ratio of its smoothed
frequencies in the two classes, the vector is brought to about length one, and a linear hinge-loss model is fitted by
dual coordinate descent. A logistic curve fitted on rows the model did not see turns margins into scores.

Only the fit uses a bounded sample of the labelled rows (`SAMPLE_ROWS`, chosen by a digest of the id); scoring
reads every text whole.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import trimmed

SAMPLE_ROWS = 8_000
BITS = 18
GRAMS = (2, 3, 4)
FEW = 30.0


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Sorted numbers of the hashed n-grams that occur in a text; a null or empty text has none.

    Besides byte n-grams there are n-grams of one word said again: the same word 2, 3, ... up to 6 times in a row.
    """
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    seen = np.zeros(1 << bits, bool)
    code = data.astype(np.uint32)
    for n in range(2, GRAMS[-1] + 1):
        if len(data) < n:
            break
        code = code[:-1] << np.uint32(8) | data[n - 1 :]
        if n in GRAMS:
            seen[(code + np.uint32(n * 0x51ED270B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)] = True
    words = raw.split()
    same = np.fromiter(map(operator.eq, words, words[1:]), bool, max(len(words) - 1, 0))
    for n in range(2, 7):
        if not same.any():
            break
        seen[n * 0x9E3779B1 % (1 << bits)] = True
        same = same[1:] & same[:-1]
    return np.flatnonzero(seen).astype(np.int32)


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, smooth: float = 1.0) -> np.ndarray:
    """Log ratio of each n-gram's share among class 1 to that among class 0."""
    counts = [np.full(1 << bits, smooth), np.full(1 << bits, smooth)]
    for row, label in zip(rows, labels, strict=True):
        counts[label][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def descend(rows, values, signs: np.ndarray, bits: int = BITS, cost: float = 1.0, passes: int = 12, seed: int = 7):
    """Hinge-loss weights by dual coordinate descent; `values` holds each row's entries, the last weight is the bias."""
    weight = np.zeros((1 << bits) + 1)
    alpha, size = np.zeros(len(rows)), np.array([v @ v for v in values]) + 1.0
    order = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            row, value, sign = rows[i], values[i], signs[i]
            slope = sign * (weight[row] @ value + weight[-1]) - 1.0
            after = min(max(alpha[i] - slope / size[i], 0.0), cost)
            step = (after - alpha[i]) * sign
            if step:
                weight[row] += step * value
                weight[-1] += step
                moved = max(moved, abs(after - alpha[i]))
                alpha[i] = after
        if moved < 1e-3:
            break
    return weight


def logistic(margin: np.ndarray, labels: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope (not below 0) and offset of the logistic curve that fits the labels, by short Newton steps with a ridge on the slope."""
    middle, spread = float(margin.mean()), max(float(margin.std()), 1e-9)
    x = np.stack([(margin - middle) / spread, np.ones(len(margin))], 1)
    share = np.clip(labels.mean(), 0.01, 0.99)
    beta, ridge = np.array([1.0, np.log(share / (1 - share))]), np.diag([0.1, 1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (labels - p) - ridge @ beta)
        step /= max(1.0, np.abs(step).max())
        beta = np.array([max(beta[0] + step[0], 0.0), beta[1] + step[1]])
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / spread), float(beta[1] - beta[0] * middle / spread)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights, bias, slope and offset as one vector; with one class only, a constant score."""
    size = 1 << BITS
    out = np.zeros(2 * size + 3)
    if len(np.unique(labels)) < 2:
        out[-1] = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        return out
    held = np.arange(len(rows)) % 4 == 3
    if len(np.unique(labels[held])) < 2 or len(np.unique(labels[~held])) < 2:
        held = np.ones(len(rows), bool)  # too few rows to keep some out
        train = held
    else:
        train = ~held
    ratios = log_ratios([rows[i] for i in np.flatnonzero(train)], labels[train])
    values = [scaled(row, ratios) for row in rows]
    chosen = np.flatnonzero(train)
    weight = descend([rows[i] for i in chosen], [values[i] for i in chosen], 2.0 * labels[chosen] - 1)
    margin = np.array([weight[rows[i]] @ values[i] + weight[-1] for i in np.flatnonzero(held)])
    out[:size], out[size : 2 * size], out[-3] = ratios, weight[:-1], weight[-1]
    out[-2:] = logistic(margin, labels[held].astype(float))
    return out


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Log ratios of a row's n-grams, brought to a length of at most one; few n-grams stay short, as weak evidence."""
    value = ratios[row]
    return value / np.sqrt(value @ value + FEW)


def sample_labelled(docs: DataFrame, marks: DataFrame, rows: int) -> DataFrame:
    """`(doc_id, text, label)` of a bounded sample: the first `rows` of `marks` `(doc_id, label)` by a digest of the id.

    The sample is drawn before the texts are met, so that a broadcast of at most `rows` ids finds them.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = marks.select("doc_id", "label").orderBy(digest, "doc_id", "label").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Fit on `(doc_id, text, label)`, label 0 or 1: the model as one vector of fixed size.

    At most `rows` rows take part, the first by a digest of the id. Their n-gram sets are computed by the tasks
    that read them; the sets of the bounded sample meet in one task, and only the model comes to the driver.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sample = labelled.select("doc_id", "text", "label")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("label"), pa.array(lists, pa.list_(pa.int32()))], ["digest", "label", "grams"]
            )

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(size=frame["grams"].map(len)).sort_values(["digest", "label", "size"], kind="stable")
        model = fit_rows([np.asarray(g) for g in frame["grams"]], frame["label"].to_numpy().astype(np.int64))
        return pd.DataFrame({"model": [model.astype(np.float32).tobytes()]})

    chosen = sample.where("label is not null").withColumn("digest", digest).orderBy("digest", "doc_id").limit(rows)
    grams = chosen.select("digest", "label", "text").mapInArrow(trimmed(sets), "digest string, label int, grams array<int>")
    found = grams.groupBy(F.lit(1).alias("one")).applyInPandas(lambda _, f: fitted(f), "model binary").collect()
    return np.frombuffer(found[0].model, np.float32) if found else fit_rows([], np.zeros(0, np.int64)).astype(np.float32)


def score(docs: DataFrame, model: np.ndarray, id_column: str = "doc_id", text_column: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """`(id, *keep, score)` of each whole text, between 0 and 1; null and empty texts get the model's score of no n-grams.

    The model has a fixed size (two numbers per hashed n-gram), whatever the data; it goes out as a broadcast.
    Ids may be null or repeat; other columns are not read; an empty table gives no rows.
    """
    source = docs.select(*dict.fromkeys([id_column, *keep, text_column]))
    carried = [c for c in source.columns if c in (id_column, *keep)]
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(model, np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BITS
        vector = sent.value
        ratios, weight = vector[:size].astype(float), vector[size : 2 * size].astype(float)
        bias, slope, offset = (float(x) for x in vector[-3:])
        for batch in batches:
            out = []
            for text in batch.column(text_column):
                row = features(text.as_py())
                value = scaled(row, ratios)
                out.append(1 / (1 + np.exp(-np.clip(slope * (weight[row] @ value + bias) + offset, -30, 30))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(out, pa.float64())], [*carried, "score"])

    types = dict(source.dtypes)
    return source.mapInArrow(trimmed(run), ", ".join([*(f"{c} {types[c]}" for c in carried), "score double"]))
