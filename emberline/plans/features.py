"""Preparation of transaction records for the tree models, and repeatable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.columns import drop_first, fields, hash_bucket, type_code
from emberline.operators.skew import ROWS_PER_TASK
from emberline.session import cut_lineage, shuffle_width

# The columns of a prepared transaction, in field order.
PREPARED = (
    "step", "ttype", "amt", "nameOrig", "oldBalOrg", "newBalOrg",
    "nameDest", "oldBalDest", "newBalDest", "isFraud", "isFlagged",
)
FEATURES = tuple(c for c in PREPARED if c != "isFraud")
HASH_VALUES = 2**32


def _numbers(parts: Column) -> dict[str, Column]:
    numbers = {}
    for i, name in enumerate(PREPARED):
        text = F.get(parts, F.lit(i))
        if name == "ttype":
            numbers[name] = type_code(text)
        else:
            numbers[name] = (drop_first(text) if name.startswith("name") else text).try_cast("double")
    return numbers


def _is_well_formed(parts: Column) -> Column:
    good = F.size(parts) == len(PREPARED)
    for value in _numbers(parts).values():
        good = good & value.isNotNull()
    return F.coalesce(good, F.lit(False))


def prepare_transactions(lines: DataFrame, malformed: str = "fail", keep: Sequence[str] = ()) -> DataFrame:
    """Text lines of 11 fields, in column `value`, to 11 numbers, after the columns named in `keep`.

    The type becomes its code and the two names lose their first letter. A line with another number of
    fields, or a field that is no number, stops the query; with `malformed="drop"` it is left out, and
    `count_malformed` tells how many there are.
    """
    parts = fields(F.col("value"))
    if malformed == "drop":
        numbers = _numbers(parts)
        return lines.where(_is_well_formed(parts)).select(*keep, *[c.alias(name) for name, c in numbers.items()])
    if malformed != "fail":
        raise ValueError(f"unknown choice {malformed!r}")
    stop = F.raise_error(F.concat(F.lit("malformed transaction: "), F.col("value")))
    eleven = F.when(F.size(parts) == len(PREPARED), parts).otherwise(stop.cast("array<string>"))
    numbers = {name: F.coalesce(c, stop.cast("double")) for name, c in _numbers(eleven).items()}
    return lines.select(*keep, *[c.alias(name) for name, c in numbers.items()])


def count_malformed(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count_if(~_is_well_formed(fields(F.col("value")))).alias("malformed"))


def kept_for_training(df: DataFrame, key: str) -> DataFrame:
    """The rows spread evenly by a unique key and stored once, for the many passes of training; more rows take more tasks."""
    width = max(shuffle_width(df.sparkSession), -(-df.count() // ROWS_PER_TASK))
    return cut_lineage(df.repartition(width, key))


def assemble_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def index_label(df: DataFrame, column: str = "isFraud") -> DataFrame:
    """`label`: 0.0 for the most frequent value of the column, 1.0 for the next, ..."""
    return StringIndexer(inputCol=column, outputCol="label").fit(df).transform(df)


def split_random(df: DataFrame, key: str, share: float = 0.8, seed: int = 20) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the key: every row in one of them, the same on every run and partitioning."""
    marked = mark_random(df, key, share, seed, "_first")
    return marked.where("_first").drop("_first"), marked.where(~F.col("_first")).drop("_first")


def mark_random(df: DataFrame, key: str, share: float = 0.8, seed: int = 20, out: str = "first") -> DataFrame:
    """Add whether a row belongs to the first part: its whole 32-bit hash lies below that share of all hashes."""
    return df.withColumn(out, F.coalesce(hash_bucket(F.col(key), seed, HASH_VALUES) < round(share * HASH_VALUES), F.lit(False)))


def split_stratified(
    df: DataFrame, key: str, label: str, share: float = 0.7, seed: int = 20
) -> tuple[DataFrame, DataFrame]:
    """As `split_random`, drawn for each label value by itself, so that both parts hold every label."""
    drawn = F.concat_ws(":", F.col(label).cast("string"), F.col(key).cast("string"))
    first = hash_bucket(drawn, seed, HASH_VALUES) < round(share * HASH_VALUES)
    return df.where(first), df.where(~first)
