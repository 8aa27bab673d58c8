"""Readers and writers for the delimited text forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.columns import fields, record_line

EDGE = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])

TRANSACTION = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)


def read_edges_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Headerless edge list `src,dst`; a line that does not fit stops the query."""
    return spark.read.schema(EDGE).option("sep", sep).option("mode", "FAILFAST").csv(path)


def read_transactions_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Transactions of 11 fields; with a header, one that names other columns or another order stops the query."""
    reader = spark.read.schema(TRANSACTION).option("header", header).option("mode", "FAILFAST")
    return reader.option("enforceSchema", not header).csv(path)


def read_key_value(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """`(key, value)` split at the first separator; a line without one is a key with an empty value."""
    parts = fields(F.col("value"), sep, 2)
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("key"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("value")
    )


def split_fields(lines: DataFrame, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Text lines in column `value` to one string column per field; missing fields are null."""
    parts = fields(F.col("value"), sep)
    return lines.select(*[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)])


def write_text(df: DataFrame, path: str, tuples: bool = False) -> None:
    """One line per record; with `tuples`, in the form `(a,b)`."""
    line = record_line(df.columns)
    if tuples:
        line = F.concat(F.lit("("), line, F.lit(")"))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, single: bool = False, header: bool = False) -> None:
    """CSV files; `single` asks for one file, written by one task, and suits small results only."""
    if single:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", header).csv(path)


def write_key_value(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("sep", sep).csv(path)


def write_parts(df: DataFrame, part: str, path: str) -> None:
    """Comma-joined lines in one folder per value of `part` (`part=value`), written in one pass over the rows."""
    line = record_line([c for c in df.columns if c != part]).alias("value")
    df.select(line, part).write.mode("overwrite").partitionBy(part).text(path)


def write_split(train: DataFrame, test: DataFrame, train_path: str, test_path: str) -> None:
    """The two halves of a split as comma-joined lines in two folders."""
    write_text(train, train_path)
    write_text(test, test_path)
