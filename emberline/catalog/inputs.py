"""Inputs of the registered queries, derived from the given tables, and the same in SQL.

Every input uses all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.columns import TYPE_CODES
from emberline.plans import features
from emberline.session import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder for files that one call writes and reads back; it goes when the session ends."""
    return new_folder(spark)


def supply_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Part -> supplier for each line item: repeated edges, self-loops, hubs."""
    return table(spark, folder, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


SUPPLY_EDGES = "supply as (select l_partkey src, l_suppkey dst from lineitem)"


def order_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Customer -> a tenth of the order number, for each order."""
    orders = table(spark, folder, "orders")
    return orders.select(F.col("o_custkey").alias("src"), F.expr("o_orderkey div 10").alias("dst"))


ORDER_EDGES = "ordered as (select o_custkey src, o_orderkey // 10 dst from orders)"


def balances(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.floor("c_acctbal").alias("x"))


BALANCES = "points as (select c_custkey id, floor(c_acctbal)::bigint x from customer)"


def follower_points(spark: SparkSession, folder: str) -> DataFrame:
    counts = supply_edges(spark, folder).groupBy("dst").agg(F.count(F.lit(1)).alias("x"))
    return counts.withColumnRenamed("dst", "id")


FOLLOWER_POINTS = "points as (select l_suppkey id, count(*) x from lineitem group by 1)"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("type"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_custkey").alias("user"),
        (F.col("o_orderstatus") == "F").cast("int").alias("cls"),
    )


def drawn(key: str, seed: int, share: float) -> str:
    """SQL for the condition of the first part of a split."""
    return (
        f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::bigint % {features.HASH_VALUES}) < {round(share * features.HASH_VALUES)}"
    )


TRANSACTIONS = f"""txn as (
    select o_orderkey id, o_orderpriority type, o_totalprice amount, o_custkey usr, (o_orderstatus = 'F')::int cls from orders),
train as (select * from txn where {drawn("id", 20, 0.8)}),
test as (select * from txn where not {drawn("id", 20, 0.8)})"""

# The transaction type that stands for each order priority.
PRIORITY_TYPES = dict(zip(("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"), TYPE_CODES, strict=True))


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of 11 fields, one per order of a known customer, with the order number in front."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    kind = F.lit(None).cast("string")
    for priority, name in PRIORITY_TYPES.items():
        kind = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(kind)
    amount, balance = F.col("o_totalprice"), F.col("c_acctbal")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")).alias("step"),
        kind.alias("type"),
        amount.alias("amount"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        balance.alias("oldbalanceOrg"),
        F.round(balance - amount, 2).alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.col("c_nationkey").cast("string")).alias("nameDest"),
        F.lit(0.0).alias("oldbalanceDest"),
        amount.alias("newbalanceDest"),
        ((amount > 400000) & urgent).cast("int").alias("isFraud"),
        (amount > 490000).cast("int").alias("isFlaggedFraud"),
    )


_TYPE_CASE = " ".join(f"when '{p}' then '{t}'" for p, t in PRIORITY_TYPES.items())
RECORDS = f"""records as (
    select o_orderkey, date_diff('day', date '1992-01-01', o_orderdate::date)::int step,
        case o_orderpriority {_TYPE_CASE} end type, o_totalprice amount, 'C' || o_custkey "nameOrig",
        c_acctbal "oldbalanceOrg", round(c_acctbal - o_totalprice, 2) "newbalanceOrig", 'M' || c_nationkey "nameDest",
        0.0::double "oldbalanceDest", o_totalprice "newbalanceDest",
        (o_totalprice > 400000 and o_orderpriority in ('1-URGENT', '2-HIGH'))::int "isFraud",
        (o_totalprice > 490000)::int "isFlaggedFraud"
    from orders join customer on o_custkey = c_custkey)"""

# The prepared form of `records`.
_CODE_CASE = " ".join(f"when '{t}' then {c}" for t, c in TYPE_CODES.items())
PREPARED = f"""{RECORDS},
prepared as (
    select o_orderkey, step::double step, (case type {_CODE_CASE} else 0.0 end)::double ttype, amount amt,
        substr("nameOrig", 2)::double "nameOrig", "oldbalanceOrg" "oldBalOrg", "newbalanceOrig" "newBalOrg",
        substr("nameDest", 2)::double "nameDest", "oldbalanceDest" "oldBalDest", "newbalanceDest" "newBalDest",
        "isFraud"::double "isFraud", "isFlaggedFraud"::double "isFlagged"
    from records)"""


def record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The records as text lines, with the order number kept beside them."""
    from emberline.functions.columns import record_line

    df = records(spark, folder)
    return df.select("o_orderkey", record_line([c for c in df.columns if c != "o_orderkey"]).alias("value"))


def model_table(spark: SparkSession, folder: str) -> DataFrame:
    """Prepared records with features and label, ready for the tree models."""
    df = features.kept_for_training(prepared_with_key(spark, folder), "o_orderkey")
    return features.index_label(features.assemble_features(df))


def prepared_with_key(spark: SparkSession, folder: str) -> DataFrame:
    return features.prepare_transactions(record_lines(spark, folder), keep=("o_orderkey",))


def model_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return features.split_stratified(model_table(spark, folder), "o_orderkey", "isFraud")
