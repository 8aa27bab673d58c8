"""What several operators of this subpackage share: stored tables, ordered ranks, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberline.session import shared_folder, shuffles_dropped

WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and go on from the written rows.

    Cuts the lineage; every executor can read the files, so a lost one costs nothing already written.
    The files go when the session ends, the shuffle files of the write at its end.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Delete tables that `stored` wrote, or that lie under these results, once everything that reads them is written itself."""
    for each in tables:
        spark = each.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(each.stored_at)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hand_back() -> None:
    """Give memory that this process has freed, but its allocators keep, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function `run` for `mapInArrow`, whose worker hands freed memory back when a task of it ends.

    Spark keeps a worker for later tasks, also through stages without Python; what it still holds counts
    beside the executor's heap there.
    """

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        hand_back()

    return inside


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ranked(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """Add the global position of each row from 0 in `order`, which must be a total order of the rows.

    Rows are cut into ranges, numbered inside their range, and shifted by the sizes of the ranges below:
    no task sees the whole order, only a table of one row per range. `released` takes the result once it is stored.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    below = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(below), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    numbered = parts.withColumn("_inside", F.row_number().over(inside) - 1)
    found = numbered.join(offsets, "_part").withColumn(out, F.col("_offset") + F.col("_inside")).drop("_part", "_offset", "_inside")
    found.stored_at = parts.stored_at
    return found


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """`(a, b)` links between ids to `(id, component_id)` for every linked id; the least id names a component.

    Alternates two star rounds: every vertex sends its larger neighbours, then its smaller ones, to the least
    neighbour, until the links are one star per component. A round moves links only; minima combine before
    the shuffle, so a vertex with many links sends one row per task to its minimum. More rounds than `rounds`
    raise an error rather than return unfinished components.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        before, edges = edges, stored(small.distinct())
        released(before, large)
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("u").alias("us")).first()
        inner = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if state.n == state.us and inner.isEmpty():  # every vertex hangs on one root, and no root hangs on another
            roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component_id", F.col("id"))
            found = stored(edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots))
            released(edges)
            return found
    raise RuntimeError(f"components did not settle in {rounds} rounds")
