"""Bucketed, sorted tables in the shared folder, for loops that join one table by the same key in every round.

A table is written once, hash-partitioned and sorted by its keys, one file per bucket. Joins and aggregates by these keys read
it without an exchange or a sort, and an executor that is lost takes nothing of it away.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from emberline.session import new_folder

# Spark reports the order of bucket files only on request; loops ask for it while they run.
_SETTINGS = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Plans made inside read bucketed tables by bucket and in their order."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@dataclass
class BucketedTable:
    name: str
    path: str
    rows: DataFrame
    """Read by bucket inside `sorted_buckets`."""

    @classmethod
    def write(cls, df: DataFrame, keys: Sequence[str], buckets: int) -> BucketedTable:
        """`df` stored in `buckets` files by a hash of `keys`, each sorted by them."""
        spark = df.sparkSession
        name, path = f"emberline_{uuid.uuid4().hex}", new_folder(spark, "buckets")
        by_key = df.repartition(buckets, *keys)
        by_key.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
        return cls(name, path, spark.table(name))

    def is_empty(self) -> bool:
        """Without a job: a bucket without rows has no file."""
        return not self.rows.inputFiles()

    def plain(self) -> DataFrame:
        """The same rows from the files alone; stays readable when the table's name is gone."""
        return self.rows.sparkSession.read.schema(self.rows.schema).parquet(self.path)

    def forget(self) -> None:
        """Take the name out of the catalog; the files stay until the session ends."""
        self.rows.sparkSession.sql(f"drop table if exists {self.name}")

    def remove(self) -> None:
        """Forget the name and delete the files, once everything that reads them is written itself."""
        self.forget()
        spark = self.rows.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
