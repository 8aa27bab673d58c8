"""Rounds of a loop written to a folder, from which the loop can go on."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Round i's rows in `iter=i` below `path`, and then, as the sign that they are whole, its manifest in `_manifest/iter=i`.

    The manifest holds the settings of the run and facts about the round. A run with other settings does not go on from it.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict):
        self.spark, self.path, self.settings = spark, path, settings

    def write(self, number: int, rows: DataFrame, **facts) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/iter={number}")
        text = json.dumps({"round": number, "settings": self.settings, "facts": facts})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/_manifest/iter={number}")

    def last(self) -> tuple[int, dict] | None:
        """Number and facts of the last whole round; None if there is none."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest")
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return None
        told = [json.loads(r.value) for r in self.spark.read.text(f"{self.path}/_manifest").select("value").collect()]  # a row per round
        if not told:
            return None
        found = max(told, key=lambda t: t["round"])
        if found["settings"] != self.settings:
            raise ValueError(f"{self.path} holds rounds of {found['settings']}, not of {self.settings}")
        return found["round"], found["facts"]

    def read(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/iter={number}")

    def up_to(self, number: int) -> DataFrame:
        """All rounds up to `number`, with the round in `iter`."""
        return self.spark.read.parquet(self.path).where(f"iter <= {number}")
