"""Session settings and lineage cutting shared by the iterative plans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    name: str = "emberline", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on; `settings` come last and win."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint folder.

    A folder of our own is made only on a local master with the setting absent, as in tests.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="emberline-"))
        current = context.getCheckpointDir()
    return current


def new_folder(spark: SparkSession, prefix: str = "emberline") -> str:
    """A new path in the shared folder, removed with what is in it when the session ends."""
    path = f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; without this they stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder and continue from the stored rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
