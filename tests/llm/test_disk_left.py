import random
import time
from pathlib import Path

import corpus_pipeline
from emberline.llm import bwt_dedup, common, jaccard_join, source_mix
from emberline.session import shared_folder


def tables(spark):
    """The tables in the shared folder."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    return {p for p in folder.iterdir() if p.is_dir() and p.name.startswith(("llm-", "buckets-"))}


def columns(spark, paths):
    return {c for p in paths for c in spark.read.parquet(str(p)).columns}


def sample(documents, n=60):
    draw = random.Random(11)
    base = [f"w{draw.randint(0, 400)}" for _ in range(120)]
    texts = [" ".join([*base[: 60 + i % 50], f"x{i % 9}", *(f"y{draw.randint(0, 400)}" for _ in range(i % 4 * 30))]) for i in range(n)]
    return documents([(i, t, "abc"[i % 3]) for i, t in enumerate(texts)])


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    df = spark.range(1000).repartition(3, "id").groupBy("id").count()
    assert common.stored(df).count() == 1000
    assert spark.conf.get(setting, None) == was
    assert df.where("count = 1").count() == 1000  # the plan itself can still run
    again = shuffle_files(spark)
    common.stored(df.repartition(5, "count"))
    for _ in range(50):  # executors drop them a moment later
        if not (left := shuffle_files(spark) - again):
            break
        time.sleep(0.2)
    assert not left


def test_components_leave_their_result_alone(spark, documents):
    df, before = sample(documents), tables(spark)
    found = jaccard_join.jaccard_components(df, 3, 80)
    assert len(tables(spark) - before) == 1
    assert found.count() == 60
    before = tables(spark)
    links = common.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint"))
    assert len(tables(spark) - before) == 1
    assert {r.component_id for r in links.collect()} == {0}


def test_removals_leave_their_marks_alone(spark, documents):
    df, before = sample(documents), tables(spark)
    found = bwt_dedup.removals(df, width=250)
    assert len(tables(spark) - before) == 1
    assert found.where("size(spans) > 0").count() > 0


def test_stages_leave_no_copy_of_the_texts(spark, documents):
    df = sample(documents)
    for stage in (corpus_pipeline.near_copies, corpus_pipeline.repeated_passages, corpus_pipeline.mixture):
        before = tables(spark)
        rows = stage(spark, df, "").count()
        left = tables(spark) - before
        assert rows and not columns(spark, left) & {"text", "bytes", "grams", "prefix"}, stage.__name__
    before = tables(spark)
    mixed = source_mix.mix_sources(df)
    assert len(tables(spark) - before) <= 4  # the copies, and a few rows per source
    common.released(mixed)
    assert not columns(spark, tables(spark) - before) & {"doc_id", "digest"}


def test_copies_go_without_a_shuffle_of_the_texts(spark, documents):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_copies(spark, sample(documents), "")
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(row" not in plan and "BroadcastHashJoin" in plan
    assert 0 < kept.count() < 60


def test_fewer_full_buckets_than_shuffle_partitions_are_not_shuffled_again(spark, documents, monkeypatch):
    used, write = [], jaccard_join.BucketedTable.write
    monkeypatch.setattr(jaccard_join, "DOCS_PER_BUCKET", 20)
    monkeypatch.setattr(jaccard_join.BucketedTable, "write", lambda df, keys, buckets: (used.append(buckets), write(df, keys, buckets))[1])
    assert jaccard_join.jaccard_components(sample(documents), 3, 80).count() == 60
    assert used == [4]


def test_counts_take_the_bytes_they_need():
    import numpy as np

    for most, width in ((0, 1), (255, 1), (256, 2), (70_000, 4), (2**31 - 1, 4)):
        counts = np.array([0, 1, most], np.int64)
        data = jaccard_join.narrow(counts)
        assert len(data) == 3 * width and (jaccard_join.widened(data, 3) == counts).all()


def test_a_slice_of_texts_is_small():
    import pyarrow as pa

    from emberline.llm.piece_bpe import slices

    texts = ["x" * 200_000] * 10 + ["y" * 900_000, "", None]
    parts = [p.column("text").to_pylist() for p in slices(pa.record_batch({"text": texts}), "text")]
    assert sum(parts, []) == texts
    assert all(sum(len(t or "") for t in p[1:]) <= 1 << 19 for p in parts)
