"""What the plans must look like at scale."""

from pyspark.sql import functions as F

from emberline.catalog import entries, inputs
from emberline.operators import aggregates, edges
from emberline.plans import features, trees

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bound_reaches_the_scan_and_only_two_columns_are_read(spark):
    text = plan(edges.filter_max_id(inputs.supply_edges(spark, FOLDER), 50))
    assert "LessThan(l_partkey,50)" in text and "LessThan(l_suppkey,50)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text


def test_counts_combine_before_the_shuffle(spark):
    text = plan(aggregates.follower_count(inputs.supply_edges(spark, FOLDER)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_no_query_pairs_everything(spark):
    for name in ("path2", "triangle_count", "closed_triangles", "knn_classify", "knn_classify_topk", "knn_confusion", "roc_auc"):
        text = plan(entries.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_broadcast_triangles_do_not_shuffle_paths(spark):
    text = plan(entries.QUERIES["triangle_count_broadcast"](spark, FOLDER))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text  # the neighbour lists, sent once
    assert text.count("Exchange") == text.count("BroadcastExchange") + 1  # besides them only the final sum


def test_a_model_report_reads_its_rows_once(spark):
    """However often training passes over them: training rows and test rows are made once for all three models."""
    made = spark.sparkContext.accumulator(0)

    def counted(x):
        made.add(1)
        return x

    rows = spark.range(60).selectExpr("cast(id % 3 as double) a", "cast(id % 2 as double) label")
    known = features.assemble_features(rows.withColumn("b", F.udf(counted, "double")("label")), ("a", "b"))
    report = trees.model_report(known, known).collect()
    assert {r["model"]: r["value"] for r in report} == {"random_forest": 1.0, "boosted_trees": 1.0, "decision_tree": 1.0}
    assert made.value == 2 * 60
