import random

import pytest
from pyspark.sql import functions as F

from emberline.operators import aggregates, edges as edge_ops, ranges, topk
from emberline.plans import features, metrics, trees
from emberline.sources import text


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_five_styles_of_one_sum_agree(spark):
    draw = random.Random(1)
    data = [(0 if draw.random() < 0.4 else draw.randrange(5), draw.randrange(9)) for _ in range(300)]
    df = spark.createDataFrame(data, "k bigint, x bigint").repartition(5)
    expected = rows(df.groupBy("k").agg(F.sum("x")))
    assert rows(aggregates.reduce_by_key(df, "k", "x")) == expected
    assert rows(aggregates.fold_by_key(df, "k", "x")) == expected
    assert rows(aggregates.group_values_sum(df, "k", "x")) == expected
    assert rows(aggregates.aggregate_by_key(df, "k", {"x": F.sum("x")})) == expected
    assert rows(aggregates.fold_by_key(df, "k", "x", 10)) == [(k, x + 10) for k, x in expected]



def test_amounts_are_cut_not_rounded(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (7.2,)], "amount double")
    assert rows(aggregates.amount_min_max(df)) == [(7, -1)]


def test_adjacency_of_a_hub_takes_several_rows(edges):
    pairs = [(1, i) for i in range(50)] + [(1, 3), (2, 1)]
    lists = aggregates.adjacency_list(edges(pairs), neighbours_per_row=10).collect()
    of_hub = [r for r in lists if r["v"] == 1]
    assert len(of_hub) > 1
    assert sorted(d for r in of_hub for d in r["neighbours"]) == list(range(50))
    assert sum(n for r in of_hub for n in r["copies"]) == 51
    whole = {r["v"]: r["neighbours"] for r in aggregates.adjacency_list(edges(pairs)).collect()}
    assert whole == {1: list(range(50)), 2: [1]}


def test_bound_is_strict(edges):
    assert rows(edge_ops.filter_max_id(edges([(1, 2), (3, 1), (1, 3)]), 3)) == [(1, 2)]


@pytest.mark.parametrize("rows_per_task", [10**6, 2])
def test_relaxation_step(spark, edges, rows_per_task):
    state = spark.createDataFrame([(1, 0), (2, 4)], "v bigint, dist int")
    found = edge_ops.explode_neighbours(edges([(1, 2), (1, 3), (1, 3), (9, 1)]), state, rows_per_task)
    assert rows(found) == [(1, 0), (2, 1), (2, 4), (3, 1), (3, 1)]


@pytest.mark.parametrize("rows_per_range", [7, 1000])
def test_ids_follow_the_order(spark, rows_per_range):
    keys = [x * x for x in range(100)]
    df = spark.createDataFrame([(k,) for k in random.Random(1).sample(keys, 100)], "key bigint")
    found = ranges.assign_ids(df, "key", rows_per_range=rows_per_range)
    assert rows(found.select("key", "id")) == [(k, 10001 + i) for i, k in enumerate(keys)]


def test_k_smallest_merges_equal_distances(spark):
    pairs = spark.createDataFrame([(1, 1.0, 1), (1, 1.0, 0), (1, 2.0, 1), (1, 3.0, 1), (2, 5.0, 0)], "id bigint, d double, cls int")
    assert rows(topk.k_smallest(pairs, 2)) == [(1, 1.0, 0, 1), (1, 2.0, 1, 2), (2, 5.0, 0, 1)]


def test_majority(spark):
    votes = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (2, 0)], "id bigint, cls int")
    assert rows(topk.majority_vote(votes)) == [(1, 0), (2, 1)]


def test_tagged_union(edges):
    found = edge_ops.tagged_union(edges([(1, 2)]), edges([(3, 4)]), "src", "dst")
    assert rows(found) == [(1, "A", "2"), (3, "B", "4")]


def test_key_value_splits_at_the_first_separator(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("a,b,c",), ("alone",), ("x,",)], "value string").write.text(path)
    assert rows(text.read_key_value(spark, path, ",")) == [("a", "b,c"), ("alone", ""), ("x", "")]


def test_written_files_read_back(spark, edges, tmp_path):
    df = edges([(1, 2), (3, 4), (3, 4)])
    for separator in (",", "\t"):
        text.write_key_value(df, str(tmp_path / "kv"), separator)
        assert rows(text.read_edges_csv(spark, str(tmp_path / "kv"), separator)) == rows(df)
    text.write_csv(df.repartition(3), str(tmp_path / "csv"), single=True)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 1
    assert rows(text.read_edges_csv(spark, str(tmp_path / "csv"))) == rows(df)
    text.write_text(df, str(tmp_path / "text"), tuples=True)
    assert rows(spark.read.text(str(tmp_path / "text"))) == [("(1,2)",), ("(3,4)",), ("(3,4)",)]


def test_edge_that_is_no_number_stops_the_query(spark, tmp_path):
    spark.createDataFrame([("1,2",), ("x,3",)], "value string").write.text(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="(?i)malformed"):
        text.read_edges_csv(spark, str(tmp_path / "bad")).collect()


GOOD = "1,PAYMENT,9.5,C12,1.0,2.0,M34,3.0,4.0,0,1"
ODD_TYPE = "1,LOAN,9.5,C12,1.0,2.0,M34,3.0,4.0,1,0"
SHORT = "1,PAYMENT,9.5,C12,1.0,2.0,M34,3.0,4.0,0"
NO_NUMBER = "1,PAYMENT,much,C12,1.0,2.0,M34,3.0,4.0,0,1"


def test_transactions_become_numbers(spark):
    lines = spark.createDataFrame([(GOOD,), (ODD_TYPE,)], "value string")
    assert rows(features.prepare_transactions(lines)) == [
        (1.0, 0.0, 9.5, 12.0, 1.0, 2.0, 34.0, 3.0, 4.0, 1.0, 0.0),
        (1.0, 4.0, 9.5, 12.0, 1.0, 2.0, 34.0, 3.0, 4.0, 0.0, 1.0),
    ]


@pytest.mark.parametrize("bad", [SHORT, NO_NUMBER, GOOD + ",7"])
def test_malformed_transactions(spark, bad):
    lines = spark.createDataFrame([(GOOD,), (bad,)], "value string")
    with pytest.raises(Exception, match="malformed transaction"):
        features.prepare_transactions(lines).collect()
    assert features.prepare_transactions(lines, malformed="drop").count() == 1
    assert rows(features.count_malformed(lines)) == [(1,)]


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("cls", (F.col("id") % 10 == 0).cast("int"))
    train, test = features.split_random(df, "id")
    again, _ = features.split_random(df.repartition(7), "id")
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 2000
    assert 0.75 < train.count() / 2000 < 0.85
    train, test = features.split_stratified(df, "id", "cls")
    assert train.where("cls = 1").count() > 100 and test.where("cls = 1").count() > 30


def test_confusion_ignores_other_predictions(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 0), (1, 2), (2, 0)], "actual int, pred int")
    assert rows(metrics.confusion_matrix(df)) == [(1, 1, 1, 2)]
    assert metrics.accuracy(df).first()["accuracy"] == pytest.approx(2 / 6)


@pytest.mark.parametrize("rows_per_range", [5, 1000])
def test_area_under_roc(spark, rows_per_range):
    draw = random.Random(3)
    data = [(float(draw.randrange(20)), int(draw.random() < 0.4)) for _ in range(80)]
    positives, negatives = [s for s, y in data if y], [s for s, y in data if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    df = spark.createDataFrame(data, "score double, label int")
    found = metrics.roc_auc(df, rows_per_range=rows_per_range).first()["auc"]
    assert found == pytest.approx(won / len(positives) / len(negatives))
    assert metrics.roc_auc(df.where("label = 1")).first()["auc"] is None


def test_models_learn_the_label(spark):
    from emberline.catalog import inputs

    train, test = inputs.model_split(spark, "/root/testdata/sf0.001")
    train, test = train.cache(), test.cache()
    report = {r["model"]: r["value"] for r in trees.model_report(train, test).collect()}
    assert set(report) == {"random_forest", "boosted_trees", "decision_tree"}
    assert min(report.values()) > 0.9
    model = trees.decision_tree().fit(train)
    assert "If (feature" in trees.model_summary(model)
    assert rows(model.transform(test).select("prediction")) == rows(trees.decision_tree().fit(train).transform(test).select("prediction"))
