"""Inputs and sizes beyond the usual ones: fine and large amounts, nulls, text keys, small limits."""

import random

import numpy as np
import pyarrow as pa
import pytest

from emberline.functions.columns import record_line
from emberline.operators import aggregates, ranges, skew, topk
from emberline.plans import features, knn, metrics, shortest_path, trees
from emberline.sources import graphs, text
from tests.test_knn import TEST, TRAIN, brute_force, run


def test_amounts_that_differ_in_the_seventh_decimal(spark):
    train = [("a", 1.0000001, "u", 1), ("a", 1.0000004, "u", 1), ("a", 2.0, "u", 0)]
    test = [(0, "a", 1.0, "u"), (1, "b", 1.0000002, "v")]
    assert run(spark, train, test, 2) == brute_force(train, test, 2)


@pytest.mark.parametrize("rows_per_range", [10**6, 9])
def test_amounts_too_coarse_to_stay_apart(spark, rows_per_range):
    draw = random.Random(3)
    amounts = [2.0**53 + 2 * i for i in range(12)] + [1e-9 * i for i in range(25)] + [3.0e12 + 0.0005 * i for i in range(10)]
    record = lambda: (draw.choice("ab"), draw.choice(amounts), draw.choice("uvw"))
    train, test = [(*record(), draw.randrange(3)) for _ in range(120)], [(i, *record()) for i in range(25)]
    assert run(spark, train, test, 4, rows_per_range=rows_per_range) == brute_force(train, test, 4)


def test_records_without_an_amount_stay_in_the_labelled_output(spark):
    train = spark.createDataFrame([("a", 1.0, "u", 1), ("a", None, "u", 0)], TRAIN)
    test = spark.createDataFrame([(0, "a", 1.0, "u"), (1, "a", None, "u"), (2, "a", float("nan"), "u")], TEST)
    found = knn.labelled(knn.knn_classify_topk(train, test, 1), test).collect()
    assert {r["id"]: r["pred"] for r in found} == {0: 1, 1: None, 2: None}


def test_missing_fields_keep_their_place(spark, tmp_path):
    rows = [(1, None, 3), (None, 2, 3), (1, 2, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    lines = [r["line"] for r in df.select(record_line(["a", "b", "c"]).alias("line")).collect()]
    assert lines == ["1,,3", ",2,3", "1,2,", ",,"]
    text.write_text(df, str(tmp_path / "lines"))
    back = text.split_fields(spark.read.text(str(tmp_path / "lines")), ["a", "b", "c"]).collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


def test_a_header_that_names_other_columns_stops_the_query(spark, tmp_path):
    names = [f.name for f in text.TRANSACTION.fields]
    row = spark.createDataFrame([(1, "DEBIT", 2.0, "C1", 3.0, 4.0, "M1", 5.0, 6.0, 0, 0)], text.TRANSACTION)
    text.write_csv(row, str(tmp_path / "good"), header=True)
    assert text.read_transactions_csv(spark, str(tmp_path / "good")).collect() == row.collect()
    i, j = names.index("oldbalanceOrg"), names.index("newbalanceOrig")
    names[i], names[j] = names[j], names[i]
    text.write_csv(row.select(*names), str(tmp_path / "swapped"), header=True)
    with pytest.raises(Exception, match="(?i)header|schema"):
        text.read_transactions_csv(spark, str(tmp_path / "swapped")).collect()


def test_parts_are_written_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, "y")], "a int, b int, part string")
    text.write_parts(df, "part", str(tmp_path / "parts"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "parts/part=x")).collect()] == ["1,"]


@pytest.mark.parametrize("rows_per_range", [10, 10_000])
def test_ids_of_text_keys(spark, rows_per_range):
    keys = sorted(f"k{i * 37 % 101:03d}" for i in range(100))
    df = spark.createDataFrame([(k,) for k in random.Random(2).sample(keys, 100)], "key string")
    found = ranges.assign_ids(df, "key", rows_per_range=rows_per_range).collect()
    assert sorted((r["key"], r["id"]) for r in found) == [(k, 10_001 + i) for i, k in enumerate(keys)]


def test_no_more_hot_keys_than_the_list_holds(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEY_LIMIT", 3)
    counts = spark.createDataFrame([(i, 10 + i) for i in range(20)], "k int, size bigint")
    found = skew.hot_from_counts(counts, ["k"], "size", 5)
    assert found is None or found.count() <= 3


def test_blocks_of_neighbours_are_sorted_and_full(edges):
    pairs = [(1, i) for i in range(45)] + [(2, 7), (3, 1), (3, 0)]
    lists = {(r["v"], r["part"]): r["neighbours"] for r in aggregates.adjacency_list(edges(pairs), neighbours_per_row=10).collect()}
    assert lists == {**{(1, p): list(range(10 * p, min(10 * p + 10, 45))) for p in range(5)}, (2, 0): [7], (3, 0): [0, 1]}


def test_a_share_finer_than_the_old_buckets(spark):
    first, second = features.split_random(spark.range(200_000), "id", share=0.99996)
    assert first.count() + second.count() == 200_000 and 0 < second.count() < 40


def test_unfinished_distances_say_so(edges):
    pairs = edges([(i, i + 1) for i in range(6)])
    assert {r["finished"] for r in shortest_path.sssp(pairs, 0, max_rounds=2).collect()} == {False}
    assert {r["finished"] for r in shortest_path.sssp(pairs, 0, max_rounds=9).collect()} == {True}
    assert "finished" not in shortest_path.sssp(pairs, 0).columns


def test_chains_over_rows(spark):
    df = spark.createDataFrame([(v,) for v in (9, 2, 5, 30, 11)], "key int")
    found = {r["src"]: r["dst"] for r in graphs.chains_over(df, "key", 2).collect()}
    assert found == {2: 5, 5: 0, 9: 11, 11: 0, 30: 0}


def test_one_distance_many_times(spark):
    pairs = [(1, 1.0, i % 7 + 1) for i in range(500)] + [(1, 2.0, 3), (1, 3.0, 0), (2, 5.0, 4)]
    found = topk.k_smallest(spark.createDataFrame(pairs, "id bigint, d double, cls int").repartition(5), 2).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1.0, 1, 1), (1, 2.0, 3, 2), (2, 5.0, 4, 1)]


def test_one_shuffle_of_what_tasks_have_cut(spark):
    plan = topk.k_smallest(spark.createDataFrame([(1, 1.0, 0)], "id bigint, d double, cls int"), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")


def test_a_task_sends_k_rows_of_a_million_at_one_distance():
    one = pa.RecordBatch.from_pydict({"id": np.zeros(10_000, np.int64), "d": np.ones(10_000), "cls": np.arange(10_000, 0, -1).astype(np.int32)})
    other = pa.RecordBatch.from_pydict({"id": np.array([0, 0, 5]), "d": np.array([0.5, 3.0, 9.0]), "cls": np.array([7, 7, 7], np.int32)})
    for k in (1, 2, 5):
        sent = [r for b in topk.least_of_batches(iter([one] * 100 + [other]), k) for r in zip(*(b.column(c).to_pylist() for c in ("id", "d", "cls")), strict=True)]
        assert sorted(sent) == [(0, 0.5, 7), (0, 1.0, 1), (0, 3.0, 7)][:k] + [(5, 9.0, 7)]


def test_many_ids_are_sent_on_in_pieces(spark):
    draw = random.Random(9)
    rows = [(draw.choice([*range(40), None]), draw.choice([0.5, 1.0, 2.0, 2.5, 4.0, None]), draw.randrange(5)) for _ in range(900)]
    batches = [pa.RecordBatch.from_pylist([{"id": i, "d": d, "cls": c} for i, d, c in rows[a : a + 50]], pa.schema([("id", pa.int64()), ("d", pa.float64()), ("cls", pa.int32())])) for a in range(0, 900, 50)]
    sent = [b for b in topk.least_of_batches(iter(batches), 2, held_rows=60)]
    assert len(sent) > 1
    df = spark.createDataFrame(rows, "id bigint, d double, cls int")
    found = {(r["id"], r["rank"]): (r["d"], r["cls"]) for r in topk.k_smallest(df.repartition(4), 2).collect()}
    expected = {}
    for i in {r[0] for r in rows}:
        ds = sorted({r[1] for r in rows if r[0] == i}, key=lambda d: (d is None, d or 0))[:2]
        expected |= {(i, n + 1): (d, min(c for j, e, c in rows if (j, e) == (i, d))) for n, d in enumerate(ds)}
    assert found == expected


def test_the_reported_area_is_exact(spark):
    draw = random.Random(5)
    rows = [(draw.random(), float(draw.random() < 0.4)) for _ in range(5_000)]
    df = spark.createDataFrame(rows, "p double, label double").selectExpr("label", "p")
    from pyspark.ml.feature import VectorAssembler

    wrong = df.selectExpr("label", "1 - p as q", "p")
    scored = VectorAssembler(inputCols=["q", "p"], outputCol="rawPrediction").transform(wrong)
    exact = metrics.roc_auc(df.selectExpr("p as score", "label")).first()["auc"]
    assert trees.area_under_roc(scored) == exact


def test_blocks_do_not_depend_on_a_list_of_hot_keys(edges, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEY_LIMIT", 2)
    pairs = [(v, i) for v in (1, 2) for i in range(25)] + [(v, 0) for v in range(3, 33)]
    sizes = {(r["v"], r["part"]): len(r["neighbours"]) for r in aggregates.adjacency_list(edges(pairs), neighbours_per_row=10).collect()}
    assert {k: n for k, n in sizes.items() if k[0] < 3} == {(v, p): n for v in (1, 2) for p, n in enumerate((10, 10, 5))}
    assert all(n == 1 for k, n in sizes.items() if k[0] > 2)


def test_rows_of_one_key_spread_over_ranges(spark):
    df = spark.range(20_000).selectExpr("cast(id % 2 as int) other", "7 key")
    parts = ranges.in_ranges(ranges._told_apart(df, unique=False), ["key", "_tie"], 1_000)
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2_000
    ids = [r["id"] for r in ranges.assign_ids(df, "key", start=0, rows_per_range=1_000).select("id").collect()]
    assert sorted(ids) == list(range(1, 20_001))


@pytest.mark.parametrize("rows_per_range", [1, 9, 10**6])
def test_places_in_groups_over_many_ranges(spark, rows_per_range):
    draw = random.Random(8)
    rows = [("hub", i) for i in range(60)] + [(draw.choice(["a", "b", None]), 1_000 + i) for i in range(60)] + [("z", 5)]
    df = spark.createDataFrame(draw.sample(rows, len(rows)), "g string, x int")
    found = {(r["g"], r["x"]): r["place"] for r in ranges.places_in_groups(df, ["g"], ["x"], "place", rows_per_range).collect()}
    assert found == {(g, x): sum(h == g and y < x for h, y in rows) for g, x in rows}
