import random

import pytest
from pyspark.sql import functions as F

from emberline.plans import knn, metrics

TRAIN = "type string, amount double, user string, cls int"
TEST = "id bigint, type string, amount double, user string"


def brute_force(train, test, k):
    found = {}
    for i, kind, amount, user in test:
        least = {}
        for t, a, u, c in train:
            d = (0.0 if t == kind else 1.0) + abs(amount - a) + (0.0 if u == user else 1.0)
            least[d] = min(c, least.get(d, c))
        if least:
            found[i] = sorted(least.items())[:k]
    return found


def vote(neighbours):
    classes = [c for _, c in neighbours]
    return min(set(classes), key=lambda c: (-classes.count(c), c))


def run(spark, train, test, k, **options):
    rows = knn.knn_neighbours(spark.createDataFrame(train, TRAIN), spark.createDataFrame(test, TEST), k, **options).collect()
    return {r["id"]: [(n["d"], n["cls"]) for n in r["neighbours"]] for r in rows}


def sample(seed, n_train, n_test, step, hot=0.0, users=6, types=3, span=40):
    draw = random.Random(seed)

    def record():
        amount = 7.0 if draw.random() < hot else round(draw.randrange(span) * step, 2)
        user = "hub" if draw.random() < hot else f"u{draw.randrange(users)}"
        return f"t{draw.randrange(types)}", amount, user

    train = [(*record(), draw.randrange(3)) for _ in range(n_train)]
    test = [(i, *record()) for i in range(n_test)]
    return train, test


@pytest.mark.parametrize(
    ("seed", "step", "hot", "k", "rows_per_range", "prune"),
    [
        (1, 1.0, 0.0, 3, 10**6, True),
        (2, 0.25, 0.3, 3, 15, True),
        (3, 0.5, 0.5, 1, 10, False),
        (4, 1.0, 0.3, 5, 12, True),
        (5, 3.7, 0.0, 2, 8, False),
        (6, 0.01, 0.3, 4, 20, True),
    ],
)
def test_neighbours_equal_brute_force(spark, seed, step, hot, k, rows_per_range, prune):
    train, test = sample(seed, 90, 40, step, hot)
    assert run(spark, train, test, k, rows_per_range=rows_per_range, prune=prune) == brute_force(train, test, k)


def test_many_types_and_users_at_one_amount(spark):
    train, test = sample(7, 120, 40, 1.0, 0.4, users=3, types=6, span=3)
    assert run(spark, train, test, 6, rows_per_range=10) == brute_force(train, test, 6)


def test_more_types_than_one_list_takes(spark, monkeypatch):
    monkeypatch.setattr(knn, "TYPES_PER_LIST", 2)
    train, test = sample(10, 120, 30, 1.0, 0.2, users=4, types=9, span=4)
    assert run(spark, train, test, 5) == brute_force(train, test, 5)


def test_hot_user_hides_the_other_users(spark):
    train = [("a", float(i), "hub", 1) for i in range(30)] + [("a", 100.0, "other", 0), ("b", 50.0, "hub", 2)]
    test = [(1, "a", 10.0, "hub"), (2, "a", 10.0, "nobody"), (3, "c", 99.0, "other"), (4, "b", 29.0, "hub")]
    for rows_per_range in (5, 10**6):
        assert run(spark, train, test, 4, rows_per_range=rows_per_range) == brute_force(train, test, 4)


def test_equal_distances_are_one_neighbour_with_the_least_class(spark):
    train = [("a", 9.0, "u", 1), ("a", 11.0, "u", 0)]
    assert run(spark, train, [(1, "a", 10.0, "u")], 3) == {1: [(1.0, 0)]}


def test_vote_tie_takes_the_least_class(spark):
    train = spark.createDataFrame([("a", 9.0, "u", 1), ("a", 12.0, "u", 0)], TRAIN)
    test = spark.createDataFrame([(1, "a", 10.0, "u")], TEST)
    assert [tuple(r) for r in knn.knn_classify(train, test, 2).collect()] == [(1, 0)]


def test_both_variants_agree_and_rows_do_not_influence_each_other(spark):
    train, test = sample(8, 80, 12, 0.5, 0.2)
    frames = spark.createDataFrame(train, TRAIN), spark.createDataFrame(test, TEST)
    expected = {i: vote(n) for i, n in brute_force(train, test, 3).items()}
    plain = {r["id"]: r["pred"] for r in knn.knn_classify(*frames, 3, rows_per_range=10).collect()}
    pruned = {r["id"]: r["pred"] for r in knn.knn_classify_topk(*frames, 3, rows_per_range=10).collect()}
    alone = {}
    for row in test[:3]:
        one = spark.createDataFrame([row], TEST)
        alone |= {r["id"]: r["pred"] for r in knn.knn_classify(frames[0], one, 3).collect()}
    assert plain == pruned == expected
    assert alone == {i: expected[i] for i in alone}


def test_confusion_counts_every_test_row(spark):
    train, test = sample(9, 60, 20, 1.0)
    train = [(*r[:3], r[3] % 2) for r in train]
    frame = spark.createDataFrame(test, TEST).withColumn("cls", (F.col("id") % 2).cast("int"))
    results = knn.labelled(knn.knn_classify_topk(spark.createDataFrame(train, TRAIN), frame, 3), frame)
    assert sum(metrics.confusion_matrix(results, "cls").first()) == len(test)


def test_no_train_rows_give_no_prediction(spark):
    assert run(spark, [], [(1, "a", 1.0, "u")], 3) == {}
    assert run(spark, [("a", 1.0, "u", 0)], [], 3) == {}


@pytest.mark.parametrize(("k", "rows_per_range", "seed"), [(40, 10**6, 11), (40, 7, 12), (7, 1, 13)])
def test_many_neighbours_and_tiny_ranges(spark, k, rows_per_range, seed):
    train, test = sample(seed, 150, 30, 0.5, 0.2, users=4, types=3, span=120)
    assert run(spark, train, test, k, rows_per_range=rows_per_range) == brute_force(train, test, k)


def test_four_window_functions_whatever_k_is(spark):
    train, test = sample(14, 40, 10, 0.5)
    tables = knn.train_tables(knn.distinct_rows(spark.createDataFrame(train, TRAIN)), 3)
    parts = knn.in_amount_ranges(tables, knn._prepared(spark.createDataFrame(test, TEST), "id"), 10**6, 200)
    for k in (3, 40):
        text = knn._candidates(parts, k, knn.reaches(k))._jdf.queryExecution().optimizedPlan().toString()
        window = next(line for line in text.splitlines() if "lag(entries" in line and "Window" in line)
        assert window.count("lag(entries") == 2 and window.count("lead(entries") == 2


def test_ranges_come_back_to_nobody(spark, monkeypatch):
    """Nothing that grows with the rows is collected: only single rows come to the driver."""
    taken = []
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    collect = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: taken.append(rows := collect(self)) or rows)
    train, test = sample(15, 90, 30, 0.25, 0.3)
    found = knn.knn_neighbours(spark.createDataFrame(train, TRAIN), spark.createDataFrame(test, TEST), 3, rows_per_range=5)
    assert all(len(rows) <= 1 for rows in taken)
    assert found.count() == len(test)


def test_scaled_amounts(spark):
    train, test = sample(16, 80, 25, 3.7, 0.1)
    test += [(900, "t0", -500.0, "u0"), (901, "t1", 10_000.0, "u1")]
    low, high = min(r[1] for r in train), max(r[1] for r in train)
    move = lambda a: (a - low) / (high - low)
    moved = [(t, move(a), u, c) for t, a, u, c in train], [(i, t, move(a), u) for i, t, a, u in test]
    assert run(spark, train, test, 4, scale_amount=True) == brute_force(*moved, 4)
    one = [("a", 5.0, "u", 1), ("b", 5.0, "u", 0)]
    assert run(spark, one, [(1, "a", 70.0, "u"), (2, "b", None, "u")], 2, scale_amount=True) == {1: [(0.0, 1), (1.0, 0)]}
