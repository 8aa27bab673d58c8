import random
from collections import Counter

import pytest

from emberline.plans import triangles


def closed_paths(pairs):
    found = Counter()
    copies = Counter(pairs)
    for (a, b), n in copies.items():
        for (b2, c), m in copies.items():
            if b == b2 and a != c and copies[(c, a)]:
                found[(a, c)] += n * m * copies[(c, a)]
    return found


def paths(pairs):
    found = Counter()
    copies = Counter(pairs)
    for (a, b), n in copies.items():
        for (b2, c), m in copies.items():
            if b == b2 and a != c:
                found[(a, c)] += n * m
    return found


def graph(seed, vertices, size, hub=0.0):
    draw = random.Random(seed)

    def vertex():
        return 0 if draw.random() < hub else draw.randrange(vertices)

    return [(vertex(), vertex()) for _ in range(size)]


MICRO = {
    "triangle": ([(1, 2), (2, 3), (3, 1)], 3, 1, 1),
    "two_cycle": ([(1, 2), (2, 1)], 0, 0, 0),
    "self_loop_and_two_cycle": ([(1, 1), (1, 2), (2, 1)], 2, 0, 0),
    "duplicate": ([(1, 2), (1, 2), (2, 3), (3, 1)], 6, 2, 2),
    "reverse": ([(1, 2), (1, 3), (2, 3)], 0, 0, 0),
    "empty": ([], 0, 0, 0),
}


@pytest.mark.parametrize("name", MICRO)
def test_micro_graphs(edges, name):
    pairs, closed, whole, strict = MICRO[name]
    assert tuple(triangles.triangle_count(edges(pairs)).first()) == (closed, whole)
    assert tuple(triangles.triangle_count_broadcast(edges(pairs)).first()) == (closed, whole)
    assert triangles.triangle_count(edges(pairs), strict=True).first()["triangles"] == strict


def test_distinct_edges_and_bound(edges):
    assert triangles.triangle_count(edges(MICRO["duplicate"][0]), distinct_edges=True).first()["triangles"] == 1
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 2)]
    assert triangles.triangle_count(edges(pairs)).first()["triangles"] == 2
    assert triangles.triangle_count(edges(pairs), max_id=4).first()["triangles"] == 1


@pytest.mark.parametrize(("seed", "hub", "rows_per_task", "star_rows"), [(1, 0.0, 10**6, 4096), (2, 0.35, 5, 2), (3, 0.5, 3, 1)])
def test_random_graphs_equal_brute_force(edges, seed, hub, rows_per_task, star_rows):
    pairs = graph(seed, 14, 120, hub)
    options = {"rows_per_task": rows_per_task, "star_rows": star_rows}
    expected = closed_paths(pairs)
    total = sum(expected.values())
    rows = triangles.closed_triangles(edges(pairs), **options).collect()
    assert {(r["src"], r["dst"]): r["n_closed"] for r in rows} == dict(expected)
    assert tuple(triangles.triangle_count(edges(pairs), **options).first()) == (total, total // 3)
    assert tuple(triangles.triangle_count_broadcast(edges(pairs)).first()) == (total, total // 3)
    assert tuple(triangles.triangle_count_broadcast(edges(pairs), max_broadcast_bytes=0).first()) == (total, total // 3)
    rows = triangles.path2(edges(pairs), rows_per_task=rows_per_task).collect()
    assert {(r["src"], r["dst"]): r["n_paths"] for r in rows} == dict(paths(pairs))


def test_relabelled_and_shuffled_edges_give_the_same_count(edges):
    pairs = graph(4, 12, 90)
    expected = tuple(triangles.triangle_count(edges(pairs)).first())
    names = list(range(100, 112))
    random.Random(5).shuffle(names)
    other = [(names[a], names[b]) for a, b in pairs]
    random.Random(6).shuffle(other)
    assert tuple(triangles.triangle_count(edges(other).repartition(7)).first()) == expected


def test_star_of_a_hub_has_no_wedges(edges):
    """All edges into one vertex: the hub's neighbours are never paired."""
    pairs = [(i, 0) for i in range(1, 200)] + [(0, i) for i in range(1, 200)]
    oriented = triangles.oriented_pairs(edges(pairs))
    assert triangles.wedges(oriented).count() == 0


@pytest.mark.parametrize("rows_per_task", [2, 10**6])
def test_two_hubs_with_many_shared_neighbours(edges, rows_per_task):
    pairs = [(0, 1)] + [(i, 0) for i in range(2, 40)] + [(1, i) for i in range(2, 40)] + [(1, 0), (5, 6), (6, 5)]
    found = {(r["src"], r["dst"]): r["n_closed"] for r in triangles.closed_triangles(edges(pairs), rows_per_task=rows_per_task).collect()}
    assert found == closed_paths(pairs) and found[0, 2] == 1


def test_wedges_of_a_hot_pair_are_spread(spark):
    open_ = spark.createDataFrame([(x, 1, 2, 500, 1, 0) for x in range(500)], "x bigint, y bigint, z bigint, y_deg bigint, turn bigint, counter bigint")
    closing = spark.createDataFrame([(1, 2, 500, 3, 4)], "y bigint, z bigint, y_deg bigint, yz bigint, zy bigint")
    assert triangles.closed_wedges(open_, closing, 50).count() == 500
    text = triangles.closed_wedges(open_, closing, 50)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in text and "sequence" in text


def test_a_hub_is_never_paired_with_itself(spark, edges):
    n = 10_000
    into = [(i, 0) for i in range(1, n + 1)]
    out = [(0, n + i) for i in range(1, n + 1)]
    back = [(n + i, i) for i in range(1, n + 1)]
    graph_ = edges(into + out + back)
    lists = triangles.neighbour_lists(triangles.oriented_pairs(triangles.bounded(graph_, None, False)))
    assert lists.agg({"x": "count"}).first()[0] <= 2 * n + 1
    assert max(len(r["ids"]) for r in lists.select("ids").collect()) <= 2
    assert tuple(triangles.triangle_count_broadcast(graph_).first()) == (3 * n, n)
    assert tuple(triangles.triangle_count_broadcast(graph_, max_broadcast_bytes=10).first()) == (3 * n, n)
