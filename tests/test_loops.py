import random
from collections import deque

import pytest

from emberline.plans import kmeans, pagerank, shortest_path
from emberline.plans.graph_layout import EdgeLayout
from emberline.sources.bucketed import sorted_buckets
from emberline.sources.graphs import chain_graph


def distances(df):
    return {r["v"]: r["dist"] for r in df.collect()}


def breadth_first(pairs, source):
    found, queue = {source: 0}, deque([source])
    while queue:
        v = queue.popleft()
        for a, b in pairs:
            if a == v and b not in found:
                found[b] = found[v] + 1
                queue.append(b)
    return found


def test_sink_unreachable_and_missing_source(edges):
    assert distances(shortest_path.sssp(edges([(1, 2), (2, 3)]), 1)) == {1: 0, 2: 1, 3: 2}
    pairs = edges([(1, 2), (3, 4)])
    assert distances(shortest_path.sssp(pairs, 1)) == {1: 0, 2: 1}
    assert distances(shortest_path.sssp(pairs, 1, include_unreached=True)) == {1: 0, 2: 1, 3: None, 4: None}
    missing = shortest_path.sssp(pairs, 9)
    assert distances(missing) == {9: 0}
    assert shortest_path.longest_shortest_path(missing).first()["longest"] == 0


@pytest.mark.parametrize("rows_per_task", [10**6, 3])
def test_distances_equal_breadth_first(edges, rows_per_task):
    draw = random.Random(1)
    pairs = [(0 if draw.random() < 0.3 else draw.randrange(30), draw.randrange(30)) for _ in range(45)]
    assert distances(shortest_path.sssp(edges(pairs), 0, rows_per_task=rows_per_task)) == breadth_first(pairs, 0)


def test_long_path_and_round_limit(edges, tmp_path):
    pairs = edges([(i, i + 1) for i in range(19)] + [(5, 5), (7, 2)])
    found = shortest_path.sssp(pairs, 0, snapshots=str(tmp_path))
    assert distances(found) == {i: i for i in range(20)}
    assert len(list(tmp_path.glob("iter=*"))) == 19
    assert distances(shortest_path.sssp(pairs, 0, max_rounds=2)) == {0: 0, 1: 1, 2: 2}


def ranks_by_hand(pairs, damping, rounds):
    names = sorted({v for p in pairs for v in p})
    degree = {v: sum(a == v for a, _ in pairs) for v in names}
    rank = {v: 1 / len(names) for v in names}
    for _ in range(rounds):
        lost = sum(rank[v] for v in names if not degree[v])
        new = {v: (1 - damping) / len(names) + damping * lost / len(names) for v in names}
        for a, b in pairs:
            new[b] += damping * rank[a] / degree[a]
        rank = new
    return rank


@pytest.mark.parametrize(("damping", "rows_per_task"), [(1.0, 10**6), (0.85, 2)])
def test_pagerank_equals_the_plain_loop(edges, damping, rows_per_task):
    draw = random.Random(2)
    pairs = [(0 if draw.random() < 0.4 else draw.randrange(15), draw.randrange(18)) for _ in range(50)]
    result = pagerank.pagerank(edges(pairs), damping, 4, rows_per_task)
    expected = ranks_by_hand(pairs, damping, 4)
    assert {r["v"]: r["pr"] for r in result.ranks.collect()} == pytest.approx(expected, abs=1e-12)
    assert result.masses == pytest.approx([1.0] * 4, abs=1e-9)


def test_chain_ranks(spark):
    result = pagerank.pagerank_chain(spark, 3)
    ranks = {r["v"]: r["pr"] for r in result.ranks.collect()}
    assert ranks[0] == 0.0
    assert [ranks[v] for v in (3, 6, 9)] == pytest.approx([0.1668520117943478] * 3)
    assert [ranks[v] for v in (2, 5, 8)] == pytest.approx([0.1111525079924206] * 3)
    assert result.masses == pytest.approx([1.0] * 10, abs=1e-9)
    assert [r["v"] for r in pagerank.top_ranks(result.ranks).collect()] == [3, 6, 9, 2, 5]
    with pytest.raises(ValueError):
        chain_graph(spark, 1)


def test_rounds_are_written_on_request(spark, edges, tmp_path):
    pagerank.pagerank(edges([(1, 2), (2, 1)]), rounds=2, snapshots=str(tmp_path / "ranks"))
    found = kmeans.kmeans_1d(points(spark, [1, 2, 50, 60]), 2, "even", snapshots=str(tmp_path / "clusters"))
    assert spark.read.parquet(str(tmp_path / "ranks")).count() == 4
    assert spark.read.parquet(str(tmp_path / "clusters")).select("iter").distinct().count() == len(found.errors)


def test_pagerank_without_edges(edges):
    assert pagerank.pagerank(edges([])).ranks.count() == 0


def points(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, x bigint")


def test_tie_goes_to_the_lower_centroid(spark):
    rows = kmeans.assign(points(spark, [0, 10, 5]), [4.0, 6.0]).collect()
    assert {r["x"]: r["centroid"] for r in rows} == {0: 4.0, 10: 6.0, 5: 4.0}


def test_one_value_gives_one_cluster(spark):
    for init in ("even", "max_minus"):
        found = kmeans.kmeans_1d(points(spark, [7, 7, 7]), 3, init)
        assert found.centroids == [7.0]
    assert kmeans.kmeans_1d(points(spark, []), 3).history.count() == 0


def kmeans_by_hand(values, centroids):
    errors = []
    while True:
        clusters = {}
        for x in values:
            clusters.setdefault(min(centroids, key=lambda c: (abs(x - c), c)), []).append(x)
        errors.append(sum(int(round(sum(abs(x - c) for x in xs), 6)) for c, xs in clusters.items()))
        centroids = sorted({sum(xs) / len(xs) for xs in clusters.values()})
        if len(errors) == 10 or (len(errors) > 1 and errors[-2] - errors[-1] <= 0.01):
            return centroids, errors


@pytest.mark.parametrize(("init", "seed"), [("even", 1), ("max_minus", 2)])
def test_rounds_and_stop_equal_the_plain_loop(spark, init, seed):
    draw = random.Random(seed)
    values = [draw.randrange(-500, 2000) for _ in range(80)]
    low, high = min(values), max(values)
    start = [high - 100.0 * i for i in range(1, 5)] if init == "max_minus" else [float(low + i * ((high - low) // 4)) for i in range(1, 5)]
    centroids, errors = kmeans_by_hand(values, sorted(start))
    found = kmeans.kmeans_1d(points(spark, values), 4, init)
    assert found.errors == errors
    assert found.centroids == pytest.approx(centroids)


@pytest.mark.parametrize("stopped", [1, 3])
def test_loops_go_on_from_their_snapshots(spark, edges, tmp_path, stopped):
    draw = random.Random(4)
    pairs = [(draw.randrange(40), draw.randrange(40)) for _ in range(70)] + [(i, i + 1) for i in range(50, 62)] + [(0, 50)]
    graph = edges(pairs)
    path = str(tmp_path / "paths")
    assert {r["finished"] for r in shortest_path.sssp(graph, 0, max_rounds=stopped, snapshots=path).collect()} == {False}
    assert distances(shortest_path.sssp(graph, 0, snapshots=path, resume=True)) == breadth_first(pairs, 0)
    assert distances(shortest_path.sssp(graph, 0, snapshots=path, resume=True)) == breadth_first(pairs, 0)
    with pytest.raises(ValueError, match="source"):
        shortest_path.sssp(graph, 1, snapshots=path, resume=True)

    path = str(tmp_path / "ranks")
    pagerank.pagerank(graph, rounds=stopped, snapshots=path)
    whole, resumed = pagerank.pagerank(graph, rounds=5), pagerank.pagerank(graph, rounds=5, snapshots=path, resume=True)
    assert resumed.masses == pytest.approx(whole.masses, abs=1e-12)
    ranks = lambda found: {r["v"]: r["pr"] for r in found.ranks.collect()}
    assert ranks(resumed) == pytest.approx(ranks(whole), abs=1e-12)

    path, values = str(tmp_path / "clusters"), points(spark, [draw.randrange(-500, 2000) for _ in range(80)])
    kmeans.kmeans_1d(values, 4, "even", max_rounds=stopped, snapshots=path)
    whole, resumed = kmeans.kmeans_1d(values, 4, "even"), kmeans.kmeans_1d(values, 4, "even", snapshots=path, resume=True)
    assert (resumed.errors, resumed.centroids) == (whole.errors, whole.centroids)
    assert sorted(resumed.history.collect()) == sorted(whole.history.collect())


def test_a_round_without_its_manifest_does_not_count(edges, tmp_path):
    pairs = [(i, i + 1) for i in range(8)]
    path = str(tmp_path / "paths")
    shortest_path.sssp(edges(pairs), 0, max_rounds=2, snapshots=path)
    edges([(99, 99)]).selectExpr("src v", "3 dist").write.parquet(f"{path}/iter=3")
    assert distances(shortest_path.sssp(edges(pairs), 0, snapshots=path, resume=True)) == {i: i for i in range(9)}


def test_only_messages_move(spark, edges):
    """With broadcasts off, neither the edges nor the reached vertices are shuffled or sorted, however many layers there are."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sorted_buckets(spark):
            layout = EdgeLayout.build(edges([(i, i * 7 % 50) for i in range(50)]))
            reached = shortest_path.Reached(layout.buckets)
            frontier = reached.add(edges([(1, 0), (2, 0)]).selectExpr("src v", "cast(dst as int) dist")).rows
            for i in range(3):
                reached.add(edges([(100 + i, 0)]).selectExpr("src v", "cast(dst as int) dist"))
            met = layout.follow(frontier.withColumnRenamed("v", "src")).groupBy("dst").agg({"dist": "min"}).withColumnRenamed("dst", "v")
            text = reached.without(met)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Bucketed: true") == 6 and text.count("SortMergeJoin") == 5
        assert text.count("Exchange") == 1, text  # the messages by target; the frontier lies bucketed like the edges
        assert text.count("Sort [") == 1, text
        layout.release()
        reached.forget()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_layers_are_merged(edges):
    pairs = [(i, i + 1) for i in range(20)]
    assert distances(shortest_path.sssp(edges(pairs), 0)) == {i: i for i in range(21)}
