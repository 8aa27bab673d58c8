"""The registered queries: each a DataFrame program over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.catalog import inputs, sql
from emberline.functions.columns import gap, mismatch, record_line
from emberline.operators import aggregates, edges, ranges, topk
from emberline.plans import features, kmeans, knn, metrics, pagerank, shortest_path, trees, triangles
from emberline.sources import graphs, text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

K = 3
CLUSTERS = 4
SOURCE = 2  # fixed value: the source vertex
MAX_ID = 1000  # fixed value: the id bound
TOP = 5


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if oracle is not None:
            ORACLE[key] = oracle
        return function

    return register


# ---- sources and sinks -------------------------------------------------------------------------


@query("select l_partkey src, l_suppkey dst from lineitem")
def read_edges_csv(spark, folder):
    path = inputs.scratch(spark)
    text.write_csv(inputs.supply_edges(spark, folder), path)
    return text.read_edges_csv(spark, path)


@query(f"with {inputs.RECORDS} select * exclude (o_orderkey) from records")
def read_transactions_csv(spark, folder):
    path = inputs.scratch(spark)
    text.write_csv(inputs.records(spark, folder).drop("o_orderkey"), path, header=True)
    return text.read_transactions_csv(spark, path)


@query("select o_orderkey::varchar as key, o_orderpriority || ',' || o_orderstatus as value from orders")
def read_key_value(spark, folder):
    path = inputs.scratch(spark)
    text.write_text(inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), path)
    return text.read_key_value(spark, path, ",")


@query("select l_orderkey::varchar l_orderkey, l_linenumber::varchar l_linenumber, l_returnflag from lineitem")
def split_fields(spark, folder):
    names = ["l_orderkey", "l_linenumber", "l_returnflag"]
    lines = inputs.table(spark, folder, "lineitem").select(record_line(names).alias("value"))
    return text.split_fields(lines, names)


@query(
    "select l_suppkey as key, 'A' tag, l_partkey::varchar as value from lineitem "
    "union all select o_custkey, 'B', (o_orderkey // 10)::varchar from orders"
)
def tagged_union(spark, folder):
    first = inputs.supply_edges(spark, folder).toDF("value", "key")
    second = inputs.order_edges(spark, folder).toDF("key", "value")
    return edges.tagged_union(first, second, "key", "value")


def chain_length(spark: SparkSession, folder: str) -> int:
    """The k whose chains have about as many vertices as there are customers."""
    return max(2, int(inputs.table(spark, folder, "customer").count() ** 0.5))


CHAIN = """chain_k as (select greatest(2, floor(sqrt(count(*))))::bigint k from customer),
chain as (
    select src, case when place % k = 0 then 0 else coalesce(next, 0) end dst from chain_k, (
        select c_custkey + 1 src, row_number() over (order by c_custkey) place, lead(c_custkey + 1) over (order by c_custkey) next
        from customer))"""


def chains(spark: SparkSession, folder: str) -> DataFrame:
    """Chains over the given customers, as many as a chain has vertices; a vertex is the customer's number plus one."""
    customers = inputs.table(spark, folder, "customer").select((F.col("c_custkey") + 1).alias("v"))
    return graphs.chains_over(customers, "v", chain_length(spark, folder))


@query(f"with {CHAIN} select * from chain")
def chain_graph(spark, folder):
    return chains(spark, folder)


@query("select '(' || l_partkey || ',' || l_suppkey || ')' line from lineitem")
def write_text(spark, folder):
    path = inputs.scratch(spark)
    text.write_text(inputs.supply_edges(spark, folder), path, tuples=True)
    return spark.read.text(path).toDF("line")


@query("select l_suppkey dst, count(*) followers from lineitem group by 1")
def write_csv(spark, folder):
    path = inputs.scratch(spark)
    text.write_csv(aggregates.follower_count(inputs.supply_edges(spark, folder)), path)
    return spark.read.schema("dst bigint, followers bigint").csv(path)


@query("select o_custkey::varchar as key, (o_orderkey // 10)::varchar as value from orders")
def write_key_value(spark, folder):
    path = inputs.scratch(spark)
    text.write_key_value(inputs.order_edges(spark, folder), path, "\t")
    return text.read_key_value(spark, path, "\t")


# ---- rows and sets -----------------------------------------------------------------------------


@query(f"with {inputs.ORDER_EDGES} select * from ordered where src < {MAX_ID} and dst < {MAX_ID}")
def filter_max_id(spark, folder):
    """The bound on both ids is the operator itself; all rows are read."""
    return edges.filter_max_id(inputs.order_edges(spark, folder), MAX_ID)


@query("select l_suppkey src, l_partkey dst from lineitem")
def reverse_edges(spark, folder):
    return edges.reverse_edges(inputs.supply_edges(spark, folder))


@query("select o_orderkey || ',' || o_custkey || ',' || o_orderpriority || ',' || o_orderstatus line from orders")
def row_to_csv_line(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"]
    return inputs.table(spark, folder, "orders").select(record_line(columns).alias("line"))


@query(f"with {inputs.SUPPLY_EDGES}, {inputs.ORDER_EDGES} select * from supply union all select * from ordered")
def union_all(spark, folder):
    return edges.union_all(inputs.supply_edges(spark, folder), inputs.order_edges(spark, folder))


@query(
    """select l_orderkey, l_linenumber,
    round((l_returnflag <> l_linestatus)::int::double + abs(l_extendedprice - l_quantity) + (l_partkey <> l_suppkey)::int::double, 6) d
    from lineitem"""
)
def record_distance(spark, folder):
    """The distance of two records, here of two sets of columns of each line item."""
    kind, amount = mismatch(F.col("l_returnflag"), F.col("l_linestatus")), gap(F.col("l_extendedprice"), F.col("l_quantity"))
    d = kind + amount + mismatch(F.col("l_partkey"), F.col("l_suppkey"))
    return inputs.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.round(d, 6).alias("d"))


RELAXED = f"""{inputs.ORDER_EDGES},
relaxed as (
    select dst v, c_nationkey + 1 dist from ordered join customer on c_custkey = src
    union all select c_custkey, c_nationkey from customer)"""


def relaxed(spark: SparkSession, folder: str) -> DataFrame:
    state = inputs.table(spark, folder, "customer").select(F.col("c_custkey").alias("v"), F.col("c_nationkey").alias("dist"))
    return edges.explode_neighbours(inputs.order_edges(spark, folder), state)


@query(f"with {RELAXED} select * from relaxed")
def explode_neighbours(spark, folder):
    return relaxed(spark, folder)


# ---- aggregates --------------------------------------------------------------------------------


@query("select l_suppkey dst, count(*) followers from lineitem group by 1")
def follower_count(spark, folder):
    return aggregates.follower_count(inputs.supply_edges(spark, folder))


@query('select o_custkey "user", max(o_totalprice) amount from orders group by 1')
def reduce_by_key(spark, folder):
    return aggregates.reduce_by_key(inputs.transactions(spark, folder), "user", "amount", F.max)


@query("select l_suppkey, sum(l_linenumber)::bigint l_linenumber from lineitem group by 1")
def fold_by_key(spark, folder):
    return aggregates.fold_by_key(inputs.table(spark, folder, "lineitem"), "l_suppkey", "l_linenumber", 0)


@query(
    "select l_suppkey, sum(l_linenumber)::bigint total, count(*) n, round(sum(l_linenumber)::double / count(*), 9) mean "
    "from lineitem group by 1"
)
def aggregate_by_key(spark, folder):
    value = F.col("l_linenumber")
    results = {"total": F.sum(value), "n": F.count(value), "mean": F.round(F.avg(value), 9)}
    return aggregates.aggregate_by_key(inputs.table(spark, folder, "lineitem"), "l_suppkey", results)


@query("select l_partkey, sum(l_linenumber)::bigint l_linenumber from lineitem group by 1")
def group_values_sum(spark, folder):
    return aggregates.group_values_sum(inputs.table(spark, folder, "lineitem"), "l_partkey", "l_linenumber")


@query("select min(l_extendedprice) min_value, max(l_extendedprice) max_value from lineitem")
def min_max(spark, folder):
    return aggregates.min_max(inputs.table(spark, folder, "lineitem"), "l_extendedprice")


@query("select max(trunc(o_totalprice)::int) max_amount, min(trunc(o_totalprice)::int) min_amount from orders")
def amount_min_max(spark, folder):
    return aggregates.amount_min_max(inputs.transactions(spark, folder))


@query(f"with {RELAXED} select v, min(dist) dist from relaxed group by 1")
def min_by_key(spark, folder):
    return aggregates.min_by_key(relaxed(spark, folder), "v", "dist")


@query(
    f"""with {inputs.ORDER_EDGES}, e as (select src, dst, count(*) n from ordered group by 1, 2)
    select src v, 0 part, string_agg(dst::varchar, ',' order by dst) neighbours, string_agg(n::varchar, ',' order by dst) copies
    from e group by 1"""
)
def adjacency_list(spark, folder):
    lists = aggregates.adjacency_list(inputs.order_edges(spark, folder))
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return lists.select("v", "part", join("neighbours"), join("copies"))


# ---- paths and triangles -----------------------------------------------------------------------

PATHS = "paths as (select a.src, b.dst from {e} a join {e} b on a.dst = b.src and a.src <> b.dst)"
CLOSED = f"""{inputs.SUPPLY_EDGES}, {PATHS.format(e="supply")},
closed as (select p.src, p.dst from paths p join supply c on p.dst = c.src and p.src = c.dst)"""
TRIANGLES = f"with {CLOSED} select count(*) closed_rows, count(*) // 3 triangles from closed"


@query(
    f"with {inputs.ORDER_EDGES}, {PATHS.format(e='ordered')} select src, dst, count(*) n_paths from paths group by 1, 2"
)
def path2(spark, folder):
    return triangles.path2(inputs.order_edges(spark, folder))


@query(f"with {CLOSED} select src, dst, count(*) n_closed from closed group by 1, 2")
def closed_triangles(spark, folder):
    return triangles.closed_triangles(inputs.supply_edges(spark, folder))


@query(TRIANGLES)
def triangle_count(spark, folder):
    return triangles.triangle_count(inputs.supply_edges(spark, folder))


@query(TRIANGLES)
def triangle_count_broadcast(spark, folder):
    return triangles.triangle_count_broadcast(inputs.supply_edges(spark, folder))


@query(
    f"""with {inputs.SUPPLY_EDGES} select count(*) closed_rows, count(*) // 3 triangles
    from supply a join supply b on a.dst = b.src join supply c on b.dst = c.src and c.dst = a.src
    where a.src <> a.dst and b.src <> b.dst and c.src <> c.dst"""
)
def triangle_count_strict(spark, folder):
    return triangles.triangle_count(inputs.supply_edges(spark, folder), strict=True)


@query(
    f"""with {inputs.SUPPLY_EDGES}, e as (select distinct * from supply), {PATHS.format(e="e")}
    select count(*) closed_rows, count(*) // 3 triangles from paths p join e c on p.dst = c.src and p.src = c.dst"""
)
def triangle_count_distinct(spark, folder):
    return triangles.triangle_count(inputs.supply_edges(spark, folder), distinct_edges=True)


# ---- shortest paths ----------------------------------------------------------------------------

REACHED = f"with recursive {inputs.ORDER_EDGES}, {sql.distances('ordered', SOURCE, 40)}"


@query(f"{REACHED} select * from reached")
def sssp(spark, folder):
    return shortest_path.sssp(inputs.order_edges(spark, folder), SOURCE)


@query(
    f"""{REACHED}, everyone as (select src v from ordered union select dst from ordered union select v from reached)
    select everyone.v, reached.dist from everyone left join reached on reached.v = everyone.v"""
)
def sssp_unreached(spark, folder):
    return shortest_path.sssp(inputs.order_edges(spark, folder), SOURCE, include_unreached=True)


@query(f"{REACHED} select max(dist) longest from reached")
def longest_shortest_path(spark, folder):
    return shortest_path.longest_shortest_path(shortest_path.sssp(inputs.order_edges(spark, folder), SOURCE))


@query(f"{REACHED} select * from reached")
def sssp_resumed(spark, folder):
    """Stopped after three rounds, then taken up again from what those wrote."""
    path, ordered = inputs.scratch(spark), inputs.order_edges(spark, folder)
    shortest_path.sssp(ordered, SOURCE, max_rounds=3, snapshots=path)
    return shortest_path.sssp(ordered, SOURCE, snapshots=path, resume=True)


@query(f"{REACHED} select dist as round, v, dist from reached where dist > 0")
def sssp_snapshots(spark, folder):
    """The rounds as they lie in the folder."""
    path = inputs.scratch(spark)
    shortest_path.sssp(inputs.order_edges(spark, folder), SOURCE, snapshots=path)
    return spark.read.parquet(path).withColumnRenamed("iter", "round")


# ---- ranks -------------------------------------------------------------------------------------

ROUNDS = pagerank.ROUNDS
RANKS = f"with {inputs.ORDER_EDGES}, {sql.pagerank('ordered', ROUNDS)}"
CHAIN_RANKS = f"with {CHAIN}, links as (select * from chain where dst <> 0), {sql.pagerank('links', ROUNDS)}"


def rounded(ranks: DataFrame) -> DataFrame:
    return ranks.select("v", F.round("pr", 10).alias("pr"))


@query(f"{CHAIN_RANKS} select v, round(pr, 10) pr from r{ROUNDS} union all select 0, 0.0")
def pagerank_chain(spark, folder):
    return rounded(pagerank.pagerank_chains(chains(spark, folder)).ranks)


@query(f"{RANKS} select v, round(pr, 10) pr from r{ROUNDS}", name="pagerank")
def pagerank_edges(spark, folder):
    return rounded(pagerank.pagerank(inputs.order_edges(spark, folder)).ranks)


@query(f"with {inputs.ORDER_EDGES}, {sql.pagerank('ordered', ROUNDS, 0.85)} select v, round(pr, 10) pr from r{ROUNDS}")
def pagerank_damped(spark, folder):
    return rounded(pagerank.pagerank(inputs.order_edges(spark, folder), damping=0.85).ranks)


@query(
    f"{RANKS} "
    + " union all ".join(f"select {i} round, round(sum(pr), 9) mass from r{i}" for i in range(1, ROUNDS + 1))
)
def pagerank_mass(spark, folder):
    masses = pagerank.pagerank(inputs.order_edges(spark, folder)).masses
    return pagerank.mass_table(spark, masses).withColumn("mass", F.round("mass", 9))


@query(f"{RANKS} select v, round(pr, 10) pr from r{ROUNDS} order by round(pr, 10) desc, v limit {TOP}")
def pagerank_top5(spark, folder):
    return pagerank.top_ranks(pagerank.pagerank(inputs.order_edges(spark, folder)).ranks, TOP)


@query(f"{RANKS} select v, round(pr, 10) pr from r{ROUNDS}")
def pagerank_resumed(spark, folder):
    """Stopped after three rounds, then taken up again from what those wrote."""
    path, ordered = inputs.scratch(spark), inputs.order_edges(spark, folder)
    pagerank.pagerank(ordered, rounds=3, snapshots=path)
    return rounded(pagerank.pagerank(ordered, snapshots=path, resume=True).ranks)


@query(f"{RANKS} " + " union all ".join(f"select {i} round, v, round(pr, 10) pr from r{i}" for i in range(1, 4)))
def pagerank_snapshots(spark, folder):
    """The rounds as they lie in the folder."""
    path = inputs.scratch(spark)
    pagerank.pagerank(inputs.order_edges(spark, folder), rounds=3, snapshots=path)
    return spark.read.parquet(path).select(F.col("iter").alias("round"), "v", F.round("pr", 10).alias("pr"))


# ---- clusters ----------------------------------------------------------------------------------


def first_step(spark: SparkSession, folder: str) -> DataFrame:
    points = inputs.balances(spark, folder)
    return kmeans.step(points, kmeans.initial_centroids(points, CLUSTERS, "even"))


FIRST_STEP = f"with {inputs.BALANCES}, {sql.kmeans('points', CLUSTERS, 'even', 1)}"
HISTORY = "select round, round(old_centroid, 9) old_centroid, round(centroid, 9) centroid, n, abs_error from history"


def history(points: DataFrame, init: str, **options) -> DataFrame:
    found = kmeans.kmeans_1d(points, CLUSTERS, init, **options).history
    return found.select("round", F.round("old_centroid", 9).alias("old_centroid"), F.round("centroid", 9).alias("centroid"), "n", "abs_error")


@query(
    f"""{FIRST_STEP} select id, x, centroid from (
    select id, x, c centroid, row_number() over (partition by id order by abs(x - c), c) place from points cross join c0)
    where place = 1"""
)
def kmeans_assign(spark, folder):
    points = inputs.balances(spark, folder)
    return kmeans.assign(points, kmeans.initial_centroids(points, CLUSTERS, "even"))


@query(
    f"""{FIRST_STEP}, squares as (select c, round(sum((x - c) * (x - c)) / count(*), 4) mse from near1 group by 1)
    select old_centroid, round(centroid, 9) centroid, n, abs_error, mse from s1 join squares on c = old_centroid"""
)
def kmeans_step(spark, folder):
    found = first_step(spark, folder)
    return found.select("old_centroid", F.round("centroid", 9).alias("centroid"), "n", "abs_error", F.round(F.col("sse") / F.col("n"), 4).alias("mse"))


@query(f"{FIRST_STEP} select err abs_error from err1")
def kmeans_step_error(spark, folder):
    return kmeans.step_error(first_step(spark, folder))


@query(f"with {inputs.BALANCES}, {sql.kmeans('points', CLUSTERS, 'max_minus', kmeans.MAX_ROUNDS)} {HISTORY}")
def kmeans_1d(spark, folder):
    return history(inputs.balances(spark, folder), "max_minus")


@query(f"with {inputs.BALANCES}, {sql.kmeans('points', CLUSTERS, 'even', kmeans.MAX_ROUNDS)} {HISTORY}")
def kmeans_1d_even(spark, folder):
    return history(inputs.balances(spark, folder), "even")


@query(f"with {inputs.FOLLOWER_POINTS}, {sql.kmeans('points', CLUSTERS, 'even', kmeans.MAX_ROUNDS)} {HISTORY}")
def kmeans_followers(spark, folder):
    return history(inputs.follower_points(spark, folder), "even")


@query(f"with {inputs.BALANCES}, {sql.kmeans('points', CLUSTERS, 'max_minus', kmeans.MAX_ROUNDS)} {HISTORY}")
def kmeans_resumed(spark, folder):
    """Stopped after three rounds, then taken up again from what those wrote."""
    path, points = inputs.scratch(spark), inputs.balances(spark, folder)
    kmeans.kmeans_1d(points, CLUSTERS, "max_minus", max_rounds=3, snapshots=path)
    return history(points, "max_minus", snapshots=path, resume=True)


# ---- nearest neighbours ------------------------------------------------------------------------

def neighbours_sql(train: str = "train", test: str = "test") -> str:
    return f"""pairs as (
    select t.id, (t.type <> r.type)::int::double + abs(t.amount - r.amount) + (t.usr <> r.usr)::int::double d, r.cls
    from {test} t cross join {train} r),
ranked as (select *, dense_rank() over (partition by id order by d) place from pairs),
near as (select id, d, min(cls) cls from ranked where place <= {K} group by 1, 2),
votes as (select id, cls, count(*) n from near group by 1, 2),
pred as (select id, cls pred from votes qualify row_number() over (partition by id order by n desc, cls) = 1)"""


NEIGHBOURS = f"with {inputs.TRANSACTIONS}, {neighbours_sql()}"
_MOVED = "(amount - (select min(amount) from train)) / (select max(amount) - min(amount) from train)"
SCALED_NEIGHBOURS = f"""with {inputs.TRANSACTIONS},
scaled_train as (select * replace ({_MOVED} as amount) from train), scaled_test as (select * replace ({_MOVED} as amount) from test),
{neighbours_sql("scaled_train", "scaled_test")}"""
PREDICTED = f"{NEIGHBOURS} select * from pred"


def split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return features.split_random(inputs.transactions(spark, folder), "id", 0.8, 20)


def listed(neighbours: DataFrame) -> DataFrame:
    return neighbours.select("id", F.inline("neighbours")).withColumn("d", F.round("d", 6))


@query(
    """select o_custkey, round(d, 6) d, cls, place::int place from (
        select o_custkey, d, min(cls) cls, row_number() over (partition by o_custkey order by d) place
        from (select o_custkey, o_totalprice d, (o_orderstatus = 'F')::int cls from orders) group by 1, 2) where place <= 3"""
)
def k_smallest(spark, folder):
    pairs = inputs.transactions(spark, folder).select(F.col("user").alias("id"), F.col("amount").alias("d"), "cls")
    found = topk.k_smallest(pairs, K)
    return found.select(F.col("id").alias("o_custkey"), F.round("d", 6).alias("d"), "cls", F.col("rank").alias("place"))


@query(f"{NEIGHBOURS} select id, round(d, 6) d, cls from near")
def knn_neighbours(spark, folder):
    return listed(knn.knn_neighbours(*split(spark, folder), K, prune=False))


@query(f"{NEIGHBOURS} select id, round(d, 6) d, cls from near")
def knn_topk_neighbours(spark, folder):
    return listed(knn.knn_neighbours(*split(spark, folder), K))


@query(f"{SCALED_NEIGHBOURS} select id, round(d, 9) d, cls from near")
def knn_scaled_neighbours(spark, folder):
    """With amounts relative to the span of the train amounts."""
    found = knn.knn_neighbours(*split(spark, folder), K, scale_amount=True)
    return found.select("id", F.inline("neighbours")).withColumn("d", F.round("d", 9))


@query(PREDICTED)
def knn_classify(spark, folder):
    return knn.knn_classify(*split(spark, folder), K)


@query(PREDICTED)
def knn_classify_topk(spark, folder):
    return knn.knn_classify_topk(*split(spark, folder), K)


@query(f'{NEIGHBOURS} select test.id, type, amount, usr "user", cls, pred from test left join pred on pred.id = test.id')
def knn_labelled_output(spark, folder):
    train, test = split(spark, folder)
    return knn.labelled(knn.knn_classify_topk(train, test, K), test)


@query(
    f"""{NEIGHBOURS} select count(*) filter (pred = 1 and cls = 1) tp, count(*) filter (pred = 1 and cls <> 1) fp,
    count(*) filter (pred = 0 and cls = 0) tn, count(*) filter (pred = 0 and cls <> 0) fn
    from test join pred on pred.id = test.id"""
)
def knn_confusion(spark, folder):
    train, test = split(spark, folder)
    return metrics.confusion_matrix(knn.labelled(knn.knn_classify_topk(train, test, K), test), "cls")


@query("select o_orderkey, 10000 + row_number() over (order by o_orderkey) id from orders")
def assign_ids(spark, folder):
    return ranges.assign_ids(inputs.table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("select o_clerk_key, 10000 + row_number() over (order by o_clerk_key) id from (select o_orderpriority || ':' || o_orderkey o_clerk_key from orders)")
def assign_text_ids(spark, folder):
    """Ids for records whose key is a text."""
    key = F.concat_ws(":", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("o_clerk_key")
    return ranges.assign_ids(inputs.table(spark, folder, "orders").select(key), "o_clerk_key")


VOTES = "votes as (select l_suppkey id, case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end cls from lineitem)"


@query(
    f"""with {VOTES}, counts as (select id, cls, count(*) n from votes group by 1, 2)
    select id, cls pred from counts qualify row_number() over (partition by id order by n desc, cls) = 1"""
)
def majority_vote(spark, folder):
    flag = F.col("l_returnflag")
    cls = F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("cls")
    return topk.majority_vote(inputs.table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("id"), cls))


# ---- features and models -----------------------------------------------------------------------


@query(f"with {inputs.PREPARED} select * from prepared")
def prepare_transactions(spark, folder):
    return inputs.prepared_with_key(spark, folder)


@query(
    f"with {inputs.PREPARED} select o_orderkey, "
    + ", ".join(f'"{name}" f{i}' for i, name in enumerate(features.FEATURES))
    + " from prepared"
)
def assemble_features(spark, folder):
    df = features.assemble_features(inputs.prepared_with_key(spark, folder)).withColumn("f", vector_to_array("features"))
    return df.select("o_orderkey", *[F.col("f")[i].alias(f"f{i}") for i in range(len(features.FEATURES))])


@query(
    f"""with {inputs.PREPARED},
    places as (select "isFraud" v, (row_number() over (order by count(*) desc, "isFraud") - 1)::double as label from prepared group by 1)
    select o_orderkey, label from prepared join places on v = "isFraud" """
)
def index_label(spark, folder):
    return features.index_label(inputs.prepared_with_key(spark, folder)).select("o_orderkey", "label")


def in_parts(train: DataFrame, test: DataFrame, *columns: str) -> DataFrame:
    """Both parts in one table, with the name of the part."""
    return train.select(*columns, F.lit("train").alias("part")).unionByName(test.select(*columns, F.lit("test").alias("part")))


@query(f"select o_orderkey id, case when {inputs.drawn('o_orderkey', 20, 0.8)} then 'train' else 'test' end part from orders")
def split_random(spark, folder):
    return in_parts(*split(spark, folder), "id")


@query(
    f"""select o_orderkey || ',' || o_custkey || ',' || o_orderpriority line,
    case when {inputs.drawn('o_orderkey', 20, 0.8)} then 'train' else 'test' end part from orders"""
)
def split_write(spark, folder):
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    marked = features.mark_random(orders, "o_orderkey", 0.8, 20)
    part = F.when(F.col("first"), "train").otherwise("test")
    path = inputs.scratch(spark)
    text.write_parts(marked.withColumn("part", part).drop("first"), "part", path)
    return in_parts(spark.read.text(f"{path}/part=train").toDF("line"), spark.read.text(f"{path}/part=test").toDF("line"), "line")


@query(
    f"""with {inputs.RECORDS} select o_orderkey, "isFraud",
    case when {inputs.drawn('''"isFraud" || ':' || o_orderkey''', 20, 0.7)} then 'train' else 'test' end part from records"""
)
def split_stratified(spark, folder):
    return in_parts(*features.split_stratified(inputs.records(spark, folder), "o_orderkey", "isFraud"), "o_orderkey", "isFraud")


RESULTS = "(select (l_returnflag = 'R')::int actual, (l_linestatus = 'F')::int pred from lineitem)"


def results(spark: SparkSession, folder: str) -> DataFrame:
    actual = (F.col("l_returnflag") == "R").cast("int").alias("actual")
    return inputs.table(spark, folder, "lineitem").select(actual, (F.col("l_linestatus") == "F").cast("int").alias("pred"))


@query(
    f"""select count(*) filter (pred = 1 and actual = 1) tp, count(*) filter (pred = 1 and actual <> 1) fp,
    count(*) filter (pred = 0 and actual = 0) tn, count(*) filter (pred = 0 and actual <> 0) fn from {RESULTS}"""
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(results(spark, folder))


@query(f"select round(avg((actual = pred)::int::double), 9) accuracy from {RESULTS}")
def accuracy(spark, folder):
    return metrics.accuracy(results(spark, folder)).select(F.round("accuracy", 9).alias("accuracy"))


@query(
    """with s as (select o_totalprice score, (o_orderstatus = 'F') pos from orders),
    ranked as (select pos, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 place from s),
    t as (select sum(place) filter (pos) places, count(*) filter (pos) p, count(*) filter (not pos) n from ranked)
    select round((places - p * (p + 1) / 2.0) / (p::double * n), 9) auc from t"""
)
def roc_auc(spark, folder):
    scores = inputs.transactions(spark, folder).select(F.col("amount").alias("score"), F.col("cls").alias("label"))
    return metrics.roc_auc(scores).select(F.round("auc", 9).alias("auc"))


# The label is a rule with a threshold on the amount. Near it a model may err, and what it says there is left open (null); farther
# away the rule says what each of the models must predict for rows it has not seen.

THRESHOLD, MARGIN = 400_000, 40_000
FAR = f"abs(amt - {THRESHOLD}) > {MARGIN}"
_HELD = inputs.drawn("\"isFraud\" || ':' || o_orderkey", 20, 0.7)
LABELLED = f"""with {inputs.PREPARED},
places as (select "isFraud" v, (row_number() over (order by count(*) desc, "isFraud") - 1)::double as label from prepared group by 1),
held as (select o_orderkey, amt, label from prepared join places on v = "isFraud" where not {_HELD})"""
PREDICTIONS = f"{LABELLED} select o_orderkey, label, case when {FAR} then label end as prediction, true as agrees from held"


def predictions(spark: SparkSession, folder: str, estimator) -> DataFrame:
    """Test rows with the prediction, and whether the probability lies on its side."""
    train, test = inputs.model_split(spark, folder)
    found = trees.predict(trees.fit_all([estimator], train)[0], test).withColumn("p", vector_to_array("probability")[1])
    agrees = F.col("p").between(0.0, 1.0) & (F.col("prediction") == (F.col("p") > 0.5).cast("double"))
    return found.select("o_orderkey", "label", F.expr(f"case when {FAR} then prediction end").alias("prediction"), agrees.alias("agrees"))


@query(PREDICTIONS)
def rf_predict(spark, folder):
    return predictions(spark, folder, trees.random_forest())


@query(PREDICTIONS)
def gbt_predict(spark, folder):
    return predictions(spark, folder, trees.boosted_trees())


@query(PREDICTIONS)
def dt_predict(spark, folder):
    return predictions(spark, folder, trees.decision_tree())


@query()
def model_summary(spark, folder):
    """The text form of the decision tree and of the forest."""
    train, _ = inputs.model_split(spark, folder)
    models = trees.fit_all([trees.decision_tree(), trees.random_forest()], train)
    found = [(name, trees.model_summary(model)) for name, model in zip(("decision_tree", "random_forest"), models, strict=True)]
    return spark.createDataFrame(found, "model string, summary string")


@query()
def model_report(spark, folder):
    return trees.model_report(*inputs.model_split(spark, folder))


# More that SQL can say of the models: that their outputs agree with each other, what they must learn where the label is a rule on few
# values, and their report away from the threshold.

MODELS = {"random_forest": trees.random_forest, "boosted_trees": trees.boosted_trees, "decision_tree": trees.decision_tree}
_NAMES = f"(values {', '.join(f'({name!r})' for name in MODELS)}) m(model)"


@query(
    f"""with {inputs.PREPARED},
    places as (select "isFraud" v, (row_number() over (order by count(*) desc, "isFraud") - 1)::double as label from prepared group by 1)
    select model, o_orderkey, label, true valid, true bounded, true agrees
    from prepared join places on v = "isFraud" cross join {_NAMES} where not {_HELD}"""
)
def model_checks(spark, folder):
    """Each model's test rows: the prediction is 0 or 1, the probability lies between 0 and 1, and the two agree."""
    train, test = inputs.model_split(spark, folder)
    found, judged = test.select("o_orderkey", "label", "features"), []
    for name, model in zip(MODELS, trees.fit_all([make() for make in MODELS.values()], train), strict=True):
        outputs = {kind: f"{name}_{kind}" for kind in ("rawPrediction", "probability", "prediction")}
        model.setRawPredictionCol(outputs["rawPrediction"]).setProbabilityCol(outputs["probability"]).setPredictionCol(outputs["prediction"])
        found = trees.predict(model, found).withColumn(f"{name}_p", vector_to_array(outputs["probability"])[1]).drop(outputs["rawPrediction"], outputs["probability"])
        prediction, p = F.col(outputs["prediction"]), F.col(f"{name}_p")
        checks = {"valid": prediction.isin(0.0, 1.0), "bounded": p.between(0.0, 1.0), "agrees": prediction == (p > 0.5).cast("double")}
        judged.append(F.struct(F.lit(name).alias("model"), "o_orderkey", "label", *[check.alias(c) for c, check in checks.items()]))
    return found.select(F.inline(F.array(*judged)))


@query(
    f"""with ruled as (
        select o_orderkey, (left(o_orderpriority, 1)::int <= 2 and o_orderstatus = 'F' or o_orderkey % 4 = 3)::int::double as label from orders)
    select model, o_orderkey, label, label as prediction from ruled cross join {_NAMES}"""
)
def model_rule(spark, folder):
    """Models of a label that is a rule on three features with few values: they must predict it for every order."""
    urgent, final = F.substring("o_orderpriority", 1, 1).cast("int"), F.col("o_orderstatus") == "F"
    turn = F.col("o_orderkey") % 4
    label = (((urgent <= 2) & final) | (turn == 3)).cast("double").alias("label")
    rows = inputs.table(spark, folder, "orders").select("o_orderkey", urgent.cast("double").alias("urgent"), final.cast("double").alias("final"), turn.cast("double").alias("turn"), label)
    known = features.assemble_features(features.kept_for_training(rows, "o_orderkey"), ("urgent", "final", "turn"))
    makers = {name: make() for name, make in MODELS.items()}
    makers["random_forest"].setFeatureSubsetStrategy("all")  # a forest sees a part of the features at each split; here it may look at all three
    out = None
    for name, model in zip(makers, trees.fit_all(list(makers.values()), known), strict=True):
        some = trees.predict(model, known).select(F.lit(name).alias("model"), "o_orderkey", "label", "prediction")
        out = some if out is None else out.unionByName(some)
    return out


@query()
def model_sizes(spark, folder):
    """How many trees each model has, and that none is deeper than 10."""
    train, _ = inputs.model_split(spark, folder)
    found = []
    for name, model in zip(MODELS, trees.fit_all([make() for make in MODELS.values()], train), strict=True):
        members = [model] if name == "decision_tree" else model.trees
        found.append((name, len(members), all(t.depth <= 10 for t in members)))
    return spark.createDataFrame(found, "model string, trees int, shallow boolean")


@query(
    f"""{LABELLED} select model, case model when 'random_forest' then 'area_under_roc' else 'accuracy' end metric, count(*) n, avg((label in (0, 1))::int)::double as value
    from held cross join {_NAMES} where {FAR} group by model"""
)
def model_report_checked(spark, folder):
    """The report over the test rows away from the threshold, where nothing may be wrong, and how many these are."""
    train, test = inputs.model_split(spark, folder)
    far = test.where(FAR)
    return trees.model_report(train, far).crossJoin(far.agg(F.count(F.lit(1)).alias("n")))
