"""Length-2 paths and directed triangles.

A path a->b->c counts when a and c differ; it closes when the edge c->a exists. Only the ends are
compared, so a self-loop on a vertex of a mutual pair also gives closed paths. Repeated edges
multiply.

Counting never builds the in x out pairs around a hub. Vertex pairs are oriented from lower to
higher degree, which leaves every vertex at most sqrt(2 * pairs) outgoing pairs, and each triangle is
found once, at its lowest vertex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.operators.edges import filter_max_id, weighted_edges
from emberline.operators.skew import ROWS_PER_TASK, balanced_join, grid_join, hot_from_counts, hot_keys
from emberline.session import cut_lineage

STAR_ROWS = 4096


def bounded(edges: DataFrame, max_id: int | None, distinct_edges: bool) -> DataFrame:
    edges = edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if max_id is not None:
        edges = filter_max_id(edges, max_id)
    return edges.distinct() if distinct_edges else edges


def path2(
    edges: DataFrame, max_id: int | None = None, distinct_edges: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Ends of all length-2 paths with distinct ends, and how many paths join them: `(src, dst, n_paths)`."""
    counted = cut_lineage(weighted_edges(bounded(edges, max_id, distinct_edges)))
    into = counted.select("src", F.col("dst").alias("mid"), F.col("n").alias("n_in"))
    out = counted.select(F.col("src").alias("mid"), "dst", F.col("n").alias("n_out"))
    paths = grid_join(into, out, "mid", ["src"], ["dst"], rows_per_task).where(F.col("src") != F.col("dst"))
    return paths.groupBy("src", "dst").agg(F.sum(F.col("n_in") * F.col("n_out")).alias("n_paths"))


def vertex_pairs(edges: DataFrame) -> DataFrame:
    """One row per unordered pair: `(u, v, fwd, back)` with the copies of u->v and of v->u.

    A self-loop is the row with u = v and its copies in `fwd`.
    """
    forward = F.col("src") <= F.col("dst")
    return edges.groupBy(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).agg(
        F.sum(forward.cast("bigint")).alias("fwd"), F.sum((~forward).cast("bigint")).alias("back")
    )


def vertex_table(pairs: DataFrame) -> DataFrame:
    """Degree, self-loops, and whether edges leave and enter, per vertex."""
    plain = F.col("u") != F.col("v")
    ends = F.array(
        F.struct(
            F.col("u").alias("id"),
            plain.cast("bigint").alias("deg"),
            (plain & (F.col("fwd") > 0)).alias("leaves"),
            (plain & (F.col("back") > 0)).alias("enters"),
            F.when(plain, F.lit(0).cast("bigint")).otherwise(F.col("fwd")).alias("loops"),
        ),
        F.struct(
            F.col("v").alias("id"),
            plain.cast("bigint").alias("deg"),
            (plain & (F.col("back") > 0)).alias("leaves"),
            (plain & (F.col("fwd") > 0)).alias("enters"),
            F.lit(0).cast("bigint").alias("loops"),
        ),
    )
    return (
        pairs.select(F.inline(ends))
        .groupBy("id")
        .agg(
            F.sum("deg").alias("deg"),
            F.max("leaves").alias("leaves"),
            F.max("enters").alias("enters"),
            F.sum("loops").alias("loops"),
        )
    )


def oriented_pairs(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Pairs from the lower end x to the higher end y by (degree, id): `(x, y, x_deg, y_deg, fwd, back, loops)`.

    `fwd` counts x->y, `back` counts y->x, `loops` the self-loops on both ends. A pair with an end that
    edges never leave or never enter cannot close a path and is left out.
    """
    pairs = cut_lineage(vertex_pairs(edges))
    table = cut_lineage(vertex_table(pairs))
    hot = hot_from_counts(table, ["id"], "deg", rows_per_task)
    useful = table.where("leaves and enters").select("id", "deg", "loops")

    def attach(df: DataFrame, end: str, other: str) -> DataFrame:
        facts = useful.select(F.col("id").alias(end), F.col("deg").alias(f"{end}_deg"), F.col("loops").alias(f"{end}_loops"))
        hot_end = None if hot is None else hot.withColumnRenamed("id", end)
        return balanced_join(df, facts, [end], [other], hot_end)

    both = attach(attach(pairs.where("u <> v"), "u", "v"), "v", "u")
    u_lower = F.struct("u_deg", "u") < F.struct("v_deg", "v")
    return both.select(
        F.when(u_lower, F.col("u")).otherwise(F.col("v")).alias("x"),
        F.when(u_lower, F.col("v")).otherwise(F.col("u")).alias("y"),
        F.when(u_lower, F.col("u_deg")).otherwise(F.col("v_deg")).alias("x_deg"),
        F.when(u_lower, F.col("v_deg")).otherwise(F.col("u_deg")).alias("y_deg"),
        F.when(u_lower, F.col("fwd")).otherwise(F.col("back")).alias("fwd"),
        F.when(u_lower, F.col("back")).otherwise(F.col("fwd")).alias("back"),
        (F.col("u_loops") + F.col("v_loops")).alias("loops"),
    )


def wedges(oriented: DataFrame, star_rows: int = STAR_ROWS) -> DataFrame:
    """Two pairs x-y, x-z with y below z, and the edges they add to the cycles x->y->z->x and x->z->y->x.

    The pairs of one x are split so that no task gets more than `star_rows` of them to combine with
    the rest of that star.
    """
    one = oriented.select("x", "y", "y_deg", F.col("fwd").alias("xy"), F.col("back").alias("yx"))
    two = oriented.select("x", F.col("y").alias("z"), F.col("y_deg").alias("z_deg"), F.col("fwd").alias("xz"), F.col("back").alias("zx"))
    hot = hot_keys(oriented, ["x"], star_rows)
    ordered = F.struct("y_deg", "y") < F.struct("z_deg", "z")
    met = balanced_join(one, two, ["x"], ["y"], hot, ordered)
    out = met.select("x", "y", "z", "y_deg", (F.col("xy") * F.col("zx")).alias("turn"), (F.col("xz") * F.col("yx")).alias("counter"))
    return out.where("turn > 0 or counter > 0")


def closing(oriented: DataFrame) -> DataFrame:
    return oriented.select(
        F.col("x").alias("y"), F.col("y").alias("z"), F.col("x_deg").alias("y_deg"), F.col("fwd").alias("yz"), F.col("back").alias("zy")
    )


def closed_wedges(open_: DataFrame, closing_rows: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Wedges with the pair that closes them, joined on (y, z).

    A pair closes no more wedges than its lower end has neighbours, so both sides know from `y_deg` into how many parts the wedges of a
    pair go, without a list of hot pairs: wedges are spread by `x`, the closing row is copied to each part.
    """
    parts = F.ceil(F.col("y_deg") / F.lit(rows_per_task)).cast("int")
    spread = open_.withColumn("part", F.pmod(F.xxhash64("x"), parts).cast("int")).drop("y_deg")
    copied = closing_rows.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("y_deg")
    return spread.join(copied, ["y", "z", "part"]).drop("part")


def closed_triangles(
    edges: DataFrame,
    max_id: int | None = None,
    distinct_edges: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    star_rows: int = STAR_ROWS,
) -> DataFrame:
    """Ends of the closed length-2 paths, with multiplicity: `(src, dst, n_closed)`."""
    oriented = cut_lineage(oriented_pairs(bounded(edges, max_id, distinct_edges), rows_per_task))
    found = closed_wedges(wedges(oriented, star_rows), closing(oriented), rows_per_task)
    turn = F.col("turn") * F.col("yz")
    counter = F.col("counter") * F.col("zy")
    rotations = F.array(
        *[F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), turn.alias("n")) for a, b in ("xz", "yx", "zy")],
        *[F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), counter.alias("n")) for a, b in ("xy", "zx", "yz")],
    )
    proper = found.select(F.inline(rotations))
    looped = F.col("fwd") * F.col("back") * F.col("loops")
    via_loops = oriented.where(looped > 0).select(
        F.inline(
            F.array(
                F.struct(F.col("x").alias("src"), F.col("y").alias("dst"), looped.alias("n")),
                F.struct(F.col("y").alias("src"), F.col("x").alias("dst"), looped.alias("n")),
            )
        )
    )
    rows = proper.where("n > 0").unionByName(via_loops)
    return rows.groupBy("src", "dst").agg(F.sum("n").alias("n_closed"))


def triangle_count(
    edges: DataFrame,
    max_id: int | None = None,
    distinct_edges: bool = False,
    strict: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    star_rows: int = STAR_ROWS,
) -> DataFrame:
    """One row `(closed_rows, triangles)`: the closed paths, and a third of them rounded down.

    With `strict` only cycles through three distinct vertices count.
    """
    oriented = cut_lineage(oriented_pairs(bounded(edges, max_id, distinct_edges), rows_per_task))
    open_ends = wedges(oriented, star_rows).groupBy("y", "z").agg(F.sum("turn").alias("turn"), F.sum("counter").alias("counter"))
    cycles = open_ends.join(closing(oriented), ["y", "z"])
    rows = cycles.select((3 * (F.col("turn") * F.col("yz") + F.col("counter") * F.col("zy"))).alias("n"))
    if not strict:
        rows = rows.unionByName(oriented.select((2 * F.col("fwd") * F.col("back") * F.col("loops")).alias("n")))
    return thirds(rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("closed_rows")))


def thirds(closed: DataFrame) -> DataFrame:
    return closed.select("closed_rows", F.expr("closed_rows div 3").alias("triangles"))


def neighbour_lists(oriented: DataFrame) -> DataFrame:
    """One row per vertex with out-going pairs: `(x, ids, fwds, backs)`, sorted by the neighbour's id."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col("y").alias("id"), "fwd", "back"))).alias("pairs")
    return oriented.groupBy("x").agg(pairs).select("x", F.col("pairs.id").alias("ids"), F.col("pairs.fwd").alias("fwds"), F.col("pairs.back").alias("backs"))


def row_bytes() -> Column:
    """Bytes that a row of `neighbour_lists` takes as Spark lays it out: header, one word per column, and per list a header, a bit
    per element and a word per element."""
    words = F.size("ids")
    one = 8 + 8 * F.ceil(words / 64) + 8 * words
    return F.lit(8 + 4 * 8) + 3 * one


def triangle_count_broadcast(
    edges: DataFrame,
    max_id: int | None = None,
    distinct_edges: bool = False,
    max_broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """The same count with the neighbour lists of the oriented pairs copied to every executor once, and no shuffle of paths.

    Each pair x-y intersects the list of x with that of y, so the in x out pairs around a hub never exist. The lists are stored
    and the bytes of their rows summed first; above `max_broadcast_bytes` the shuffled count runs instead.
    """
    edges = bounded(edges, max_id, distinct_edges)
    oriented = cut_lineage(oriented_pairs(edges))
    lists = cut_lineage(neighbour_lists(oriented))
    if (lists.agg(F.sum(row_bytes())).first()[0] or 0) > max_broadcast_bytes:
        return triangle_count(edges)
    sent = F.broadcast(lists)
    mine = lists.select("x", F.col("ids").alias("z_ids"), F.explode(F.arrays_zip("ids", "fwds", "backs")).alias("y"), "fwds", "backs")
    mine = mine.select("z_ids", F.col("fwds").alias("x_fwds"), F.col("backs").alias("x_backs"), F.col("y.ids").alias("x"), F.col("y.fwds").alias("xy"), F.col("y.backs").alias("yx"))
    met = mine.join(sent, "x").where(F.arrays_overlap("z_ids", "ids"))
    third = met.withColumn("z", F.explode(F.array_intersect("z_ids", "ids")))
    at = lambda lists, ids: F.element_at(lists, F.array_position(ids, F.col("z")).cast("int"))
    turn = F.col("xy") * at("fwds", F.col("ids")) * at("x_backs", F.col("z_ids"))
    counter = F.col("yx") * at("backs", F.col("ids")) * at("x_fwds", F.col("z_ids"))
    rows = third.select((3 * (turn + counter)).alias("n"))
    rows = rows.unionByName(oriented.select((2 * F.col("fwd") * F.col("back") * F.col("loops")).alias("n")))
    return thirds(rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("closed_rows")))
