"""SQL of the loops, written out round by round."""

from __future__ import annotations


def pagerank(edges: str, rounds: int, damping: float = 1.0) -> str:
    """CTEs r0 .. r{rounds} `(v, pr)` over the CTE `edges (src, dst)`."""
    steps = [
        f"e as materialized (select src, dst, count(*) n from {edges} group by 1, 2)",
        "deg as materialized (select src, sum(n)::double out_edges from e group by 1)",
        "vs as materialized (select src v from e union select dst from e)",
        "size as materialized (select count(*)::double n from vs)",
        "r0 as materialized (select v, 1.0 / n pr from vs, size)",
    ]
    for i in range(1, rounds + 1):
        last = f"r{i - 1}"
        steps.append(
            f"""r{i} as materialized (
            select vs.v, (1 - {damping}) / size.n + {damping} * (coalesce(got, 0) + lost.pr / size.n) pr
            from vs cross join size
            cross join (select coalesce(sum(pr), 0) pr from {last} where v not in (select src from deg)) lost
            left join (
                select e.dst v, sum(pr / out_edges * e.n) got
                from {last} r join deg on deg.src = r.v join e on e.src = r.v group by 1) g on g.v = vs.v)"""
        )
    return ",\n".join(steps)


def kmeans(points: str, k: int, init: str, rounds: int) -> str:
    """CTE `history` of the rounds run, over the CTE `points (id, x)`."""
    ks = f"generate_series(1, {k})"
    start = {
        "max_minus": f"select distinct (hi - 100 * i)::double c from ends, {ks} t(i)",
        "even": f"select distinct (lo + i * ((hi - lo) // {k}))::double c from ends, {ks} t(i)",
    }[init]
    steps = [
        f"ends as materialized (select min(x) lo, max(x) hi from {points})",
        f"c0 as materialized ({start})",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""near{i} as materialized (
            select x, c from (select id, x, c, row_number() over (partition by id order by abs(x - c), c) place
                from {points} cross join c{i - 1}) where place = 1),
            s{i} as materialized (
            select {i} round, c old_centroid, sum(x)::double / count(*) centroid, count(*) n,
                floor(round(sum(abs(x - c)), 6))::bigint abs_error from near{i} group by c),
            c{i} as materialized (select distinct centroid c from s{i}),
            err{i} as materialized (select sum(abs_error)::bigint err from s{i})"""
        )
    parts = []
    for i in range(1, rounds + 1):
        went_on = [f"(select a.err - b.err > 0.01 from err{j - 1} a, err{j} b)" for j in range(2, i)]
        where = f" where {' and '.join(went_on)}" if went_on else ""
        parts.append(f"select * from s{i}{where}")
    steps.append(f"history as ({' union all '.join(parts)})")
    return ",\n".join(steps)


def distances(edges: str, source: int, bound: int) -> str:
    """CTE `reached (v, dist)`; `bound` must exceed the longest distance."""
    return f"""walk(v, d) as (
        select {source}::bigint, 0
        union select e.dst, d + 1 from walk join (select distinct src, dst from {edges}) e on e.src = walk.v where d < {bound}),
    reached as (select v, min(d)::int dist from walk group by v)"""
