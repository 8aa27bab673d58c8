"""Mixing sources to target weights by weighted fair queueing.

Every source serves its documents in a shuffled order, starting again when it runs out, up to
`max_repeats` passes. A copy of a document gets the virtual finish time (words its source has served,
this copy included) / (the source's target). The copies of all sources, range-sorted by finish time, are
the mix, cut where its words reach the total budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import WORD, ranked, released, stored, text_of

ROWS_PER_BUCKET = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """`(source, source_size, docs, target)` of a table with `source` and `size`.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes. A target
    stops at `max_repeats` times its source's size; what is left over is shared again by weight until no
    target is above. The shares come from one aggregated row per pass: the level `left / open weight`.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    numbered = ranked(per_source, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(numbered.withColumn("weight", weight).withColumn("most", F.col("source_size") * max_repeats))
    level = None
    while True:
        capped = F.lit(False) if level is None else F.col("most") <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("budget"),
            F.sum(F.when(capped, F.col("most"))).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        after = ((row.budget or 0) - (row.given or 0)) / row.open if row.open else level or 0.0
        if after == level:
            break
        level = after
    target = F.least(F.col("most").cast("double"), F.lit(float(level)) * F.col("weight"))
    return sources.select("source", "source_size", "docs", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_repeats: int = 3,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The mix: one row per document with `doc_id, source, size, source_size, target, taken`.

    `taken` counts the words the mix takes from the document over all its copies; the copy that a source is
    serving when its target or the budget is reached is cut there. Null text has size 0, null is a source of
    its own, repeated ids and rows count separately, a source without words has target 0, and an empty table
    gives no rows. The order follows a digest of `doc_id`, so reruns agree. Other columns are not read.
    `released` takes the result once it is stored.
    """
    sizes = stored(docs.select("doc_id", "source", word_count(text_of()).alias("size")))
    targets = stored(source_targets(sizes, weights, max_repeats))
    key = [F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_n")]
    joined = sizes.select("*", *key).join(targets.select(*key, "source_size", "docs", "target"), ["_s", "_n"])

    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint")
    parts = F.ceil(F.col("docs") / rows_per_bucket).cast("bigint")
    cut = joined.withColumn("digest", order).withColumn("part", F.shiftright(place * parts, 32))
    cut = stored(cut)
    by = ["_s", "_n", "part"]
    inside = Window.partitionBy(*by).orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = Window.partitionBy("_s", "_n").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(*by).agg(F.sum("size").alias("words")).select(
        *by, F.coalesce(F.sum("words").over(below), F.lit(0)).alias("before")
    )
    served = cut.select(
        "*", F.row_number().over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("place"),
        F.sum("size").over(inside).alias("until"),
    ).join(offsets, by)
    start = F.col("before") + F.col("until") - F.col("size") + F.col("pass") * F.col("source_size")
    copies = (
        served.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
        .withColumn("start", start)
        .where((F.col("pass") == 0) | (F.col("start") < F.col("target")))
    )
    end = F.least((F.col("start") + F.col("size")).cast("double"), F.col("target"))
    copies = copies.withColumn("words", F.greatest(F.floor(end) - F.col("start"), F.lit(0)).cast("bigint"))
    finish = F.when(F.col("target") > 0, F.least((F.col("start") + F.col("size")) / F.col("target"), F.lit(1.0))).otherwise(1.0)
    copies = stored(copies.withColumn("finish", finish))

    total = copies.agg(F.count(F.lit(1)).alias("n")).first().n
    budget = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first().b
    released(sizes, targets, cut)
    ranges = max(1, -(-total // rows_per_bucket))
    # Finish times are spread evenly over 0 to 1 by construction; those at 1 (one per source, and what is not taken) spread by digest.
    last = F.col("finish") >= 1.0
    queued = copies.withColumn("range", F.when(last, ranges).otherwise(F.floor(F.col("finish") * ranges)).cast("bigint")).withColumn(
        "slot", F.when(last, F.shiftright(F.conv(F.substring("digest", 1, 8), 16, 10).cast("bigint") * ranges, 32)).otherwise(0).cast("bigint")
    )
    sums = queued.groupBy("range", "slot").agg(F.sum("words").alias("sum"))
    over = Window.partitionBy(F.lit(1)).orderBy("range", "slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", "slot", F.coalesce(F.sum("sum").over(over), F.lit(0)).alias("ahead"))
    line = Window.partitionBy("range", "slot").orderBy("finish", "digest", "doc_id", "_n", "_s", "pass", "place").rowsBetween(Window.unboundedPreceding, -1)
    running = queued.withColumn("inside", F.coalesce(F.sum("words").over(line), F.lit(0))).join(sums, ["range", "slot"])
    left = F.lit(budget) - F.col("ahead") - F.col("inside")
    given = running.withColumn("taken", F.greatest(F.least("words", left), F.lit(0)))
    mixed = given.groupBy(*by, "place", "doc_id", "source", "size", "source_size", "target").agg(
        F.sum("taken").cast("bigint").alias("taken")
    ).select("doc_id", "source", "size", "source_size", "target", "taken")
    mixed.stored_at = copies.stored_at
    return mixed
