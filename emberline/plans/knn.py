"""Exact k-nearest-neighbour classification of transactions, without pairing test and train rows.

The distance is `[type differs] + |amount difference| + [user differs]`; the neighbours of a test row are
its k smallest distinct distances, each with the least class found at that distance.

Train rows fall into four kinds for a given test row: same type and user, same type only, same user
only, neither. Within a kind the distance grows with the amount difference alone, so only the train
amounts next to the test amount can matter. Per side (below or equal, above) the nearest distinct amounts of a
group are enough:

    group                  nearest amounts   distances of one amount
    same type and user     k                 gap
    same type              2k - 1            gap, gap + 1
    same user              2k - 1            gap, gap + 1
    all                    3k - 2            gap, gap + 1, gap + 2

One distance can come from at most that many amounts of a side, so these lists hold k distinct
distances that all lie below anything farther out of the same kind. Per group and amount, a few train rows answer every test row:
the least classes that differ in the excluded type or user.

All four kinds go through one range partitioning of train and test rows by (group, amount), stored and numbered by
range. Inside a range the train rows of a group are packed, sorted by amount, into blocks of as many amounts as the table says; a test
row takes two blocks on each side, which hold all it needs, whatever k is. A range also gets one block from the ranges below
it and one from those above, if its first or last group goes on there.

Distances are plain doubles, so that different amounts may come out at one distance where numbers are too coarse to tell
them apart. A test row whose list is full but holds too few different distances for the table above is asked again with
blocks twice as long.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.operators.ranges import ROWS_PER_RANGE, in_ranges
from emberline.operators.topk import k_smallest_in_array, majority
from emberline.session import cut_lineage

TYPES_PER_LIST = 500
FEATURES = ("type", "user", "amount")
PLACE = ("level", "type_key", "user_key")
"""A group of a kind: the level of the kind, and the type and user it shares, empty where it shares none."""


@dataclass(frozen=True)
class Kind:
    """Train rows that share the `same` columns with the test row and differ in the other ones."""

    same: tuple[str, ...]
    distances_per_amount: int

    @property
    def differs(self) -> tuple[str, ...]:
        return tuple(c for c in ("type", "user") if c not in self.same)

    @property
    def level(self) -> int:
        return 2 * ("type" in self.differs) + ("user" in self.differs)

    def reach(self, k: int) -> int:
        return self.distances_per_amount * (k - 1) + 1


KINDS = (Kind(("type", "user"), 1), Kind(("type",), 2), Kind(("user",), 2), Kind((), 3))


def _prepared(df: DataFrame, other: str) -> DataFrame:
    """Type and user compare as text, with a missing one as empty text. Rows without an amount have no distance."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("type", "user")]
    amount = F.col("amount").cast("double").alias("amount")
    return df.select(*text, amount, other).where(F.col("amount").isNotNull() & ~F.isnan("amount"))


def _two_least(rows: DataFrame, same: str, other: str) -> DataFrame:
    """Per `same` and amount, the least class and the least class of another `other`, as rows."""
    order = Window.partitionBy(same, "amount").orderBy("cls", other)
    return rows.withColumn("place", F.row_number().over(order)).where("place <= 2").drop("place")


def _answers(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    listed = F.sort_array(F.collect_list(F.struct("cls", "type", "user")))
    return rows.groupBy(*keys, "amount").agg(listed.alias("answers"))


def _five_least(answers: Column) -> Column:
    """The entries needed to find the least class with another type and another user, for any type and user."""
    first = F.get(answers, F.lit(0))
    other_type = F.filter(answers, lambda e: e["type"] != first["type"])
    other_user = F.filter(answers, lambda e: e["user"] != first["user"])
    one, two = F.get(other_type, F.lit(0)), F.get(other_user, F.lit(0))
    kept = F.array(
        first,
        one,
        F.get(F.filter(other_type, lambda e: e["user"] != one["user"]), F.lit(0)),
        two,
        F.get(F.filter(other_user, lambda e: e["type"] != two["type"]), F.lit(0)),
    )
    return F.filter(kept, lambda e: e.isNotNull())


def _least_of_all(of_type: DataFrame, types: int) -> DataFrame:
    """Per amount, the five entries. With very many types they are found among slots of types first."""
    slots = -(-types // TYPES_PER_LIST)
    if slots > 1:
        slot = F.pmod(F.xxhash64("type"), F.lit(slots))
        lists = _answers(of_type.withColumn("slot", slot), ["slot"])
        of_type = lists.select("amount", F.inline(_five_least(F.col("answers"))))
    return _answers(of_type, []).withColumn("answers", _five_least(F.col("answers")))


def distinct_rows(train: DataFrame) -> DataFrame:
    """One row `(type, user, amount, cls)` per distinct features, with the least class."""
    known = _prepared(train, "cls").where("cls is not null")
    return known.groupBy(*FEATURES).agg(F.min("cls").alias("cls"))


def train_tables(rows: DataFrame, types: int) -> dict[Kind, DataFrame]:
    """Per kind, one row for each group and amount: `(same columns, amount, answers)`.

    `types` is about the number of distinct types in the distinct `rows`.
    """
    both, by_type, by_user, every = KINDS
    of_type = _two_least(rows, "type", "user")
    return {
        both: rows.select(*FEATURES, F.array(F.struct("cls", "type", "user")).alias("answers")),
        by_type: _answers(of_type, ["type"]),
        by_user: _answers(_two_least(rows, "user", "type"), ["user"]),
        every: _least_of_all(of_type, types),
    }


def _group(kind: Kind) -> list[Column]:
    keys = [(F.col(c) if c in kind.same else F.lit("")).alias(f"{c}_key") for c in ("type", "user")]
    return [F.lit(kind.level).alias("level"), *keys]


def _by_level(values: Sequence[int]) -> str:
    """SQL for the value of the row's level."""
    return f"element_at(array({', '.join(map(str, values))}), level + 1)"


def reaches(k: int, longer: int = 1) -> list[int]:
    """How many amounts a side of each level needs, times `longer`."""
    return [longer * kind.reach(k) for kind in sorted(KINDS, key=lambda kind: kind.level)]


def in_amount_ranges(tables: dict[Kind, DataFrame], test: DataFrame, rows_per_range: int, rows: int | None = None) -> DataFrame:
    """Train rows (`side` 0, with `answers`) and test rows (`side` 1) of all kinds, in stored ranges of (group, amount).

    `rows` is a bound of how many there are, if known.
    """
    every = None
    for kind in KINDS:
        train = tables[kind].select(*_group(kind), "amount", F.lit(0).alias("side"), "answers")
        asked = test.select(*_group(kind), *FEATURES, F.lit(1).alias("side"), "id")
        both = train.unionByName(asked, allowMissingColumns=True)
        every = both if every is None else every.unionByName(both)
    return in_ranges(every, [*PLACE, "amount", "side", "id"], rows_per_range, rows)


def packed(parts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Blocks `(_part, level, type_key, user_key, amount, entries)` of as many amounts as their level's length, from their
    least one; the last one of a group in a range can be shorter."""
    inside = Window.partitionBy("_part", *PLACE).orderBy("amount")
    placed = parts.where("side = 0").withColumn("place", F.row_number().over(inside) - 1)
    block = F.expr(f"place div {_by_level(lengths)}").alias("block")
    lists = placed.groupBy("_part", *PLACE, block).agg(F.sort_array(F.collect_list(F.struct("amount", "answers"))).alias("entries"))
    return lists.select("_part", *PLACE, F.expr("entries[0].amount").alias("amount"), "entries")


def _carried(parts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """One block per range of the nearest rows below it in its first group, and one of the nearest above in its last group.

    Every table here has a few rows per range; a range whose part of the group is short is looked past.
    """
    key, most = F.struct(*PLACE), max(lengths)
    ends = parts.groupBy("_part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    rows = parts.where("side = 0").select("_part", key.alias("key"), F.struct("amount", "answers").alias("entry"))

    def outermost(order: list[Column]) -> DataFrame:
        """Per range, the outermost entries of the outermost group, sorted."""
        near = rows.withColumn("n", F.row_number().over(Window.partitionBy("_part").orderBy(*order))).where(F.col("n") <= most)
        return near.groupBy("_part", "key").agg(F.sort_array(F.collect_list("entry")).alias("entries"))

    def next_to(of: DataFrame, asked: str, turn: int, frame: tuple[int, int], cut: str) -> DataFrame:
        """`turn` -1 or 1 puts the asking row of a range before or behind its own entries, out of its frame."""
        asks = ends.select("_part", F.col(asked).alias("key"), F.lit(turn).alias("turn"))
        both = of.withColumn("turn", F.lit(0)).unionByName(asks, allowMissingColumns=True)
        over = Window.partitionBy("key").orderBy("_part", "turn").rowsBetween(*frame)
        near = both.withColumn("near", F.flatten(F.collect_list("entries").over(over))).where((F.col("turn") == turn) & (F.size("near") > 0))
        return near.select("_part", "key.*", "near").select("_part", *PLACE, F.expr(cut).alias("entries"))

    length = _by_level(lengths)
    reach = 2 * most  # rows of the window: entries of at least one amount each, and the asking rows between them
    before = next_to(outermost([F.desc("key"), F.desc("entry.amount")]), "first", -1, (-reach, -1), f"slice(near, greatest(size(near) - {length} + 1, 1), {length})")
    behind = next_to(outermost([F.asc("key"), F.asc("entry.amount")]), "last", 1, (1, reach), f"slice(near, 1, {length})")
    return before.unionByName(behind).withColumn("amount", F.expr("entries[0].amount"))


def _too_few(gaps: str, lengths: Sequence[int], needed: Sequence[int]) -> str:
    """Whether a side's list is full and, at one of the offsets, holds fewer different distances than needed."""
    kinds = ", ".join(f"size(array_distinct(transform({gaps}, g -> g + {c}.0D)))" for c in (0, 1, 2))
    return f"(size({gaps}) = {_by_level(lengths)} and least({kinds}) < {_by_level(needed)})"


def _candidates(parts: DataFrame, k: int, lengths: Sequence[int]) -> DataFrame:
    """Per test row and kind, the distances and classes of the nearest train rows, and whether its lists were too
    short: `(id, near, short)`.
    """
    blocks = packed(parts, lengths).unionByName(_carried(parts, lengths)).withColumn("side", F.lit(0))
    rows = parts.where("side = 1").drop("answers").unionByName(blocks, allowMissingColumns=True)
    over = f"over (partition by _part, {', '.join(PLACE)} order by amount, side)"
    functions = ("lag(entries, 2)", "lag(entries, 1)", "lead(entries, 1)", "lead(entries, 2)")
    near = [f"coalesce({f} ignore nulls {over}, array())" for f in functions]
    found = rows.withColumn("found", F.expr(f"concat({', '.join(near)})")).where("side = 1")
    length = _by_level(lengths)
    found = found.withColumn("below", F.expr("filter(found, e -> e.amount <= amount)"))
    found = found.withColumn("above", F.expr(f"slice(found, size(below) + 1, {length})"))
    found = found.withColumn("below", F.expr(f"slice(below, greatest(size(below) - {length} + 1, 1), {length})"))
    for side in ("below", "above"):
        found = found.withColumn(f"{side}_gaps", F.expr(f"transform({side}, e -> abs(amount - e.amount))"))

    fits = "(level < 2 or a.type <> type) and (level % 2 = 0 or a.user <> user)"
    least = f"array_min(transform(filter(e.answers, a -> {fits}), a -> a.cls))"
    distance = "if(level < 2, 0.0D, 1.0D) + abs(amount - e.amount) + if(level % 2 = 0, 0.0D, 1.0D)"
    measured = f"transform(concat(below, above), e -> struct({distance} as d, {least} as cls))"
    short = " or ".join(_too_few(f"{side}_gaps", lengths, reaches(k)) for side in ("below", "above"))
    return found.select("id", F.expr(f"filter({measured}, e -> e.cls is not null)").alias("near"), F.expr(short).alias("short"))


def scaled(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with amounts moved to 0 .. 1 by the least and the greatest train amount; all 0 if these are one."""
    amount = F.col("amount").cast("double")
    low, high = train.where(~F.isnan(amount)).agg(F.min(amount), F.max(amount)).first()
    part = F.lit(0.0) if low is None or low == high else (amount - low) / (high - low)
    return tuple(df.withColumn("amount", F.when(F.isnan(amount), amount).when(amount.isNotNull(), part)) for df in (train, test))


def knn_neighbours(
    train: DataFrame, test: DataFrame, k: int, prune: bool = True, rows_per_range: int = ROWS_PER_RANGE, scale_amount: bool = False
) -> DataFrame:
    """`(id, neighbours)`: per test row the up to k nearest `(d, cls)`, nearest first.

    `train` has `type, user, amount, cls`; `test` has a unique `id` and `type, user, amount`. With `prune`, each task keeps the k
    nearest of a kind before the rows of one id are brought together. With `scale_amount`, amounts count relative
    to the span of the train amounts (see `scaled`), so that type and user weigh as much as that span.
    """
    if scale_amount:
        train, test = scaled(train, test)
    rows = cut_lineage(distinct_rows(train))
    queries = cut_lineage(_prepared(test, "id"))
    n_rows, types = rows.agg(F.count(F.lit(1)), F.approx_count_distinct("type")).first()
    tables = train_tables(rows, types)
    most = len(KINDS) * (n_rows + queries.count())
    done, longer = None, 1
    while True:
        parts = in_amount_ranges(tables, queries, rows_per_range, most)
        found = _candidates(parts, k, reaches(k, longer))
        if prune:
            found = found.withColumn("near", k_smallest_in_array("near", k))
        lists = F.flatten(F.collect_list("near")).alias("near")  # four lists per id
        merged = cut_lineage(found.groupBy("id").agg(lists, F.max("short").alias("short")))
        nearest = merged.where("not short").select("id", k_smallest_in_array("near", k).alias("neighbours"))
        done = nearest if done is None else done.unionByName(nearest)
        short = merged.where("short").select("id")
        if short.isEmpty():
            return done.where(F.size("neighbours") > 0)
        queries, longer = cut_lineage(queries.join(short, "id", "left_semi")), 2 * longer


def classify(neighbours: DataFrame) -> DataFrame:
    """Majority class of the neighbours, the least class on a tie: `(id, pred)`."""
    return neighbours.select("id", majority("neighbours.cls").alias("pred"))


def knn_classify(train: DataFrame, test: DataFrame, k: int, **options) -> DataFrame:
    return classify(knn_neighbours(train, test, k, prune=False, **options))


def knn_classify_topk(train: DataFrame, test: DataFrame, k: int, **options) -> DataFrame:
    """The same answer; each task passes on at most k neighbours per test row and kind."""
    return classify(knn_neighbours(train, test, k, prune=True, **options))


def labelled(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """Each test record with its prediction, which is null for a record without an amount or without any neighbour."""
    return test.join(predictions, "id", "left")
