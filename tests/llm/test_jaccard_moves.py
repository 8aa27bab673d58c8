import random

from emberline.llm import jaccard_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefixes_and_sketches_move_once(spark, documents, monkeypatch):
    """The joins by id read the sketches where they lie, and the candidates need no second look at a shingle's rows."""
    seen, candidates = [], jaccard_join.candidates

    def watched(open_, sketches, percent):
        beside = open_.select("id").join(sketches.select("id", "sketch"), "id")
        seen.append((plan(beside), plan(candidates(open_, sketches, percent))))
        return candidates(open_, sketches, percent)

    monkeypatch.setattr(jaccard_join, "candidates", watched)
    draw = random.Random(7)
    base = [f"w{draw.randint(0, 90)}" for _ in range(60)]
    rows = [(i, " ".join(base[i % 7 :] + [f"x{i % 5}"])) for i in range(40)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join.jaccard_components(documents(rows), 3, 90).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == len(rows)
    (beside, whole), = seen
    assert beside.count("Exchange") == 1 and "Bucketed: true" in beside
    assert "hashpartitioning(token" not in whole
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("emberline_")]
