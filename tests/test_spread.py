"""The balanced joins and numberings against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from acreage.operators.spread import (
    first_per_key,
    fits_broadcast,
    heavy_keys,
    linked_rows,
    lookup_join,
    numbered,
    rows_after_first,
    salted_join,
)


def skewed(spark, rows=300):
    """A third of the rows share one key, a third have none; the first third are exact copies."""
    random.seed(7)
    data = [("hot", 1)] * (rows // 3) + [(None, i) for i in range(rows // 3)]
    data += [(f"k{random.randrange(40)}", i) for i in range(rows // 3)]
    return spark.createDataFrame(data, "k string, v int").repartition(5)


@pytest.mark.parametrize("settings", ["spark", "crowded"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join(request, settings, how, null_safe):
    spark = request.getfixturevalue(settings)
    left = skewed(spark)
    pairs = [("hot", 10), ("k1", 11), ("k2", None), (None, 99)]
    right = spark.createDataFrame(pairs, "k string, w int")
    got = sorted(map(tuple, lookup_join(left, right, ["k"], how, null_safe=null_safe).collect()), key=repr)
    known = {k: w for k, w in pairs if null_safe or k is not None}
    want = []
    for k, v in map(tuple, left.collect()):
        if how == "left" or (how == "inner" and k in known):
            want.append((k, v, known.get(k)))
        elif (how == "left_semi" and k in known) or (how == "left_anti" and k not in known):
            want.append((k, v))
    assert got == sorted(want, key=repr)


def test_heavy_rows_are_spread_over_the_shuffle(crowded):
    left = skewed(crowded)
    right = crowded.createDataFrame([("hot", 10)], "k string, w int")
    plan = lookup_join(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert any("hashpartitioning(k" in line and "_slot" in line for line in plan.splitlines())


def test_heavy_keys_are_counted_and_limited(crowded):
    counts = skewed(crowded).groupBy("k").count()
    heavy = {r["k"]: r["_shares"] for r in heavy_keys(counts, ["k"]).collect()}
    assert heavy["hot"] == 20 and None in heavy


def test_salted_join(crowded):
    left = crowded.createDataFrame([("hot", i) for i in range(50)] + [("b", 1), (None, 3)], "k string, a int")
    right = crowded.createDataFrame([("hot", "x"), ("hot", "y"), ("b", "z"), ("c", "w")], "k string, e string")
    got = sorted(map(tuple, salted_join(left, right, ["k"], ["a"]).collect()))
    assert got == sorted([("hot", i, e) for i in range(50) for e in "xy"] + [("b", 1, "z")])


def test_picks_count_exact_copies_once(spark):
    rows = [("a", 3)] * 7 + [("a", 1), ("b", 2), (None, 5), (None, 5)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    order = [F.col("v").desc()]
    first = sorted(map(tuple, first_per_key(df, ["k"], order).collect()), key=repr)
    assert first == sorted([("a", 3), ("b", 2), (None, 5)], key=repr)
    rest = sorted(map(tuple, rows_after_first(df, ["k"], order).collect()), key=repr)
    assert rest == sorted([("a", 3)] * 6 + [("a", 1), (None, 5)], key=repr)


def test_first_pick_shrinks_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_linked_rows_across_blocks(spark):
    data = [(k, s, s * s) for k in "ab" for s in range(0, 20, 3)]
    df = spark.createDataFrame(data, "k string, seq int, v int").repartition(3)
    got = linked_rows(
        df, ["k"], F.floor(F.col("seq") / 4), ["seq"], ["v"], wrap=True, running_max=F.when(F.col("v") < 50, F.col("v"))
    ).collect()
    steps = list(range(0, 20, 3))
    assert len(got) == len(data)
    for row in got:
        at = steps.index(row["seq"])
        assert row["rank"] == at + 1
        assert row["next"]["v"] == steps[(at + 1) % len(steps)] ** 2
        assert row["first"]["v"] == 0
        assert row["highest"] == max(s * s for s in steps[: at + 1] if s * s < 50)


def test_numbered(spark):
    random.seed(3)
    data = [(random.choice(["x", "y", None]), i) for i in random.sample(range(500), 200)]
    df = spark.createDataFrame(data, "g string, v int").repartition(6)
    ordered = sorted(v for _, v in data)
    assert {(r["v"], r["row_no"]) for r in numbered(df, ["v"]).collect()} == {(v, i + 1) for i, v in enumerate(ordered)}
    within = {(r["g"], r["v"]): r["row_no"] for r in numbered(df, ["v"], within=["g"]).collect()}
    for g in ("x", "y", None):
        mine = sorted(v for k, v in data if k == g)
        assert [within[g, v] for v in mine] == list(range(1, len(mine) + 1))


def test_fits_broadcast(crowded):
    assert not fits_broadcast(crowded.range(1))
    assert fits_broadcast(crowded.range(0))


def test_fits_broadcast_counts_bytes(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(wide)
    spark.conf.set("spark.acreage.broadcastBytes", "5000")
    try:
        assert not fits_broadcast(wide)
    finally:
        spark.conf.unset("spark.acreage.broadcastBytes")
