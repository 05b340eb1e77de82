import random

import pytest
from pyspark.sql import functions as F

from spindle.operators import cluster, counting


def test_follower_count_and_max(spark):
    e = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("a", "y"), ("d", "x")], "src string, dst string")
    got = {r["dst"]: r["cnt"] for r in counting.follower_count(e).collect()}
    assert got == {"x": 3, "y": 2}
    assert counting.max_count(counting.follower_count(e)).first()[0] == 3


def test_init_centres_integer_division():
    # seeds for max 564512, k = 4 (fixture F5)
    assert cluster.init_centres(564512, 4) == [141128.0, 282256.0, 423384.0, 564512.0]
    assert cluster.init_centres(49, 6) == [8.0, 16.0, 24.0, 32.0, 40.0, 48.0]


def test_assign_tie_goes_to_lowest_index(spark):
    p = spark.createDataFrame([(5.0,), (15.0,)], "x double")
    got = sorted((r["x"], r["cid"]) for r in cluster.assign(p, [0.0, 10.0, 20.0]).collect())
    assert got == [(5.0, 0), (15.0, 1)]


def test_many_centres_in_any_order(spark):
    rnd = random.Random(8)
    centres = [rnd.choice([rnd.uniform(-50, 50), float(rnd.randint(-20, 20))]) for _ in range(700)]
    xs = [rnd.uniform(-60, 60) for _ in range(200)] + [float(v) + d for v in range(-21, 22) for d in (0, 0.5)]
    got = {r["x"]: r["cid"] for r in cluster.assign(spark.createDataFrame([(x,) for x in xs], "x double"), centres).collect()}
    assert got == {x: min(range(len(centres)), key=lambda i: (abs(x - centres[i]), i)) for x in xs}
    assert cluster.assign(spark.createDataFrame([(None,)], "x double"), [1.0]).first()["cid"] is None


def test_loop_without_end_is_an_error(spark):
    from spindle.plans.loops import iterate
    with pytest.raises(RuntimeError):
        iterate(spark.range(1), lambda s, i: s, until=lambda a, b, i: False, max_iter=2)


def test_empty_cluster_disappears(spark):
    p = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    out = cluster.kmeans_step(p, [0.0, 100.0, 1000.0]).collect()
    assert len(out) == 1 and out[0]["center"] == 2.0 and out[0]["n"] == 3 and out[0]["sse"] == 2.0


def _lloyd(points, centres, iters):
    prev = list(centres)
    for it in range(iters):
        groups = {}
        for x in points:
            best = min(range(len(prev)), key=lambda i: (abs(x - prev[i]), i))
            groups.setdefault(best, []).append(x)
        new = [sum(groups[i]) / len(groups[i]) for i in sorted(groups)]
        if it == iters - 1:
            return [(c, len(groups[i]), sum((x - c) ** 2 for x in groups[i]))
                    for c, i in zip(new, sorted(groups))]
        prev = new


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kmeans_matches_plain_lloyd(spark, seed):
    rnd = random.Random(seed)
    pts = [float(rnd.choice([rnd.randint(0, 50), rnd.randint(200, 260), rnd.randint(1000, 1010)])) for _ in range(400)]
    seeds = cluster.init_centres(max(pts), 5)
    df = spark.createDataFrame([(x,) for x in pts], "x double")
    got = sorted((r["center"], r["n"], r["sse"]) for r in cluster.kmeans_1d(df, seeds, iterations=10).collect())
    want = sorted(_lloyd(pts, seeds, 10))
    assert [g[1] for g in got] == [w[1] for w in want]
    assert sum(g[1] for g in got) == len(pts)   # n conserved
    for g, w in zip(got, want):
        assert g[0] == pytest.approx(w[0], rel=1e-12) and g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-9)


def test_kmeans_plan_is_narrow_assignment(spark):
    df = spark.range(100).select((F.col("id") % 7).cast("double").alias("x"))
    plan = cluster.assign(df, [1.0, 4.0])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_iterate_fixed_and_until(spark):
    from spindle.plans.loops import iterate
    df = spark.createDataFrame([(1,)], "v long")
    out = iterate(df, lambda s, i: s.select((F.col("v") * 2).alias("v")), n=5)
    assert out.first()[0] == 32
    out = iterate(df, lambda s, i: s.select((F.col("v") + 1).alias("v")),
                  until=lambda prev, new, i: new.first()[0] >= 4)
    assert out.first()[0] == 4


def test_follower_count_hot_key_partial_aggregate(spark):
    # one followee holds a third of all edges
    e = spark.range(3000).select(F.col("id").alias("src"),
                                 F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("dst"))
    got = {r["dst"]: r["cnt"] for r in counting.follower_count(e).collect()}
    assert got[-1] == 1000 and sum(got.values()) == 3000
    plan = counting.follower_count(e)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
