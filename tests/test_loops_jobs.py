"""Restartable loops, nearest join, relaxation over pieces, resampling, distinct distances."""
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.operators import cluster, distinct_neighbors as dn, graph, resample
from spindle.plans.chained import StepFolder, chain


def test_chain_resumes_from_the_last_whole_step(spark, tmp):
    def step(state, i):
        if i == boom:
            raise RuntimeError("the driver is lost")
        made.append(i)
        return state.select((F.col("x") + i).alias("x"))

    def run(**how):
        return chain(spark, f"{tmp}/loop", lambda: spark.range(3).select(F.col("id").alias("x")), step, lambda f, p: f.write.mode("overwrite").parquet(p), spark.read.parquet,
                     metrics=lambda f: {"total": F.sum("x")}, **how)

    made, boom = [], 4
    with pytest.raises(RuntimeError, match="lost"):
        run(n=6)
    assert made == [1, 2, 3]
    # a half-written step has files but no marker
    os.makedirs(f"{tmp}/loop/step-000004")
    with open(f"{tmp}/loop/step-000004/part-junk.parquet", "w") as f:
        f.write("junk")
    made, boom = [], None
    assert sorted(r.x for r in run(n=6).collect()) == [21, 22, 23] and made == [4, 5, 6]
    assert StepFolder(spark, f"{tmp}/loop").observed(6) == {"total": 66} and StepFolder(spark, f"{tmp}/loop").last() == 6
    made = []
    assert sorted(r.x for r in run(n=6).collect()) == [21, 22, 23] and made == []
    assert sorted(r.x for r in run(until=lambda seen: seen["total"] > 100).collect()) == [36, 37, 38] and made == [7, 8]
    assert sorted(x for x in os.listdir(f"{tmp}/loop") if x.startswith("step") and not x.endswith("json")) == ["step-000007", "step-000008"]


def test_bfs_files_stop_and_resume(spark, tmp):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2), (4, 5), (7, 8), (8, 7)], "src long, dst long")
    lines = graph.node_lines(edges, 1)
    seen = []

    def stop(i, observed):
        seen.append((i, observed.get("changed")))
        if i == 2 and len(seen) == 3:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        graph.bfs_files(spark, lines, f"{tmp}/bfs", on_step=stop)
    got = {r.node: (r.dist, r.adj) for r in graph.bfs_files(spark, lines, f"{tmp}/bfs", on_step=stop).collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": 0, "2": 1, "3": 2, "4": 3, "5": 4, "7": None, "8": None}
    assert got["4"][1] == "2:5:" and got["5"][1] is None
    assert [i for i, _ in seen] == [0, 1, 2, 3, 4, 5] and [c for _, c in seen][1:] == [1, 1, 1, 1, 0]


def test_kmeans_files_equal_the_loop_in_memory(spark, tmp):
    rng = random.Random(4)
    pts = spark.createDataFrame([(float(rng.choice([rng.gauss(10, 3), rng.gauss(60, 9), rng.gauss(200, 5)])),) for _ in range(400)], "x double")
    seeds = spark.createDataFrame([(i, float(c)) for i, c in enumerate([0, 50, 120, 1000])], "cid long, center double")
    got = sorted(r.center for r in cluster.kmeans_files(pts, seeds, f"{tmp}/km", iterations=4).collect())
    want = sorted(r.center for r in cluster.kmeans_1d(pts, [0.0, 50.0, 120.0, 1000.0], iterations=4).collect())
    assert np.allclose(got, want) and len(got) == 3


def test_nearest_join(spark):
    rng = random.Random(6)
    points = [(i, rng.choice([None, float(rng.randint(-50, 400)) / 2])) for i in range(400)] + [(1000, 7.0)] * 5
    centres = [(i, float(rng.randint(-20, 150))) for i in range(90)] + [(500, None)]
    got = cluster.nearest_join(spark.createDataFrame(points, "id int, x double"), spark.createDataFrame(centres, "cid long, center double"))
    real = [(c, i) for i, c in centres if c is not None]
    def best(x):
        return None if x is None else min((abs(x - c), i, c) for c, i in real)[1:]
    assert sorted(((r.id, r.x, r.cid, r.center) for r in got.collect()), key=str) == sorted(((i, x, *(best(x) or (None, None))) for i, x in points), key=str)
    none = cluster.nearest_join(spark.createDataFrame(points, "id int, x double"), spark.createDataFrame([], "cid long, center double"))
    assert none.count() == len(points) and none.where("cid IS NOT NULL").count() == 0


def test_relaxation_over_pieces_of_a_hub(spark):
    edges = [(0, i) for i in range(1, 3001)] + [(i, i + 3000) for i in range(1, 3001)] + [(i, 0) for i in range(1, 500)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    lines = graph.node_pieces(frame, 0, max_per_row=50)
    first = graph.bfs_relax_pieces(lines)
    hub = first.where("node = '0'").orderBy("piece").collect()
    assert [r.piece for r in hub] == list(range(60)) and all(r.dist == 0 for r in hub) and all(r.adj.count(":") == 50 for r in hub)
    assert ":".join(r.adj.rstrip(":") for r in hub).split(":") == [str(i) for i in range(1, 3001)]
    assert first.where("dist = 1").count() == 3000 and first.count() == 6001 + 59
    again = first.select(F.concat_ws(" ", "node", F.col("piece").cast("string"), F.coalesce("dist", F.lit(graph.MR_INFINITY)).cast("string"), F.coalesce("adj", F.lit(""))).alias("value"))
    assert graph.bfs_relax_pieces(again).where("dist = 2").count() == 3000
    plain = {(r.node, r.dist) for r in graph.bfs_relax_step(graph.node_lines(frame, 0)).collect()}
    assert {(r.node, r.dist) for r in first.collect()} == plain
    lone = graph.bfs_relax_pieces(spark.createDataFrame([("a 0 3 b:c:",), ("a x 1 b:",), ("b 0 10009 ",)], "value string")).collect()
    assert sorted((r.node, r.piece, r.dist, r.adj) for r in lone if r.adj is not None) == [("a", 0, 3, "b:c:"), ("b", 0, 4, "")] and [r.dist for r in lone if r.adj is None] == [4]


def test_scheme_sample_shares(spark):
    """Early rows of a split are drawn in proportion to the rows after them; n rows a split come out; repeatable."""
    rows = spark.createDataFrame([(f"{i:05d}", "big" if i < 4000 else "s" if i < 4007 else "one") for i in range(4008)], "k string, part string")
    out = [resample.scheme_sample(rows, "k", "part", seed=3).orderBy("k", "copy").collect() for _ in range(2)]
    assert out[0] == out[1]
    sizes = {}
    for r in out[0]:
        sizes[r.part] = sizes.get(r.part, 0) + 1
    assert sizes["big"] == 4000 and sizes.get("s", 0) <= 7 and sizes.get("one", 0) <= 1
    thirds = [sum(1 for r in out[0] if r.part == "big" and int(r.k) // 1000 == q) / 4000 for q in range(4)]
    assert np.allclose(thirds, [7 / 16, 5 / 16, 3 / 16, 1 / 16], atol=0.03)
    m = resample.multiplicities(rows, "k", "part", seed=3).where("part = 'big'").toPandas()
    draws = 4000 - m.k.astype(int)
    assert (m._m % 2 == 0).all() and abs(m._m.sum() / (0.6 * draws.sum()) - 1) < 0.01
    assert resample.scheme_sample(rows.limit(0), "k", "part").count() == 0


def knn_by_hand(queries, training, k):
    out = []
    for qk, qu, *qa in queries:
        best = {}
        for tk, tu, *ta in sorted(training, key=lambda t: t[0]):
            if qu is not None and tu is not None:
                best[(qu - tu) ** 2 + sum(a != b for a, b in zip(qa, ta))] = tk
        out += [(qk, n + 1, best[d], d) for n, d in enumerate(sorted(best)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("direct", [1, 1000])
def test_knn_distinct_by_hand(spark, direct):
    """Hot users by their sieves, others directly: the same rows."""
    rng = random.Random(9)
    def rows(n, tag):
        return [(f"{tag}{i:04d}", rng.choice([None, 1.0, 1.0, 1.0, 2.0, 4.5, 30.0]), *(rng.choice(["a", "b", "c", None]) for _ in range(4))) for i in range(n)]
    q, t = rows(60, "q"), rows(250, "t")
    schema = "row_key string, user_id double, location string, title string, author string, publisher string"
    got = dn.knn_distinct(spark.createDataFrame(q, schema), spark.createDataFrame(t, schema), k=4, direct_max=direct)
    assert sorted((tuple(r) for r in got.collect()), key=str) == knn_by_hand(q, t, 4)
    assert dn.knn_distinct(spark.createDataFrame(q, schema), spark.createDataFrame([], schema), k=4).count() == 0


def test_sieves_are_bounded(spark):
    rng = random.Random(10)
    t = spark.createDataFrame([(1.0, i, *(f"{rng.randrange(40)}" for _ in range(4))) for i in range(3000)], "tu double, _tk long, a string, b string, c string, d string").dropDuplicates(["a", "b", "c", "d"])
    per = dn.sieves(t, "tu", ["a", "b", "c", "d"]).groupBy("tu", "sid", "k0", "k1", "k2", "k3").count().groupBy("sid").agg(F.max("count").alias("n")).collect()
    assert max(r.n for r in per) <= 65


def test_nearest_join_windows_grow_row_by_row(spark):
    """A frame that starts at the current row is gone through anew for every row."""
    points = spark.createDataFrame([(i, float(i * 7 % 1009)) for i in range(300)], "id int, x double")
    centres = spark.createDataFrame([(i, i * 3.5) for i in range(100)], "cid long, center double")
    got = cluster.nearest_join(points, centres)
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedfollowing" not in plan.replace("specifiedwindowframe(rowframe, 1, unboundedfollowing", "")       # the frame over one row a part may
    want = {(i, min((abs(float(i * 7 % 1009) - c * 3.5), c) for c in range(100))[1]) for i in range(300)}
    assert {(r["id"], r["cid"]) for r in got.collect()} == want


def test_knn_distinct_in_the_sorted_pass(spark, monkeypatch):
    monkeypatch.setattr(dn.near_users, "partitions_for", lambda *_: 2)
    joined = []
    plain_pairs = dn._user_pairs
    monkeypatch.setattr(dn, "_user_pairs", lambda pending, *rest: (joined.append(pending.count()), plain_pairs(pending, *rest))[1])
    rng = random.Random(12)
    schema = "row_key string, user_id double, location string, title string, author string, publisher string"
    rows = lambda pre, n: [(f"{pre}{i:05d}", rng.randint(0, 300) * 1.5, rng.choice("ABC"), rng.choice(["T0", "T1", None]), rng.choice("XY"), rng.choice("PQ")) for i in range(n)]
    qs, ts = rows("q", 1000), rows("t", 1200)
    got = dn.knn_distinct(spark.createDataFrame(qs, schema), spark.createDataFrame(ts, schema), k=5, q_carry=["title"]).collect()
    want = []
    for q in qs:
        last = {}
        for t in sorted(ts):
            last[(q[1] - t[1]) ** 2 + sum(x != y for x, y in zip(q[2:], t[2:]))] = t[0]
        want += [(q[0], i + 1, last[d], d, q[3]) for i, d in enumerate(sorted(last)[:5])]
    key = lambda x: tuple(map(str, x))
    assert sorted(((r["row_key"], r["rank"], r["t_row_key"], r["distance"], r["q_title"]) for r in got), key=key) == sorted(want, key=key)
    assert sum(joined[:1]) < len(qs) * 0.2
