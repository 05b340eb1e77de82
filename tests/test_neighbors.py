import hashlib
import random

import pytest
from pyspark.sql import functions as F

from spindle import session
from spindle.operators import near_users
from spindle.operators import neighbors as nb
from spindle.plans import loops, workloads
from spindle.sources.delimited import parse_book_rows

SCHEMA = "row_key string, user_id double, location string, title string, author string, year int, publisher string"


def _dist(q, t):
    return (q[1] - t[1]) ** 2 + sum(q[i] != t[i] for i in (2, 3, 4, 6))


def _brute(qs, ts, k):
    out = []
    for q in qs:
        ranked = sorted(((_dist(q, t), t[0]) for t in ts), key=lambda x: (x[0], x[1]))[:k]
        out += [(q[0], i + 1, t, d) for i, (d, t) in enumerate(ranked)]
    return sorted(out)


def test_distance_worked_example(spark):
    q = parse_book_rows(spark.createDataFrame([("7|A|x|x|T|P|1999|Z",)], "value string")).first().asDict()
    t = parse_book_rows(spark.createDataFrame([("5|A|x|x|T|Q|2001|Z",)], "value string"))
    assert nb.distance_to(t, q).first()["distance"] == 5.0


def test_parse_book_rows_bad_fields(spark):
    rows = parse_book_rows(spark.createDataFrame([("1|L|a|b|T|A|19x9|P",), ("short|row",)], "value string")).collect()
    assert rows[0]["year"] == 0 and rows[0]["_corrupt"] is None
    assert rows[1]["_corrupt"] == "short|row"


def _fixture(seed, nq, nt):
    rnd = random.Random(seed)
    locs, titles, authors, pubs = list("ABC"), [f"T{i}" for i in range(6)], list("XYZ"), list("PQ")

    def row(i, pre):
        u = 7.0 if rnd.random() < 0.34 else float(rnd.choice([0, 1, 2, 3, 40, 41, 90]) + rnd.choice([0, 0.5]))
        return (f"{pre}{i:04d}", u, rnd.choice(locs), rnd.choice(titles), rnd.choice(authors), 2000, rnd.choice(pubs))
    return [row(i, "q") for i in range(nq)], [row(i, "t") for i in range(nt)]


@pytest.mark.parametrize("seed,k,band,direct", [(1, 3, 2.0, 64), (2, 5, 0.5, 4), (3, 2, 100.0, 0), (4, 3, 2.0, 10)])
def test_knn_topk_matches_brute_force(spark, seed, k, band, direct):
    qs, ts = _fixture(seed, 60, 150)
    ts += ts[:20]                                                    # identical-attribute duplicates
    ts = [(f"t{i:04d}",) + tuple(r[1:]) for i, r in enumerate(ts)]
    qs.append(("q_far", 500.0, "A", "T0", "X", 2000, "P"))          # needs many widenings
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), k=k, band=band,
                      direct_max=direct)
    got = sorted((r["row_key"], r["rank"], r["t_row_key"], r["distance"]) for r in got.collect())
    assert got == _brute(qs, ts, k)


def test_knn_fewer_training_rows_than_k(spark):
    qs, ts = _fixture(4, 5, 2)
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), k=3)
    assert got.count() == 10


def test_knn_by_title(spark):
    qs, ts = _fixture(5, 40, 80)
    q = spark.createDataFrame(qs, SCHEMA)
    got = nb.knn_by_title(nb.knn_topk(q, spark.createDataFrame(ts, SCHEMA), k=3), q, k=3)
    got = sorted((r["title"], r["rank"], r["t_row_key"], r["distance"]) for r in got.collect())
    per = {}
    title_of = {x[0]: x[3] for x in qs}
    for qk, _, tk, d in _brute(qs, ts, 3):
        key = (title_of[qk], tk)
        per[key] = min(per.get(key, d), d)
    want = []
    for title in sorted({t for t, _ in per}):
        best = sorted(((d, tk) for (t, tk), d in per.items() if t == title))[:3]
        want += [(title, i + 1, tk, d) for i, (d, tk) in enumerate(best)]
    assert got == sorted(want)


def test_dense_index(spark):
    keys = [f"k{random.Random(1).randint(0, 10**6) + i * 7919:09d}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r["key"]: r["idx"] for r in nb.dense_index(df, "key").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_bootstrap_matches_md5_rule(spark):
    keys = [f"r{i:03d}" for i in range(97)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    for m in (0, 2):
        got = sorted(r["key"] for r in nb.bootstrap_sample(df, "key", model=m).collect())
        idx = [int(hashlib.md5(f"{m}:{s}".encode()).hexdigest()[:15], 16) % 97 for s in range(97)]
        assert got == sorted(keys[i] for i in idx)


def test_minmax(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    assert sorted(r["x_norm"] for r in nb.minmax_normalize(df, "x").collect()) == [0.0, 0.5, 1.0]


def test_knn_candidate_window_is_group_limited(spark):
    qs, ts = _fixture(6, 5, 30)
    t = spark.createDataFrame(ts, SCHEMA)
    from pyspark.sql import Window
    tx = nb._explode_subsets(t, nb.NOMINAL)
    w = Window.partitionBy("user_id", "sid", "k0", "k1", "k2", "k3").orderBy("row_key")
    plan = tx.withColumn("rn", F.row_number().over(w)).where("rn <= 3")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_knn_empty_training(spark):
    qs, _ = _fixture(7, 3, 0)
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame([], SCHEMA), k=3)
    assert got.count() == 0 and got.columns == ["row_key", "rank", "t_row_key", "distance"]


@pytest.mark.parametrize("direct", [64, 0])
def test_knn_collapsed_copies_match_brute_force(spark, direct):
    qs, ts = _fixture(8, 40, 60)
    rnd = random.Random(8)
    # copies: same row key and attributes, distinct (model, copy); one key copied many times
    rows = []
    for r in ts:
        for m in range(3):
            for c in range(1, (rnd.randint(0, 2) if r[0] != "t0005" else 7) + 1):
                rows.append(r + (m, c))
    sch = SCHEMA + ", model int, copy int"
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(rows, sch), k=4,
                      tie=["row_key", "model", "copy"], collapse_copies=True, direct_max=direct)
    got = sorted((r["row_key"], r["rank"], r["t_row_key"], r["t_model"], r["t_copy"], r["distance"])
                 for r in got.collect())
    want = []
    for q in qs:
        ranked = sorted(((_dist(q, t), t[0], t[7], t[8]) for t in rows))[:4]
        want += [(q[0], i + 1, tk, m, c, d) for i, (d, tk, m, c) in enumerate(ranked)]
    assert got == sorted(want)


def test_shuffled_is_a_reproducible_permutation(spark):
    df = spark.range(200).select(F.col("id").alias("v")).repartition(7)
    a = [r["v"] for r in nb.shuffled(df, ["v"], seed=3).orderBy("pos").collect()]
    b = [r["v"] for r in nb.shuffled(df.repartition(3), ["v"], seed=3).orderBy("pos").collect()]
    c = [r["v"] for r in nb.shuffled(df, ["v"], seed=4).orderBy("pos").collect()]
    assert a == b != c and sorted(a) == list(range(200)) and a != list(range(200))
    assert sorted(r["pos"] for r in nb.shuffled(df, ["v"], seed=3).collect()) == list(range(200))


@pytest.mark.parametrize("copies", [False, True])
def test_sorted_walk_against_brute_force(spark, copies):
    """2,000 values in [0, 1), ties and NULLs: same rows as comparing all pairs, with candidates linear in the queries."""
    rnd = random.Random(12)
    def row(i):
        return (f"r{i:05d}", rnd.choice([rnd.random(), rnd.randrange(20) / 20]), rnd.choice("abc"), rnd.choice(["t1", "t2", None]), rnd.choice("xy"), 2000, rnd.choice("pq"))
    qs, ts = [row(i) for i in range(60)], [row(1000 + i) for i in range(2000)]
    q, t = (spark.createDataFrame(r, SCHEMA) for r in (qs, ts))
    got = {}
    for r in nb.knn_topk(q, t, k=3, dense=0.0, collapse_copies=copies).collect():
        got.setdefault(r["row_key"], []).append((r["rank"], r["distance"], r["t_row_key"]))
    for x in qs:
        want = sorted(((x[1] - y[1]) * (x[1] - y[1]) + sum(x[i] != y[i] for i in (2, 3, 4, 6)), y[0]) for y in ts)[:3]
        assert [(d, k) for _, d, k in sorted(got[x[0]])] == want
    tt = nb.dense_index(t.select(*[F.col(c).alias("t_" + c) for c in t.columns]), ["t_row_key"], out="_tk")
    qq = q.select(F.monotonically_increasing_id().alias("_qid"), F.col("user_id").alias("_qu"), *[F.col(a).alias("q_" + a) for a in nb.NOMINAL])
    assert nb._sorted_candidates(qq, tt, "t_user_id", nb.NOMINAL, 3).count() <= 60 * 16 * 6


def test_dense_users_take_the_walk(spark):
    q = spark.createDataFrame([(float(i) / 2000,) for i in range(2000)], "_qu double")
    users = spark.createDataFrame([(float(i) / 2000,) for i in range(2000)], "tu double")
    assert nb._pairs_per_user(q, users, 2.0) > nb.DENSE > nb._pairs_per_user(q.selectExpr("_qu * 4000 as _qu"), users.selectExpr("tu * 4000 as tu"), 2.0)


def _spread(seed, nq, nt, users):
    """Rows whose users lie apart unevenly, no user with many rows, nulls among the attributes."""
    rnd = random.Random(seed)
    at = [float(u * 1.5 if u < users // 2 else u * 7) for u in range(users)]

    def row(i, pre):
        some = [rnd.choice([*values, None]) for values in ("AB", ["T0", "T1", "T2"], "XY", "PQ")]
        return (f"{pre}{i:05d}", rnd.choice(at), some[0], some[1], some[2], 2000, some[3])
    return [row(i, "q") for i in range(nq)] + [("q_low", -400.0, "A", "T0", "X", 2000, "P"), ("q_high", 1e5, "B", None, "Y", 2000, "Q")], [row(i, "t") for i in range(nt)]


@pytest.mark.parametrize("band,k", [(2.0, 3), (0.25, 6)])
def test_knn_leaves_few_queries_to_joins(spark, monkeypatch, band, k):
    """Candidates stay in the sorted pass: only queries at its partitions' edges are joined with rows."""
    monkeypatch.setattr(nb.near_users, "partitions_for", lambda *_: 2)
    joined = []
    plain_pairs = nb._user_pairs
    monkeypatch.setattr(nb, "_user_pairs", lambda pending, *rest: (joined.append(pending.count()), plain_pairs(pending, *rest))[1])
    qs, ts = _spread(5, 1500, 1500, 400)
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), k=k, band=band, carry=["year"], q_carry=["title"]).collect()
    assert sorted((r["row_key"], r["rank"], r["t_row_key"], r["distance"]) for r in got) == _brute(qs, ts, k)
    titles = {q[0]: q[3] for q in qs}
    assert all(r["t_year"] == 2000 and r["q_title"] == titles[r["row_key"]] for r in got)
    assert sum(joined[:1]) < len(qs) * 0.2


def test_knn_copies_and_a_hot_user_beside_small_ones(spark):
    qs, ts = _spread(8, 80, 300, 40)
    ts += [(f"h{i:05d}", 30.0, "AB"[i % 2], f"T{i % 50}", "XY"[i % 3 % 2], 2000, f"P{i % 7}") for i in range(500)]
    copies = [(*t, c) for t in ts for c in range(1 + int(t[0][1:]) % 3)]
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(copies, SCHEMA + ", copy int"), k=4, tie=["row_key", "copy"], collapse_copies=True).collect()
    want = []
    for q in qs:
        best = sorted((_dist(q, t), t[0], t[7]) for t in copies)[:4]
        want += [(q[0], i + 1, t, c, d) for i, (d, t, c) in enumerate(best)]
    assert sorted((r["row_key"], r["rank"], r["t_row_key"], r["t_copy"], r["distance"]) for r in got) == sorted(want)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList().mkString("\n").split("\n")
    return {f for f in files if "shuffle_" in f}


def test_stored_leaves_no_shuffle_files(spark):
    frame = spark.range(2000).repartition(3, "id").groupBy((F.col("id") % 7).alias("x")).agg(F.count("*").alias("n"))
    before = _shuffle_files(spark)
    made = []
    assert sorted(map(tuple, session.stored(frame, "test", made).collect())) == [(x, 286 if x < 5 else 285) for x in range(7)] and len(made) == 1
    assert not _shuffle_files(spark) - before


def test_knn_payload_in_pieces(spark, monkeypatch):
    """Search by ranges of users gives the same rows, carried columns included, as all at once."""
    monkeypatch.setattr(session, "PIECE_ROWS", 40)
    qs, ts = _fixture(11, 90, 160)
    ts = [(r[0], r[1], *r[2:5], i, r[6]) for i, r in enumerate(ts)]
    year = {r[0]: r[5] for r in ts}
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), carry=["year"], q_carry=["publisher"]).collect()
    assert sorted((r["row_key"], r["rank"], r["t_row_key"], r["distance"]) for r in got) == _brute(qs, ts, 3)
    assert all(r["t_year"] == year[r["t_row_key"]] and r["q_publisher"] == {q[0]: q[6] for q in qs}[r["row_key"]] for r in got)


def test_search_moves_one_range_of_users_at_a_time(spark, monkeypatch):
    """Each piece is written on its own, and training rows beyond a piece's reach are not in it."""
    seen = []
    monkeypatch.setattr(session, "PIECE_ROWS", 100)
    monkeypatch.setattr(near_users, "stored_pieces", lambda pieces, name: session.stored_pieces((seen.append(p) or p for p in pieces), name))
    qs = [(f"q{i:04d}", float(i), "A", "T", "X", 2000, "P") for i in range(200)]
    ts = [(f"t{i:04d}", i + 0.25, "A", "T", "X", 2000, "P") for i in range(200)]
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), k=2)
    assert sorted((r["row_key"], r["rank"], r["t_row_key"], r["distance"]) for r in got.collect()) == _brute(qs, ts, 2)
    assert len(seen) == 4


def test_only_rows_of_near_users_are_shuffled_after_the_search(spark, monkeypatch):
    """Queries left over by the search are joined with the training rows of the users in their bands, picked before the shuffle."""
    asked = []
    monkeypatch.setattr(nb, "broadcast_if_small", lambda df, most: asked.append(df.count()) or session.broadcast_if_small(df, most))
    qs = [("q0", -500.0, "A", "T", "X", 2000, "P")] + [(f"q{i}", float(i), "A", "T", "X", 2000, "P") for i in range(1, 60)]
    ts = [(f"t{i:03d}", float(i), "A", "T", "X", 2000, "P") for i in range(300)]
    got = nb.knn_topk(spark.createDataFrame(qs, SCHEMA), spark.createDataFrame(ts, SCHEMA), k=2)
    assert sorted((r["row_key"], r["rank"], r["t_row_key"], r["distance"]) for r in got.collect()) == _brute(qs, ts, 2)
    assert asked and asked[0] < 300


def _book_tables(spark, folder):
    """Tables with repeated and null keys in each of them; returns lineitem's rows."""
    lines = [(o, n, o % 5, o % 3, "OF"[o % 2]) for o in range(40) for n in range(o % 4)] + [(None, 1, 1, 1, "O"), (7, 9, None, 1, "F"), (7, 1, 2, 1, "O")]
    rows = {"lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_linestatus string"),
            "orders": ([(o, o % 6, f"199{o % 9}-01-02 00:00:00") for o in range(38)] + [(7, 2, None), (None, 1, None)], "o_orderkey long, o_custkey long, d string"),
            "customer": ([(c, c % 3) for c in range(5)] + [(2, 1)], "c_custkey long, c_nationkey int"),
            "nation": ([(0, "N0"), (1, "N1"), (2, None)], "n_nationkey int, n_name string"),
            "part": ([(p, f"part {p % 2}", "B") for p in range(4)] + [(1, "other", None)], "p_partkey long, p_name string, p_brand string"),
            "supplier": ([(s, f"S{s}") for s in range(3)] + [(1, "S9")], "s_suppkey long, s_name string")}
    for name, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        df = df.select("o_orderkey", "o_custkey", F.col("d").cast("timestamp_ntz").alias("o_orderdate")) if name == "orders" else df
        df.write.parquet(f"{folder}/{name}.parquet")


def test_book_split_in_pieces(spark, tmp_path, monkeypatch):
    _book_tables(spark, tmp_path)
    whole = [sorted(map(str, side.collect())) for side in workloads.book_split(spark, str(tmp_path))]
    direct = sorted(str(r) for r in workloads.book_rows(spark, str(tmp_path)).drop("status").collect())
    monkeypatch.setattr(session, "PIECE_ROWS", 9)
    assert [sorted(map(str, side.collect())) for side in workloads.book_split(spark, str(tmp_path))] == whole
    assert sorted(whole[0] + whole[1]) == direct and len(direct) > 50


def test_book_lines_are_shuffled_twice(spark, tmp_path):
    _book_tables(spark, tmp_path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        plan = workloads.book_rows(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 6          # lines by order and part, orders by customer and order, customers, parts


@pytest.mark.parametrize("piece_rows", [60_000_000, 50])
def test_ensemble_training_is_the_union_of_the_samples(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(session, "PIECE_ROWS", piece_rows)
    df = spark.createDataFrame([(f"k{i:03d}", float(i)) for i in range(97)], "key string, v double")
    want = [r for m in range(3) for r in nb.bootstrap_sample(df, "key", model=m).select("key", "v", "copy", "model").collect()]
    got = nb.ensemble_training(df, "key", models=3)
    assert got.columns == ["key", "v", "copy", "model"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_ensemble_joins_a_row_once(spark, monkeypatch):
    """The rows are joined with the draws of all models at once, and no table is written as uncompressed rows."""
    cuts, joined = [], []
    monkeypatch.setattr(nb, "cut", lambda df: cuts.append(df) or loops.cut(df))
    monkeypatch.setattr(nb, "stored_pieces", lambda pieces, name: session.stored_pieces((joined.append(p) or p for p in pieces), name))
    df = spark.createDataFrame([(f"k{i:03d}", float(i)) for i in range(30)], "key string, v double")
    assert nb.ensemble_training(df, "key", models=3).count() == 90
    assert not cuts and len(joined) == 1
