import random

import pytest
from pyspark.sql import functions as F

from spindle.operators import graph

# Golden graphs and their distances.
F2_LINES = ["1,2", "2,3", "3", "4,5", "5,6", "6", "7,8", "8,9", "9"]
F3_EDGES = [("1", "2"), ("2", "4"), ("1", "3"), ("1", "5"), ("3", "5"), ("4", "5"), ("5", "6"), ("6", "7")]


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_parse_edge_lines_f2_is_chain_k3(spark):
    lines = spark.createDataFrame([(x,) for x in F2_LINES], "value string")
    got = _rows(graph.parse_edge_lines(lines), "src", "dst")
    assert len(got) == 9 and [s for s, d in got if d is None] == ["3", "6", "9"]
    chain = graph.chain_graph(spark, 3).select(F.col("src").cast("string"), F.col("dst").cast("string"))
    assert got == _rows(chain, "src", "dst")


def test_read_edge_list_file(spark, tmp):
    p = f"{tmp}/edges.csv"
    open(p, "w").write("\n".join(F2_LINES) + "\n")
    assert graph.read_edge_list(spark, p).count() == 9


def test_sssp_golden_f3(spark):
    e = spark.createDataFrame(F3_EDGES, "src string, dst string")
    d = graph.sssp_hops(e, "1")
    assert _rows(d, "node", "dist") == [("2", 1), ("3", 1), ("4", 2), ("5", 1), ("6", 2), ("7", 3)]
    assert _rows(graph.farthest(d), "node", "dist") == [("7", 3)]


def test_sssp_salted_equals_plain_and_unreachable(spark):
    e = spark.createDataFrame(F3_EDGES + [("8", "9")], "src string, dst string")
    a = _rows(graph.sssp_hops(e, "1"), "node", "dist")
    b = _rows(graph.sssp_hops(e, "1", hot_threshold=1), "node", "dist")
    assert a == b
    full = dict(_rows(graph.sssp_hops(e, "1", include_unreachable=True), "node", "dist"))
    assert full["8"] is None and full["9"] is None and full["1"] is None


def _bfs(edges, src):
    adj = {}
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    dist, frontier, lvl = {}, sorted(set(adj.get(src, []))), 1
    while frontier:
        for v in frontier:
            dist[v] = lvl
        nxt = {w for v in frontier for w in adj.get(v, []) if w not in dist}
        frontier, lvl = sorted(nxt), lvl + 1
    return dist


def test_sssp_random_graph_vs_bfs(spark):
    rnd = random.Random(7)
    edges = list({(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(150)})
    e = spark.createDataFrame(edges, "src long, dst long")
    got = dict(_rows(graph.sssp_hops(e, 0), "node", "dist"))
    assert got == _bfs(edges, 0)


def test_pagerank_chain_closed_form(spark):
    # k = 100, 2 iterations, reference rule: 1.01e-6, 2.01e-6, then 1.0201e-4; sum 1
    pr = dict(_rows(graph.pagerank(graph.chain_graph(spark, 100), iterations=2, split_by_outdegree=False),
                    "node", "pr"))
    assert len(pr) == 10000
    assert pr[1] == pytest.approx(1.01e-6, rel=1e-9) and pr[101] == pytest.approx(1.01e-6, rel=1e-9)
    assert pr[2] == pytest.approx(2.01e-6, rel=1e-9)
    assert pr[3] == pytest.approx(1.0201e-4, rel=1e-9) and pr[100] == pytest.approx(1.0201e-4, rel=1e-9)
    assert sum(pr.values()) == pytest.approx(1.0, abs=1e-9)


def _pagerank_ref(edges, nodes, iters, split=True):
    n = len(nodes)
    out = {v: [d for s, d in edges if s == v] for v in nodes}
    pr = {v: 1.0 / n for v in nodes}
    for _ in range(iters):
        dang = sum(pr[v] for v in nodes if not out[v])
        new = {v: 0.0 for v in nodes}
        for v in nodes:
            for d in out[v]:
                new[d] += pr[v] / (len(out[v]) if split else 1)
        pr = {v: new[v] + dang / n for v in nodes}
    return pr


@pytest.mark.parametrize("hot", [None, 3])
def test_pagerank_random_graph(spark, hot):
    rnd = random.Random(3)
    edges = list({(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(90)})
    edges += [(0, d) for d in range(1, 30)]          # node 0 is hot
    edges = sorted(set(edges))
    nodes = sorted({s for s, _ in edges} | {d for _, d in edges})
    e = spark.createDataFrame(edges, "src long, dst long")
    got = dict(_rows(graph.pagerank(e, iterations=6, hot_threshold=hot), "node", "pr"))
    want = _pagerank_ref(edges, nodes, 6)
    assert got.keys() == want.keys()
    for v in nodes:
        assert got[v] == pytest.approx(want[v], rel=1e-9)
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-9)


def test_pagerank_damping(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "src long, dst long")
    pr = dict(_rows(graph.pagerank(e, iterations=5, damping=0.85), "node", "pr"))
    assert all(v == pytest.approx(1 / 3) for v in pr.values())


def test_bfs_relax_step_f4(spark):
    lines = spark.createDataFrame([("1 0 2:3:",)], "value string")
    got = _rows(graph.bfs_relax_step(lines), "node", "dist", "adj")
    assert got == [("1", 0, "2:3:"), ("2", 1, None), ("3", 1, None)]


def test_bfs_relax_unreachable_and_far(spark):
    """10009 marks an unreachable node; a real distance beyond it stays what it is."""
    lines = spark.createDataFrame([("1 10009 2:",), ("2 10009 ",), ("3 10010 4:",), ("4 10009 ",), ("b 7 3:",), ("x far 1:",), (" 1 ",)], "value string")
    got = {r["node"]: r["dist"] for r in graph.bfs_relax_step(lines).collect()}
    assert got == {"1": None, "2": None, "3": 8, "4": 10011, "b": 7}
    bad = [r["_corrupt"] for r in graph.parse_node_lines(lines).where("_corrupt IS NOT NULL").collect()]
    assert sorted(bad) == [" 1 ", "x far 1:"]
    back = graph.bfs_relax_step(lines).select(graph.node_line(F.col("node"), F.col("dist"), F.col("adj")).alias("l"))
    assert "2 10009 " in [r["l"] for r in back.collect()]


def test_bfs_relax_one_row_per_node(spark):
    e = spark.createDataFrame([(1, d) for d in range(2, 12)], "src long, dst long")
    got = graph.bfs_relax_step(graph.node_lines(e, 1)).collect()
    assert len(got) == 11 and {r["adj"] for r in got if r["node"] == "1"} == {":".join(map(str, range(2, 12))) + ":"}


def test_edge_lines_corrupt(spark):
    lines = spark.createDataFrame([("a,b",), ("a,b,c",), (",b",), (" ",), ("a",)], "value string")
    rows = graph.parse_edge_lines(lines).collect()
    assert sorted(r["_corrupt"] for r in rows if r["_corrupt"]) == [",b", "a,b,c"] and len(rows) == 4


def test_long_path_keeps_its_partitions(spark):
    path = spark.range(100).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    g = graph.prepare_graph(path)
    d = graph.sssp_hops(g, 0)
    assert d.rdd.getNumPartitions() <= 16
    assert {r["node"]: r["dist"] for r in d.collect()} == {i: i for i in range(1, 101)}
    assert {r["node"] for r in graph.sssp_hops(g, 0, max_iter=5).collect()} == {1, 2, 3, 4, 5}


def test_edges_are_not_shuffled_on_raw_keys(spark):
    e = spark.createDataFrame([(0, d) for d in range(60)] + [(d, 0) for d in range(1, 9)], "src long, dst long")
    g = graph.prepare_graph(e, hot_threshold=5)
    assert {r["nsalt"] for r in g.nodes.where("node = 0").collect()} != {1}
    assert g.edges.count() == 68 and g.edges.select("salt").distinct().count() > 1


def test_adjacency_chunks_hot_node(spark):
    edges = [(0, d) for d in range(1, 50)] + [(1, 2), (1, 3)]
    e = spark.createDataFrame(edges, "src long, dst long")
    hot = sorted((r["chunk"], r["neighbours"]) for r in graph.adjacency_chunks(e, max_per_row=10).collect() if r["src"] == 0)
    assert [x for _, n in hot for x in n] == list(range(1, 50)) and [len(n) for _, n in hot] == [10, 10, 10, 10, 9]
    whole = {r["src"]: r["neighbours"] for r in graph.adjacency_list(e).collect()}
    assert whole == {0: list(range(1, 50)), 1: [2, 3]}


def test_dangling_mass(spark):
    e = spark.createDataFrame([(1, 2), (2, None), (3, 1)], "src long, dst long")
    g = graph.prepare_graph(e)
    assert graph.dangling_mass(g).first()[0] == pytest.approx(1 / 3)


def test_pagerank_joins_lists_not_edges(spark, monkeypatch):
    """A step joins one row a source (and salt), not one an edge."""
    edges = spark.createDataFrame([(i, (i * 7 + j) % 40) for i in range(30) for j in range(9)], "src long, dst long").distinct()
    joined = []
    plain = graph._fan_out

    def watched(df, key):
        joined.append(df.count())
        return plain(df, key)
    monkeypatch.setattr(graph, "_fan_out", watched)
    plans = []
    cut = graph._cut_observing
    monkeypatch.setattr(graph, "_cut_observing", lambda df, m: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cut(df, m))[1])
    rank = {r["node"]: r["pr"] for r in graph.pagerank(edges, iterations=3).collect()}
    pairs = {(r["src"], r["dst"]) for r in edges.collect()}
    nodes = {n for e in pairs for n in e}
    degree = {n: sum(s == n for s, _ in pairs) for n in nodes}
    want = {n: 1 / len(nodes) for n in nodes}
    for _ in range(3):
        lost = sum(want[n] for n in nodes if not degree[n]) / len(nodes)
        want = {n: lost + sum(want[s] / degree[s] for s, d in pairs if d == n) for n in nodes}
    assert rank.keys() == want.keys() and all(abs(rank[n] - want[n]) < 1e-12 for n in nodes)
    assert len(joined) == 3 and all("explode(to" in p for p in plans[1:])


def test_bfs_files_step_has_no_join(spark, tmp, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 2), (6, 7)], "src long, dst long")
    plans = []
    plain = graph._relaxed
    monkeypatch.setattr(graph, "_relaxed", lambda *a: (plans.append(1), plain(*a))[1])
    found = {r["node"]: r["dist"] for r in graph.bfs_files(spark, graph.node_lines(edges, 1), f"{tmp}/steps").collect()}
    assert found == {"1": 0, "2": 1, "3": 2, "4": 3, "6": None, "7": None} and len(plans) == 4
    written = [f for _, _, names in __import__("os").walk(f"{tmp}/steps") for f in names if f.startswith("part-")]
    assert written and all(f.endswith(".gz") for f in written)
