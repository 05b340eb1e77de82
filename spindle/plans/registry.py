"""Registered queries over the shared test tables, and their DuckDB oracles.

Each query reads whole tables (see ``workloads``). Oracle SQL uses the same
column names; doubles that depend on summation order are rounded on both
sides; integer results are cast to BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import workloads as W
from ..operators import counting
from ..session import drop_scratch, scratch_path
from .loops import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- counting

@register("follower_count", """
SELECT l_partkey AS dst, CAST(count(*) AS BIGINT) AS cnt
FROM lineitem GROUP BY l_partkey""")
def q_follower_count(spark, sf):
    return counting.follower_count(W.follow_edges(spark, sf))


@register("follower_count_max", """
SELECT CAST(max(cnt) AS BIGINT) AS max_cnt
FROM (SELECT count(*) AS cnt FROM lineitem GROUP BY l_partkey)""")
def q_follower_count_max(spark, sf):
    return counting.max_count(counting.follower_count(W.follow_edges(spark, sf)))


# ---------------------------------------------------------------- k-means

from ..operators import cluster  # noqa: E402

KMEANS_K = 6

_COUNTS_SQL = "SELECT l_partkey AS id, count(*) AS cnt FROM lineitem GROUP BY l_partkey"
_PTS_SQL = f"SELECT CAST(cnt AS DOUBLE) AS x, count(*) AS w FROM ({_COUNTS_SQL}) GROUP BY 1"
_SEED_SQL = (f"SELECT CAST(range AS INT) AS cid, CAST((mx // {KMEANS_K}) * (range + 1) AS DOUBLE) AS center "
             f"FROM range({KMEANS_K}), (SELECT max(cnt) AS mx FROM ({_COUNTS_SQL}))")


def _counts(spark, sf):
    """Follower counts, written once; points and seeds come from this table."""
    return cut(counting.follower_count(W.follow_edges(spark, sf)))


def _points(counts):
    return counts.select(F.col("dst").alias("id"), F.col("cnt").cast("double").alias("x"))


def _seeds(counts, k: int = KMEANS_K):
    return cluster.init_centres(counting.max_count(counts).first()[0], k)


def _kmeans_chain_sql(iterations: int) -> str:
    """Unrolled Lloyd iterations, one materialised CTE per step."""
    ctes = [f"pts AS MATERIALIZED ({_PTS_SQL})", f"c0 AS MATERIALIZED ({_SEED_SQL})"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT x, w, cid FROM (SELECT x, w, cid, row_number() OVER "
            f"(PARTITION BY x ORDER BY abs(x - center), cid) AS rn FROM pts, c{i-1}) WHERE rn = 1)")
        ctes.append(
            f"c{i} AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY cid) - 1 AS INT) AS cid, "
            f"cid AS oc, sum(w * x) / sum(w) AS center, CAST(sum(w) AS BIGINT) AS n FROM a{i} GROUP BY cid)")
    n = iterations
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT c.cid, c.center, c.n, round(sum(a.w * (a.x - c.center) * (a.x - c.center)), 4) AS sse "
            f"FROM a{n} a JOIN c{n} c ON a.cid = c.oc GROUP BY c.cid, c.center, c.n")


def _round_sse(df):
    return df.select("cid", "center", "n", F.round("sse", 4).alias("sse"))


@register("kmeans_init", _SEED_SQL)
def q_kmeans_init(spark, sf):
    counts = counting.follower_count(W.follow_edges(spark, sf))
    return cluster.init_centres_df(spark, counting.max_count(counts), KMEANS_K)


@register("kmeans_assign", f"""
WITH pts AS ({_COUNTS_SQL}), c0 AS ({_SEED_SQL})
SELECT id, x, cid, center FROM (
  SELECT id, CAST(cnt AS DOUBLE) AS x, cid, center,
         row_number() OVER (PARTITION BY id ORDER BY abs(cnt - center), cid) AS rn
  FROM pts, c0) WHERE rn = 1""")
def q_kmeans_assign(spark, sf):
    counts = _counts(spark, sf)
    return cluster.assign(_points(counts), _seeds(counts)).select("id", "x", "cid", "center")


@register("kmeans_step", _kmeans_chain_sql(1))
def q_kmeans_step(spark, sf):
    counts = _counts(spark, sf)
    return _round_sse(cluster.kmeans_step(_points(counts), _seeds(counts)))


@register("kmeans_1d", _kmeans_chain_sql(10))
def q_kmeans_1d(spark, sf):
    counts = _counts(spark, sf)
    return _round_sse(cluster.kmeans_1d(_points(counts), _seeds(counts), iterations=10))


@register("kmeans_assign_many", f"""
WITH pts AS ({_COUNTS_SQL}), c0 AS (SELECT CAST(range AS INT) AS cid, CAST(range * 7 % 2003 AS DOUBLE) / 20 AS center FROM range(2003))
SELECT id, x, cid, center FROM (
  SELECT id, CAST(cnt AS DOUBLE) AS x, cid, center,
         row_number() OVER (PARTITION BY id ORDER BY abs(cnt - center), cid) AS rn
  FROM pts, c0) WHERE rn = 1""")
def q_kmeans_assign_many(spark, sf):
    """2,003 centres in no order: the search costs log2(k) steps a value."""
    centres = [(i * 7 % 2003) / 20 for i in range(2003)]
    return cluster.assign(_points(_counts(spark, sf)), centres).select("id", "x", "cid", "center")


# ---------------------------------------------------------------- graph

from ..operators import graph  # noqa: E402

CHAIN_K = 100
_GRAPH_SQL = ("SELECT a.o_custkey AS src, b.o_custkey AS dst FROM orders a "
              "JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey "
              "UNION SELECT o_custkey, -1 - l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
_CHAIN_SQL = (f"SELECT c.c_custkey AS src, CASE WHEN (c.c_custkey + 1) % {CHAIN_K} <> 0 "
              f"THEN n.c_custkey END AS dst FROM customer c LEFT JOIN customer n ON n.c_custkey = c.c_custkey + 1")
_NODES_SQL = "SELECT src AS node FROM e UNION SELECT dst FROM e WHERE dst IS NOT NULL"


def _pagerank_ctes(edges_sql: str, iterations: int, split: bool) -> tuple[str, str]:
    share = "r.pr / r.outdeg" if split else "r.pr"
    ctes = [f"e AS MATERIALIZED ({edges_sql})",
            f"nodes AS MATERIALIZED ({_NODES_SQL})",
            "deg AS MATERIALIZED (SELECT n.node, count(e.dst) AS outdeg FROM nodes n "
            "LEFT JOIN e ON e.src = n.node GROUP BY n.node)",
            "cnt AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)",
            "r0 AS MATERIALIZED (SELECT node, outdeg, 1.0 / (SELECT n FROM cnt) AS pr FROM deg)"]
    for i in range(1, iterations + 1):
        ctes.append(
            f"r{i} AS MATERIALIZED (SELECT d.node, d.outdeg, coalesce(c.s, 0.0) + "
            f"(SELECT coalesce(sum(pr), 0.0) FROM r{i-1} WHERE outdeg = 0) / (SELECT n FROM cnt) AS pr "
            f"FROM deg d LEFT JOIN (SELECT e.dst, sum({share}) AS s FROM e JOIN r{i-1} r ON r.node = e.src "
            f"WHERE e.dst IS NOT NULL GROUP BY e.dst) c ON c.dst = d.node)")
    return "WITH " + ",\n".join(ctes), f"r{iterations}"


def _pr_sql(edges_sql, iterations, split, select):
    head, last = _pagerank_ctes(edges_sql, iterations, split)
    return head + "\n" + select.format(r=last)


def _scaled_rank(edges, iterations=10, split=True):
    """(node, pr_n): rank times the number of nodes, so that rounding keeps as
    many digits of a rank at 10^9 nodes as at ten."""
    g = graph.prepare_graph(edges)
    pr = graph.pagerank(g, iterations=iterations, split_by_outdegree=split)
    g.release()
    return pr.select("node", F.round(F.col("pr") * g.n, 9).alias("pr_n"))


_PR_N = "round(pr * (SELECT n FROM cnt), 9)"


@register("chain_graph", _CHAIN_SQL)
def q_chain_graph(spark, sf):
    return W.customer_chains(spark, sf, CHAIN_K)


@register("edge_list_parse", f"""
WITH e AS ({_GRAPH_SQL}), nodes AS ({_NODES_SQL})
SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM e
UNION ALL
SELECT CAST(node AS VARCHAR) AS src, CAST(NULL AS VARCHAR) AS dst FROM nodes
WHERE node NOT IN (SELECT src FROM e)""")
def q_edge_list_parse(spark, sf):
    """Edges written as an edge-list file and read back."""
    e = cut(W.order_graph(spark, sf))
    lone = graph.graph_nodes(e).join(e.select(F.col("src").alias("node")), "node", "left_anti")
    path = scratch_path(spark, "edges")
    graph.edge_lines(e.unionByName(lone.select(F.col("node").alias("src"), F.lit(None).cast("long").alias("dst")))).write.text(path)
    return graph.read_edge_list(spark, path)


@register("adjacency_list", f"""
WITH e AS ({_GRAPH_SQL})
SELECT src, string_agg(CAST(dst AS VARCHAR), ':' ORDER BY dst) AS neighbours FROM e GROUP BY src""")
def q_adjacency_list(spark, sf):
    return graph.adjacency_strings(graph.adjacency_list(W.order_graph(spark, sf)))


@register("adjacency_chunks", f"""
WITH e AS ({_GRAPH_SQL}),
n AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 20 AS chunk FROM e)
SELECT src, chunk, string_agg(CAST(dst AS VARCHAR), ':' ORDER BY dst) AS neighbours FROM n GROUP BY src, chunk""")
def q_adjacency_chunks(spark, sf):
    return graph.adjacency_strings(graph.adjacency_chunks(W.order_graph(spark, sf), max_per_row=20))


@register("dangling_mass", f"""
WITH e AS ({_GRAPH_SQL}), nodes AS ({_NODES_SQL})
SELECT round(CAST((SELECT count(*) FROM nodes WHERE node NOT IN (SELECT src FROM e)) AS DOUBLE)
       / (SELECT count(*) FROM nodes), 12) AS dangling_mass""")
def q_dangling_mass(spark, sf):
    g = graph.prepare_graph(W.order_graph(spark, sf))
    return graph.dangling_mass(g).select(F.round("dangling_mass", 12).alias("dangling_mass"))


@register("pagerank", _pr_sql(_GRAPH_SQL, 10, True, f"SELECT node, {_PR_N} AS pr_n FROM {{r}}"))
def q_pagerank(spark, sf):
    return _scaled_rank(W.order_graph(spark, sf))


@register("pagerank_total", _pr_sql(_GRAPH_SQL, 10, True, "SELECT round(sum(pr), 9) AS total FROM {r}"))
def q_pagerank_total(spark, sf):
    return graph.pagerank(W.order_graph(spark, sf)).agg(F.round(F.sum("pr"), 9).alias("total"))


@register("pagerank_top", _pr_sql(_GRAPH_SQL, 10, True,
                                  f"SELECT node, {_PR_N} AS pr_n FROM {{r}} ORDER BY {_PR_N} DESC, node LIMIT 100"))
def q_pagerank_top(spark, sf):
    return _scaled_rank(W.order_graph(spark, sf)).orderBy(F.col("pr_n").desc(), F.col("node")).limit(100)


@register("pagerank_unsplit", _pr_sql(_GRAPH_SQL, 2, False, f"SELECT node, {_PR_N} AS pr_n FROM {{r}}"))
def q_pagerank_unsplit(spark, sf):
    return _scaled_rank(W.order_graph(spark, sf), iterations=2, split=False)


@register("pagerank_chain", _pr_sql(_CHAIN_SQL, 2, False, f"SELECT node, {_PR_N} AS pr_n FROM {{r}}"))
def q_pagerank_chain(spark, sf):
    return _scaled_rank(W.customer_chains(spark, sf, CHAIN_K), iterations=2, split=False)


def _sssp_sql(levels: int = 16) -> str:
    """BFS level by level; the last level must come out empty (it does at the checked scales)."""
    ctes = [f"e AS MATERIALIZED ({_GRAPH_SQL})",
            "v1 AS MATERIALIZED (SELECT dst AS node, 1 AS dist FROM e WHERE src = (SELECT min(src) FROM e))"]
    for i in range(2, levels + 1):
        ctes.append(f"v{i} AS MATERIALIZED (SELECT * FROM v{i-1} UNION ALL SELECT DISTINCT e.dst, {i} FROM e "
                    f"JOIN v{i-1} p ON p.node = e.src AND p.dist = {i-1} WHERE e.dst NOT IN (SELECT node FROM v{i-1}))")
    return "WITH " + ",\n".join(ctes) + f", d AS (SELECT node, CAST(dist AS INT) AS dist FROM v{levels})"


_SSSP_SQL = _sssp_sql()


def sssp_source(edges):
    """BFS source: the smallest node with an out-edge (data-derived)."""
    return edges.agg(F.min("src")).first()[0]


@register("sssp_hops", _SSSP_SQL + "\nSELECT node, dist FROM d")
def q_sssp_hops(spark, sf):
    e = cut(W.order_graph(spark, sf))
    return graph.sssp_hops(e, sssp_source(e))


@register("sssp_longest", _SSSP_SQL + "\nSELECT node, dist FROM d ORDER BY dist DESC, node LIMIT 1")
def q_sssp_longest(spark, sf):
    e = cut(W.order_graph(spark, sf))
    return graph.farthest(graph.sssp_hops(e, sssp_source(e)))


@register("bfs_relax_step", f"""
WITH e AS ({_GRAPH_SQL}), nodes AS ({_NODES_SQL}),
adj AS (SELECT src, string_agg(CAST(dst AS VARCHAR), ':' ORDER BY dst) || ':' AS adj FROM e GROUP BY src),
lines AS (SELECT n.node, CASE WHEN n.node = (SELECT min(src) FROM e) THEN 0 END AS dist, coalesce(adj, '') AS adj
          FROM nodes n LEFT JOIN adj ON adj.src = n.node),
cand AS (SELECT node, dist FROM lines
         UNION ALL SELECT e.dst, l.dist + 1 FROM lines l JOIN e ON e.src = l.node)
SELECT CAST(c.node AS VARCHAR) AS node, CAST(min(c.dist) AS INT) AS dist, any_value(l.adj) AS adj
FROM cand c LEFT JOIN lines l ON l.node = c.node GROUP BY c.node""")
def q_bfs_relax_step(spark, sf):
    e = cut(W.order_graph(spark, sf))
    return graph.bfs_relax_step(graph.node_lines(e, sssp_source(e)))


# ---------------------------------------------------------------- text

from ..operators import text as textops  # noqa: E402
from ..sources import folders, tagged  # noqa: E402

# The test lexicon (our own, ten frequent words of `documents`).
LEXICON = [("the", 1), ("of", -1), ("and", 2), ("to", -2), ("in", 3),
           ("is", -3), ("that", 4), ("for", -4), ("it", 5), ("was", -5)]
_LEX_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{t}', {s})" for t, s in LEXICON) + ") lex(term, score)"
# tweet i is stamped 2011-07-01 00:00:00 UTC + i minutes


def _tweets(spark, sf):
    d = W.table(spark, sf, "documents")
    return d.select(
        F.lit("status").alias("type"), F.col("source").alias("origin"), "text", F.lit("").alias("url"),
        F.col("doc_id").alias("tweet_id"),
        (F.expr("TIMESTAMP_NTZ '2011-07-01 00:00:00'") + F.make_dt_interval(secs=(F.col("doc_id") * 60).cast("decimal(18,6)")))
        .alias("time"),
        F.col("n_chars").cast("int").alias("ret_count"), (F.col("lang") == "en").alias("favorite"),
        F.array(F.col("doc_id"), F.col("n_chars")).alias("mentioned"), F.array(F.col("lang")).alias("hashtags"))


def _parsed_tweets(spark, sf):
    path = scratch_path(spark, "tweets")
    tagged.render_tagged_records(_tweets(spark, sf)).write.mode("overwrite").text(path)
    parsed = cut(tagged.parse_tagged_records(tagged.read_tagged_records(spark, path)))
    drop_scratch(spark, path)
    return parsed


_TWEETS_SQL = (f"SELECT doc_id AS tweet_id, 'status' AS type, source AS origin, text, '' AS url, "
               f"TIMESTAMP '2011-07-01 00:00:00' + (doc_id * 60) * INTERVAL 1 SECOND AS time, "
               f"CAST(n_chars AS INT) AS ret_count, lang = 'en' AS favorite, "
               f"CAST(doc_id AS VARCHAR) || ' ' || CAST(n_chars AS VARCHAR) AS mentioned, lang AS hashtags "
               f"FROM documents")


@register("tagged_records", _TWEETS_SQL)
def q_tagged_records(spark, sf):
    p = _parsed_tweets(spark, sf)
    return p.select("tweet_id", "type", "origin", "text", "url", "time", "ret_count", "favorite",
                    F.array_join(F.col("mentioned").cast("array<string>"), " ").alias("mentioned"),
                    F.array_join("hashtags", " ").alias("hashtags"))


@register("tweet_csv", f"""
SELECT tweet_id, CAST(tweet_id AS VARCHAR) || ',"' || strftime(time, '%a %b %d %H:%M:%S UTC %Y')
       || '","' || replace(text, '"', '""') || '"' AS line
FROM ({_TWEETS_SQL})""")
def q_tweet_csv(spark, sf):
    return tagged.tweet_csv_line(_parsed_tweets(spark, sf))


@register("merge_lines", r"""
SELECT doc_id, CASE WHEN length(text) = 0 THEN '' ELSE
  regexp_replace(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n', ',', 'g') || ',' END AS merged
FROM documents""")
def q_merge_lines(spark, sf):
    d = W.table(spark, sf, "documents").select("doc_id", "text")
    return folders.merge_lines(d, "text").select("doc_id", "merged")


@register("sentiment_score", f"""
WITH lex AS ({_LEX_SQL}),
toks AS (SELECT d.doc_id, unnest(string_split(d.text, ' ')) AS tok FROM documents d)
SELECT t.doc_id, CAST(coalesce(sum(l.score), 0) AS BIGINT) AS score
FROM toks t LEFT JOIN lex l ON l.term = t.tok GROUP BY t.doc_id""")
def q_sentiment_score(spark, sf):
    lex = spark.createDataFrame(LEXICON, "term string, score int")
    return textops.sentiment_score(W.table(spark, sf, "documents"), lex)


# Every word of `benchmark` is a term; its score is derived from its length and first letter.
_LARGE_LEX_SQL = ("SELECT tok AS term, (length(tok) * 7 + ascii(tok)) % 11 - 5 AS score FROM "
                  "(SELECT DISTINCT unnest(string_split(text, ' ')) AS tok FROM benchmark) WHERE tok <> ''")


def _large_lexicon(spark, sf):
    toks = W.table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("term")).where("term <> ''").distinct()
    return toks.select("term", ((F.length("term") * 7 + F.ascii("term")) % 11 - 5).cast("int").alias("score"))


_LARGE_SCORE_SQL = f"""
WITH lex AS ({_LARGE_LEX_SQL}),
toks AS (SELECT d.doc_id, unnest(string_split(d.text, ' ')) AS tok FROM documents d)
SELECT t.doc_id, CAST(coalesce(sum(l.score), 0) AS BIGINT) AS score
FROM toks t LEFT JOIN lex l ON l.term = t.tok GROUP BY t.doc_id"""


@register("sentiment_score_large", _LARGE_SCORE_SQL)
def q_sentiment_score_large(spark, sf):
    return textops.sentiment_score(W.table(spark, sf, "documents"), _large_lexicon(spark, sf))


@register("sentiment_score_shuffled", _LARGE_SCORE_SQL)
def q_sentiment_score_shuffled(spark, sf):
    """The way of a lexicon too large to broadcast: salted shuffle join."""
    return textops.sentiment_score(W.table(spark, sf, "documents"), _large_lexicon(spark, sf), broadcast_bytes=0)


@register("sentiment_job", f"""
WITH s AS ({_LARGE_SCORE_SQL}) SELECT d.doc_id AS tweet_id, d.text, s.score FROM documents d JOIN s USING (doc_id)""")
def q_sentiment_job(spark, sf):
    """Tweet CSV files -> quote-aware read -> last row per id -> score."""
    path = scratch_path(spark, "tweet-csv")
    tagged.write_tweet_csv(_tweets(spark, sf), path)
    tweets = cut(tagged.read_tweet_csv(spark, path).where("_corrupt IS NULL"))
    drop_scratch(spark, path)
    return textops.sentiment_job(tweets, _large_lexicon(spark, sf))


@register("dedup_last", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def q_dedup_last(spark, sf):
    ev = W.table(spark, sf, "events")
    return textops.dedup_last(ev, "user_id", ["ts", "event_id"])


# ---------------------------------------------------------------- neighbours

from ..operators import neighbors as nb  # noqa: E402

KNN_K = 3
ENSEMBLE_MODELS = 3
_BOOK_SQL = ("SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key, "
             "CAST(c_custkey AS DOUBLE) AS user_id, n_name AS location, p_name AS title, p_brand AS author, "
             "CAST(year(o_orderdate) AS INT) AS year, s_name AS publisher, l_linestatus AS status "
             "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
             "JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey "
             "JOIN supplier ON l_suppkey = s_suppkey")
_DIST_SQL = ("(q.user_id - t.user_id) * (q.user_id - t.user_id)"
             " + CASE WHEN q.location = t.location THEN 0.0 ELSE 1.0 END"
             " + CASE WHEN q.title = t.title THEN 0.0 ELSE 1.0 END"
             " + CASE WHEN q.author = t.author THEN 0.0 ELSE 1.0 END"
             " + CASE WHEN q.publisher = t.publisher THEN 0.0 ELSE 1.0 END")
# Oracle pruning: user ids are integers and, at the checked scales, every
# query has >= K training rows within 9 users, so its K-th distance is
# <= 9^2 + 4 < 10^2 and rows farther than 10 users cannot enter the top K.
_BAND = 10
_BOOKS_CTE = (f"b AS MATERIALIZED ({_BOOK_SQL}), q AS (SELECT * FROM b WHERE status = 'O'), "
              f"t AS (SELECT * FROM b WHERE status = 'F')")
_KNN_CTE = (f"{_BOOKS_CTE}, c AS (SELECT q.row_key, t.row_key AS t_row_key, {_DIST_SQL} AS distance "
            f"FROM q JOIN t ON t.user_id BETWEEN q.user_id - {_BAND} AND q.user_id + {_BAND}), "
            f"knn AS (SELECT * FROM (SELECT row_key, CAST(row_number() OVER (PARTITION BY row_key "
            f"ORDER BY distance, t_row_key) AS INT) AS rank, t_row_key, distance FROM c) WHERE rank <= {KNN_K})")


def _knn(spark, sf, **options):
    q, t = W.book_split(spark, sf)
    return nb.knn_topk(q, t, k=KNN_K, **options), q


@register("knn_distance", f"""
WITH {_BOOKS_CTE}, p AS (SELECT * FROM t ORDER BY row_key LIMIT 1)
SELECT q.row_key, {_DIST_SQL.replace('t.', 'p.')} AS distance FROM b q, p""")
def q_knn_distance(spark, sf):
    probe = W.book_training(spark, sf).orderBy("row_key").first().asDict()
    return nb.distance_to(W.book_rows(spark, sf), probe).select("row_key", "distance")


@register("knn_topk", f"WITH {_KNN_CTE} SELECT * FROM knn")
def q_knn_topk(spark, sf):
    return _knn(spark, sf)[0]


@register("knn_payload", f"""
WITH {_KNN_CTE}
SELECT k.row_key, k.rank, k.t_row_key, k.distance, t.title AS t_title, t.year AS t_year, t.publisher AS t_publisher, q.publisher
FROM knn k JOIN (SELECT DISTINCT row_key, title, year, publisher FROM t) t ON t.row_key = k.t_row_key
JOIN (SELECT DISTINCT row_key, publisher FROM q) q ON q.row_key = k.row_key""")
def q_knn_payload(spark, sf):
    """Neighbours with what the job prints: training title and year, both publishers."""
    return _knn(spark, sf, carry=["title", "year", "publisher"], q_carry=["publisher"])[0].withColumnRenamed("q_publisher", "publisher")


_BAL_SQL = "SELECT c_acctbal AS x FROM customer UNION ALL SELECT s_acctbal FROM supplier"


@register("knn_scaled", f"""
WITH lim AS (SELECT min(x) AS lo, max(x) AS hi FROM ({_BAL_SQL})),
q AS (SELECT c_custkey AS id, (c_acctbal - lo) / (hi - lo) AS x, c_nationkey AS nation, n_regionkey AS region
      FROM customer JOIN nation ON n_nationkey = c_nationkey, lim),
t AS (SELECT s_suppkey AS id, (s_acctbal - lo) / (hi - lo) AS x, s_nationkey AS nation, n_regionkey AS region
      FROM supplier JOIN nation ON n_nationkey = s_nationkey, lim),
c AS (SELECT q.id, t.id AS t_id, (q.x - t.x) * (q.x - t.x) + CASE WHEN q.nation = t.nation THEN 0.0 ELSE 1.0 END
             + CASE WHEN q.region = t.region THEN 0.0 ELSE 1.0 END AS distance FROM q, t)
SELECT * FROM (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, t_id) AS INT) AS rank, t_id, distance FROM c)
WHERE rank <= {KNN_K}""")
def q_knn_scaled(spark, sf):
    """Suppliers nearest to each customer by scaled balance, nation and region: users lie close, so the sorted walk is taken."""
    c, s = W.table(spark, sf, "customer"), W.table(spark, sf, "supplier")
    n = W.table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    rows = (c.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_nationkey").alias("nation"), F.lit("q").alias("side"))
            .unionByName(s.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"), F.lit("t").alias("side"))))
    rows = cut(nb.minmax_normalize(rows, "bal", out="x").join(n, "nation"))
    q, t = (rows.where(F.col("side") == side).select("id", "x", "nation", "region") for side in "qt")
    return nb.knn_topk(q, t, k=KNN_K, qid="id", user="x", attrs=["nation", "region"])


@register("knn_by_title", f"""
WITH {_KNN_CTE},
best AS (SELECT q.title, k.t_row_key, min(k.distance) AS distance FROM knn k JOIN q USING (row_key)
         GROUP BY q.title, k.t_row_key)
SELECT * FROM (SELECT title, CAST(row_number() OVER (PARTITION BY title ORDER BY distance, t_row_key) AS INT)
               AS rank, t_row_key, distance FROM best) WHERE rank <= {KNN_K}""")
def q_knn_by_title(spark, sf):
    res, q = _knn(spark, sf, q_carry=["title"])
    return nb.knn_by_title(res, q, k=KNN_K)


def _boot_sql(models: int) -> str:
    return (f"idx AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY row_key) - 1 AS idx FROM t), "
            f"nn AS (SELECT count(*) AS n FROM t), "
            f"drawn AS (SELECT m.model, ('0x' || substr(md5(CAST(m.model AS VARCHAR) || ':' || CAST(s.idx AS VARCHAR)), 1, 15))"
            f"::BIGINT % (SELECT n FROM nn) AS idx, count(*) AS copies "
            f"FROM idx s, (SELECT range AS model FROM range({models})) m GROUP BY 1, 2), "
            f"boot AS (SELECT i.*, CAST(d.model AS INT) AS model, CAST(g.copy AS BIGINT) AS copy "
            f"FROM drawn d JOIN idx i USING (idx), generate_series(1, d.copies) g(copy))")


@register("bootstrap_sample", f"WITH {_BOOKS_CTE}, {_boot_sql(1)} SELECT row_key, model, copy FROM boot")
def q_bootstrap_sample(spark, sf):
    s = nb.bootstrap_sample(W.book_training(spark, sf), "row_key", model=0)
    return s.select("row_key", "model", "copy")


@register("bootstrap_shuffled", f"""
WITH {_BOOKS_CTE}, {_boot_sql(1)}
SELECT row_key, copy, row_number() OVER (ORDER BY md5('7:' || row_key || ':' || CAST(copy AS VARCHAR)), row_key, copy) - 1 AS pos FROM boot""")
def q_bootstrap_shuffled(spark, sf):
    """The sample in a random order that can be repeated."""
    s = nb.bootstrap_sample(W.book_training(spark, sf), "row_key", model=0)
    return nb.shuffled(s.select("row_key", "copy"), ["row_key", "copy"], seed=7).select("row_key", "copy", "pos")


@register("ensemble_knn", f"""
WITH {_BOOKS_CTE}, {_boot_sql(ENSEMBLE_MODELS)},
c AS (SELECT q.row_key, t.row_key AS t_row_key, t.model AS t_model, t.copy AS t_copy, {_DIST_SQL} AS distance
      FROM q JOIN boot t ON t.user_id BETWEEN q.user_id - {_BAND} AND q.user_id + {_BAND})
SELECT * FROM (SELECT row_key, CAST(row_number() OVER (PARTITION BY row_key
       ORDER BY distance, t_row_key, t_model, t_copy) AS INT) AS rank, t_row_key, t_model, t_copy, distance FROM c)
WHERE rank <= {KNN_K}""")
def q_ensemble_knn(spark, sf):
    q, t = W.book_split(spark, sf)
    ens = nb.ensemble_training(t, "row_key", models=ENSEMBLE_MODELS)
    return nb.knn_topk(q, ens, k=KNN_K, tie=["row_key", "model", "copy"], collapse_copies=True)


@register("minmax_normalize", """
SELECT c_custkey, round((c_acctbal - (SELECT min(c_acctbal) FROM customer))
       / ((SELECT max(c_acctbal) FROM customer) - (SELECT min(c_acctbal) FROM customer)), 12) AS c_acctbal_norm
FROM customer""")
def q_minmax_normalize(spark, sf):
    c = W.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return nb.minmax_normalize(c, "c_acctbal").select(
        "c_custkey", F.round("c_acctbal_norm", 12).alias("c_acctbal_norm"))


# ---------------------------------------------------------------- formats

from ..sources import arff  # noqa: E402


def _through_arff_and_csv(spark, src, **how):
    """rows -> ARFF -> rows -> CSV -> rows (inferred types), cast back."""
    a_path, c_path = scratch_path(spark, "arff"), scratch_path(spark, "csv")
    arff.write_arff(src, a_path, relation="t", **how)
    arff.write_csv(arff.read_arff(spark, a_path), c_path)
    back = arff.read_csv_inferred(spark, c_path)
    back = cut(back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in src.schema.fields]))
    drop_scratch(spark, a_path, c_path)
    return back


@register("arff_roundtrip", "SELECT * FROM customer")
def q_arff_roundtrip(spark, sf):
    return _through_arff_and_csv(spark, W.table(spark, sf, "customer"), nominal=["c_mktsegment"])


@register("arff_roundtrip_texts", "SELECT * FROM documents")
def q_arff_roundtrip_texts(spark, sf):
    """Texts with line ends, quotes, commas and backslashes."""
    return _through_arff_and_csv(spark, W.table(spark, sf, "documents"))


# ---------------------------------------------------------------- loaders

from ..sources import delimited  # noqa: E402


@register("book_rows_io", f"SELECT user_id, location, title, author, year, publisher, count(*) AS n FROM ({_BOOK_SQL}) GROUP BY ALL")
def q_book_rows_io(spark, sf):
    """Rating rows written as ``|`` lines and read back by the loader."""
    path = scratch_path(spark, "books")
    b = W.book_rows(spark, sf)
    fields = [F.col(c) if c in b.columns else F.lit("x") for c in delimited.BOOK_FIELDS]
    delimited.write_values(b.select(F.concat_ws("|", *[f.cast("string") for f in fields]).alias("value")), path)
    back = delimited.read_book_rows(spark, path).where("_corrupt IS NULL")
    return back.groupBy("user_id", "location", "title", "author", "year", "publisher").agg(F.count("*").alias("n"))


@register("points_io", f"SELECT CAST(id AS VARCHAR) AS id, CAST(cnt AS DOUBLE) AS x FROM ({_COUNTS_SQL})")
def q_points_io(spark, sf):
    """Follower counts written as ``id<TAB>count`` lines and read as points."""
    path = scratch_path(spark, "points")
    delimited.write_separated(counting.follower_count(W.follow_edges(spark, sf)), path, "\t")
    return delimited.read_points(spark, path).where("_corrupt IS NULL").drop("_corrupt")


@register("kmeans_step_io", _kmeans_chain_sql(1))
def q_kmeans_step_io(spark, sf):
    """Centres written as a file and read by the centroid loader, then one step."""
    path = scratch_path(spark, "centres")
    counts = _counts(spark, sf)
    seeds = cluster.init_centres_df(spark, counting.max_count(counts), KMEANS_K)
    delimited.write_separated(seeds.orderBy("cid").select("center").coalesce(1), path, "\t")      # k rows
    centres = delimited.read_centroids(spark, path)
    drop_scratch(spark, path)
    return _round_sse(cluster.kmeans_step(_points(counts), centres))


@register("lexicon_io", _LARGE_SCORE_SQL.replace("WHERE tok <> ''", r"WHERE tok <> '' AND NOT regexp_matches(tok, '[\n\r\t]')"))
def q_lexicon_io(spark, sf):
    """The lexicon written as ``term<TAB>score`` lines (terms that such a line can hold), read by the loader, then scored."""
    path = scratch_path(spark, "lexicon")
    lines = _large_lexicon(spark, sf).where(~F.col("term").rlike("[\n\r\t]"))
    delimited.write_values(lines.select(F.concat_ws("\t", "term", F.col("score").cast("string")).alias("value")), path)
    return textops.sentiment_score(W.table(spark, sf, "documents"), delimited.read_lexicon(spark, path), order="line")


@register("merge_files", """
SELECT strftime(o_orderdate, '%Y-%m') AS file, string_agg(o_orderkey || '|' || o_custkey, ',' ORDER BY o_orderkey) || ',' AS merged FROM orders GROUP BY 1""")
def q_merge_files(spark, sf):
    """One folder per month of orders written by the per-file sink, its lines in key order, then merged file by file."""
    path = scratch_path(spark, "files")
    o = W.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("file"), "o_orderkey", F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("value"))
    delimited.write_per_file(o.repartition("file").sortWithinPartitions("file", "o_orderkey"), path)
    merged = folders.merge_lines(folders.read_files(spark, path))
    return merged.select(F.url_decode(F.regexp_extract("path", "file=([^/]+)/", 1)).alias("file"), "merged")
