"""Graph family: edge parsing, chain graphs, adjacency lists, PageRank with
dangling-mass redistribution, single-source shortest paths (hops) and the
MapReduce-style relaxation step over ``node dist a:b:`` lines.

Scale design
* Edges are prepared once (``prepare_graph``): out-degree by a partial
  aggregate; a node whose out-degree exceeds the per-partition share is
  *hot* and gets ``nsalt`` > 1 salts (there are at most as many hot nodes as
  partitions, so their list is broadcast); each of its edges carries
  ``salt = pmod(xxhash64(dst), nsalt)``. The edges are shuffled once, on
  ``(src, salt)``. Per-node values are
  replicated ``nsalt`` times before joining, so a node with a third of all
  edges is spread over many tasks instead of one.
* Loops cut their state with ``checkpoint()`` every step (plan stays one
  step long; a lost executor recomputes one step).
* Scalars that steer a loop (dangling mass, frontier emptiness) are one-row
  aggregates; nothing else reaches the driver.
* ``adjacency_list`` has one row per node, as the line format asks; where a
  list may outgrow a row, ``adjacency_chunks`` gives the same lists as rows
  of at most ``max_per_row`` neighbours, in order.
"""

from __future__ import annotations

import time

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..plans.loops import cut, cut_observing
from ..session import broadcast_if_small, partitions_for

# Fixed values of the reference formats.
MR_INFINITY = 10009          # stands for "unreachable" in a node line; NULL everywhere else
MAX_PER_ROW = 100_000        # neighbours per row of the chunked adjacency
COMPACT_LEVELS = 16          # BFS levels kept as tables of their own before they are merged
PIECE_SALTS = 16             # parts of a hub's pieces that its distance is sent to


# ---------------------------------------------------------------- sources

def parse_edge_lines(lines: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """``"src,dst"`` or ``"src"`` lines -> ``(src STRING, dst STRING NULL,
    _corrupt)``. A line with one field is a node without out-edge (dst NULL); a
    line with more fields or without a source is kept in ``_corrupt``."""
    parts = F.split(F.trim(F.col(col)), sep)
    src, dst = F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))
    ok = (F.size(parts) <= 2) & (F.length(src) > 0)
    return (lines.where(F.length(F.trim(F.col(col))) > 0)
            .select(F.when(ok, src).alias("src"), F.when(ok & (F.length(dst) > 0), dst).alias("dst"),
                    F.when(~ok, F.col(col)).alias("_corrupt")))


def read_edge_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Edges of edge-list text files (one edge or one lone node per line);
    ``parse_edge_lines`` also shows the corrupt lines."""
    return parse_edge_lines(spark.read.text(path), "value", sep).where("_corrupt IS NULL").drop("_corrupt")


def chain_graph(spark: SparkSession, k: int) -> DataFrame:
    """k chains of k nodes, ids 1..k^2: i -> i+1 unless i % k == 0 (dst NULL)."""
    ids = spark.range(1, k * k + 1)
    return ids.select(F.col("id").alias("src"),
                      F.when(F.col("id") % k != 0, F.col("id") + 1).alias("dst"))


def graph_nodes(edges: DataFrame) -> DataFrame:
    return (edges.select(F.col("src").alias("node"))
            .unionByName(edges.where(F.col("dst").isNotNull()).select(F.col("dst").alias("node")))
            .distinct())


def edge_lines(edges: DataFrame) -> DataFrame:
    """Inverse of ``parse_edge_lines``: one line per edge, lone nodes as ``src``."""
    return edges.select(F.concat_ws(",", F.col("src").cast("string"),
                                    F.col("dst").cast("string")).alias("value"))


# ---------------------------------------------------------------- adjacency

def adjacency_list(edges: DataFrame) -> DataFrame:
    """``(src, neighbours ARRAY)``, one row per node with an out-edge, sorted."""
    real = edges.where(F.col("dst").isNotNull())
    return real.groupBy("src").agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))


def adjacency_chunks(edges: DataFrame, max_per_row: int = MAX_PER_ROW) -> DataFrame:
    """``(src, chunk, neighbours ARRAY)``: the lists of ``adjacency_list`` cut
    into rows of at most ``max_per_row``; chunk c precedes chunk c + 1. A node's
    neighbours are numbered by a distributed sort, not gathered first."""
    from .neighbors import dense_index
    real = cut(edges.where(F.col("dst").isNotNull()).select("src", "dst"))
    at = dense_index(real, ["src", "dst"], out="_at")
    low = at.groupBy("src").agg(F.min("_at").alias("_low"))      # one row per node and task before the shuffle
    placed = at.join(low, "src").withColumn("chunk", F.floor((F.col("_at") - F.col("_low")) / F.lit(max_per_row)))
    return placed.groupBy("src", "chunk").agg(F.sort_array(F.collect_list("dst")).alias("neighbours"))


def adjacency_strings(adj: DataFrame, sep: str = ":") -> DataFrame:
    return adj.withColumn("neighbours", F.array_join(F.col("neighbours").cast("array<string>"), sep))


# ---------------------------------------------------------------- prepared graph

@dataclass
class Graph:
    edges: DataFrame   # (src, salt, dst, dst_nsalt), hash-partitioned + sorted on (src, salt), cached
    nodes: DataFrame   # (node, outdeg, nsalt), cut
    n: int             # node count

    def release(self) -> None:
        self.edges.unpersist()


def prepare_graph(edges: DataFrame, nodes: DataFrame | None = None,
                  hot_threshold: int | None = None, max_salt: int | None = None) -> Graph:
    spark = edges.sparkSession
    real = edges.where(F.col("dst").isNotNull()).select("src", "dst")
    if nodes is None:
        nodes = graph_nodes(edges)
    nodes = nodes.select(F.col("node"))
    deg = real.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("outdeg"))
    deg = cut(deg)
    total = deg.agg(F.sum("outdeg")).first()[0] or 0
    parts = partitions_for(spark, total)
    if hot_threshold is None:
        hot_threshold = max(10_000, -(-total // parts))
    max_salt = max_salt or max(parts, 1)
    nsalt = F.least(F.lit(max_salt).cast("long"),
                    F.greatest(F.lit(1).cast("long"), F.ceil(F.col("outdeg") / F.lit(hot_threshold)).cast("long")))
    node_tab = (nodes.join(deg, "node", "left")
                .select("node", F.coalesce("outdeg", F.lit(0)).cast("long").alias("outdeg"))
                .withColumn("nsalt", F.when(F.col("outdeg") > 0, nsalt).otherwise(F.lit(1).cast("long"))))
    node_tab = cut(node_tab)
    # at most one hot node per partition at the default threshold: broadcast, so no edge is shuffled on its raw keys
    hot = node_tab.where(F.col("nsalt") > 1).select("node", "nsalt")
    e = (real.join(broadcast_if_small(hot.withColumnRenamed("node", "src")), "src", "left")
         .join(broadcast_if_small(hot.select(F.col("node").alias("dst"), F.col("nsalt").alias("dst_nsalt"))), "dst", "left"))
    e = e.select("src", F.when(F.col("nsalt").isNull(), F.lit(0).cast("long"))
                 .otherwise(F.pmod(F.xxhash64("dst"), F.col("nsalt"))).alias("salt"), "dst",
                 F.coalesce(F.col("dst_nsalt"), F.lit(1).cast("long")).alias("dst_nsalt"))
    # Cut the preparation lineage, then keep the edges hash-partitioned and
    # sorted on (src, salt) in the block cache: the cache reports that
    # partitioning and order, so every iteration's join shuffles only the
    # per-node side. A lost cached block is rebuilt from the short lineage
    # (checkpoint files + one shuffle).
    e = cut(e).repartition(parts, "src", "salt").sortWithinPartitions("src", "salt")
    e = e.persist(StorageLevel.MEMORY_AND_DISK)
    e.count()
    n = node_tab.count()
    return Graph(edges=e, nodes=node_tab, n=n)


def _cut_observing(df: DataFrame, metric: Column):
    """Cut ``df``; also return one aggregate computed by that same job."""
    out, got = cut_observing(df, m=metric)
    return out, got["m"]


def _fan_out(df: DataFrame, key: str) -> DataFrame:
    """Replicate per-node rows once per salt of that node: ``(src, salt, ...)``."""
    return (df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nsalt") - 1)))
            .withColumnRenamed(key, "src"))


# ---------------------------------------------------------------- PageRank

def dangling_mass(g: Graph) -> DataFrame:
    """First-iteration dangling rank: Σ over nodes without out-edge of 1/N."""
    return g.nodes.agg((F.sum(F.when(F.col("outdeg") == 0, 1).otherwise(0)) / F.lit(float(g.n)))
                       .alias("dangling_mass"))


def pagerank(edges: DataFrame | Graph, nodes: DataFrame | None = None, iterations: int = 10,
             damping: float | None = None, split_by_outdegree: bool = True,
             hot_threshold: int | None = None, history: list | None = None,
             ticks: list | None = None) -> DataFrame:
    """``(node, pr)`` after ``iterations`` steps.

    pr' = Σ_{u->v} pr(u) / outdeg(u) + D / N, D = rank held by nodes without
    out-edge. ``split_by_outdegree=False`` is the reference rule (every
    out-edge carries the full rank); on chain graphs the two agree.
    ``damping`` d, if given: pr' = (1-d)/N + d * (...).
    """
    own = not isinstance(edges, Graph)
    g = prepare_graph(edges, nodes, hot_threshold) if own else edges
    n = float(g.n)
    # The rank held by dangling nodes is observed while each state is being
    # written (an Observation on the checkpoint job), so reading it costs no
    # extra job.
    state, dangling = _cut_observing(
        g.nodes.select("node", "outdeg", "nsalt", F.lit(1.0 / n).alias("pr")),
        F.sum(F.when(F.col("outdeg") == 0, F.col("pr"))))
    # one row a (src, salt) in place of one an edge: lists of at most the hot threshold, made where the edges lie
    lists = g.edges.groupBy("src", "salt").agg(F.collect_list("dst").alias("to")).persist(StorageLevel.MEMORY_AND_DISK)
    lists.count()
    if own:
        g.release()
    if ticks is not None:
        ticks.append(time.perf_counter())
    for _ in range(iterations):
        dangling = dangling or 0.0
        share = F.col("pr") / F.col("outdeg") if split_by_outdegree else F.col("pr")
        send = _fan_out(state.where(F.col("outdeg") > 0).select("node", "nsalt", share.alias("c")), "node")
        contrib = (lists.join(send, ["src", "salt"]).select("c", F.explode("to").alias("node"))
                   .groupBy("node").agg(F.sum("c").alias("s")))
        base = F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(dangling / n)
        if damping is not None:
            base = F.lit((1.0 - damping) / n) + F.lit(damping) * base
        state, dangling = _cut_observing(
            state.select("node", "outdeg", "nsalt").join(contrib, "node", "left")
            .select("node", "outdeg", "nsalt", base.alias("pr")),
            F.sum(F.when(F.col("outdeg") == 0, F.col("pr"))))
        if history is not None:
            history.append(state)
        if ticks is not None:
            ticks.append(time.perf_counter())
    lists.unpersist()        # the result is a checkpoint; the cached edges are no longer needed
    return state.select("node", "pr")


# ---------------------------------------------------------------- shortest paths

def sssp_hops(edges: DataFrame | Graph, source, include_unreachable: bool = False,
              max_iter: int | None = None, hot_threshold: int | None = None,
              levels: list | None = None, ticks: list | None = None) -> DataFrame:
    """Unit-weight single-source shortest paths ``(node, dist INT)``.

    As in the reference, the state starts with the source's neighbours at
    distance 1 (the source itself gets a row only if it is reachable from
    itself). Level-synchronous BFS: the frontier (nodes first reached at the
    last level) joins the salted edges, the minimum per node is taken, and
    already-visited nodes are removed by an anti-join. Stops when the
    frontier is empty, so unreachable nodes cannot make it loop forever.
    """
    own = not isinstance(edges, Graph)
    g = prepare_graph(edges, None, hot_threshold) if own else edges
    spark = g.nodes.sparkSession
    parts = partitions_for(spark, g.n)
    src_lit = F.lit(source).cast(g.nodes.schema["node"].dataType)
    # Only the new level is written; its size is observed while it is. Older
    # levels are merged into one table, partitioned on node, now and then, so
    # neither the plan nor the number of partitions grows with the depth.
    level, size = _cut_observing(
        g.edges.where(F.col("src") == src_lit)
        .groupBy(F.col("dst").alias("node")).agg(F.max("dst_nsalt").alias("nsalt"))
        .select("node", "nsalt", F.lit(1).alias("dist")),
        F.count(F.lit(1)))
    depth, held = 1, [level]
    if ticks is not None:
        ticks.append(time.perf_counter())
    while size and (max_iter is None or depth < max_iter):
        f = _fan_out(held[-1].select("node", "nsalt"), "node")
        reached = (g.edges.join(f, ["src", "salt"])
                   .groupBy(F.col("dst").alias("node")).agg(F.max("dst_nsalt").alias("nsalt")))
        new = (reached.join(_merged(held).select("node"), "node", "left_anti")
               .select("node", "nsalt", F.lit(depth + 1).alias("dist")))
        new, size = _cut_observing(new, F.count(F.lit(1)))
        depth += 1
        if len(held) >= COMPACT_LEVELS:
            held = [cut(_merged(held).repartition(parts, "node"))]
        held.append(new)
        if levels is not None:
            levels.append(depth)
        if ticks is not None:
            ticks.append(time.perf_counter())
    visited = _merged(held).select("node", "dist").coalesce(parts)
    if own:
        g.release()
    out = visited
    if include_unreachable:
        out = g.nodes.select("node").join(visited, "node", "left")
    return out.select("node", F.col("dist").cast("int").alias("dist"))


def _merged(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for d in levels[1:]:
        out = out.unionByName(d)
    return out


def farthest(dist: DataFrame) -> DataFrame:
    """The node with the largest finite distance; ties -> smallest node."""
    return (dist.where(F.col("dist").isNotNull())
            .orderBy(F.col("dist").desc(), F.col("node").asc()).limit(1))


# ---------------------------------------------------------------- MR node lines

def node_line(node: Column, dist: Column, adj: Column) -> Column:
    """``node dist a:b:``; an unreachable node (NULL) is written as infinity."""
    return F.concat_ws(" ", node.cast("string"), F.coalesce(dist, F.lit(MR_INFINITY)).cast("string"), F.coalesce(adj, F.lit("")))


def node_lines(edges: DataFrame, source, nodes: DataFrame | None = None) -> DataFrame:
    """``node dist a:b:`` lines: source at 0, others at infinity, adjacency
    sorted, trailing ``:`` (empty for nodes without out-edge)."""
    if nodes is None:
        nodes = graph_nodes(edges)
    adj = adjacency_strings(adjacency_list(edges)).select(F.col("src").alias("node"), F.concat("neighbours", F.lit(":")).alias("adj"))
    j = nodes.select("node").join(adj, "node", "left")
    return j.select(node_line(F.col("node"), F.when(F.col("node") == F.lit(source), 0), F.col("adj")).alias("value"))


def parse_node_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(node STRING, dist INT, adj, _corrupt)``: infinity becomes NULL, a line
    without a node or with a distance that is no integer goes to ``_corrupt``."""
    p = F.split(F.col(col), " ")
    node, dist = F.get(p, 0), F.get(p, 1).try_cast("int")
    ok = F.coalesce((F.length(node) > 0) & dist.isNotNull(), F.lit(False))
    return lines.select(F.when(ok, node).alias("node"), F.when(ok & (dist != MR_INFINITY), dist).alias("dist"),
                        F.when(ok, F.coalesce(F.get(p, 2), F.lit(""))).alias("adj"), F.when(~ok, F.col(col)).alias("_corrupt"))


def bfs_relax_step(lines: DataFrame, col: str = "value") -> DataFrame:
    """One relaxation over node lines -> ``(node STRING, dist, adj)``, one row
    per node: dist NULL while unreachable, adj NULL for a node without a line.

    Each line sends its own distance and ``dist + 1`` to every neighbour; per
    node the minimum and the line's adjacency are kept, in one aggregate over
    one pass of the lines. Corrupt lines are left out."""
    return _relaxed(lines, col).drop("was")


def _relaxed(lines: DataFrame, col: str = "value") -> DataFrame:
    """``bfs_relax_step`` with ``was``, the distance on the node's own line."""
    parsed = parse_node_lines(lines, col).where("_corrupt IS NULL")
    nbrs = F.filter(F.split(F.col("adj"), ":"), lambda x: x != "")
    sent = F.concat(F.array(F.struct("node", "dist", "adj", F.col("dist").alias("was"))),
                    F.transform(nbrs, lambda x: F.struct(x.alias("node"), (F.col("dist") + 1).alias("dist"), F.lit(None).cast("string").alias("adj"), F.lit(None).cast("int").alias("was"))))
    each = parsed.select(F.explode(sent).alias("s")).select("s.*")
    return each.groupBy("node").agg(F.min("dist").cast("int").alias("dist"), F.max("adj").alias("adj"), F.min("was").alias("was"))


def bfs_files(spark: SparkSession, lines: DataFrame, folder: str, on_step=None) -> DataFrame:
    """Relaxation over node-line files until no distance changes: each step reads
    the files that the one before wrote and can be resumed (see ``chained``).
    Returns ``(node STRING, dist, adj)`` as ``bfs_relax_step`` does.

    A step's lines carry the distance before it in a fourth field, so how many
    nodes changed is observed while they are written. The distance before travels
    with the node's own line (no join with the state); the files are gzipped."""
    from ..plans.chained import chain

    def step(state: DataFrame, _: int) -> DataFrame:
        return _relaxed(state).select(
            F.concat_ws(" ", node_line(F.col("node"), F.col("dist"), F.col("adj")), F.coalesce("was", F.lit(MR_INFINITY)).cast("string")).alias("value"))

    def changed(frame: DataFrame) -> dict[str, Column]:
        p = F.split("value", " ")
        return {"changed": F.sum((F.get(p, 1) != F.coalesce(F.get(p, 3), F.get(p, 1))).cast("long"))}

    done = chain(spark, folder, lambda: lines, step, lambda frame, path: frame.write.mode("overwrite").option("compression", "gzip").text(path), spark.read.text, metrics=changed,
                 until=lambda seen: not seen.get("changed"), on_step=on_step)
    return parse_node_lines(done).where("_corrupt IS NULL").select("node", "dist", F.when(F.col("adj") != "", F.col("adj")).alias("adj"))


# ---------------------------------------------------------------- node lines in pieces

def node_pieces(edges: DataFrame, source, max_per_row: int = MAX_PER_ROW, nodes: DataFrame | None = None) -> DataFrame:
    """``node piece dist a:b:`` lines: as ``node_lines``, but a node's neighbours
    stand in as many ordered lines as it takes, so that no line grows with a
    hub. A node without out-edge has one piece."""
    if nodes is None:
        nodes = graph_nodes(edges)
    chunks = adjacency_strings(adjacency_chunks(edges, max_per_row)).select(F.col("src").alias("node"), F.col("chunk").cast("long").alias("piece"), F.concat("neighbours", F.lit(":")).alias("adj"))
    j = nodes.select("node").join(chunks, "node", "left")
    dist = F.coalesce(F.when(F.col("node") == F.lit(source), 0), F.lit(MR_INFINITY))
    return j.select(F.concat_ws(" ", F.col("node").cast("string"), F.coalesce("piece", F.lit(0)).cast("string"), dist.cast("string"), F.coalesce("adj", F.lit(""))).alias("value"))


def parse_node_pieces(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(node STRING, piece LONG, dist INT, adj, _corrupt)``, as ``parse_node_lines``."""
    p = F.split(F.col(col), " ")
    node, piece, dist = F.get(p, 0), F.get(p, 1).try_cast("long"), F.get(p, 2).try_cast("int")
    ok = F.coalesce((F.length(node) > 0) & piece.isNotNull() & dist.isNotNull(), F.lit(False))
    return lines.select(F.when(ok, node).alias("node"), F.when(ok, piece).alias("piece"), F.when(ok & (dist != MR_INFINITY), dist).alias("dist"),
                        F.when(ok, F.coalesce(F.get(p, 3), F.lit(""))).alias("adj"), F.when(~ok, F.col(col)).alias("_corrupt"))


def bfs_relax_pieces(lines: DataFrame, col: str = "value") -> DataFrame:
    """One relaxation over node pieces -> ``(node STRING, piece, dist, adj)``, one
    row per piece; a node that is only a neighbour gets piece 0 and adj NULL.

    The minimum is merged in two levels: every piece sends distances, combined
    per task and node, and then each piece takes its node's minimum. No
    neighbour list is ever gathered: a hub's pieces stay apart, and all that is
    brought together for it is one distance a task. Where a node has very many
    pieces its distance is sent once to each of ``PIECE_SALTS`` parts of them."""
    parsed = parse_node_pieces(lines, col).where("_corrupt IS NULL").drop("_corrupt")
    reached = parsed.where("dist IS NOT NULL")
    sent = reached.select(F.explode(F.filter(F.split("adj", ":"), lambda x: x != "")).alias("node"), (F.col("dist") + 1).alias("dist"))
    best = sent.unionByName(reached.select("node", "dist")).groupBy("node").agg(F.min("dist").alias("dist"))
    known = parsed.select("node").distinct()
    unlisted = parsed.select(F.explode(F.filter(F.split("adj", ":"), lambda x: x != "")).alias("node")).distinct().join(known, "node", "left_anti")
    pieces = (parsed.select("node", "piece", "adj").unionByName(unlisted.select("node", F.lit(0).cast("long").alias("piece"), F.lit(None).cast("string").alias("adj")))
              .withColumn("_salt", F.pmod(F.col("piece"), F.lit(PIECE_SALTS)).cast("int")))
    salted = best.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(PIECE_SALTS - 1))))
    return pieces.join(salted, ["node", "_salt"], "left").select("node", "piece", F.col("dist").cast("int").alias("dist"), "adj")
