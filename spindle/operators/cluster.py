"""One-dimensional Lloyd k-means.

Design for scale:
* points are first collapsed to distinct ``(x, w)`` pairs with a partial
  aggregate (follower counts repeat heavily), cut once to reliable storage,
  and every iteration scans only that table;
* the k centres are a sorted literal array in the plan, searched by halving:
  assignment is a narrow projection (no join, no broadcast table) of about
  log2(k) steps per distinct point value;
* each iteration ends with a k-row aggregate collected to the driver (bounded
  by k), which becomes the next literal array; the plan never grows.

Semantics kept from the reference: the nearest centre wins with a strict
``<`` scan, i.e. on a tie the lowest index; clusters that receive no point
disappear from the next iteration; a fixed iteration count (default 10),
with an optional ``tol`` stop.
Fixed: SSE is a double and is computed per cluster (see README).
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.loops import cut
from ..session import partitions_for

UNROLLED = 32          # centres up to which the search is unrolled into conditions


def init_centres(max_value: int | float, k: int) -> list[float]:
    """Evenly spaced seeds: centre i = floor(max / k) * i, i = 1..k
    (integer division, as both operands are integers in the reference)."""
    step = int(max_value) // int(k)
    return [float(step * (i + 1)) for i in range(k)]


def init_centres_df(spark: SparkSession, max_df: DataFrame, k: int, col: str = "max_cnt") -> DataFrame:
    """Seeds as a DataFrame ``(cid INT, center DOUBLE)`` from a one-row max."""
    mx = max_df.select(F.col(col).cast("long")).first()[0]
    step = int(mx) // int(k)
    return spark.range(k).select(F.col("id").cast("int").alias("cid"),
                                 ((F.col("id") + 1) * F.lit(step)).cast("double").alias("center"))


def weighted_points(points: DataFrame, col: str = "x") -> DataFrame:
    """Distinct point values with their multiplicity ``w``."""
    return (points.where(F.col(col).isNotNull())
            .groupBy(F.col(col).cast("double").alias("x"))
            .agg(F.count(F.lit(1)).alias("w")))


def _doubles(values: list[float]) -> Column:
    """A literal array (one constant in the plan, whatever its length)."""
    return F.lit([float(v) for v in values]) if len(values) < 64 else F.from_json(F.lit(json.dumps([float(v) for v in values])), "array<double>")


def _unrolled(x: Column, values: list[float], ids: list[int], low: int, high: int) -> Column:
    """The halving as nested conditions (these are code-generated): the first centre >= x lies in low..high."""
    if low < high:
        mid = (low + high) // 2
        return F.when(x > values[mid], _unrolled(x, values, ids, mid + 1, high)).otherwise(_unrolled(x, values, ids, low, mid))
    if low == 0:
        return F.lit(ids[0])
    if low == len(values):
        return F.lit(ids[-1])
    left, right = F.abs(x - F.lit(values[low - 1])), F.abs(x - F.lit(values[low]))
    nearer = left <= right if ids[low - 1] < ids[low] else left < right
    return F.when(nearer, ids[low - 1]).otherwise(ids[low])


def nearest(x: Column, centres: list[float]) -> Column:
    """Index of the nearest centre; ties go to the lowest index.

    The centres are sorted (of equal ones the lowest index stays). Halving finds
    the first centre >= x; the nearest is that one or the one before."""
    if not centres:
        raise ValueError("no centres")
    first: dict[float, int] = {}
    for i, c in enumerate(centres):
        first.setdefault(float(c), i)
    values = sorted(first)
    if len(values) <= UNROLLED:
        return F.when(x.isNotNull(), _unrolled(x, values, [first[v] for v in values], 0, len(values)).cast("int"))
    arr = _doubles(values)
    low, high = F.lit(0), F.lit(len(values))
    start = F.struct(low.alias("low"), high.alias("high"))

    def halve(s, _):
        mid = F.floor((s.low + s.high) / 2).cast("int")
        right = (s.low < s.high) & (F.get(arr, mid) < x)
        return F.struct(F.when(right, mid + 1).otherwise(s.low).alias("low"), F.when(right | (s.low >= s.high), s.high).otherwise(mid).alias("high"))

    steps = F.sequence(F.lit(1), F.lit(max(1, len(values).bit_length())))
    at = F.aggregate(steps, start, halve, lambda s: s.low)
    ids = F.lit([first[v] for v in values]) if len(values) < 64 else F.from_json(F.lit(json.dumps([first[v] for v in values])), "array<int>")

    def pick(p: Column) -> Column:
        left, right = F.get(arr, p - 1), F.get(arr, p)
        dl, dr = F.abs(x - left), F.abs(x - right)
        use_left = right.isNull() | (left.isNotNull() & ((dl < dr) | ((dl == dr) & (F.get(ids, p - 1) < F.get(ids, p)))))
        return F.when(use_left, F.get(ids, p - 1)).otherwise(F.get(ids, p)).cast("int")

    # the search result is bound once by a one-element transform
    return F.when(x.isNotNull(), F.get(F.transform(F.array(at), pick), 0))


def assign(points: DataFrame, centres: list[float], col: str = "x") -> DataFrame:
    """Each point with its nearest centre: ``(..., cid, center)``."""
    cid = nearest(F.col(col).cast("double"), centres)
    return points.withColumn("cid", cid).withColumn("center", F.get(_doubles(centres), F.col("cid")))


def _update(wp: DataFrame, centres: list[float]) -> list[tuple[int, float, int]]:
    """One Lloyd update: ``[(old_cid, new_center, n), ...]`` for non-empty clusters."""
    rows = (wp.select("x", "w", nearest(F.col("x"), centres).alias("cid"))
            .groupBy("cid").agg(F.sum(F.col("w") * F.col("x")).alias("sx"), F.sum("w").alias("n"))
            .collect())  # at most k rows
    rows = sorted(rows, key=lambda r: r["cid"])
    return [(r["cid"], r["sx"] / r["n"], r["n"]) for r in rows]


def _summary(wp: DataFrame, prev: list[float], upd: list[tuple[int, float, int]]) -> DataFrame:
    """``(cid, center, n, sse)`` for the clusters formed with ``prev`` centres,
    ``center`` being their new mean. SSE is an exact second pass."""
    place = {oc: i for i, (oc, _, _) in enumerate(upd)}
    new_id = _doubles([place.get(i, -1) for i in range(len(prev))])
    a = wp.select("x", "w", nearest(F.col("x"), prev).alias("oc")).select("x", "w", F.get(new_id, F.col("oc")).cast("int").alias("cid"))
    a = a.withColumn("center", F.get(_doubles([c for _, c, _ in upd]), F.col("cid")))
    return (a.groupBy("cid", "center")
            .agg(F.sum("w").alias("n"),
                 F.sum(F.col("w") * F.pow(F.col("x") - F.col("center"), 2)).alias("sse")))


def kmeans_step(points: DataFrame, centres: list[float], col: str = "x") -> DataFrame:
    """One iteration from ``centres``: ``(cid, center, n, sse)``."""
    wp = weighted_points(points, col)
    return _summary(wp, centres, _update(wp, centres))


def kmeans_1d(points: DataFrame, centres: list[float], iterations: int = 10, col: str = "x",
              tol: float | None = None, history: list | None = None, ticks: list | None = None) -> DataFrame:
    """Lloyd iterations; returns the last iteration's ``(cid, center, n, sse)``."""
    wp = cut(weighted_points(points, col))
    if ticks is not None:
        ticks.append(time.perf_counter())
    prev, upd = list(centres), None
    for it in range(iterations):
        upd = _update(wp, prev)
        if ticks is not None:
            ticks.append(time.perf_counter())
        new = [c for _, c, _ in upd]
        if history is not None:
            history.append(new)
        last = it == iterations - 1
        moved = max((abs(a - b) for a, b in zip(new, [prev[oc] for oc, _, _ in upd])), default=0.0)
        if last or (tol is not None and moved <= tol and len(new) == len(prev)):
            break
        prev = new
    return _summary(wp, prev, upd)


def kmeans_files(points: DataFrame, centres: DataFrame, folder: str, iterations: int = 10, col: str = "x", on_step=None) -> DataFrame:
    """Lloyd iterations whose centres are files: each step reads the centre lines
    (``cid<TAB>center``) that the one before wrote and writes the next ones; a
    loop that was cut off goes on from its last whole step (see ``chained``).
    Centres are joined as rows (``nearest_join``), so their number is not bound
    by the driver. Returns ``(cid, center)`` of the last step."""
    from ..plans.chained import chain
    spark = points.sparkSession
    wp = cut(weighted_points(points, col))

    def read(path: str) -> DataFrame:
        return spark.read.schema("cid LONG, center DOUBLE").option("sep", "\t").csv(path)

    def step(state: DataFrame, _: int) -> DataFrame:
        met = nearest_join(wp, state, "x", "center", "cid")
        return met.groupBy("cid").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("center"))

    return chain(spark, folder, lambda: centres.select(F.col("cid").cast("long").alias("cid"), "center"), step,
                 lambda frame, path: frame.write.mode("overwrite").option("sep", "\t").csv(path), read, metrics=lambda f: {"centres": F.count(F.lit(1))}, n=iterations, on_step=on_step)


def nearest_join(points: DataFrame, centres: DataFrame, x: str = "x", centre: str = "center", cid: str = "cid") -> DataFrame:
    """``points`` with ``cid`` and ``center`` of the nearest centre, ties going to
    the lowest ``cid``; for centres too many for the plan or the driver.

    Distinct points and centres are range-partitioned and sorted together once.
    Within a part a running window gives each point the centre at or before it, and
    one in falling order the centre after it (both grow row by row, so a part costs
    one pass each); the outermost centres of each part (one
    row a part) are carried over to the parts beside it. Points without a value,
    and all points if there are no centres, get NULLs."""
    spark = points.sparkSession
    c = centres.where(F.col(centre).isNotNull()).groupBy(F.col(centre).cast("double").alias("_x")).agg(F.min(cid).alias("_c"))
    p = points.where(F.col(x).isNotNull()).select(F.col(x).cast("double").alias("_x")).distinct()
    both = c.select("_x", F.struct(F.col("_x").alias("at"), F.col("_c").alias("id")).alias("_here")).unionByName(p.select("_x"), allowMissingColumns=True)
    size = both.groupBy("_x").agg(F.first("_here", ignorenulls=True).alias("_here"))         # a point on a centre is one row with it
    size = cut(size)
    parts = partitions_for(spark, size.count(), 64)
    placed = cut(size.repartitionByRange(parts, "_x").withColumn("_part", F.spark_partition_id()))
    left = Window.partitionBy("_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    right = Window.partitionBy("_part").orderBy(F.col("_x").desc()).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumns({"_low": F.last("_here", ignorenulls=True).over(left), "_high": F.last("_here", ignorenulls=True).over(right)})
    edges = placed.groupBy("_part").agg(F.max("_here").alias("_max"), F.min("_here").alias("_min"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    carried = edges.select("_part", F.max("_max").over(before).alias("_before"), F.min("_min").over(after).alias("_after"))       # one row a part
    met = within.join(F.broadcast(carried), "_part").select("_x", F.coalesce("_low", "_before").alias("_low"), F.coalesce("_high", "_after").alias("_high"))
    gap_low, gap_high = F.col("_x") - F.col("_low.at"), F.col("_high.at") - F.col("_x")
    use_low = F.col("_high").isNull() | (F.col("_low").isNotNull() & ((gap_low < gap_high) | ((gap_low == gap_high) & (F.col("_low.id") <= F.col("_high.id")))))
    best = F.when(use_low, F.col("_low")).otherwise(F.col("_high"))
    found = met.select(F.col("_x").alias("_px"), best.alias("_best"))
    return (points.join(found, F.col(x).cast("double") == F.col("_px"), "left")
            .select(*points.columns, F.col("_best.id").alias(cid), F.col("_best.at").alias(centre)))
