"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. Angles obey the
triangle inequality, so the angle of two rows lies between the largest
difference and the smallest sum of their angles to one reference; the cosines
of these limits, times both norms, bound their inner product. The bounds are
rounded outwards (``SLACK``), and only rows whose bounds overlap a wanted score
window get an integer score; the score decides.

1. Rows become integers (``SCALE`` times a component, floored), with norm and
   angles, and are packed into blocks of similar rows: range-partitioned and
   sorted by nearest reference, angle to it, and a hash (so that very many equal
   vectors spread over blocks).
2. Anchors are packed into blocks too and meet every block of rows: the stated
   queries against all rows, in blocks. First each anchor takes its best rows of
   the same label; a row whose upper bound is below the n-th largest lower
   bound of its block is not scored.
3. Each positive gives a score window. In a second pass rows of other labels
   whose bounds overlap one of an anchor's windows are scored.
4. Each block gives at most the wanted number of rows per anchor or window;
   these are ranked over all blocks by a window that limits before it shuffles.

No row is capped or left out: bounds only skip what cannot be in the result.
Nothing but the references, picked from ``SAMPLE`` rows, goes through the
driver; they decide speed, not results.

Defined cases: rows with a null label or vector, or a null or non-finite
component, take no part; a null key is no anchor, ranks last among ties and has
a null id in the result; rows that bear the anchor's key are the anchor, other
repeated rows count each; missing trailing components are 0; an anchor without
other rows of its label gives no rows; an empty table gives none. Scores are 64
bits: norms must multiply to less than 2^63 (float32 components below 10^6 with
a few thousand dimensions do). Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.session import partitions_for

from .runtime import on_workers, written

SCALE = 256
REFERENCES = 8
SAMPLE = 2_000            # rows that references are picked from
BLOCK_ROWS = 2_048
BLOCK_BYTES = 1 << 20
SLACK = 1e-6              # of the product of norms: far above the rounding of angles and cosines
_EXACT = float(1 << 53)
_NO_KEY = np.iinfo(np.int64).max

# A block of rows: their values side by side; anchors also have score windows (lowest and highest score of each).
_NAMES = ["dims", "n", "ids", "keys", "nulls", "labels", "vectors", "norms", "angles", "windows"]
_FIELDS = "dims int, n int, " + ", ".join(f"{c} binary" for c in _NAMES[2:])


def _integers(vector: str) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))


def _usable(label: str, vector: str) -> Column:
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and edges of a list column."""
    edges = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False).astype(np.int64), edges.astype(np.int64)


def _angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    d = min(vectors.shape[1], references.shape[1])
    cosines = (vectors[:, :d].astype(float) @ references[:, :d].T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def pick_references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """Unit directions far from each other: the first of a sample (by hash),
    then each time the one whose largest cosine to those taken is smallest."""
    some = rows.orderBy(F.xxhash64("key", "vec"), "key").limit(sample).select("vec").toArrow().column("vec").combine_chunks()
    values, edges = _lists(some)
    wide = int(np.diff(edges).max(initial=1))
    dense = np.zeros((len(edges) - 1, max(1, wide)))
    for r, (a, b) in enumerate(zip(edges, edges[1:])):
        dense[r, :b - a] = values[a:b]
    norms = np.linalg.norm(dense, axis=1)
    dense = dense[norms > 0] / norms[norms > 0][:, None]
    if not len(dense):
        return np.eye(1, max(1, wide))
    taken, closest = [0], dense @ dense[0]
    while len(taken) < min(count, len(dense)):
        taken.append(int(np.argmin(closest)))
        closest = np.maximum(closest, dense @ dense[taken[-1]])
    return dense[taken]


def _measure(batches, references):
    for batch in batches:
        values, edges = _lists(batch.column(2))
        near, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
        for d in np.unique(np.diff(edges)):
            held = np.flatnonzero(np.diff(edges) == d)
            v = values[edges[held][:, None] + np.arange(d)]
            angles = _angles(v, np.sqrt((v.astype(float) ** 2).sum(axis=1)), references)
            near[held] = angles.argmin(axis=1)
            angle[held] = angles.min(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(edges).astype(np.int32)), pa.array(near), pa.array(angle)],
                                         names=["key", "label", "vec", "anchor", "dims", "near", "angle"])


def _pack(batches, references):
    """Rows in order -> blocks of rows with equally many components."""
    held, rows, dims = [], 0, -1

    def block():
        ids, keys, nulls, labels, v, windows = (np.concatenate([h[k] for h in held]) for k in range(6))
        norms = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        arrays = (ids, keys, nulls, labels, v, norms, _angles(v, norms, references), windows)
        return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], names=_NAMES)

    for batch in batches:
        values, edges = _lists(batch.column(3))
        limits, ends = _lists(batch.column(4))
        ids, labels = batch.column(0).to_numpy().astype(np.int64), batch.column(2).to_numpy().astype(np.int64)
        nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        keys = batch.column(1).fill_null(_NO_KEY).to_numpy().astype(np.int64)
        size, lo = np.diff(edges), 0
        while lo < batch.num_rows:
            d = int(size[lo])
            most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 8 * d)))
            if held and (d != dims or rows >= most):
                yield block()
                held, rows = [], 0
            dims = d
            other = np.flatnonzero(size[lo:] != d)
            hi = min(lo + (int(other[0]) if len(other) else batch.num_rows - lo), lo + most - rows)
            held.append((ids[lo:hi], keys[lo:hi], nulls[lo:hi], labels[lo:hi], values[edges[lo]:edges[hi]].reshape(hi - lo, d), limits[ends[lo]:ends[hi]]))
            rows, lo = rows + hi - lo, hi
    if held:
        yield block()


class _Block:
    def __init__(self, row: dict):
        n, d = row["n"], row["dims"]
        self.ids, self.keys = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["keys"], np.int64)
        self.nulls, self.labels = np.frombuffer(row["nulls"], bool), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(n, d)
        self.norms = np.frombuffer(row["norms"])
        self.angles = np.frombuffer(row["angles"]).reshape(n, -1)
        self.windows = np.frombuffer(row["windows"], np.int64).reshape(n, -1, 2)
        self.floats = self.vectors.astype(float)

    def bounds(self, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Score bounds of all rows against one vector, rounded outwards."""
        least = np.abs(self.angles - angles).max(axis=1)
        most = np.minimum((self.angles + angles).min(axis=1), 2 * np.pi - (self.angles + angles).max(axis=1))
        size = self.norms * norm
        slack = size * SLACK + 1
        return size * np.cos(np.minimum(np.maximum(most, least), np.pi)) - slack, size * np.cos(least) + slack

    def scores(self, held: np.ndarray, vector: np.ndarray, norm: float) -> np.ndarray:
        d = min(self.vectors.shape[1], len(vector))
        if self.norms.max(initial=0.0) * norm < _EXACT / 2:          # every partial sum of such floats is exact
            return (self.floats[held, :d] @ vector[:d].astype(float)).astype(np.int64)
        return self.vectors[held, :d] @ vector[:d]


def _cells(batches):
    last, rows = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(j)[k].as_py() for j, c in enumerate(batch.schema.names)}
            if row["block"] != last:
                rows, last = _Block(row), row["block"]
            yield rows, _Block({c: row["a_" + c] for c in _NAMES})


def _first(keys: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores; ties by smaller key."""
    if len(scores) > n:
        limit = np.partition(scores, len(scores) - n)[len(scores) - n]
        some = np.flatnonzero(scores >= limit)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort([keys[some], -scores[some]])[:n]]


def _table(found: list, names: list[str]) -> pa.RecordBatch:
    """The last column holds which keys, in the column before, are null."""
    columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(len(names) + 1)]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:-2]), pa.array(columns[-2], pa.int64(), mask=columns[-1].astype(bool))], names=names)


def _positives(batches, n: int):
    for rows, anchors in _cells(batches):
        found = []
        for a in range(len(anchors.ids)):
            same = np.flatnonzero((rows.labels == anchors.labels[a]) & ((rows.keys != anchors.keys[a]) | rows.nulls))
            if not len(same):
                continue
            low, high = (x[same] for x in rows.bounds(anchors.angles[a], anchors.norms[a]))
            if len(same) > n:
                same = same[high >= np.partition(low, len(low) - n)[len(low) - n]]
            scores = rows.scores(same, anchors.vectors[a], anchors.norms[a])
            best = _first(rows.keys[same], scores, n)
            held = same[best]
            found.append((np.full(len(best), anchors.ids[a]), scores[best], rows.keys[held], rows.nulls[held]))
        yield _table(found, ["anchor", "score", "key"])


def _negatives(batches, n: int):
    for rows, anchors in _cells(batches):
        found = []
        for a in range(len(anchors.ids)):
            low, high = rows.bounds(anchors.angles[a], anchors.norms[a])
            windows = [(w, lo, hi) for w, (lo, hi) in enumerate(anchors.windows[a].tolist()) if lo <= hi]
            fits = np.zeros(len(low), bool)
            for _, lo, hi in windows:
                fits |= (high >= lo) & (low <= hi)
            held = np.flatnonzero(fits & (rows.labels != anchors.labels[a]) & ((rows.keys != anchors.keys[a]) | rows.nulls))
            if not len(held):
                continue
            scores = rows.scores(held, anchors.vectors[a], anchors.norms[a])
            for w, lo, hi in windows:
                inside = np.flatnonzero((scores >= lo) & (scores <= hi))
                best = inside[_first(rows.keys[held[inside]], scores[inside], n)]
                found.append((np.full(len(best), anchors.ids[a]), np.full(len(best), w + 1), scores[best], rows.keys[held[best]], rows.nulls[held[best]]))
        yield _table(found, ["anchor", "place", "score", "key"])


def mine(spark: SparkSession, vectors: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, references: int = REFERENCES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each row for which ``anchors`` holds and each of its first ``positives``
    rows of the same label, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score."""
    on_workers(spark)
    rows = (vectors.where(_usable(label, vector))
            .select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), _integers(vector).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor")))
    rows, _ = written(spark, rows, "integers")
    directions = spark.sparkContext.broadcast(pick_references(rows, references))       # a few vectors
    measured = rows.mapInArrow(lambda b: _measure(b, directions.value), "key long, label long, vec array<long>, anchor boolean, dims int, near int, angle double")
    measured, _ = written(spark, measured.withColumn("id", F.monotonically_increasing_id()), "measured")
    total, volume = measured.agg(F.count("*"), F.sum("dims")).first()
    row_bytes = 64 + 8 * (volume or 0) // max(1, total)
    parts = max(partitions_for(spark, total, row_bytes), -(-total * row_bytes // (4 * BLOCK_BYTES)))

    def blocks(frame: DataFrame, parts: int) -> DataFrame:
        order = ["dims", "near", "angle", "spread"]
        in_order = frame.withColumn("spread", F.xxhash64("key", "vec")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        return in_order.select("id", "key", "label", "vec", "windows").mapInArrow(lambda b: _pack(b, directions.value), _FIELDS)

    none = F.array().cast("array<long>")
    data, _ = written(spark, blocks(measured.withColumn("windows", none), parts).withColumn("slot", F.spark_partition_id()).withColumn("block", F.monotonically_increasing_id()), "rows")
    slots = data.agg(F.max("slot")).first()[0]
    asked = measured.where("anchor")
    some = max(1, -(-asked.count() // BLOCK_ROWS))

    def cells(queries: DataFrame) -> DataFrame:
        """Every block of anchors beside every block of rows: the anchors travel to each slot of rows, by an equal join."""
        each, _ = written(spark, blocks(queries, some).select(*[F.col(c).alias("a_" + c) for c in _NAMES]), "anchors")
        to = each.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots or 0)))).repartition(parts, "slot")
        return data.repartition(parts, "slot").join(to, "slot").drop("slot")

    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    found = cells(asked.withColumn("windows", none)).mapInArrow(lambda b: _positives(b, positives), "anchor long, score long, key long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    best, _ = written(spark, found.withColumn("place", place).where(F.col("place") <= positives), "positives")

    window = F.struct("place", F.expr(f"CAST(ceil(({low}) * CAST(score AS DECIMAL(20, 0)) / 100) AS LONG)").alias("lo"), F.expr(f"CAST(floor(({high}) * CAST(score AS DECIMAL(20, 0)) / 100) AS LONG)").alias("hi"))
    per_anchor = best.groupBy(F.col("anchor").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("place", window.alias("w")))).alias("by"))     # at most ``positives``
    limits = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda p: F.array(F.coalesce(F.element_at("by", p).lo, F.lit(1)), F.coalesce(F.element_at("by", p).hi, F.lit(0)))))
    ready = asked.join(per_anchor, "id").withColumn("windows", limits)
    hard = cells(ready).mapInArrow(lambda b: _negatives(b, negatives), "anchor long, place long, score long, key long")
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*order))
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    about = best.join(asked.select(F.col("id").alias("anchor"), F.col("key").alias("anchor_id")), "anchor")
    return (hard.select("anchor", "place", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(about.select("anchor", "place", "anchor_id", F.col("key").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "place"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
