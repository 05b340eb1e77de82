"""Near-duplicate groups by Order MinHash with banded alignment.

Texts become sequences of words and then of 5-word shingles; equal shingles of
a text are told apart by their occurrence number. One Order MinHash sketch
takes the ``PICKED`` smallest of a text's labelled shingles under one random
order and keeps them in text order, so two texts share it when they hold the
same shingles in the same order: likelier the smaller their edit distance. A
text has ``SKETCHES`` such sketches; texts that share one are candidates.

Candidates are verified by an alignment of their labelled shingle sequences,
banded: with similarity s a shingle can be shifted by at most the number of
shingles that may be unmatched. Since labelled shingles are distinct within a
text, the alignment is a longest increasing run of places. Similarity is
m / (a + b - m) for m aligned of a and b shingles (the Jaccard similarity that
keeps order); pairs of 0.8 or more are links, and classes are the connected
components of the links.

No group is expanded into all its pairs:

1. Texts with equal words are one node (smallest id), counted, not paired.
2. In every bucket (texts that share a sketch) each node is paired with one
   leader, drawn by a hash of bucket and id. A family of near copies meets as
   many leaders as it has sketches, so its links connect it however large it
   is. In buckets of up to ``PAIRED`` nodes all pairs are taken. Two sketches
   are dealt first; in the others only nodes of another class than the leader's
   are paired, so a family costs about two pairs a node.
3. Verified links become components. Larger buckets whose nodes still lie in
   several components are dealt anew by ``TOGETHER`` sketches at once and go
   through step 2 again, without pairs tried before or already in one component.
4. What stands in larger buckets of several components even then goes through
   the prefixes of a set-similarity join: the rarest labelled shingles of a
   text, of which a similar pair has one in common, with length and positional
   filters. A shingle of up to ``PAIRED`` nodes gives all its pairs: copies made
   from one another share shingles that the rest of a family lacks, and are
   always found here. At a more frequent shingle each node meets one leader a
   turn, drawn anew each time; there are ``TURNS`` turns, fewer if one brings no
   new link. So a turn has at most one pair an entry.
5. The turns only make classes larger and the rest smaller; the rest is exact.
   Nodes at frequent shingles that several classes still share are dealt into
   blocks of about ``BLOCK`` nodes; any two blocks with such a shingle in common
   meet once, and all their pairs of different classes are compared there by
   the number of common shingles and, if that suffices, by alignment. So of the
   nodes of step 4 no similar pair is left apart. A family whose texts truly
   stay apart is compared pair by pair, each pair once: its time grows with the
   square of its size, its memory does not (two blocks a group).

The largest groups of a deal are joined by broadcast (their number is bounded),
and a leader's text is sent to groups of its pairs, so no bucket and no leader
meets in one task.

Everything runs over all rows and whole texts; tables, links and components
stay in Spark.

Defined cases: rows whose id or text is null, and texts without words, are
classes of their own; a text of fewer than five words, but not none, has one
shingle; repeated rows (equal id, equal words) are one node and get the same
class; an empty table gives no rows; other columns of ``docs`` are kept by
``keep_one`` and not looked at elsewhere.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .runtime import drop_path, few_tasks, on_workers, released, written

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKED = 2
PAIRED = 16
FIRST = 2                       # sketches dealt before the others
TOGETHER = 4                    # sketches that larger buckets are dealt by anew
TURNS = 2                       # leaders that a node meets at a frequent shingle in step 4
BLOCK = 512                     # nodes of a block in step 5
BLOCK_SHINGLES = 1 << 18        # their shingles, 8 bytes each
OWN = 64                        # nodes of one class at a shingle that get blocks of their own
COLUMNS = 1024                  # shingles counted at a time
LED = 256                       # pairs of a leader that its text is sent to at a time
TASK_PAIRS = 1_000              # pairs aligned in a task, if there are fewer than partitions would hold
HOT_LEADERS = 100_000           # ids with a number
HOT_GROUPS = 2_000              # largest groups, a few dozen bytes each
ENTRIES = 50_000                # prefix entries in an Arrow batch
BROADCAST_ROWS = 500_000        # ids, 8 bytes each
SLOTS = 1 << 20                 # counts of shingles, 8 bytes each
CHUNK_BYTES = 1 << 18           # texts sketched at a time; a worker keeps the memory of its largest slice
WORDS_COLUMN = "spindle_words"

_SEEDS = np.random.RandomState(71).randint(1, 2**62, 256).astype(np.uint64)


def _labelled(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shingle hashes that also tell the occurrence number within the row."""
    keyed = at.mix(h ^ (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = keyed[order[1:]] == keyed[order[:-1]]
    begin = np.maximum.accumulate(np.where(~same, np.arange(len(order)), 0)) if len(order) else np.zeros(0, np.int64)
    nth = np.empty(len(order), np.uint64)
    nth[order] = (np.arange(len(order)) - begin).astype(np.uint64)
    return at.mix(h + nth * np.uint64(0xD1342543DE82EF95))


def _sketches(labelled: np.ndarray, row: np.ndarray, rows: int, sketches: int, picked: int) -> np.ndarray:
    """[row, sketch] keys; rows without shingles get 0."""
    out = np.zeros((rows, sketches), np.uint64)
    if not len(labelled):
        return out
    some, begin = np.unique(row, return_index=True)
    group = np.repeat(np.arange(len(some)), np.diff([*begin, len(row)]))
    last = np.uint64(2**64 - 1)
    for k in range(sketches):
        v = labelled ^ _SEEDS[k]
        v = v * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        place, value = np.empty((picked, len(some)), np.int64), np.empty((picked, len(some)), np.uint64)
        for j in range(picked):
            low = np.minimum.reduceat(v, begin)
            at_ = np.flatnonzero(v == low[group])
            _, one = np.unique(group[at_], return_index=True)
            at_ = at_[one]
            place[j], value[j] = at_, low
            v[at_] = last
        # text order; a row with fewer shingles than picked repeats the marker value at its own end
        ordered = np.argsort(np.where(value == last, np.iinfo(np.int64).max, place), axis=0, kind="stable")
        key = np.full(len(some), k + 1, np.uint64)
        for j in range(picked):
            key = at.mix(key * np.uint64(0xD6E8FEB86659FD93) + value[ordered[j], np.arange(len(some))])
        out[some, k] = key
    return out


def _digests(w: at.Words) -> pa.Array:
    """128-bit digest of each row's word sequence, null if it has no words."""
    return pa.array([hashlib.blake2b(w.hash[a:b].tobytes(), digest_size=16).digest() if b > a else None
                     for a, b in zip(w.first, w.first[1:])], pa.binary())


def _sketch_batches(batches, sketches: int, picked: int):
    for batch in batches:
        for part in at.slices(batch.column(1), CHUNK_BYTES):
            w = at.words(part)
            n = part.hi - part.lo
            h, row, _ = at.shingles(w, WORDS)
            keys = _sketches(_labelled(h, row), row, n, sketches, picked)
            flat = pa.array(keys.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.lo, n), _digests(w), pa.array(np.bincount(row, minlength=n), pa.int64()),
                pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * sketches, flat)], names=["id", "words", "shingles", "keys"])


def sketch(spark: SparkSession, docs: DataFrame, key: str, text: str, sketches: int = SKETCHES, picked: int = PICKED) -> DataFrame:
    """id, words (digest of the word sequence, null if none), shingles, keys (the sketches)."""
    on_workers(spark)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(
        lambda b: released(_sketch_batches(b, sketches, picked)), f"id {kind}, words binary, shingles long, keys array<long>")


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> float:
    """Similarity of two labelled shingle sequences by banded alignment; 0 if
    they cannot reach ``similarity``."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) < similarity * len(b):
        return 0.0
    need = int(np.ceil(similarity * (len(a) + len(b)) / (1 + similarity) - 1e-9))
    order = np.argsort(b)
    found = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    place = order[found]
    ok = b[place] == a
    shift = place - np.arange(len(a))
    ok &= (shift >= -(len(a) - need)) & (shift <= len(b) - need)           # the band
    place = place[ok]
    if len(place) < need:
        return 0.0
    if (np.diff(place) > 0).all():
        m = len(place)
    else:
        tails: list[int] = []
        for p in place.tolist():
            k = bisect_left(tails, p)
            if k == len(tails):
                tails.append(p)
            else:
                tails[k] = p
        m = len(tails)
    s = m / (len(a) + len(b) - m)
    return s if m >= need else 0.0


def _sequences(column):
    for part in at.slices(column, CHUNK_BYTES):
        h, row, _ = at.shingles(at.words(part), WORDS)
        v = _labelled(h, row)
        edge = np.searchsorted(row, np.arange(part.hi - part.lo + 1))
        for a, b in zip(edge, edge[1:]):
            yield v[a:b]


def _verify(batches, similarity):
    for batch in batches:
        pairs = [aligned(x, y, similarity) for x, y in zip(_sequences(batch.column(2)), _sequences(batch.column(3)))]
        table = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pairs, pa.float64())], names=["a", "b", "similarity"])
        yield table.filter(pa.array(np.array(pairs, float) >= similarity))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, rows: int | None = None) -> DataFrame:
    """The pairs (a, b) whose texts align; ``texts`` has id and text, ``pairs`` also
    ``lead``, the one of the two that may stand in many pairs. A leader's pairs
    are dealt into groups of about ``LED`` and its text goes once to each group.
    ``rows``: the number of pairs, if known."""
    kind = pairs.schema["a"].dataType.simpleString()
    led, _ = written(pairs.sparkSession, pairs.groupBy("lead").agg(F.ceil(F.count("*") / F.lit(LED)).cast("int").alias("groups")), "led", rows)
    each = pairs.select("lead", F.when(F.col("lead") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("other"))
    hot = led.where("groups > 1")
    few = hot.limit(HOT_LEADERS + 1).count() <= HOT_LEADERS
    each = each.join(F.broadcast(hot) if few else hot, "lead", "left").withColumn("part", F.pmod(F.xxhash64("other"), F.coalesce("groups", F.lit(1))).cast("int")).drop("groups")
    leaders = texts.join(led, texts["id"] == led["lead"]).select("lead", F.col("text").alias("tl"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    both = (each.join(texts.select(F.col("id").alias("other"), F.col("text").alias("to")), "other").join(leaders, ["lead", "part"])
            .select(F.least("lead", "other").alias("a"), F.greatest("lead", "other").alias("b"), "tl", "to"))
    return (few_tasks(both, rows, TASK_PAIRS)
            .mapInArrow(lambda batches: released(_verify(batches, similarity)), f"a {kind}, b {kind}, similarity double"))


def _counts(batches):
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for v in _sequences(batch.column(0)):
            np.add.at(total, (v & np.uint64(SLOTS - 1)).astype(np.int64), 1)
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], names=["slot", "n"])


def _prefixes(batches, similarity, counts):
    """Each text's rarest labelled shingles: as many as the longer text of a
    similar pair needs; ``short`` marks those that the shorter one needs."""
    names = ["shingle", "place", "short", "size", "row"]
    for batch in batches:
        found = []
        for k, v in enumerate(_sequences(batch.column(2))):
            v = v[np.lexsort([v, counts[(v & np.uint64(SLOTS - 1)).astype(np.int64)]])]
            n = len(v)
            rare = v[:n - int(np.ceil(similarity * n - 1e-9)) + 1]
            place = np.arange(len(rare))
            found.append((rare.view(np.int64), place, place <= n - np.ceil(2 * similarity / (1 + similarity) * n - 1e-9), np.full(len(rare), n), np.full(len(rare), k)))
            if sum(len(f[0]) for f in found) > ENTRIES or k == batch.num_rows - 1:
                columns = dict(zip(names, (pa.array(np.concatenate(x)) for x in zip(*found))))
                found = []
                row = columns.pop("row")
                yield pa.RecordBatch.from_arrays([*columns.values(), batch.column(0).take(row), batch.column(1).take(row)], names=[*columns, "id", "class"])


def prefix_entries(spark: SparkSession, texts: DataFrame, similarity: float) -> DataFrame:
    """(shingle, place, short, size, id): the prefixes of ``texts`` (id, class,
    text), without shingles that stand in one class only or that no shorter
    text of a pair needs. A similar pair has a shingle in common here."""
    kind = texts.schema["id"].dataType.simpleString()
    counted = texts.select("text").mapInArrow(lambda batches: released(_counts(batches)), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    sent = spark.sparkContext.broadcast(counts)
    entries, _ = written(spark, texts.select("id", "class", "text").mapInArrow(
        lambda batches: released(_prefixes(batches, similarity, sent.value)), f"shingle long, place long, short boolean, size long, id {kind}, class {kind}"), "prefixes")
    sent.destroy()
    mixed = entries.groupBy("shingle").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.max("short").alias("short")).where("c0 != c1 and short").select("shingle")
    return written(spark, entries.join(mixed, "shingle").drop("class"), "mixed", entries.count())[0]


def prefix_pairs(entries: DataFrame, classes: DataFrame, similarity: float, turn: int, paired: int, rows: int | None = None) -> DataFrame:
    """Pairs (a, b, lead) of nodes of different classes that share a prefix shingle
    and pass the length and positional filters. A shingle of up to ``paired``
    nodes gives all its pairs (in turn 0); at a more frequent one every node
    meets one leader, drawn anew in each turn, so a turn has at most one pair an entry.
    ``rows``: the number of entries, if known."""
    at_ = entries.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    node = F.struct(F.xxhash64(F.lit(turn), "shingle", "id").alias("drawn"), "id", "class", "place", "size")
    shared = at_.groupBy("shingle").agg(F.count("*").alias("n"), F.min(node).alias("lead"), F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 != c1").drop("c0", "c1")

    def fits(x: str, y: str):
        need = F.ceil(F.lit(similarity) * (F.col(f"{x}size") + F.col(f"{y}size")) / F.lit(1 + similarity) - F.lit(1e-9))
        return ((F.least(f"{x}size", f"{y}size") >= F.greatest(f"{x}size", f"{y}size") * F.lit(similarity) - F.lit(1e-9)) & (F.col(f"{x}class") != F.col(f"{y}class"))
                & (F.col(f"{x}place") <= F.col(f"{x}size") - need) & (F.col(f"{y}place") <= F.col(f"{y}size") - need))

    led = _with_leaders(at_, shared.where(F.col("n") > paired), "shingle", rows).where(fits("", "lead."))
    found = led.select(F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b"), F.col("lead.id").alias("lead"))
    if turn == 0:
        rare = at_.join(shared.where(F.col("n") <= paired).select("shingle"), "shingle")
        x, y = (rare.select("shingle", *(F.col(c).alias(i + c) for c in ("id", "class", "place", "size"))) for i in ("x_", "y_"))
        both = x.join(y, "shingle").where("x_id < y_id").where(fits("x_", "y_"))
        found = found.unionByName(both.select(F.col("x_id").alias("a"), F.col("y_id").alias("b"), F.col("x_id").alias("lead")))
    return found.groupBy("a", "b").agg(F.first("lead").alias("lead"))


def _with_leaders(entries: DataFrame, groups: DataFrame, key: str, rows: int | None) -> DataFrame:
    """``entries`` (``rows`` of them, if known) beside what ``groups`` (one row a ``key``, with its size n) says.
    The few largest groups are broadcast, so none of them meets in one task."""
    groups, _ = written(groups.sparkSession, groups, "groups", rows)
    largest = groups.orderBy(F.col("n").desc(), key).limit(HOT_GROUPS)
    hot, _ = written(groups.sparkSession, largest, "hot-groups")
    hot = F.broadcast(hot)                                        # at most HOT_GROUPS rows
    rest = groups.join(hot.select(key), key, "left_anti")
    return entries.join(hot, key).unionByName(entries.join(hot.select(key), key, "left_anti").join(rest, key))


def blocks(spark: SparkSession, entries: DataFrame, classes: DataFrame, similarity: float, paired: int, block: int = BLOCK, rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What the leaders of ``prefix_pairs`` leave: (id, class, block) of the nodes
    at shingles of more than ``paired`` nodes that several classes still share, and
    the pairs (i, j) of blocks, i <= j, that hold every similar pair of them. A node
    stands in the block of its most frequent such shingle; a large class there has
    blocks of its own, which need not meet each other. ``rows``: the number of entries, if known."""
    at_ = entries.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    hot = at_.groupBy("shingle").agg(F.count("*").alias("n"), F.min("class").alias("c0"), F.max("class").alias("c1")).where((F.col("n") > paired) & (F.col("c0") != F.col("c1")))
    hot, _ = written(spark, at_.join(hot.select("shingle", "n"), "shingle"), "hot", rows)
    home = hot.groupBy("id", "class", "size").agg(F.max(F.struct("n", "shingle")).alias("most")).select("id", "class", "size", F.col("most.shingle").alias("home"))
    own = home.groupBy("home", "class").count().where(F.col("count") >= OWN).select("home", "class", F.col("class").alias("own"))
    homed, _ = written(spark, home.join(own, ["home", "class"], "left"), "homed", rows)
    parts = homed.groupBy("home", "own").agg(F.ceil(F.greatest(F.count("*") / F.lit(block), F.sum("size") / F.lit(BLOCK_SHINGLES))).alias("parts"))
    parts = parts.withColumnsRenamed({"home": "h", "own": "o"})
    placed = homed.join(parts, (F.col("home") == F.col("h")) & F.col("own").eqNullSafe(F.col("o")))
    placed, _ = written(spark, placed.select("id", "class", F.xxhash64("home", F.coalesce(F.col("own").cast("string"), F.lit("")), F.pmod(F.xxhash64("id"), "parts")).alias("block")), "placed", rows)
    spans = hot.join(placed.select("id", "block"), "id").groupBy("shingle", "block").agg(
        F.min("class").alias("c0"), F.max("class").alias("c1"), F.max("short").alias("short"), F.min("size").alias("s0"), F.max("size").alias("s1"))
    spans, _ = written(spark, spans, "spans", rows)
    x, y = (spans.select("shingle", *(F.col(c).alias(i + c) for c in spans.columns[1:])) for i in ("x_", "y_"))
    several = (F.col("x_c0") != F.col("x_c1")) | (F.col("y_c0") != F.col("y_c1")) | (F.col("x_c0") != F.col("y_c0"))
    lengths = (F.col("x_s1") >= F.col("y_s0") * similarity - 1e-9) & (F.col("y_s1") >= F.col("x_s0") * similarity - 1e-9)
    met = x.join(y, "shingle").where("x_block <= y_block and (x_short or y_short)").where(several & lengths)
    return placed, met.select(F.col("x_block").alias("i"), F.col("y_block").alias("j")).distinct()


def _sequence_batches(batches):
    for batch in batches:
        seqs = [v.tobytes() for v in _sequences(batch.column(3))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(seqs, pa.binary())], names=["id", "class", "block", "seq"])


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """[x, y] numbers of common shingles."""
    flat = [np.concatenate(z) for z in (x, y)]
    row = [np.repeat(np.arange(len(z)), [len(v) for v in z]) for z in (x, y)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(x), len(y)), np.float32)
    if not len(both):
        return out
    for k, f in enumerate(flat):
        place = np.minimum(np.searchsorted(both, f), len(both) - 1)
        known = both[place] == f
        place, r = place[known], row[k][known]
        order = np.argsort(place, kind="stable")
        flat[k], row[k] = place[order], r[order]
    for low in range(0, len(both), COLUMNS):
        held = []
        for f, r, z in zip(flat, row, (x, y)):
            a, b = np.searchsorted(f, [low, low + COLUMNS])
            cells = np.zeros((len(z), min(COLUMNS, len(both) - low)), np.float32)
            cells[r[a:b], f[a:b] - low] = 1
            held.append(cells)
        out += held[0] @ held[1].T
    return out


def _met(members: list[list[dict]], similarity: float) -> list[tuple]:
    """Links (a, b, similarity) between the classes of two blocks, or of one with
    itself; classes that a link has joined are not linked again."""
    sides = [sorted(m, key=lambda r: r["id"]) for m in members]
    x, y = sides[0], sides[-1]
    seqs = [[np.frombuffer(r["seq"], np.uint64) for r in side] for side in (x, y)]
    size = [np.array([len(v) for v in s], float) for s in seqs]
    number = {c: k for k, c in enumerate({r["class"]: None for r in x + y})}
    cx, cy = (np.array([number[r["class"]] for r in side]) for side in (x, y))
    need = np.ceil(similarity * (size[0][:, None] + size[1][None, :]) / (1 + similarity) - 1e-9)
    fits = (_common(*seqs) >= need) & (cx[:, None] != cy[None, :])
    if len(sides) == 1:
        fits = np.triu(fits, 1)
    up = list(range(len(number)))

    def top(c):
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c
    out = []
    for i, j in zip(*(k.tolist() for k in np.nonzero(fits))):
        p, q = top(cx[i]), top(cy[j])
        if p != q:
            s = aligned(seqs[0][i], seqs[1][j], similarity)
            if s >= similarity:
                up[q] = p
                out.append((*sorted((x[i]["id"], y[j]["id"])), s))
    return out


def block_links(spark: SparkSession, placed: DataFrame, pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Verified links (a, b, similarity) between the classes of each two blocks of
    ``pairs``; ``placed`` has id, class and block, ``texts`` id and text."""
    kind = placed.schema["id"].dataType.simpleString()
    seqs = texts.join(placed, "id").select("id", "class", "block", "text").mapInArrow(lambda batches: released(_sequence_batches(batches)), f"id {kind}, class {kind}, block long, seq binary")
    # at most about BLOCK nodes and BLOCK_SHINGLES shingles a row (more only for one longer text)
    held, _ = written(spark, seqs.groupBy("block").agg(F.collect_list(F.struct("id", "class", "seq")).alias("members")), "blocks")
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block")).join(held, "block")

    def run(group: pa.Table) -> pa.Table:
        of = group.schema.field("members").type.value_type.field("id").type
        found = _met(group.column("members").to_pylist(), similarity)
        return pa.table([pa.array([f[k] for f in found], t) for k, t in enumerate((of, of, pa.float64()))], names=["a", "b", "similarity"])
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sides.repartition(spread, "i", "j").groupBy("i", "j").applyInArrow(run, f"a {kind}, b {kind}, similarity double")


def components(spark: SparkSession, links: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, class) for every node of ``links`` (a, b; ``rows`` of them, if known): the smallest id of its
    component. Labels spread along the links and then jump to their label's
    label, so long chains take a number of rounds that grows as their logarithm."""
    rows = rows and 2 * rows
    both, both_path = written(spark, links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links", rows)
    paths = []
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("class"))
    labels, path = written(spark, labels, "labels", rows)
    while True:
        paths.append(path)
        near = both.join(labels.select(F.col("id").alias("b"), F.col("class").alias("c")), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        spread = labels.join(near, "id").select("id", "class", F.least("class", "c").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("class").alias("far"))
        new = spread.join(jump, "low", "left").select("id", F.least("low", F.coalesce("far", "low")).alias("class"), F.col("class").alias("old"))
        new, path = written(spark, new, "labels", rows)
        labels = new.select("id", "class")
        if new.where(F.col("class") != F.col("old")).isEmpty():
            break
    for p in [*paths, both_path]:
        drop_path(spark, p)
    return labels


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                    sketches: int = SKETCHES, picked: int = PICKED, paired: int = PAIRED, broadcast_rows: int = BROADCAST_ROWS):
    """Returns (members, links): members has a row per row of ``docs`` with id,
    words, node (smallest id of the rows with equal words) and class (smallest
    id of the near-duplicate class); links has the verified pairs of nodes."""
    on_workers(spark)
    kind = docs.schema[key].dataType.simpleString()
    sketched, _ = written(spark, sketch(spark, docs, key, text, sketches, picked), "sketches")
    keyed = sketched.where("id is not null and words is not null")
    nodes, _ = written(spark, keyed.groupBy("words").agg(F.min("id").alias("id"), F.min("shingles").alias("shingles"), F.min("keys").alias("keys")), "nodes", sketched.count())
    n_nodes = nodes.count()
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    unique = sketched.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()

    def texts_of(ids: DataFrame, rows: int) -> DataFrame:
        wanted, _ = written(spark, ids.distinct(), "wanted", rows)
        if wanted.count() <= broadcast_rows:            # then the other texts stay where they are
            wanted = F.broadcast(wanted)
        found = source.join(wanted, "id", "left_semi")
        if unique:
            return found
        # ids that stand on several rows: of each node's id, one text that has the node's words
        return (with_words(found, "text").join(nodes.select("id", F.col("words").alias(WORDS_COLUMN)), ["id", WORDS_COLUMN], "left_semi")
                .groupBy("id").agg(F.first("text").alias("text")))

    def settle(near: DataFrame, rows: int) -> bool:
        """Verifies the pairs not tried before and merges the classes that the links join; tells whether any were.
        ``rows``: of what ``near`` is made from."""
        nonlocal tried
        pairs, path = written(spark, near.join(tried, ["a", "b"], "left_anti") if tried_paths else near, "pairs", rows)
        tried_paths.append(path)
        tried = spark.read.schema(pairs.schema).parquet(*tried_paths).select("a", "b")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
        n = pairs.count()
        return merge(verified(pairs, texts_of(ids, 2 * n), similarity, n))

    def merge(links: DataFrame) -> bool:
        nonlocal classes, merged_once
        found, path = written(spark, links, "found")
        link_paths.append(path)
        n_found = found.count()
        # links between components; a node without a class is its own
        ends = found.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb"))
        if merged_once:
            ends = found.select("a", "b")
            for i in "ab":
                ends = ends.join(classes.select(F.col("id").alias(i), F.col("class").alias("c" + i)), i, "left").withColumn("c" + i, F.coalesce("c" + i, i))
        joined, _ = written(spark, ends.where("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "joined", n_found)
        n_joined = joined.count()
        if not n_joined:
            return False
        merged = components(spark, joined, n_joined)
        older = classes.join(merged.select(F.col("id").alias("class"), F.col("class").alias("low")), "class", "left").select("id", F.coalesce("low", "class").alias("class"))
        classes, _ = written(spark, older.unionByName(merged.join(classes, "id", "left_anti")) if merged_once else merged, "classes", n_nodes)
        merged_once = True
        return True

    classes = spark.createDataFrame([], f"id {kind}, class {kind}")
    tried = spark.createDataFrame([], f"a {kind}, b {kind}")
    tried_paths, link_paths, large_paths = [], [], []
    merged_once = False

    def deal(bands: DataFrame, taken: int, rows: int) -> DataFrame:
        """One deal of the nodes of ``bands`` (id, keys, shingles, bands; ``rows`` bands in all) by ``taken``
        sketches together; returns (bucket, id, band) of the larger buckets that held several classes."""
        classed = bands.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id")) if merged_once else bands.withColumn("class", F.col("id"))
        at_ = (classed.select("id", "class", "keys", "shingles", F.explode("bands").alias("band"))
               .select("id", "class", "shingles", "band", F.xxhash64("band", *[F.get("keys", (F.col("band") + j) % sketches) for j in range(taken)]).alias("bucket")))
        lead = F.min(F.struct(F.xxhash64("bucket", "id").alias("drawn"), F.col("id"), F.col("class"), F.col("shingles"))).alias("lead")
        buckets = at_.groupBy("bucket").agg(F.count("*").alias("n"), lead, F.min("class").alias("c0"), F.max("class").alias("c1")).where("n > 1 and c0 != c1").drop("c0", "c1")
        shared, shared_path = written(spark, _with_leaders(at_, buckets, "bucket", rows), "buckets", rows)
        small = shared.where(F.col("n") <= paired)
        x, y = (small.select("bucket", F.col("id").alias(i), F.col("class").alias("c" + i), F.col("shingles").alias("n" + i)) for i in "ab")
        pairs = x.join(y, "bucket").where("a < b and ca != cb").select("a", "b", "na", "nb", F.col("a").alias("lead"))
        star = shared.where((F.col("n") > paired) & (F.col("class") != F.col("lead.class"))).select(
            F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b"), F.col("shingles").alias("na"), F.col("lead.shingles").alias("nb"), F.col("lead.id").alias("lead"))
        # lengths alone rule out some pairs
        near = pairs.unionByName(star).where(F.least("na", "nb") >= F.greatest("na", "nb") * similarity).groupBy("a", "b").agg(F.first("lead").alias("lead"))
        settle(near, shared.count())
        rest, _ = written(spark, shared.where(F.col("n") > paired).select("bucket", "id", "band"), "larger")
        drop_path(spark, shared_path)
        return rest

    def dealt(bands) -> DataFrame:
        return nodes.select("id", "keys", "shingles", bands.alias("bands"))

    # two sketches first: the nodes of a family are one class by then and do not meet again in the others
    first = min(FIRST, sketches)
    large = deal(dealt(F.sequence(F.lit(0), F.lit(first - 1))), 1, n_nodes * first)
    if first < sketches:
        large = large.unionByName(deal(dealt(F.sequence(F.lit(first), F.lit(sketches - 1))), 1, n_nodes * (sketches - first)))
    n_large = large.count()
    if TOGETHER < sketches and n_large:                      # buckets that are one class by now fall out in the deal
        again = large.groupBy("id").agg(F.sort_array(F.collect_set("band")).alias("bands"))      # at most one entry a sketch
        deal(again.join(nodes.select("id", "keys", "shingles"), "id"), TOGETHER, n_large)
    large = large.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id")) if merged_once else large.withColumn("class", F.col("id"))
    apart = large.groupBy("bucket").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 != c1").select("bucket")
    left, _ = written(spark, large.join(apart, "bucket", "left_semi").select("id", "class").distinct(), "left", n_large)
    if not left.isEmpty():
        entries = prefix_entries(spark, texts_of(left.select("id"), n_large).join(left, "id"), similarity)
        rows = entries.count()
        for turn in range(TURNS):
            if not settle(prefix_pairs(entries, classes, similarity, turn, paired, rows), rows):
                break
        placed, met = blocks(spark, entries, classes, similarity, paired, rows=rows)
        met, _ = written(spark, met, "met", rows)
        if not met.isEmpty():
            merge(block_links(spark, placed, met, texts_of(placed.select("id"), rows), similarity))
    members = sketched.select("id", "words").join(nodes.select("words", F.col("id").alias("node")), "words", "left").withColumn("node", F.coalesce("node", "id"))
    members = members.join(classes.withColumnRenamed("id", "node"), "node", "left").withColumn("class", F.coalesce("class", "node"))
    return members.select("id", "words", "node", "class"), spark.read.schema(f"a {kind}, b {kind}, similarity double").parquet(*link_paths)


def with_words(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` and the digest of its texts' word sequences."""
    def run(batches):
        for batch in batches:
            for part in at.slices(batch.column(batch.schema.get_field_index(text)), CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays([*(c.slice(part.lo, part.hi - part.lo) for c in batch.columns), _digests(at.words(part))],
                                                 names=[*batch.schema.names, WORDS_COLUMN])
    return frame.mapInArrow(lambda batches: released(run(batches)), T.StructType([*frame.schema.fields, T.StructField(WORDS_COLUMN, T.BinaryType())]))


def keep_one(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: that of the smallest
    id, and one of its rows if it is repeated (equal id and words). Given columns
    travel as one, so their names cannot clash."""
    members, _ = near_duplicates(spark, docs, key, text, **options)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    rows = with_words(docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), whole), "text").drop("text")
    on = ["id", WORDS_COLUMN]
    gone = members.where("id != class").select("id", F.col("words").alias(WORDS_COLUMN)).distinct()
    kept = rows.join(gone, on, "left_anti")
    again = members.where("words is not null and id is not null").groupBy("id", F.col("words").alias(WORDS_COLUMN)).count().where("count > 1").drop("count")
    again, _ = written(spark, again, "repeated")
    if not again.isEmpty():
        nth = F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64("given")))
        one = kept.join(again, on, "left_semi").withColumn("nth", nth).where("nth = 1").drop("nth")
        kept = kept.join(again, on, "left_anti").unionByName(one)
    return kept.select(*[F.col("given").getField(c).alias(c) for c in docs.columns])


def brute_force(docs: list[tuple], similarity: float = SIMILARITY) -> dict:
    """id -> class by comparing every pair of texts (for tests)."""
    seqs = {}
    for i, t in docs:
        w = at.text_words(t)
        if i is None or not w:
            continue
        g = [tuple(w[k:k + WORDS]) for k in range(max(1, len(w) - WORDS + 1))]
        seen: dict[tuple, int] = {}
        out = []
        for s in g:
            seen[s] = seen.get(s, -1) + 1
            out.append((s, seen[s]))
        seqs[i] = out
    up = {i: i for i in seqs}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(seqs)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = seqs[i], seqs[j]
            row = [0] * (len(b) + 1)
            if min(len(a), len(b)) < similarity * max(len(a), len(b)) or len(set(a) & set(b)) < similarity * len(set(a) | set(b)) - 1e-9:
                continue
            for s in a:                                      # plain alignment without a band
                prev = 0
                for k, t in enumerate(b, 1):
                    prev, row[k] = row[k], prev + 1 if s == t else max(row[k], row[k - 1])
            m = row[-1]
            if m / (len(a) + len(b) - m) >= similarity - 1e-12 and top(i) != top(j):
                p, q = sorted((top(i), top(j)))
                up[q] = p
    return {i: top(i) for i in seqs}
