"""Neighbours family: mixed-type K-nearest neighbours, per-title merge,
deterministic bootstrap resampling, ensembles, min-max scaling.

Exact K-NN without a cross join
--------------------------------
distance(q, t) = (q.user - t.user)^2 + Σ_a [q.a != t.a] over nominal
attributes a (4 by default). For a fixed training user u and a subset S of
attributes, call G(u, S, v) the training rows of user u whose S-attributes
equal v. If a row r is in the true top-K of q and M is the set of
attributes where r matches q, then r is in G(u, M, q_M), and every row of
that group that precedes r in the tie order is at a distance <= dist(q, r),
so it beats r. Hence r is among the first K rows (tie order) of its group.
So it is enough to keep, per group, its first K rows (``WindowGroupLimit``,
a partial limit before the shuffle, safe for hot groups), and to let each
query probe its 2^|A| groups for every training user in a band around its
own user value: at most 2^|A| * K candidates per (query, nearby user), never
all pairs of a group.

The band starts at ``band`` (user units). A query is finished when its K-th
candidate distance is <= band^2 (anything outside the band is farther than
band^2). Unfinished queries are retried with band = sqrt(K-th distance)
(exact in one more round) or, if they have fewer than K candidates, a band
four times wider, until the band covers every training user.

Queries without a hot user (more than ``direct_max`` rows) in their band are
answered in one pass over queries and rows sorted by user (``near_users``), where
no candidate is shuffled; the others, and those at the edges of its partitions,
go through rounds of joins.

Where users lie so close that a band holds many of them (a scaled column, say),
bands would pair almost all users. Then the group lists are walked instead
(``_sorted_candidates``): in each group, sorted by user, a row of the true top-K
of q is among the K rows next below or the K next above q's user, because
whatever lies between has a smaller gap and at most as many mismatches. Places
come from distributed sorts, so no group is gathered and a query meets at most
2^|A| * 2K candidates however dense the users are. Both ways give the same rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distance import mixed
from ..functions.hashing import md5_slot
from ..plans.loops import cut, cut_observing
from ..session import broadcast_if_small, drop_scratch, partitions_for, piece_count, stored, stored_pieces
from . import near_users
from .near_users import plain

NOMINAL = ["location", "title", "author", "publisher"]
_MISSING = "\u0000"   # stands for NULL inside a group key
DIRECT_MAX = 64        # training rows per user compared pair by pair
NEAR_USERS = 500_000   # broadcast up to so many training users to pick their rows
DENSE = 32             # user pairs per user in the first band beyond which the sorted walk is taken


def _subsets(n: int) -> list[tuple[int, ...]]:
    return [c for r in range(n, -1, -1) for c in combinations(range(n), r)]


def _explode_subsets(df: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per attribute subset: ``sid`` plus ``k0..k{n-1}`` where
    attributes outside the subset are blanked to ''."""
    subs = _subsets(len(attrs))
    masks = F.array(*[F.array(*[F.lit(i in s) for i in range(len(attrs))]) for s in subs])
    out = df.select("*", F.posexplode(masks).alias("sid", "_mask"))
    keys = [F.when(F.col("_mask")[i], F.coalesce(F.col(a).cast("string"), F.lit(_MISSING))).otherwise(F.lit(""))
            .alias(f"k{i}") for i, a in enumerate(attrs)]
    return out.select(*[c for c in df.columns], "sid", *keys)


def knn_topk(queries: DataFrame, training: DataFrame, k: int = 3, qid: str = "row_key",
             tie: list[str] | None = None, user: str = "user_id", attrs: list[str] | None = None,
             band: float = 2.0, max_rounds: int = 64, carry: list[str] | None = None,
             direct_max: int = DIRECT_MAX, collapse_copies: bool = False, dense: float = DENSE, q_carry: list[str] | None = None) -> DataFrame:
    """Top-``k`` training rows per query row ``(qid, rank, t_<tie>..., distance)``
    ordered by (distance, tie columns).

    Training rows with identical (user, attributes) are always at the same
    distance, so only the first ``k`` of each such tuple (tie order) are kept.
    A training user with at most ``direct_max`` remaining rows is compared
    directly (bounded work per query); a hot user is reached through the
    per-subset group lists (see module docstring), never pair by pair.
    ``carry`` lists training columns to return alongside (prefixed ``t_``),
    ``q_carry`` columns of the query (prefixed ``q_``).

    ``collapse_copies``: training rows sharing the first tie column are copies
    (identical attributes, e.g. bootstrap draws). They are consecutive in tie
    order, so each group is searched once, as a representative with a
    multiplicity (capped at k), and expanded back to rows at the end."""
    attrs = attrs or NOMINAL
    tie = tie or [qid]
    carry = [c for c in carry or [] if c not in tie]
    q_carry = q_carry or []
    spark = queries.sparkSession
    kinds = {a: T.StringType() if queries.schema[a].dataType != training.schema[a].dataType else queries.schema[a].dataType for a in attrs}
    # a query without a user value has no finite distance: no neighbours
    q = queries.where(F.col(user).isNotNull()).select(
        F.struct(F.col(qid).alias("id"), *[F.col(c).alias("q_" + c) for c in q_carry]).alias("_q"), F.col(user).cast("double").alias("_u"), *[plain(F.col(a), kinds[a]).alias("_a_" + a) for a in attrs])
    out_t = ["t_" + c for c in tie + carry]
    t = training.where(F.col(user).isNotNull()).select(
        F.struct(*[F.col(c).alias("t_" + c) for c in tie]).alias("_t"), F.struct(F.lit(True).alias("_"), *[F.col(c).alias("t_" + c) for c in carry]).alias("_pay"),
        F.col(user).cast("double").alias("_u"), *[plain(F.col(a), kinds[a]).alias("_a_" + a) for a in attrs])
    names = ["_a_" + a for a in attrs]
    if collapse_copies:
        # one representative per copy group, with its first k rows (a partial limit: a hot group is fine)
        copies = Window.partitionBy("_t.t_" + tie[0]).orderBy("_t")

        def collapsed(rows: DataFrame) -> DataFrame:
            return (rows.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k).groupBy(F.col("_t.t_" + tie[0]))
                    .agg(F.min(F.struct("_t", "_u", *names)).alias("_r"), F.sort_array(F.collect_list(F.struct("_t", "_pay"))).alias("_pay"))     # at most k rows
                    .select("_r.*", "_pay"))

        pieces = piece_count(t.count())
        piece = F.pmod(F.xxhash64(F.col("_t.t_" + tie[0])), F.lit(pieces))
        t = stored_pieces((collapsed(t.where(piece == i) if pieces > 1 else t) for i in range(pieces)), "knn-copies")
    # users with more rows than are compared one by one keep the first k rows (tie order) of
    # every identical-attribute tuple (k representatives always cover at least k rows)
    users = cut(t.groupBy(F.col("_u").alias("tu")).agg(F.count(F.lit(1)).alias("_cnt")))
    lo, hi, most, n_users, rows = users.agg(F.min("tu"), F.max("tu"), F.max("_cnt"), F.count(F.lit(1)), F.sum("_cnt")).first()
    if lo is None:   # no training rows: no neighbours (same columns as a normal result)
        schema = T.StructType([T.StructField(qid, queries.schema[qid].dataType), T.StructField("rank", T.IntegerType())] + [T.StructField("t_" + c, training.schema[c].dataType) for c in tie + carry]
                              + [T.StructField("distance", T.DoubleType())] + [T.StructField("q_" + c, queries.schema[c].dataType) for c in q_carry])
        return spark.createDataFrame([], schema)
    hot = None
    if most > direct_max:
        full = users.where(F.col("_cnt") > direct_max).select(F.col("tu").alias("_u"))
        w = Window.partitionBy("_u", *names).orderBy("_t")
        limited = cut(t.join(full, "_u", "left_semi").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n"))
        hot = cut(limited.groupBy("_u").agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > direct_max).select("_u"))
        hot_t = limited.join(hot, "_u", "left_semi")
        t_small = t.join(full, "_u", "left_anti").unionByName(limited.join(hot, "_u", "left_anti"))
        hot = None if hot.isEmpty() else hot
    else:
        t_small = t
    users = users.select("tu") if hot is None else users.join(hot.select(F.col("_u").alias("tu"), F.lit(True).alias("_hot")), "tu", "left").select("tu", F.coalesce("_hot", F.lit(False)).alias("_hot"))
    if _pairs_per_user(q.select(F.col("_u").alias("_qu")), users, float(band)) > dense:
        numbered = dense_index(t_small if hot is None else t_small.unionByName(hot_t), "_t", out="_tk")
        asked = cut(q.withColumn("_qid", F.monotonically_increasing_id()).withColumnRenamed("_u", "_qu"))
        pairs = _sorted_candidates(asked.select("_qid", "_qu", *[F.col(c).alias("q_" + c) for c in names]), numbered.withColumnRenamed("_u", "_tu").withColumnsRenamed({c: "t_" + c for c in names}), "_tu", names, k)
        dist = mixed(F.col("_qu"), F.col("_tu"), [F.col("q_" + c) for c in names], [F.col("t_" + c) for c in names])
        best = Window.partitionBy("_qid").orderBy("distance", "_tk")
        top = pairs.select("_qid", "_tk", "_t", "_pay", dist.alias("distance")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found = cut(_starts(top, collapse_copies).join(asked.select("_qid", "_q"), "_qid").select("_q", "rank", "_start", "_t", "_pay", "distance"))
    else:
        found = _by_bands(q, t_small, None if hot is None else hot_t, hot, users, names, k, float(band), lo, hi, n_users, rows, max_rounds)
    if collapse_copies:
        # representatives (at most k a query) -> rows: a group's copies take consecutive ranks from where the groups before it end
        each = F.posexplode(F.slice("_pay", F.lit(1), F.lit(k) - F.col("_start"))).alias("_n", "_c")
        found = (found.where(F.col("_start") < k).select("_q", "_start", "distance", each)
                 .select("_q", (F.col("_start") + F.col("_n") + 1).cast("int").alias("rank"), "_c._t", "_c._pay", "distance"))
    return found.select(F.col("_q.id").alias(qid), "rank", *[F.col("_t.t_" + c).alias("t_" + c) for c in tie], *[F.col("_pay.t_" + c).alias("t_" + c) for c in carry], "distance",
                        *[F.col("_q.q_" + c).alias("q_" + c) for c in q_carry])


def _starts(top: DataFrame, copies: bool) -> DataFrame:
    """``top`` (one row a query and representative) with the number of rows that a query's representatives before this one stand for."""
    if not copies:
        return top.withColumn("_start", F.col("rank") - 1)
    before = Window.partitionBy("_qid").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return top.withColumn("_start", F.coalesce(F.sum(F.size("_pay")).over(before), F.lit(0)).cast("int"))


def _by_bands(q: DataFrame, t_small: DataFrame, hot_t: DataFrame | None, hot: DataFrame | None, users: DataFrame, names: list[str], k: int, band: float,
              lo: float, hi: float, n_users: int, rows: int, max_rounds: int) -> DataFrame:
    """(_q, rank, _start, _t, _pay, distance): one sorted pass over all queries and
    the rows of small users (see ``near_users``); the queries it leaves, and those
    near a hot user, go on by joins in rounds of wider bands."""
    copies = isinstance(t_small.schema["_pay"].dataType, T.ArrayType)
    out = ["_q", "rank", "_start", "_t", "_pay", "distance"]
    found = near_users.search(q, t_small, hot, names, k, band, lo, hi, n_users, rows + q.count())
    done = [found.where("rank > 0").select(*out)]
    pending = cut(found.where("rank = 0").select("_q", F.col("_u").alias("_qu"), *names, "_band").withColumn("_qid", F.monotonically_increasing_id()))
    q_keys = pending.select("_qid", "_q")
    pending = pending.drop("_q").withColumnsRenamed({c: "q_" + c for c in names})
    n_pending, width = pending.agg(F.count(F.lit(1)), F.max("_band")).first()
    t_small = t_small.withColumnRenamed("_u", "_tu").withColumnsRenamed({c: "t_" + c for c in names})
    dist = mixed(F.col("_qu"), F.col("_tu"), [F.col("q_" + c) for c in names], [F.col("t_" + c) for c in names])
    keep = ["_qid", "_t", "_pay"]
    gkey = ["_tu", "sid"] + [f"k{i}" for i in range(len(names))]
    tk = None
    if n_pending and hot is not None:
        # first k rows of every (hot user, subset, values) group; static, cut once
        hot_t = hot_t.withColumnRenamed("_u", "_tu").withColumn("_tk", F.monotonically_increasing_id())
        tx = _explode_subsets(hot_t, names).withColumnsRenamed({c: "t_" + c for c in names})
        w = Window.partitionBy(*gkey).orderBy("_t", "_tk")
        tk = cut(tx.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn"))
    if "_hot" not in users.columns:
        users = users.withColumn("_hot", F.lit(False))
    for _ in range(max_rounds):
        if not n_pending:
            break
        pairs = _user_pairs(pending, users, width).withColumnRenamed("tu", "_tu")
        # small users: compare directly (a bounded number of rows per user); rows of other users are not shuffled
        small = pairs.where(~F.col("_hot")).drop("_hot")
        cand = (pending.join(small, "_qu").join(t_small.join(broadcast_if_small(cut(small.select("_tu").distinct()), NEAR_USERS), "_tu", "left_semi"), "_tu")
                .select(*keep, dist.alias("distance")))
        if tk is not None:
            # hot users: probe the per-subset group lists
            qx = _explode_subsets(pending.withColumnsRenamed({"q_" + c: c for c in names}), names).withColumnsRenamed({c: "q_" + c for c in names})
            probe = qx.join(pairs.where("_hot").drop("_hot"), "_qu")
            hot_cand = probe.join(tk, gkey).select(*keep, dist.alias("distance"), "_tk").dropDuplicates(["_qid", "_tk"]).drop("_tk")
            cand = cand.unionByName(hot_cand)
        wq = Window.partitionBy("_qid").orderBy("distance", "_t")
        top = cut(_starts(cand.withColumn("rank", F.row_number().over(wq)).where(F.col("rank") <= k), copies))
        stat = top.groupBy("_qid").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_dk"))
        st = pending.join(stat, "_qid", "left")
        covers = (F.col("_band") >= F.lit(hi) - F.col("_qu")) & (F.col("_band") >= F.col("_qu") - F.lit(lo))
        full = F.coalesce(F.col("_n"), F.lit(0)) >= k
        finished = (full & (F.col("_dk") <= F.col("_band") * F.col("_band"))) | (~full & covers)
        st = cut(st.withColumn("_fin", F.coalesce(finished, F.lit(False))))
        done.append(top.join(st.where("_fin").select("_qid"), "_qid", "left_semi").join(q_keys, "_qid").select(*out))
        # sqrt widened a hair so that band^2 >= K-th distance despite rounding
        nxt_band = F.when(full, F.sqrt(F.col("_dk")) * 1.000001).otherwise(F.col("_band") * 4.0)
        # the next round's size and widest band are observed while it is written
        pending, got = cut_observing(st.where(~F.col("_fin")).select("_qid", "_qu", *["q_" + c for c in names], nxt_band.alias("_band")), n=F.count(F.lit(1)), w=F.max("_band"))
        n_pending, width = got["n"], got["w"]
    else:
        raise RuntimeError("knn_topk did not converge")
    res = done[0]
    for d in done[1:]:
        res = res.unionByName(d)
    return res


def _user_pairs(pending: DataFrame, users: DataFrame, width: float) -> DataFrame:
    """(_qu, tu, _hot): distinct query users with the training users inside their bands (``width`` at most)."""
    qu = pending.groupBy("_qu").agg(F.max("_band").alias("_b"))
    slot = F.floor(F.col("_qu") / F.lit(width))
    near = qu.select("_qu", "_b", F.explode(F.array(slot - 1, slot, slot + 1)).alias("_bk"))
    return cut(near.join(users.select("tu", "_hot", F.floor(F.col("tu") / F.lit(width)).alias("_bk")), "_bk")
               .where(F.abs(F.col("_qu") - F.col("tu")) <= F.col("_b")).select("_qu", "tu", "_hot"))


def _pairs_per_user(q: DataFrame, users: DataFrame, width: float) -> float:
    """Upper estimate of (query user, training user) pairs in bands of ``width``, per user: from counts per bucket."""
    bucket = F.floor(F.col("u") / F.lit(width))
    a = q.select(F.col("_qu").alias("u")).distinct().groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    near = users.select(F.explode(F.array(*[F.floor(F.col("tu") / F.lit(width)) + d for d in (-1, 0, 1)])).alias("b")).groupBy("b").agg(F.count("*").alias("m"))
    got = a.join(near, "b").agg(F.sum(F.col("n").cast("double") * F.col("m")).alias("pairs")).first()
    return (got.pairs or 0.0) / max(1, users.count())


def _group_of(attrs: list[str]) -> list[F.Column]:
    """128 bits that tell a (subset, values) group."""
    keys = ["sid", *[f"k{i}" for i in range(len(attrs))]]
    return [F.xxhash64(*keys).alias("g0"), F.xxhash64(F.lit(17), *keys).alias("g1")]


def _sorted_candidates(q: DataFrame, t: DataFrame, tu_col: str, attrs: list[str], k: int) -> DataFrame:
    """Of every query and subset group, the k training rows next below (or at)
    and the k next above its user, joined with the query's columns."""
    tx = _explode_subsets(t.select("_tk", F.col(tu_col).alias("u"), *[F.col("t_" + a).alias(a) for a in attrs]), attrs).select(*_group_of(attrs), "u", "_tk")
    # of one user and group only the first k rows (tie order) can count
    w = Window.partitionBy("g0", "g1", "u").orderBy("_tk")
    tx = cut(tx.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n"))
    qx = cut(_explode_subsets(q.select("_qid", F.col("_qu").alias("u"), *[F.col("q_" + a).alias(a) for a in attrs]), attrs).select("_qid", *_group_of(attrs), "u"))
    probes = qx.select("g0", "g1", "u").distinct()
    # rows up to a probe = its place among rows and probes less its place among probes
    side = F.lit(1)
    both = tx.select("g0", "g1", "u", F.lit(0).alias("_s"), "_tk").unionByName(probes.select("g0", "g1", "u", side.alias("_s"), F.lit(0).cast("long").alias("_tk")))
    among = dense_index(both, ["g0", "g1", "u", "_s", "_tk"], out="_i").where("_s = 1").select("g0", "g1", "u", "_i")
    alone = dense_index(probes, ["g0", "g1", "u"], out="_j")
    upto = cut(among.join(alone, ["g0", "g1", "u"]).select("g0", "g1", "u", (F.col("_i") - F.col("_j")).alias("_c")))
    # below: by falling place in (user, tie order reversed); above: by rising place in (user, tie order)
    down = dense_index(tx.withColumn("_back", -F.col("_tk")), ["g0", "g1", "u", "_back"], out="_p").select(F.col("g0").alias("h0"), F.col("g1").alias("h1"), "_tk", "_p")
    up = dense_index(tx, ["g0", "g1", "u", "_tk"], out="_p").select(F.col("g0").alias("h0"), F.col("g1").alias("h1"), "_tk", "_p")

    def next_to(places: DataFrame, offsets: list[int]) -> DataFrame:
        wanted = upto.withColumn("_o", F.explode(F.array(*[F.lit(o).cast("long") for o in offsets]))).withColumn("_p", F.col("_c") + F.col("_o"))
        return wanted.join(places, "_p").where("g0 = h0 AND g1 = h1").select("g0", "g1", "u", "_tk")

    found = next_to(down, [-j for j in range(1, k + 1)]).unionByName(next_to(up, list(range(k)))).distinct()
    pairs = qx.join(found, ["g0", "g1", "u"]).select("_qid", "_tk").distinct()
    return pairs.join(q, "_qid").join(t, "_tk").withColumn("_band", F.lit(0.0))


def knn_by_title(neighbours: DataFrame, queries: DataFrame, k: int = 3, qid: str = "row_key",
                 title: str = "title", tid: str = "t_row_key") -> DataFrame:
    """Merge the neighbours of all query rows sharing a title; keep the ``k``
    best (distance, training key) per title, each training row once (its
    smallest distance). The ranking window is a ``WindowGroupLimit``: each
    map task forwards at most k rows per title. Neighbours that carry their
    query's title (``q_<title>``) are not joined with the queries again."""
    if f"q_{title}" in neighbours.columns:
        nb = neighbours.where(F.col(qid).isNotNull()).select(F.col(f"q_{title}").alias("q_title"), tid, "distance")
    else:
        nb = neighbours.join(queries.select(F.col(qid), F.col(title).alias("q_title")), qid)
    best = nb.groupBy("q_title", tid).agg(F.min("distance").alias("distance"))
    w = Window.partitionBy("q_title").orderBy("distance", tid)
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(F.col("q_title").alias("title"), "rank", tid, "distance"))


# ---------------------------------------------------------------- bootstrap

def dense_index(df: DataFrame, order: str | list[str], out: str = "idx", made: list[str] | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (unique), without a global
    window: range-partition and sort, number rows inside each partition,
    then add the row count of all earlier partitions (a table of one row
    per partition). The numbered table is stored (its path is added to ``made``)
    so both passes see the same rows."""
    order = [order] if isinstance(order, str) else list(order)
    parts = partitions_for(df.sparkSession, df.count(), 64)
    ranged = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = stored(ranged.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).drop("_mid"), "indexed", made)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = counts.select("_pid", (F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
                         .alias("_off"))   # one row per partition
    offs = offs.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offs), "_pid")   # one row per partition
            .withColumn(out, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off"))


def bootstrap_sample(df: DataFrame, order: str, model: int = 0, n: int | None = None,
                     indexed: DataFrame | None = None) -> DataFrame:
    """``n`` rows (default: as many as ``df``) drawn with replacement.
    Slot s of model m takes row ``md5(m:s) mod N`` in ``order`` position.
    Slots are counted per drawn row (partial aggregate) before the join,
    so a row drawn many times travels once with its count."""
    spark = df.sparkSession
    idx = indexed if indexed is not None else cut(dense_index(df, order))
    total = idx.count()
    n = total if n is None else n
    if total == 0 or n == 0:
        return idx.drop("idx").withColumn("model", F.lit(model)).limit(0)
    slots = spark.range(n).select(md5_slot(F.lit(model), F.col("id"), F.lit(total)).alias("idx"))
    drawn = slots.groupBy("idx").agg(F.count(F.lit(1)).alias("_copies"))
    rows = idx.join(drawn, "idx")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .drop("_copies", "idx").withColumn("model", F.lit(model)))


def shuffled(df: DataFrame, key: list[str], seed: int = 0, out: str = "pos") -> DataFrame:
    """``df`` with the position of each row in a pseudo-random order that any
    engine can repeat (md5 of seed and key, then key): a distributed sort, no
    global window. ``orderBy(out)`` writes the rows in that order."""
    tag = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    return dense_index(df.withColumn("_tag", tag), ["_tag", *key], out=out).drop("_tag")


def ensemble_training(df: DataFrame, order: str, models: int = 3) -> DataFrame:
    """Union of ``models`` bootstrap samples of the same training rows (see
    ``bootstrap_sample``). The draws of all models are counted per row first, so
    a row is joined once with its counts, however many models draw it."""
    spark = df.sparkSession
    made: list[str] = []
    idx = dense_index(df, order, made=made)
    total = idx.count()
    if total == 0:
        return bootstrap_sample(df, order, indexed=idx)
    slots = spark.range(total).select("id", F.explode(F.array(*[F.lit(m) for m in range(models)])).alias("model"))
    drawn = (slots.select(md5_slot(F.col("model"), F.col("id"), F.lit(total)).alias("idx"), "model")
             .groupBy("idx").agg(*[F.count(F.when(F.col("model") == m, 1)).alias(f"_n{m}") for m in range(models)]))
    drawn = stored(drawn, "draws", made)
    pieces = piece_count(total * models)
    of = lambda side, i: side.where(F.pmod("idx", F.lit(pieces)) == i) if pieces > 1 else side
    rows = stored_pieces((of(idx, i).join(of(drawn, i), "idx").drop("idx") for i in range(pieces)), "drawn-rows")
    drop_scratch(spark, *made)
    counts = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_n{m}").alias("copies")) for m in range(models)])
    each = rows.withColumn("_d", F.explode(F.filter(counts, lambda d: d.copies > 0)))
    return each.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_d.copies"))).alias("copy"), F.col("_d.model").alias("model"))


# ---------------------------------------------------------------- scaling

def minmax_normalize(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """(x - min) / (max - min) using one global aggregate (two scalars)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    out = out or f"{col}_norm"
    if lo is None or hi == lo:
        return df.withColumn(out, F.lit(None).cast("double") if lo is None else F.lit(0.0))
    return df.withColumn(out, (F.col(col) - F.lit(lo)) / F.lit(float(hi - lo)))


def distance_to(df: DataFrame, probe: dict, user: str = "user_id", attrs: list[str] | None = None) -> DataFrame:
    """Distance of every row to one probe record (literal values)."""
    attrs = attrs or NOMINAL
    d = mixed(F.col(user), F.lit(probe[user]), [F.col(a) for a in attrs], [F.lit(probe[a]) for a in attrs])
    return df.withColumn("distance", d)

