"""K nearest neighbours by K distinct distances: of the training rows at one
distance only the last (in tie order) counts, as where neighbours are held in a
sorted map keyed by distance.

The distance is (q.user - t.user)^2 plus the number of nominal attributes that
differ. Exact without pairing a query with all rows of a user:

* training rows with equal user and attributes stand at one distance from every
  query, so only the last of each such tuple is kept;
* a user with at most ``direct_max`` tuples is compared directly;
* for a user with more, take a query and the set M of attributes in which a row
  matches it. The row wanted is the last one of the group (user, M, the query's
  values on M) that differs from the query on every other attribute. The group's
  *sieve* holds it, whatever the query's other values are: start with the last
  row r of the group; if r does not qualify, it agrees with the query on some
  other attribute a, so the row wanted has a value other than r's there; go on
  with the last row among those, for each a. A path excludes one attribute more
  at each step, so with 4 attributes the sieves of all 16 groups hold at most
  168 rows that a query can meet, however many rows the user has. They are built
  by as many rounds of join and maximum as there are attributes.

A query first meets the users within ``band`` of its own. It is done when it has
K distances and the K-th is at most band^2; else the band is widened to that
distance (or four times, while it has fewer than K), until it holds all users.
Queries with no hot user in their band are answered in one pass over queries and
rows sorted by user (``near_users``), where no candidate is shuffled. Where users
lie so close together that a band holds almost all of them (a scaled column), a
query meets all users: the number of users then bounds its work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distance import mixed
from ..plans.loops import cut, cut_observing
from . import near_users
from .near_users import plain
from .neighbors import _MISSING, DIRECT_MAX, NOMINAL, _explode_subsets, _subsets, _user_pairs, dense_index

SALTS = 8          # parts of a group while its sieve is built


def sieves(tuples: DataFrame, user: str, attrs: list[str], last: str = "_tk") -> DataFrame:
    """(user, sid, k0.., last) of every group's sieve; ``tuples`` has one row per user and attribute values."""
    n = len(attrs)
    names = [f"a{i}" for i in range(n)]
    group = [user, "sid", *[f"k{i}" for i in range(n)]]
    values = [F.coalesce(F.col(a).cast("string"), F.lit(_MISSING)).alias(names[i]) for i, a in enumerate(attrs)]
    rows = cut(_explode_subsets(tuples.select(user, last, *attrs), attrs).select(*group, last, *values, F.pmod(F.xxhash64(last), F.lit(SALTS)).cast("int").alias("salt")))
    held = F.array(*[F.array(*[F.lit(i in s) for i in range(n)]) for s in _subsets(n)])          # by sid: which attributes the group fixes
    best = F.max(F.struct(last, *names)).alias("r")
    # a path: the value excluded on each attribute (NULL: none); its row is the last that has none of them
    state = cut(rows.groupBy(*group).agg(best).select(*group, *[F.lit(None).cast("string").alias(f"x{i}") for i in range(n)], "r"))
    found = [state.select(*group, F.col(f"r.{last}").alias(last))]
    for _ in range(n):
        free = [F.when(~F.get(F.get(held, F.col("sid")), F.lit(i)) & F.col(f"x{i}").isNull(), F.lit(i)) for i in range(n)]
        paths = (state.withColumn("_i", F.explode(F.filter(F.array(*free), lambda x: x.isNotNull())))
                 .select(*group, *[F.when(F.col("_i") == i, F.col(f"r.a{i}")).otherwise(F.col(f"x{i}")).alias(f"x{i}") for i in range(n)]).distinct())
        paths = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        differs = [F.col(f"x{i}").isNull() | (F.col(f"x{i}") != F.col(f"a{i}")) for i in range(n)]
        kept = rows.join(paths, [*group, "salt"])
        for d in differs:
            kept = kept.where(d)
        state = cut(kept.groupBy(*group, *[f"x{i}" for i in range(n)]).agg(best))
        found.append(state.select(*group, F.col(f"r.{last}").alias(last)))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def knn_distinct(queries: DataFrame, training: DataFrame, k: int = 3, qid: str = "row_key", tie: list[str] | None = None, user: str = "user_id",
                 attrs: list[str] | None = None, band: float = 2.0, max_rounds: int = 64, carry: list[str] | None = None, direct_max: int = DIRECT_MAX,
                 q_carry: list[str] | None = None) -> DataFrame:
    """``(qid, rank, t_<tie>..., distance)``: the ``k`` smallest distinct distances
    of every query row, each with its last training row in ``tie`` order.
    ``carry`` lists training columns to return as well (prefixed ``t_``),
    ``q_carry`` columns of the query (prefixed ``q_``). Rows
    without a user are no neighbours and have none."""
    attrs = attrs or NOMINAL
    tie = tie or [qid]
    carry = [c for c in carry or [] if c not in tie]
    q_carry = q_carry or []
    spark = queries.sparkSession
    n = len(attrs)
    kind = {a: T.StringType() if queries.schema[a].dataType != training.schema[a].dataType else queries.schema[a].dataType for a in attrs}
    names = ["_a_" + a for a in attrs]
    nominal = [plain(F.col(a), kind[a]).alias("_a_" + a) for a in attrs]
    q = queries.where(F.col(user).isNotNull()).select(F.struct(F.col(qid).alias("id"), *[F.col(c).alias("q_" + c) for c in q_carry]).alias("_q"), F.col(user).cast("double").alias("_u"), *nominal)
    t = training.where(F.col(user).isNotNull()).select(F.struct(*[F.col(c).alias("t_" + c) for c in tie]).alias("_t"), F.struct(F.lit(True).alias("_"), *[F.col(c).alias("t_" + c) for c in carry]).alias("_pay"),
                                                       F.col(user).cast("double").alias("_u"), *nominal)
    users = cut(t.groupBy(F.col("_u").alias("tu")).agg(F.count(F.lit(1)).alias("_n")))
    lo, hi, most, n_users, rows = users.agg(F.min("tu"), F.max("tu"), F.max("_n"), F.count(F.lit(1)), F.sum("_n")).first()
    if lo is None:
        return spark.createDataFrame([], T.StructType([T.StructField(qid, queries.schema[qid].dataType), T.StructField("rank", T.IntegerType())] + [T.StructField("t_" + c, training.schema[c].dataType) for c in tie + carry]
                                                      + [T.StructField("distance", T.DoubleType())] + [T.StructField("q_" + c, queries.schema[c].dataType) for c in q_carry]))
    # users with more rows than are compared one by one keep the last row of each tuple; those with more tuples are hot
    few, many, hot = t, None, None
    if most > direct_max:
        large = users.where(F.col("_n") > direct_max).select(F.col("tu").alias("_u"))
        last = F.max(F.struct("_t", "_pay")).alias("_l")
        tuples = cut(t.join(large, "_u", "left_semi").groupBy("_u", *names).agg(last).select("_l._t", "_l._pay", "_u", *names))
        hot = cut(tuples.groupBy("_u").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > direct_max).select("_u"))
        few = t.join(large, "_u", "left_anti").unionByName(tuples.join(hot, "_u", "left_anti"))
        many = tuples.join(hot, "_u", "left_semi")
        if hot.isEmpty():
            hot = many = None
    users = (users.withColumn("_hot", F.lit(False)) if hot is None else users.join(hot.select(F.col("_u").alias("tu"), F.lit(True).alias("_hot")), "tu", "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))).select("tu", "_hot")
    # one sorted pass over queries and rows; what it leaves, and what is near a hot user, goes on by joins in rounds of wider bands
    out = ["_q", "rank", "_t", "_pay", "distance"]
    first = near_users.search(q, few, hot, names, k, float(band), lo, hi, n_users, rows + q.count(), distinct=True)
    done: list[DataFrame] = [first.where("rank > 0").select(*out)]
    asked = cut(first.where("rank = 0").select("_q", F.col("_u").alias("_qu"), *[F.col(c).alias("q_" + c) for c in names], "_band"))
    # queries with equal user and attributes have equal neighbours: each such kind is searched once
    equal = ["_qu", *["q_" + c for c in names]]
    kinds = cut(asked.groupBy(*equal).agg(F.max("_band").alias("_band")).withColumn("_kid", F.monotonically_increasing_id()))
    pending = kinds
    left, width = pending.agg(F.count(F.lit(1)), F.max("_band")).first()
    few = few.withColumnRenamed("_u", "tu").withColumnsRenamed({c: "t_" + c for c in names})
    dist = mixed(F.col("_qu"), F.col("tu"), [F.col("q_" + c) for c in names], [F.col("t_" + c) for c in names])
    gkey = ["tu", "sid", *[f"k{i}" for i in range(n)]]
    sieve = None
    if left and many is not None:
        numbered = dense_index(many.withColumnRenamed("_u", "tu"), "_t", out="_tk")
        sieve = cut(sieves(numbered.select("tu", "_tk", *names), "tu", names).join(numbered.drop("tu").withColumnsRenamed({c: "t_" + c for c in names}), "_tk"))
    by_kind: list[DataFrame] = []
    for _ in range(max_rounds):
        if not left:
            break
        pairs = _user_pairs(pending, users, width)
        met = pending.join(pairs.where("NOT _hot").drop("_hot"), "_qu").join(few, "tu").select("_kid", "_t", "_pay", dist.alias("distance"))
        if sieve is not None:
            probes = _explode_subsets(pending.withColumnsRenamed({"q_" + c: c for c in names}), names).withColumnsRenamed({c: "q_" + c for c in names})
            met = met.unionByName(probes.join(pairs.where("_hot").drop("_hot"), "_qu").join(sieve, gkey).select("_kid", "_t", "_pay", dist.alias("distance")))
        last = met.groupBy("_kid", "distance").agg(F.max(F.struct("_t", "_pay")).alias("_l"))
        top = cut(last.withColumn("rank", F.row_number().over(Window.partitionBy("_kid").orderBy("distance"))).where(F.col("rank") <= k).select("_kid", "rank", "_l._t", "_l._pay", "distance"))
        state = pending.join(top.groupBy("_kid").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_dk")), "_kid", "left")
        whole = (F.col("_band") >= F.lit(hi) - F.col("_qu")) & (F.col("_band") >= F.col("_qu") - F.lit(lo))
        full = F.coalesce(F.col("_n"), F.lit(0)) >= k
        state = cut(state.withColumn("_fin", F.coalesce((full & (F.col("_dk") <= F.col("_band") * F.col("_band"))) | whole, F.lit(False)))
                    .withColumn("_next", F.when(full, F.sqrt("_dk") * 1.000001).otherwise(F.col("_band") * 4.0)))
        by_kind.append(top.join(state.where("_fin").select("_kid"), "_kid", "left_semi"))
        pending, got = cut_observing(state.where("NOT _fin").select("_kid", *equal, F.col("_next").alias("_band")), n=F.count(F.lit(1)), w=F.max("_band"))
        left, width = got["n"], got["w"]
    else:
        raise RuntimeError("knn_distinct did not converge")
    if by_kind:
        same = asked.alias("q").join(kinds.alias("k"), _all_equal([(F.col("q." + c), F.col("k." + c)) for c in equal])).select("_q", "_kid")
        for f in by_kind:
            done.append(f.join(same, "_kid").select(*out))
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    return found.select(F.col("_q.id").alias(qid), "rank", *[F.col("_t.t_" + c).alias("t_" + c) for c in tie], *[F.col("_pay.t_" + c).alias("t_" + c) for c in carry], "distance",
                        *[F.col("_q.q_" + c).alias("q_" + c) for c in q_carry])


def _all_equal(pairs):
    out = F.lit(True)
    for a, b in pairs:
        out = out & a.eqNullSafe(b)
    return out


def distinct_by_title(neighbours: DataFrame, queries: DataFrame, k: int = 3, qid: str = "row_key", title: str = "title", tid: str = "t_row_key") -> DataFrame:
    """The neighbours of all query rows sharing a title, again by ``k`` distinct
    distances per title, each with its last training key. Neighbours that carry
    their query's title (``q_<title>``) are not joined with the queries again."""
    if f"q_{title}" in neighbours.columns:
        nb = neighbours.where(F.col(qid).isNotNull()).withColumnRenamed(f"q_{title}", "title")
    else:
        nb = neighbours.join(queries.select(F.col(qid), F.col(title).alias("title")), qid)
    last = nb.groupBy("title", "distance").agg(F.max(tid).alias(tid))
    place = F.row_number().over(Window.partitionBy("title").orderBy("distance"))
    return last.withColumn("rank", place).where(F.col("rank") <= k).select("title", "rank", tid, "distance")
