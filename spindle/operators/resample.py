"""The reference's own resampling scheme, in linear work.

Within a split of n rows, row i (from 1) is drawn n - i + 1 times; a draw gives
two copies with probability 1/10, four with another 1/10, else none. All copies
are shuffled and the first n are kept. Written out, that is n^2 draws; here

* the numbers of two- and four-copy draws of a row come from seeded binomials:
  counted draw by draw for the last ``EXACT`` rows of a split, by the normal
  approximation (rounded, within its range) for the others;
* "the first n of a shuffle" are the copies with the n smallest of uniform
  random keys. A row with m copies needs only its smallest keys: they are the
  partial sums of exponential gaps, key_j = 1 - exp(-sum_{i<=j} E_i / (m - i + 1)),
  and are generated only up to a threshold that holds slightly more than n keys
  of the split, about one a row;
* the n-th smallest key is found without a global sort: keys below a lower
  threshold are only counted, and only those between the thresholds (about the
  square root of n) are ranked.

All randomness is md5 of a seed, the row's key and a counter, so any engine can
repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import md5_u60
from ..plans.loops import cut
from ..session import broadcast_if_small
from .neighbors import dense_index

EXACT = 64           # rows at a split's end whose draws are made one by one
BLOCK = 16           # keys of a row generated at a time
MARGIN = 6.0         # standard deviations between the expected number of keys and each threshold

# Shares of draws that give two and four copies (one of ten numbers each).
TWO, FOUR = 0.1, 0.1


def uniform(seed: int, name: str, key: Column, counter: Column) -> Column:
    """A repeatable number strictly between 0 and 1."""
    return (md5_u60(F.concat_ws(":", F.lit(str(seed)), F.lit(name), key.cast("string"), counter.cast("string"))) % F.lit(1 << 48) + F.lit(0.5)) / F.lit(float(1 << 48))


def _normal(seed: int, name: str, key: Column) -> Column:
    return F.sqrt(-2 * F.log(uniform(seed, name, key, F.lit(0)))) * F.cos(2 * 3.141592653589793 * uniform(seed, name, key, F.lit(1)))


def _binomial(n: Column, p: float, z: Column) -> Column:
    mean = n * F.lit(p)
    return F.greatest(F.lit(0.0), F.least(n.cast("double"), F.floor(mean + z * F.sqrt(mean * F.lit(1 - p)) + F.lit(0.5)))).cast("long")


def multiplicities(df: DataFrame, key: str, split: str, seed: int = 0) -> DataFrame:
    """``df`` with ``_n`` (rows of its split) and ``_m`` (its copies in the split's
    list). Rows of a split stand in ``key`` order; a key is unique."""
    placed = cut(dense_index(df, [split, key], out="_at"))
    sizes = placed.groupBy(split).agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    draws = placed.join(broadcast_if_small(sizes), split).withColumn("_d", F.col("_n") - (F.col("_at") - F.col("_low")))
    one = F.transform(F.sequence(F.lit(1).cast("long"), F.col("_d")), lambda j: md5_u60(F.concat_ws(":", F.lit(str(seed)), F.lit("draw"), F.col(key).cast("string"), j.cast("string"))) % 10)
    counted = F.aggregate(one, F.lit(0).cast("long"), lambda a, x: a + F.when(x == 4, 2).when(x == 8, 4).otherwise(0))
    hits = _binomial(F.col("_d"), TWO + FOUR, _normal(seed, "hits", F.col(key)))
    twos = _binomial(F.col("_h"), TWO / (TWO + FOUR), _normal(seed, "twos", F.col(key)))
    return (draws.withColumn("_h", F.when(F.col("_d") > EXACT, hits))
            .withColumn("_m", F.when(F.col("_d") <= EXACT, counted).otherwise(2 * twos + 4 * (F.col("_h") - twos)))
            .drop("_at", "_low", "_d", "_h"))


def _keys(rows: DataFrame, key: str, split: str, seed: int) -> DataFrame:
    """(split, key, copy, _k) with the smallest keys of every row, up to ``_high``. Rows that
    have further keys below it go another round of ``BLOCK``."""
    out, base = None, 0
    state = rows.select(split, key, "_m", "_high", F.lit(0.0).alias("_sum"))
    while True:
        gaps = F.transform(F.sequence(F.lit(base + 1), F.lit(base + BLOCK)), lambda j: F.when(j <= F.col("_m"), -F.log(uniform(seed, "key", F.col(key), j)) / (F.col("_m") - j + 1)).otherwise(float("inf")))      # none beyond the last copy
        sums = F.aggregate(gaps, F.array(F.col("_sum")), lambda a, g: F.concat(a, F.array(F.element_at(a, -1) + g)))   
        state = cut(state.withColumn("_s", F.slice(sums, 2, BLOCK)))
        each = (state.select(split, key, "_high", F.posexplode("_s").alias("copy", "_e"))
                .select(split, key, (F.col("copy") + F.lit(base + 1)).cast("long").alias("copy"), "_high", (1 - F.exp(-F.col("_e"))).alias("_k"))
                .where("_k <= _high AND _k < 1").drop("_high"))
        out = each if out is None else out.unionByName(each)
        state = state.withColumn("_sum", F.element_at("_s", -1)).where("1 - exp(-_sum) <= _high AND 1 - exp(-_sum) < 1").drop("_s")
        if state.isEmpty():
            return cut(out)
        base += BLOCK


def scheme_sample(df: DataFrame, key: str, split: str, seed: int = 0) -> DataFrame:
    """The rows of ``df`` that the scheme emits, each as often as it stands among
    the first n copies of its split, with ``copy`` (from 1). A split whose list
    has fewer than n copies gives all of them."""
    rows = cut(multiplicities(df, key, split, seed))
    total = rows.groupBy(split).agg(F.first("_n").alias("_n"), F.sum("_m").alias("_total"))
    share = F.col("_n") / F.greatest(F.col("_total"), F.lit(1))
    spread = F.lit(MARGIN) * (F.sqrt(F.col("_n").cast("double")) + 1) / F.greatest(F.col("_total"), F.lit(1))
    total = cut(total.select(split, "_n", "_total", (share - spread).alias("_low"), (share + spread).alias("_high")))
    done = None
    while True:
        keyed = _keys(rows.join(broadcast_if_small(total.select(split, "_high")), split), key, split, seed)
        state = keyed.join(broadcast_if_small(total.select(split, "_low")), split)
        counted = state.groupBy(split).agg(F.count(F.lit(1)).alias("_got"), F.sum((F.col("_k") <= F.col("_low")).cast("long")).alias("_sure"))
        about = cut(total.join(counted, split, "left").fillna(0, ["_got", "_sure"]))
        # rank only what lies between the thresholds
        sound = about.where("(_got >= least(_n, _total)) AND _sure <= _n")
        held = state.join(broadcast_if_small(sound.select(split, "_n", "_sure")), split)
        between = held.where("_k > _low")
        place = F.row_number().over(Window.partitionBy(split).orderBy("_k", key, "copy"))
        kept = (held.where("_k <= _low").select(split, key, "copy")
                .unionByName(between.withColumn("_p", place).where("_p <= _n - _sure").select(split, key, "copy")))
        done = kept if done is None else done.unionByName(kept)
        wide = about.where("NOT ((_got >= least(_n, _total)) AND _sure <= _n)")
        if wide.isEmpty():
            break
        # by far the rarest case: thresholds that missed are moved apart, for their splits alone
        gap = F.col("_high") - F.col("_low")
        total = cut(wide.select(split, "_n", "_total", (F.col("_low") - gap).alias("_low"), F.least(F.lit(1.0), F.col("_high") + gap).alias("_high")))
        rows = rows.join(broadcast_if_small(total.select(split)), split, "left_semi")
    return df.join(done, [split, key])          # a row's keys rise with their number, so what is kept of it are its copies 1, 2, ...
