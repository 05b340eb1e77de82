"""Exact deduplication with keyed streaming state.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` is one
space. Rows arrive as a stream of (digest, id, content locator) in several
micro-batches; the state, keyed by digest and held in RocksDB on the
executors' disks with its changes in the shared checkpoint folder, keeps for
each digest the smallest id (the stable identifier), where its text stands
(content locator: file, id and length) and the number of arrivals. It has no
watermark and never expires, so later batches meet everything seen before, and
a killed executor's part is rebuilt from the checkpoint. Arrivals of one digest
are combined within a task before the state's shuffle, so a hot text costs a
row a task.

A digest hit is not trusted: every arrival after the first is compared, byte by
byte, with the text under the retained locator. The table of hit digests is
broadcast if it has at most ``BROADCAST_ROWS`` rows (about 150 bytes each) and
joined by shuffle otherwise. Hot digests are dealt over as
many salts as their size asks for. Texts that differ under one digest (tests
force this with a short digest) are grouped by their full bytes instead.

Defined cases: a null text counts as empty; empty texts are equal to each other;
of equal texts the smallest id stays, null ids only where no other is; of
repeated rows (equal id and text) one stays; an empty table gives no rows;
other columns are kept by ``keep_first``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .runtime import drop_path, fresh_path, written

BATCHES = 3
SALT_ROWS = 1000
BROADCAST_ROWS = 100_000
DIGEST_BYTES = 32

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",      # many small stores: no disk space ahead of need
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _digest(text: Column, digest_bytes: int) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, digest_bytes)


def state_of(spark: SparkSession, arrivals_path: str, batches: int = BATCHES) -> tuple[DataFrame, str]:
    """Stream the arrivals table through the keyed state; the state's content as
    (digest, keep_id, locator, group_size) and the stream's folder."""
    where = fresh_path(spark, "dedup-state")
    stored = spark.read.parquet(arrivals_path)
    files = max(1, len(stored.inputFiles()))
    stream = (spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(arrivals_path))
    first = F.min(F.struct(F.isnull("id").alias("unnamed"), F.col("id"), F.col("locator"))).alias("first")
    keyed = stream.groupBy("digest").agg(first, F.count("*").alias("n"))
    with _settings(spark, _STATE):
        query = keyed.writeStream.format("noop").outputMode("update").option("checkpointLocation", where).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.lastProgress is None:          # nothing arrived
            return stored.select("digest", F.col("id").alias("keep_id"), "locator", F.lit(0).cast("long").alias("group_size")).limit(0), where
        state = spark.read.format("statestore").load(where)
    return state.select(F.col("key.digest").alias("digest"), F.col("value.min.id").alias("keep_id"), F.col("value.min.locator").alias("locator"),
                        F.col("value.count").alias("group_size")), where


def members(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES,
            digest_bytes: int = DIGEST_BYTES, salt_rows: int = SALT_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, digest (of the normalised text), check (a
    second hash of it), keep_id, group_size, kept."""
    body = normalised(text)
    named = docs.select(F.col(key).alias("id"), body.alias("body"), F.input_file_name().alias("file")).withColumn("digest", _digest(F.col("body"), digest_bytes))
    locator = F.struct(F.input_file_name().alias("file"), F.octet_length(body).alias("bytes"))
    arrivals, arrived = written(spark, docs.select(F.col(key).alias("id"), _digest(body, digest_bytes).alias("digest"),
                                                   F.xxhash64(body).alias("check"), locator.alias("locator")), "arrivals")
    state, streamed = state_of(spark, arrived, batches)
    state, _ = written(spark, state, "state")
    drop_path(spark, streamed)

    # full bytes of every hit against the text under the retained locator
    hit, _ = written(spark, state.where("group_size > 1").withColumn("salts", F.ceil(F.col("group_size") / salt_rows).cast("int")), "hits")
    if hit.count() <= broadcast_rows:           # then the texts that stand once stay where they are
        hit = F.broadcast(hit)
    texts = named.join(hit.select("digest", "keep_id", "locator", "salts"), "digest")
    located = (F.col("file") == F.col("locator.file")) & F.col("id").eqNullSafe(F.col("keep_id")) & (F.octet_length("body") == F.col("locator.bytes"))
    retained = (texts.where(located).groupBy("digest")
                .agg(F.min("body").alias("retained"), F.first("salts").alias("salts"))
                .select("digest", "retained", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    dealt = texts.withColumn("salt", F.pmod(F.xxhash64("id", "body"), F.col("salts")).cast("int")).select("id", "digest", "body", "salt")
    differ, _ = written(spark, dealt.join(retained, ["digest", "salt"], "left").where("retained is null or body != retained").select("id", "digest", "body"), "differ")

    found = arrivals.select("id", "digest", "check").join(state.select("digest", "keep_id", "group_size"), "digest")
    if not differ.isEmpty():
        apart = differ.groupBy("digest", "body").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size")).withColumn("check", F.xxhash64("body")).drop("body")
        fewer = apart.groupBy("digest").agg(F.sum("group_size").alias("fewer"))
        own = found.join(apart.select("digest", "check"), ["digest", "check"], "left_anti").join(fewer, "digest", "left")
        own = own.withColumn("group_size", F.col("group_size") - F.coalesce("fewer", F.lit(0))).drop("fewer")
        found = own.unionByName(arrivals.select("id", "digest", "check").join(apart, ["digest", "check"]))
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    twice = arrivals.groupBy("id", "digest", "check").count().where("count > 1").drop("count")
    twice, _ = written(spark, twice, "twice")
    if twice.isEmpty():
        return found.withColumn("kept", first)
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")) & (F.col("check") == F.col("c"))
    keys = twice.select(F.col("id").alias("i"), F.col("digest").alias("d"), F.col("check").alias("c"))
    nth = F.row_number().over(Window.partitionBy("id", "digest", "check").orderBy("group_size"))
    repeated = found.join(keys, same, "left_semi").withColumn("kept", first & (nth == 1))
    return found.join(keys, same, "left_anti").withColumn("kept", first).unionByName(repeated)


def keep_first(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text an earlier id has; same columns."""
    found = members(spark, docs, key, text, **options)
    digest_bytes = options.get("digest_bytes", DIGEST_BYTES)
    on = ["spindle_digest", "spindle_check", "spindle_id"]
    found = found.select(F.col("digest").alias(on[0]), F.col("check").alias(on[1]), F.col("id").alias(on[2]), "keep_id")
    body = normalised(F.col("spindle_row").getField(text))
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("spindle_row"))
            .select("spindle_row", _digest(body, digest_bytes).alias(on[0]), F.xxhash64(body).alias(on[1]), F.col("spindle_row").getField(key).alias(on[2])))

    def on_null_safe(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.select(*[F.col(c).alias(f"{c}_b") for c in on])
        cond = (a[on[0]] == b[f"{on[0]}_b"]) & (a[on[1]] == b[f"{on[1]}_b"]) & a[on[2]].eqNullSafe(b[f"{on[2]}_b"])
        return a.join(b, cond, how)

    gone = found.where(~F.col(on[2]).eqNullSafe(F.col("keep_id"))).select(*on).distinct()
    kept = on_null_safe(rows, gone, "left_anti")
    twice, _ = written(spark, found.groupBy(*on).count().where("count > 1").select(*on), "twice")
    if not twice.isEmpty():
        nth = F.row_number().over(Window.partitionBy(*on).orderBy(F.xxhash64("spindle_row")))
        one = on_null_safe(kept, twice, "left_semi").withColumn("spindle_nth", nth).where("spindle_nth = 1").drop("spindle_nth")
        kept = on_null_safe(kept, twice, "left_anti").unionByName(one)
    return kept.select(*[F.col("spindle_row").getField(c).alias(c) for c in docs.columns])
