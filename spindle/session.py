"""Session helpers: building a local session for tests/bench and making
sure a reliable checkpoint directory is configured."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PIECE_ROWS = 60_000_000        # rows shuffled at a time by operators that work in pieces


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "spindle", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session
    (spark-submit) is used instead and this is never called."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.default.parallelism", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    always used when set. Only when it is unset (local tests) do we fall
    back to a fresh scratch folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spindle-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder, for operators that
    write an intermediate table (e.g. a rendered text file) and read it back."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/spindle-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """A query that runs within it leaves no shuffle files: they go when it ends, not
    when the driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df, name: str, made: list[str] | None = None):
    """``df`` as a compressed Parquet table in the shared folder, read back: cuts the
    plan as a checkpoint does, in a fraction of its bytes where rows are wide, but
    without its partitioning. Its path is added to ``made``."""
    return stored_pieces([df], name, made)


def stored_pieces(pieces: Iterable, name: str, made: list[str] | None = None):
    """``stored`` for the union of frames of one schema, computed one after another:
    the disks hold the shuffle files of one piece at a time."""
    path = schema = None
    for df in pieces:
        spark = df.sparkSession
        path, schema = path or scratch_path(spark, name), schema or df.schema
        with shuffles_removed(spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(schema).parquet(path)


def piece_count(rows: int) -> int:
    """Pieces for work on ``rows`` rows, of about ``PIECE_ROWS`` each."""
    return max(1, -(-rows // PIECE_ROWS))


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove scratch paths that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        where = jvm.org.apache.hadoop.fs.Path(p)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(spark: SparkSession, rows: int, row_bytes: int = 32) -> int:
    """Partition count for an explicit repartition of ``rows`` rows: at least
    the session's shuffle partitions, and enough that each partition stays
    near the AQE advisory size (64 MB by default) at any scale."""
    target = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    units = {"b": 1, "kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30}
    t = target.strip().lower()
    num = "".join(ch for ch in t if ch.isdigit() or ch == ".")
    unit = t[len(num):].strip() or "b"
    size = int(float(num) * units.get(unit, 1))
    return max(shuffle_partitions(spark), -(-rows * row_bytes // max(size, 1)))


def broadcast_if_small(df, max_rows: int = 100_000):
    """Broadcast ``df`` only after checking its row count (one small job);
    above the bound it is returned as is and joins by shuffle."""
    from pyspark.sql import functions as F
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


__all__ = ["broadcast_if_small", "build_session", "ensure_checkpoint_dir", "drop_scratch", "scratch_path", "shuffle_partitions", "shuffles_removed", "stored", "stored_pieces", "piece_count", "partitions_for"]
