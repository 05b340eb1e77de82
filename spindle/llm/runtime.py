"""Small session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import io
import os
import re
import uuid
import zipfile
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spindle.session import ensure_checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package, and keeps Arrow batches of long
    texts small (``BATCH_ROWS`` rows at most). Workers of a local session share
    the driver's machine and get its path; to others the package's modules are
    sent, once an application, as a zip file in the shared folder."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(size)) <= BATCH_ROWS:
        spark.conf.set(size, str(BATCH_ROWS))
    sc = spark.sparkContext
    if re.match(r"local(\[|$)", sc.master):
        path = sc.environment.get("PYTHONPATH", "")
        if _ROOT not in path.split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, path) if x)
    elif sc.applicationId not in _SHIPPED:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(os.path.join(_ROOT, "spindle")):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, _ROOT))
        where = f"{_shared(spark)}/spindle-{sc.applicationId}.zip"
        at = sc._jvm.org.apache.hadoop.fs.Path(where)
        stream = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
        try:
            stream.write(bytearray(packed.getvalue()))
        finally:
            stream.close()
        sc.addPyFile(where)
        _SHIPPED.add(sc.applicationId)


def _shared(spark: SparkSession) -> str:
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def released(batches):
    """The batches that a task makes; at its end the memory of what it has dropped
    goes back to the system. A Python worker waits for its next task, often of
    another stage, with all that it has not given back."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):        # the C library's; not all have it
            trim(0)


_MADE: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names."""
    _MADE.append(f"{_shared(spark)}/spindle-llm-{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


@contextmanager
def scratch_removed(spark: SparkSession):
    """Removes, at its end, the tables that operators wrote within it. Their
    results are lazy, so write or collect these inside."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            drop_path(spark, path)
        del _MADE[before:]


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table that ``written`` made, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


TASK_ROWS = 20_000


def few_tasks(frame: DataFrame, rows: int | None, task_rows: int = TASK_ROWS) -> DataFrame:
    """``frame``, made from about ``rows`` rows, with no more tasks in its last stage
    than they need or the cluster has cores: its partitions are put together, without
    a shuffle, as each costs a task and a file, however few rows it has. None: as it is."""
    if rows is None:
        return frame
    return frame.coalesce(max(frame.sparkSession.sparkContext.defaultParallelism, -(-rows // task_rows)))


def written(spark: SparkSession, frame: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """``frame`` as a Parquet table in the shared folder (cuts its lineage); ``rows``
    as for ``few_tasks``, if known."""
    path = fresh_path(spark, name)
    few_tasks(frame, rows).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path
