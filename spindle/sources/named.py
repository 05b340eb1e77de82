"""A sink that writes one named text file per key.

The rows are dealt by key, sorted by key and their order within it, and
streamed into one staging folder per key by Spark's own writer, whose commit
protocol keeps the output of failed and repeated tasks out. When that job has
committed, each key's file is moved to ``<path>/<key><suffix>``; a move is a
rename, can be repeated after a lost driver (``finish``), and takes no data
through the driver. A key's file is written by one task row by row, so its size
is not bound by memory.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGE = ".staged-"
_KEY = "spindle_file"


def _safe(name: Column) -> Column:
    """A file name: ``f`` and the text, of which letters, digits, ``.``, ``_`` and ``-`` stay and other bytes are ``=XX``; ``=00`` alone stands for NULL."""
    spelt = F.replace(F.replace(F.replace(F.url_encode(name), F.lit("*"), F.lit("%2A")), F.lit("+"), F.lit("%20")), F.lit("%"), F.lit("="))
    return F.when(name.isNull(), F.lit("=00")).otherwise(F.concat(F.lit("f"), spelt))


def write_named_files(df: DataFrame, path: str, key: str, order: list[str], value: str = "value", suffix: str = ".txt") -> int:
    """One file ``<path>/f<key><suffix>`` per value of ``key`` with its ``value``
    lines in ``order``; returns the number of files. An existing file of a
    key is replaced."""
    spark = df.sparkSession
    stage = f"{path.rstrip('/')}/{_STAGE}{uuid.uuid4().hex[:12]}"
    named = df.select(_safe(F.col(key).cast("string")).alias(_KEY), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).cast("string").alias("value"))
    by = [f"_o{i}" for i in range(len(order))]
    (named.repartition(_KEY).sortWithinPartitions(_KEY, *by).select(_KEY, "value")
     .write.option("maxRecordsPerFile", 0).partitionBy(_KEY).text(stage))
    return finish(spark, path, suffix)


def finish(spark: SparkSession, path: str, suffix: str = ".txt") -> int:
    """Moves the files of all committed staging folders under ``path`` to their
    names and removes the folders; those that never committed are removed
    unread. Can be called again at any time."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moved = 0
    for stage in [s.getPath() for s in fs.listStatus(at(path)) if s.getPath().getName().startswith(_STAGE)]:
        if fs.exists(at(stage, "_SUCCESS")):
            folders = [s.getPath() for s in fs.listStatus(stage) if s.isDirectory()]

            def move(folder) -> int:
                name = jvm.java.net.URLDecoder.decode(folder.getName().split("=", 1)[1], "UTF-8")
                files = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
                if len(files) > 1:
                    raise RuntimeError(f"{folder} has {len(files)} files")
                target = at(path, name + suffix)
                for f in files:
                    fs.delete(target, False)
                    if not fs.rename(f, target):
                        raise RuntimeError(f"cannot move {f}")
                return len(files)

            with ThreadPoolExecutor(8) as pool:
                moved += sum(pool.map(move, folders))
        fs.delete(stage, True)
    return moved


def read_named_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``(key, line, value)``: the lines of such files, numbered from 0 in each."""
    from .numbered import read_numbered_lines
    lines = read_numbered_lines(spark, f"{path.rstrip('/')}/*{suffix}")
    name = F.regexp_extract(F.url_decode("file"), rf"([^/]*)\Q{suffix}\E$", 1)
    spelt = F.replace(F.substring(name, F.lit(2), F.length(name)), F.lit("="), F.lit("%"))
    return lines.select(F.when(name != "=00", F.url_decode(spelt)).alias("key"), "line", "value")
