"""Line numbers across the splits of a file, and records of N lines each.

A text file is read in splits, each by its own task; a line's number in its
file is its place within the split plus the lines of all earlier splits. The
scan gives each line its split (where it begins in the file) and a counter that
rises within a task; a first pass counts the lines of every split (one row a
split leaves a task), a prefix sum over the splits of each file gives their
first numbers, and a second pass numbers the lines without moving them. Only
then are lines brought together, N to a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small
from .tagged import TAGS

LINES = 12          # lines of one tagged record with its two separator lines


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)``: every line of the files with its 0-based number in its file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_from"),
                                         F.monotonically_increasing_id().alias("_at"))
    splits = lines.groupBy("file", "_from").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    begin = splits.select("file", "_from", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return lines.join(broadcast_if_small(begin), ["file", "_from"]).select("file", (F.col("_at") + F.col("_shift")).alias("line"), "value")


def read_line_records(spark: SparkSession, path: str, lines_per_record: int = LINES) -> DataFrame:
    """``(file, record, lines ARRAY<STRING>, _corrupt)``: the files cut every
    ``lines_per_record`` lines, records numbered from 0 in each file. What is
    left at a file's end and has fewer lines goes to ``_corrupt`` (joined by
    line ends; ``lines`` is NULL)."""
    numbered = read_numbered_lines(spark, path)
    record = F.floor(F.col("line") / F.lit(lines_per_record)).cast("long")
    whole = numbered.groupBy("file", record.alias("record")).agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("_l"))
    values = F.transform("_l", lambda x: x.value)
    full = F.size("_l") == lines_per_record
    return whole.select("file", "record", F.when(full, values).alias("lines"), F.when(~full, F.array_join(values, "\n")).alias("_corrupt"))


def _field(lines: str, tag: str) -> Column:
    """The value after ``tag`` on its line of the record; NULL if the line bears another tag."""
    line = F.get(F.col(lines), F.lit(TAGS.index(tag) + 1))
    bare = tag.rstrip()
    return F.when(line.startswith(bare), F.regexp_replace(F.substring(line, F.lit(len(bare) + 1), F.length(line)), "^ ", ""))


def time_and_text(records: DataFrame, lines: str = "lines") -> DataFrame:
    """``(tweet_id, time, text, line, _corrupt)`` of 12-line records: the
    ``Time,Text`` line keyed by the id. A record without these three tagged
    lines, or whose id is no number, goes to ``_corrupt``."""
    got = records.select("file", "record", lines, "_corrupt", _field(lines, "ID: ").alias("_id"), _field(lines, "Time: ").alias("time"), _field(lines, "Text: ").alias("text"))
    tweet_id = F.trim("_id").try_cast("long")
    ok = F.col("_corrupt").isNull() & tweet_id.isNotNull() & F.col("time").isNotNull() & F.col("text").isNotNull()
    return got.select(F.when(ok, tweet_id).alias("tweet_id"), F.when(ok, F.col("time")).alias("time"), F.when(ok, F.col("text")).alias("text"),
                      F.when(ok, F.concat_ws(",", "time", "text")).alias("line"),
                      F.when(~ok, F.coalesce("_corrupt", F.array_join(F.col(lines), "\n"))).alias("_corrupt"))
