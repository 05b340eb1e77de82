"""Records between lines of three asterisks, one or several such lines apart,
with LF or CRLF line ends.

Spark's text source cuts the files at ``\\n***`` (split-aware, so a large file
is read in parallel). What follows such a cut is the start of a record if the
line ends there; otherwise the text merely had a line that begins with three
asterisks, and the piece belongs to the one before it. Such pieces are rare:
they alone are numbered, gathered and put back, wherever the border of a split
lies, so that all other records stay in the task that read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.loops import cut
from ..session import broadcast_if_small

_CUT = "\n***"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, value)``: the text of each record without its separator
    lines, ``record`` rising in the order of the file (with gaps). CRLF files
    give LF texts. Records without any text are left out; a line of asterisks
    with something before or after them (such as the escaped ``\\***``) is text."""
    raw = spark.read.option("lineSep", _CUT).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_from"),
                                                               F.monotonically_increasing_id().alias("_at"))
    per_split = raw.groupBy("file", "_from").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    begin = per_split.select("file", "_from", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    pieces = raw.join(broadcast_if_small(begin), ["file", "_from"]).select("file", (F.col("_at") + F.col("_shift")).alias("record"), "value")
    continued = (F.col("record") > 0) & ~F.col("value").rlike(r"\A\r?(\n|\z)")
    heads = pieces.where(~continued)
    parts = cut(pieces.where(continued))
    if not parts.isEmpty():
        heads = _put_back(heads, parts)
    # the first record of a file still has its opening line
    body = F.regexp_replace("value", r"\A\*\*\*(?=\r?\n|\z)", "")
    windows = body.startswith("\r\n")
    body = F.when(windows, F.regexp_replace(body, r"\r(?=\n|\z)", "")).otherwise(body)
    body = F.regexp_replace(F.regexp_replace(body, r"\A\n", ""), r"\n\z", "")
    return heads.select("file", "record", body.alias("value")).where(~F.col("value").rlike(r"\A\s*\z"))


def _put_back(heads: DataFrame, parts: DataFrame) -> DataFrame:
    """Pieces that are no starts joined to the record before them. A chain of
    such pieces has consecutive numbers, so number less rank tells the chain."""
    from ..operators.neighbors import dense_index
    ranked = dense_index(parts, ["file", "record"], out="_rank").withColumn("_chain", F.col("record") - F.col("_rank"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("record", "value"))), lambda p: p.value), _CUT)
    chains = ranked.groupBy("file", "_chain").agg((F.min("record") - 1).alias("record"), text.alias("_more"))
    joined = heads.join(broadcast_if_small(chains.select("file", "record", "_more"), 10_000), ["file", "record"], "left")
    return joined.select("file", "record", F.when(F.col("_more").isNotNull(), F.concat("value", F.lit(_CUT), "_more")).otherwise(F.col("value")).alias("value"))
