"""Per-file readers: every file of a folder tree as one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)``, one row per file, recursing into sub-folders.
    Whole-file rows are bounded by the file size (the unit of the operator)."""
    return (spark.read.text(path, wholetext=True, recursiveFileLookup=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("content")))


def merge_lines_expr(c: Column) -> Column:
    """Lines joined by ``,`` with a ``,`` after every line (reference format).
    A line ends at ``\\n``, ``\\r`` or ``\\r\\n``; one final terminator does
    not start an extra empty line."""
    stripped = F.regexp_replace(c, r"(\r\n|\r|\n)\z", "")
    merged = F.concat(F.regexp_replace(stripped, r"\r\n|\r|\n", ","), F.lit(","))
    return F.when(F.length(c) == 0, F.lit("")).otherwise(merged)


def merge_lines(df: DataFrame, col: str = "content", out: str = "merged") -> DataFrame:
    return df.withColumn(out, merge_lines_expr(F.col(col)))
