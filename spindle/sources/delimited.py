"""Delimited-line readers of the reference's inputs (schemas by position)
and the separator-specific writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distance import safe_int

BOOK_FIELDS = ["user_id", "location", "col2", "col3", "title", "author", "year", "publisher"]


def parse_book_rows(lines: DataFrame, col: str = "value") -> DataFrame:
    """``user|location|x|x|title|author|year|publisher`` lines. Rows with
    fewer than 8 fields or a non-numeric user go to ``_corrupt`` (kept,
    flagged) instead of failing the job; a bad year becomes 0."""
    p = F.split(F.col(col), r"\|")
    ok = (F.size(p) >= 8) & F.get(p, 0).try_cast("double").isNotNull()
    return lines.select(
        F.get(p, 0).try_cast("double").alias("user_id"),
        F.get(p, 1).alias("location"), F.get(p, 2).alias("col2"), F.get(p, 3).alias("col3"),
        F.get(p, 4).alias("title"), F.get(p, 5).alias("author"),
        safe_int(F.get(p, 6)).alias("year"), F.get(p, 7).alias("publisher"),
        F.when(~ok, F.col(col)).alias("_corrupt"))


def read_book_rows(spark: SparkSession, path: str) -> DataFrame:
    return parse_book_rows(spark.read.text(path))


def _file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``line``, their place in (file name, position) order."""
    return spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                                                          F.monotonically_increasing_id().alias("n")).alias("line"))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``term<TAB>score`` -> (term, score INT, line, _corrupt); ``line`` orders
    duplicates so that the later one can win; lines without a term or with a
    score that is no integer are kept in ``_corrupt`` (their score is NULL)."""
    p = F.split(F.col("value"), "\t")
    score = F.get(p, 1).try_cast("int")
    ok = score.isNotNull() & (F.length(F.get(p, 0)) > 0)
    return _file_lines(spark, path).select(F.when(ok, F.get(p, 0)).alias("term"), F.when(ok, score).alias("score"), "line",
                                           F.when(~F.coalesce(ok, F.lit(False)), F.col("value")).alias("_corrupt"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB|SPACE>value`` -> (id, x DOUBLE); unparsable values are dropped
    into ``_corrupt``."""
    p = F.split(F.col("value"), r"\t| ")
    return spark.read.text(path).select(F.get(p, 0).alias("id"), F.get(p, 1).try_cast("double").alias("x"),
                                        F.when(F.get(p, 1).try_cast("double").isNull(), F.col("value"))
                                        .alias("_corrupt"))


def read_centroids(spark: SparkSession, path: str) -> list[float]:
    """First field of every line of every file of a folder, in file name and line
    order (k numbers: the clusters' centres are the only data that reaches the driver)."""
    c = F.get(F.split(F.col("value"), r"\t| "), 0).try_cast("double")
    return [r["c"] for r in _file_lines(spark, path).select("line", c.alias("c")).where("c IS NOT NULL").orderBy("line").toLocalIterator()]


def write_separated(df: DataFrame, path: str, sep: str, quote_all: bool = False) -> None:
    """Key/value text sinks: ``\\t`` (counts, centres, neighbours), ``;``
    (scored tweets), ``,`` (tweet CSV), ``' '`` (node lines)."""
    (df.write.mode("overwrite").option("sep", sep).option("quoteAll", quote_all)
     .option("escape", '"').csv(path))


def write_values(df: DataFrame, path: str, col: str = "value") -> None:
    """Value-only lines (no key)."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)


def write_per_file(df: DataFrame, path: str, file_col: str = "file", col: str = "value") -> None:
    """One output folder per source file (``<path>/<file_col>=<name>/``),
    written by the executors in parallel."""
    df.select(F.col(file_col), F.col(col).cast("string").alias("value")) \
        .write.mode("overwrite").partitionBy(file_col).text(path)


def flatten_records(records: DataFrame, col: str = "value") -> DataFrame:
    """Raw record -> one line with the record's lines joined by ``,,``."""
    body = F.regexp_replace(F.regexp_replace(F.col(col), r"^(\*\*\*\n)+", ""), r"(\n?\*\*\*)?\n?\z", "")
    return records.select(F.array_join(F.split(body, "\n"), ",,").alias("value"))
