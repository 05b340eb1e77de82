"""Tagged multi-line records (raw tweets) and their CSV form.

A record is ten tagged lines between ``***`` lines, one or two of them between
consecutive records, with LF or CRLF ends (``records.read_records`` cuts the
files, in parallel). A field value may span lines. The text
is free and may hold lines that look like tags: the fields after it are taken
from the record's end, so it keeps whatever stands before them. A line of
asterisks within a field is written with a backslash before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import read_records

# Fixed values of the record format, in record order.
TAGS = ["Type:", "Origin: ", "Text: ", "URL: ", "ID: ", "Time: ", "RetCount: ", "Favorite: ",
        "MentionedEntities: ", "Hashtags: "]
TIME_FORMAT = "MMM dd HH:mm:ss zzz yyyy"   # after the leading weekday is removed
RENDER_TIME_FORMAT = "EEE MMM dd HH:mm:ss zzz yyyy"
RENDER_TIME_FORMAT_UTC = "EEE MMM dd HH:mm:ss 'UTC' yyyy"

FIELDS = ["type", "origin", "text", "url", "tweet_id", "time", "ret_count", "favorite",
          "mentioned", "hashtags"]


def read_tagged_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (column ``value``), without its separator lines."""
    return read_records(spark, path).select("value")


# Type, origin and text from the front (the text takes all it can), the rest from the end.
_RECORD = r"(?s)\A" + r"\n".join([TAGS[0] + "(.*?)", TAGS[1] + "(.*?)", TAGS[2] + "(.*)"] + [rf"{t.strip()} ?(.*?)" for t in TAGS[3:-1]] + [TAGS[-1].strip() + r" ?(.*)"]) + r"\z"


def parse_tagged_records(records: DataFrame, col: str = "value") -> DataFrame:
    """Record text -> typed columns (tweet_id BIGINT, time TIMESTAMP_NTZ in
    UTC, mentioned ARRAY<BIGINT>, hashtags ARRAY<STRING>, ...) and ``_corrupt``:
    the record if it has not all fields, no usable id, or a mention that is no
    number. Empty records (between separators) are no records."""
    body = F.regexp_replace(F.col(col), r"^(\*\*\*\n)+", "")
    body = F.regexp_replace(body, r"(\n?\*\*\*)?\n?\z", "")
    raw = records.select(F.col(col).alias("_raw"), body.alias("_b")).where(F.length(F.trim("_b")) > 0)

    def field(i: int) -> Column:
        return F.regexp_replace(F.regexp_extract("_b", _RECORD, i + 1), r"(?m)^\\(\\*\*\*\*)$", "$1")

    raw = raw.select("_raw", F.col("_b").rlike(_RECORD).alias("_ok"), *[field(i).alias(FIELDS[i]) for i in range(len(TAGS))])
    time_txt = F.regexp_replace(F.trim(F.col("time")), r"^[A-Za-z]{3} ", "")
    ts = F.try_to_timestamp(time_txt, F.lit(TIME_FORMAT))   # an instant (zone in the text)

    def words(c):
        return F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")

    mentioned = F.transform(words(F.col("mentioned")), lambda x: x.try_cast("long"))
    tweet_id = F.trim("tweet_id").try_cast("long")
    good = F.col("_ok") & tweet_id.isNotNull() & ~F.exists(mentioned, lambda x: x.isNull())
    return raw.select(
        tweet_id.alias("tweet_id"),
        F.trim("type").alias("type"),
        F.col("origin"),
        F.col("text"),
        F.col("url"),
        utc_wall_clock(ts).alias("time"),
        F.trim("ret_count").try_cast("int").alias("ret_count"),
        (F.lower(F.trim("favorite")) == "true").alias("favorite"),
        mentioned.alias("mentioned"),
        words(F.col("hashtags")).alias("hashtags"),
        F.when(~good, F.col("_raw")).alias("_corrupt"),
    )


def utc_wall_clock(ts: Column) -> Column:
    """Instant -> TIMESTAMP_NTZ holding its UTC wall-clock time, independent
    of the session time zone."""
    secs = (F.unix_micros(ts) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=secs)


def render_time(df: DataFrame, c: str = "time") -> Column:
    """Record time text. TIMESTAMP_NTZ values are UTC wall-clock times and are
    printed with a literal ``UTC``; TIMESTAMP values print their session zone."""
    if isinstance(df.schema[c].dataType, T.TimestampNTZType):
        return F.date_format(F.col(c), RENDER_TIME_FORMAT_UTC)
    return F.date_format(F.col(c).cast("timestamp"), RENDER_TIME_FORMAT)


def render_tagged_records(df: DataFrame) -> DataFrame:
    """Inverse of the parser: one ``value`` per record, ``***`` lines around.
    ``time`` is rendered in the session time zone."""
    def s(c):
        return F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"(?m)^(\\*\*\*\*)$", r"\\$1")
    lines = [
        F.concat(F.lit(TAGS[0]), s("type")),
        F.concat(F.lit(TAGS[1]), s("origin")),
        F.concat(F.lit(TAGS[2]), s("text")),
        F.concat(F.lit(TAGS[3]), s("url")),
        F.concat(F.lit(TAGS[4]), s("tweet_id")),
        F.concat(F.lit(TAGS[5]), render_time(df)),
        F.concat(F.lit(TAGS[6]), s("ret_count")),
        F.concat(F.lit(TAGS[7]), F.when(F.col("favorite"), "true").otherwise("false")),
        F.concat(F.lit(TAGS[8]), F.concat(F.array_join(F.col("mentioned").cast("array<string>"), " "),
                                          F.lit(" "))),
        F.concat(F.lit(TAGS[9] + " "), F.array_join(F.col("hashtags"), " ")),
    ]
    return df.select(F.concat_ws("\n", F.lit("***"), *lines, F.lit("***")).alias("value"))


def tweet_csv_line(df: DataFrame) -> DataFrame:
    """``ID,"Time","Text"`` with RFC 4180 quoting (inner quotes doubled)."""
    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    time_txt = render_time(df)
    return df.select("tweet_id", F.concat_ws(",", F.col("tweet_id").cast("string"), quoted(time_txt),
                                             quoted(F.col("text"))).alias("line"))


def write_tweet_csv(df: DataFrame, path: str) -> None:
    (df.select("tweet_id", render_time(df).alias("time"), "text")
     .write.mode("overwrite").option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_tweet_csv(spark: SparkSession, path: str) -> DataFrame:
    """``ID,"Time","Text"`` rows -> (tweet_id, time in UTC, text, _corrupt).
    Texts may hold line ends, quotes and commas."""
    raw = (spark.read.schema("id STRING, time STRING, text STRING, _corrupt STRING").option("columnNameOfCorruptRecord", "_corrupt")
           .option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    ts = F.try_to_timestamp(F.regexp_replace("time", r"^[A-Za-z]{3} ", ""), F.lit(TIME_FORMAT))
    tweet_id = F.trim("id").try_cast("long")
    return raw.select(tweet_id.alias("tweet_id"), utc_wall_clock(ts).alias("time"), F.coalesce("text", F.lit("")).alias("text"),
                      F.coalesce("_corrupt", F.when(tweet_id.isNull(), F.concat_ws(",", "id", "time", "text"))).alias("_corrupt"))
