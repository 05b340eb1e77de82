"""Follower counts maintained over an edge-file folder with Structured
Streaming. The aggregation is the batch operator unchanged; Spark keeps one
state row per followee in the state store, checkpointed under the shared
checkpoint folder so a restarted query resumes where it stopped."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.counting import follower_count
from ..operators.graph import parse_edge_lines
from ..session import scratch_path


def follower_count_stream(spark: SparkSession, edge_dir: str, sink: str = "memory",
                          name: str = "follower_counts", checkpoint: str | None = None,
                          max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    edges = parse_edge_lines(reader.load(edge_dir))
    counts = follower_count(edges)
    w = (counts.writeStream.outputMode("complete")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    return w.foreachBatch(lambda df, _epoch: df.write.mode("overwrite").parquet(sink)).start()
