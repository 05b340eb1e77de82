"""spindle: Spark-native batch analytics over edge lists, 1-D points,
tagged text records and mixed-type rows.

Every operator takes DataFrames (plus scalars) and returns a DataFrame.
Iterative operators (k-means, PageRank, shortest paths, K-NN widening)
run a short driver loop whose state is cut with ``checkpoint()`` into the
directory named by ``spark.checkpoint.dir``.
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming", "session"]
