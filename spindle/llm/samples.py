"""Bounded samples of labelled texts for the fits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SENT_KEYS = 1_000_000           # keys that are broadcast; beyond that they are joined by shuffle


def labelled_texts(docs: DataFrame, marked: DataFrame, rows: int, sizes: tuple[int, int], labels: list | None = None) -> pa.Table:
    """(k, y, t), ordered by k, t, y: of the distinct (k, y) of ``marked`` those of
    the smallest hash whose text in ``docs`` (k, t) has ``sizes`` bytes; at most
    ``rows``, or with ``labels`` at most ``rows`` of each of these values of y.

    Keys whose texts are too long, or that have none, are replaced by the next
    ones. A key that stands on several rows gives one text (the smallest), chosen
    before anything moves, so the driver gets at most the wanted rows."""
    marked = marked.distinct()
    groups = [marked] if labels is None else [marked.where(F.col("y") == y) for y in labels]
    total = max(g.count() for g in groups)
    order = [F.xxhash64("k"), F.col("k"), F.col("y")]
    texts = docs.where(F.octet_length("t").between(*sizes))
    asked = rows
    while True:
        chosen = None
        for g in groups:
            some = g.orderBy(*order).limit(asked)
            chosen = some if chosen is None else chosen.unionByName(some)
        found = texts.join(F.broadcast(chosen) if asked <= SENT_KEYS else chosen, "k").groupBy("k", "y").agg(F.min("t").alias("t"))
        part = Window.orderBy(*order) if labels is None else Window.partitionBy("y").orderBy(*order)
        got = found.withColumn("n", F.row_number().over(part)).where(F.col("n") <= rows).drop("n").toArrow()       # of at most ``asked`` rows a label
        held = [got.num_rows] if labels is None else [sum(v == y for v in got.column("y").to_pylist()) for y in labels]
        if asked >= total or all(n >= min(rows, total) for n in held):
            return got.select(["k", "y", "t"]).sort_by([("k", "ascending"), ("t", "ascending"), ("y", "ascending")])
        asked *= 4
