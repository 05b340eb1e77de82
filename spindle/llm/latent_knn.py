"""Quality by nearest neighbours among labelled latent-semantic vectors.

A text is a bag of terms in two blocks: its words, and its style (the shape of
each white-space token, pairs of neighbouring shapes, token lengths, tokens that
repeat the one before). Terms are hashed to ``DIMS`` places a block, weighted by
sublinear frequency and inverse document frequency, and a block has length one.
A truncated singular value decomposition of the labelled sample gives the latent
space. Every document is projected into it; its exact cosine with every labelled
vector is computed block by block (``ROWS`` documents at a time), and the labels of
the ``NEIGHBOURS`` nearest vote with weights that grow with similarity.

Document frequencies are counted over all documents. Only the fit is bounded:
at most ``LABELLED`` labelled rows, those of the smallest hash, of at most
``MAX_TEXT_BYTES`` each. What is sent to the tasks is bounded by that too
(LABELLED x LATENT numbers and a projection). Labels decide votes only; a
document's own label is never looked at.

Defined cases: null and empty texts have no terms and get the share of label 1
in the sample; without labels every score is 0.5; ties in similarity count
alike up to the order of the sample; null labels are ignored; repeated rows are
scored one by one; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .samples import labelled_texts
from .runtime import on_workers

DIMS = 1024
LATENT = 48
LABELLED = 6000
MAX_TEXT_BYTES = 20_000
NEIGHBOURS = 25
ROWS = 512
WORD_WEIGHT = 0.3

_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
_KIND = np.arange(256, dtype=np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3


def _style(s: at.Slice) -> tuple[np.ndarray, np.ndarray]:
    """(row, term hash) of a slice's style terms."""
    start, end = at.runs(~_SPACES[s.data], s.offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = np.searchsorted(s.offsets, start, "right") - 1
    exact = at.hash_ranges(s.data, start, end)
    # shape: kinds of characters with runs drawn together, a run of two or more marks told from one
    kind = _KIND[s.data]
    new = np.empty(len(kind), bool)
    new[0], new[1:] = True, kind[1:] != kind[:-1]
    new[start] = True
    at_ = np.flatnonzero(new)
    length = np.diff([*at_, len(kind)])
    drawn = kind[at_] ^ np.where((length > 1) & (kind[at_] > 3), 128, 0).astype(np.uint8)
    shape = at.hash_ranges(drawn, np.searchsorted(at_, start), np.searchsorted(at_, end))
    same_row = np.concatenate([[False], row[1:] == row[:-1]])
    before = np.concatenate([[np.uint64(0)], shape[:-1]])
    pair = at.mix(np.where(same_row, before, np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15) + shape)
    repeats = same_row & np.concatenate([[False], exact[1:] == exact[:-1]])
    size = at.mix(np.minimum(np.log2(end - start).astype(np.uint64), np.uint64(8)) + np.uint64(1000))
    return (np.concatenate([row, row, row, row[repeats]]),
            np.concatenate([shape, pair, size, np.full(repeats.sum(), 424242, np.uint64)]))


def counted(s: at.Slice, dims: int) -> np.ndarray:
    """[row, 2 * dims] term counts: words, then style."""
    n = s.hi - s.lo
    w = at.words(s)
    out = np.zeros((n, 2 * dims), np.float32)
    out[:, :dims] = np.bincount(w.doc * dims + (w.hash % np.uint64(dims)).astype(np.int64), minlength=n * dims).reshape(n, dims)
    row, term = _style(s)
    out[:, dims:] = np.bincount(row * dims + (at.mix(term) % np.uint64(dims)).astype(np.int64), minlength=n * dims).reshape(n, dims)
    return out


def _rows(s: at.Slice, rows: int):
    """The slice in parts of at most ``rows`` rows."""
    for lo in range(0, s.hi - s.lo, rows):
        hi = min(lo + rows, s.hi - s.lo)
        o = s.offsets[lo:hi + 1]
        yield at.Slice(s.lo + lo, s.lo + hi, s.data[o[0]:o[-1]], o - o[0])


def _frequencies(batches, dims):
    total, seen = np.zeros(2 * dims, np.int64), 0
    for batch in batches:
        for part in at.slices(batch.column(0)):
            for p in _rows(part, ROWS):
                c = counted(p, dims)
                total += (c > 0).sum(axis=0)
                seen += len(c)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * dims + 1), pa.int64()), pa.array([*total, seen], pa.int64())], names=["dim", "n"])


def document_frequencies(spark: SparkSession, docs: DataFrame, text: str, dims: int = DIMS) -> np.ndarray:
    """In how many of all documents each term place occurs; last, the number of documents."""
    on_workers(spark)
    found = np.zeros(2 * dims + 1, np.int64)
    per = docs.select(text).mapInArrow(lambda b: _frequencies(b, dims), "dim long, n long")
    for r in per.groupBy("dim").agg(F.sum("n").alias("n")).collect():
        found[r.dim] = r.n
    return found


@dataclass
class Model:
    dims: int
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts) * self.idf
        for lo, weight in ((0, WORD_WEIGHT), (self.dims, 1.0)):
            block = x[:, lo:lo + self.dims]
            norm = np.linalg.norm(block, axis=1, keepdims=True)
            block *= weight / np.where(norm > 0, norm, 1)
        return x

    def latent(self, counts: np.ndarray) -> np.ndarray:
        v = self.weighted(counts) @ self.projection
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        some = counts.any(axis=1)
        if len(self.labels) and some.any():
            cosine = self.latent(counts[some]) @ self.vectors.T
            k = min(self.neighbours, len(self.labels))
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6) ** 4
            out[some] = np.clip((weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1), 0, 1)
        return out


def fit(spark: SparkSession, docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", dims: int = DIMS,
        latent: int = LATENT, rows: int = LABELLED, neighbours: int = NEIGHBOURS) -> Model:
    """``labelled`` has ``key`` and ``label`` of the rows that may be learnt from."""
    df = document_frequencies(spark, docs, text, dims)
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)).astype(np.float32) + np.float32(0.1)
    marked = labelled.where(F.col(label).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("double").alias("y"))
    sample = labelled_texts(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), marked, rows, (1, MAX_TEXT_BYTES))
    y = np.array(sample.column("y").to_pylist(), float)
    model = Model(dims, idf, np.zeros((2 * dims, 0), np.float32), np.zeros((0, 0), np.float32), y, float(y.mean()) if len(y) else 0.5, neighbours)
    if not len(y):
        return model
    x = np.concatenate([model.weighted(counted(p, dims)) for s in at.slices(sample.column("t").combine_chunks()) for p in _rows(s, ROWS)])
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))           # right singular vectors of the sample
    model.projection = np.ascontiguousarray(vectors[:, ::-1][:, :latent]).astype(np.float32)
    v = x @ model.projection
    model.vectors = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    return model


def _scored(batches, sent):
    model = sent.value
    for batch in batches:
        for part in at.slices(batch.column(1)):
            for p in _rows(part, ROWS):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(p.lo, p.hi - p.lo), pa.array(model.score(counted(p, model.dims)), pa.float64())], names=["row_key", "score"])


def score(spark: SparkSession, docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key and score (0 to 1, higher: label 1 likelier) of every row."""
    on_workers(spark)
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("row_key", docs.schema[key].dataType), T.StructField("score", T.DoubleType())])
    return docs.select(F.col(key).alias("row_key"), F.col(text).alias("t")).mapInArrow(lambda b: _scored(b, sent), schema)
