"""Benchmark decontamination with suffix arrays over the training text.

Each Arrow slice of documents is a shard: its words become one stream and a
suffix array over the stream's places, ordered by ``window`` words. Every suffix
of an item that begins a window is binary-searched in every shard's array (equal
windows once), which gives the interval of places where the window stands. The
longest verbatim match of a document and an item begins at such a place; its
length is found by halving over hashed word ranges, so repetitive texts and items
cost no more than others. Windows of ``window`` words (an item of fewer, but not
none, is one window) mark the document words they cover.

Only places whose next two words occur as neighbours in the benchmark (or, for
one-word items, whose word is such an item) enter the array: no other place can
begin a match of two words. The benchmark travels to the tasks in blocks of at
about ``block_bytes`` of text (an item is not cut), one pass over the shards per block. Suffixes are places in one array of
word hashes, so memory grows with the words of block and shard, whatever the
length of an item.

Defined cases: null or wordless documents have no words and no hits; null or
wordless items match nothing; an item with a null id marks words, but is not
listed among the matches; equal item ids count as one item; an empty
benchmark leaves every document clean; an empty documents table gives no rows;
further columns of either table are ignored by ``find_matches`` and kept by
``decontaminate``. Rows with equal ids are handled one by one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .runtime import fresh_path, on_workers, released

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
LOOKED_UP = 1 << 16            # windows that are searched at a time

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_word", T.IntegerType()),
    T.StructField("doc_word", T.LongType()), T.StructField("n_match", T.IntegerType())]))


@dataclass
class Suffixes:
    """All suffixes of a block of items, as places in one array of word hashes."""
    ids: list[str | None]
    item: np.ndarray          # index into ids
    word: np.ndarray          # first word of the suffix within its item
    flat: np.ndarray          # the items' word hashes; suffix k begins at place k
    left: np.ndarray          # words from there to the item's end
    window: np.ndarray        # window length if the suffix begins a window, else 0


def item_suffixes(items: list[tuple[str, str]], window: int) -> Suffixes:
    tokens = [at.word_hashes(at.text_words(t)) for _, t in items]
    item = np.repeat(np.arange(len(items)), [len(t) for t in tokens])
    word = np.concatenate([np.arange(len(t)) for t in tokens] or [np.zeros(0, int)]).astype(np.int64)
    left = np.concatenate([np.arange(len(t), 0, -1) for t in tokens] or [np.zeros(0, int)]).astype(np.int64)
    flat = np.concatenate([*tokens, np.zeros(0, np.uint64)])
    size = np.array([len(t) for t in tokens], np.int64)[item] if len(item) else np.zeros(0, np.int64)
    starts = np.where(size >= window, left >= window, word == 0)
    return Suffixes([None if i is None else str(i) for i, _ in items], item, word, flat, left,
                    np.where(starts, np.minimum(size, window), 0))


def _rows(flat: np.ndarray, begin: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """[begin, depth] hashes from each place on, 0 beyond its ``left`` words."""
    out = np.zeros((len(begin), depth), np.uint64)
    for j in range(depth):
        inside = np.flatnonzero(j < left)
        out[inside, j] = flat[begin[inside] + j]
    return out


def _compare(array_rows, order, at_, query_rows, depth):
    """Sign of (array suffix - query suffix) over ``depth`` words for each query."""
    a, q = array_rows[order[at_]], query_rows
    differ = (a != q) & (np.arange(a.shape[1])[None, :] < depth[:, None])
    first = differ.argmax(axis=1)
    k = np.arange(len(a))
    return np.where(differ[k, first], np.where(a[k, first] < q[k, first], -1, 1), 0)


def _bound(array_rows, order, query_rows, depth, upper: bool):
    """First array place whose suffix is >= (or >, if upper) the query's first ``depth`` words."""
    lo, hi = np.zeros(len(query_rows), np.int64), np.full(len(query_rows), len(order), np.int64)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        sign = _compare(array_rows, order, np.minimum(mid, len(order) - 1), query_rows, depth)
        right = open_ & ((sign <= 0) if upper else (sign < 0))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def _ranges(flat: np.ndarray):
    """A function (start, words) -> hashes of word ranges of ``flat``."""
    power, inverse = at._powers(len(flat) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(at.mix(flat) * power[:len(flat)], dtype=np.uint64)])

    def hashes(start: np.ndarray, words) -> np.ndarray:
        return at.mix((total[start + words] - total[start]) * inverse[start] + np.asarray(words, np.uint64))
    return hashes


class ShardSearch:
    """Looks up all windows of a block in one shard after another. Windows of equal
    words are one (``windows`` holds a beginning of each) and are searched once."""

    def __init__(self, s: Suffixes):
        self.s = s
        pair = np.flatnonzero(s.left >= 2)
        self.pairs = np.unique(at.mix(s.flat[pair] * np.uint64(31) + s.flat[pair + 1]))
        self.singles = np.unique(s.flat[s.window == 1])
        self.depth = int(s.window.max(initial=1))
        begins = np.flatnonzero(s.window > 0)
        self.hashes = _ranges(s.flat)
        _, at_, self.same = np.unique(self.hashes(begins, s.window[begins]), return_index=True, return_inverse=True)
        self.windows = begins[at_]
        # the items of each window, and the beginnings of each item's windows
        both = np.unique(np.stack([self.same, s.item[begins]], axis=1), axis=0) if len(begins) else np.zeros((0, 2), np.int64)
        self.items, self.edge = both[:, 1], np.searchsorted(both[:, 0], np.arange(len(self.windows) + 1))
        self.begins, self.item_edge = begins, np.searchsorted(s.item[begins], np.arange(len(s.ids) + 1))

    def search(self, w: at.Words):
        """(window, stream place) of all occurrences: a place has one window of
        each length at most, so there are no more than the shard's words times
        the lengths (one, but for items shorter than a window)."""
        s, n = self.s, len(w.hash)
        none = np.zeros(0, np.int64)
        if not n or not len(s.item):
            return none, none
        nxt = np.zeros(n, np.uint64)
        same = w.doc[1:] == w.doc[:-1]
        nxt[:-1] = np.where(same, w.hash[1:], 0)
        keep = np.isin(at.mix(w.hash * np.uint64(31) + nxt), self.pairs) & (nxt != 0)
        if len(self.singles):
            keep |= np.isin(w.hash, self.singles)
        place = np.flatnonzero(keep)
        if not len(place):
            return none, none
        rows = _rows(w.hash, place, w.first[1:][w.doc[place]] - place, self.depth)
        order = np.lexsort(rows.T[::-1])                                   # the suffix array
        which, where = [none], [none]
        for k in range(0, len(self.windows), LOOKED_UP):
            begins = self.windows[k:k + LOOKED_UP]
            q, size = _rows(s.flat, begins, s.left[begins], self.depth), s.window[begins]
            lo = _bound(rows, order, q, size, False)
            hit = np.flatnonzero((lo < len(order)) & (_compare(rows, order, np.minimum(lo, len(order) - 1), q, size) == 0))
            lo = lo[hit]
            many = _bound(rows, order, q[hit], size[hit], True) - lo
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
            which.append(np.repeat(hit + k, many))
            where.append(place[order[inside]])
        return np.concatenate(which), np.concatenate(where)

    def longest(self, w: at.Words, hashes, which: np.ndarray, place: np.ndarray):
        """(document, item, words, item word, document word) of the longest match of
        every document and item that have a window in common; of equally long
        ones the first in the document, then in the item. The length is found by
        halving: matches that begin at those windows and have so many words."""
        s, out = self.s, []
        doc = w.doc[place]
        order = np.argsort(doc, kind="stable")
        doc, which, place = doc[order], which[order], place[order]
        for d, a, b in zip(*np.unique(doc, return_index=True), [*np.unique(doc, return_index=True)[1][1:], len(doc)]):
            mine, at_ = which[a:b], place[a:b]
            distinct = np.unique(mine)
            items = np.unique(np.concatenate([self.items[self.edge[u]:self.edge[u + 1]] for u in distinct]))
            end = w.first[d + 1]
            for i in items.tolist():
                begins, windows = (x[self.item_edge[i]:self.item_edge[i + 1]] for x in (self.begins, self.same))
                here, there = np.sort(at_[np.isin(mine, windows)]), begins[np.isin(windows, distinct)]
                low, high = int(s.window[begins[0]]), int(min((end - here).max(), s.left[there].max()))
                while low < high:
                    words = (low + high + 1) // 2
                    x, y = here[here + words <= end], there[s.left[there] >= words]
                    if len(x) and len(y) and np.isin(hashes(x, words), self.hashes(y, words)).any():
                        low = words
                    else:
                        high = words - 1
                x, y = here[here + low <= end], there[s.left[there] >= low]
                hx, hy = hashes(x, low), self.hashes(y, low)
                first = int(np.flatnonzero(np.isin(hx, hy))[0])
                out.append((int(d), i, low, int(s.word[y[np.flatnonzero(hy == hx[first])[0]]]), int(x[first] - w.first[d])))
        return out


def _covered(place, length, n):
    """Marks of the words that the runs place .. place+length cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _scan(batches, found: Suffixes):
    search = ShardSearch(found)
    for batch in batches:
        for part in at.slices(batch.column(1), SHARD_BYTES):
            w = at.words(part)
            which, place = search.search(w)
            hit = _covered(place, found.window[search.windows[which]], len(w.hash))
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[w.first[1:]] - total[w.first[:-1]]
            lists: dict[int, list] = {}
            if len(which):
                for d, i, words, item_word, doc_word in search.longest(w, _ranges(w.hash), which, place):
                    if found.ids[i] is not None:
                        lists.setdefault(d, []).append({"item_id": found.ids[i], "item_word": item_word, "doc_word": doc_word, "n_match": words})
            n_docs = part.hi - part.lo
            begin, end = at.runs(hit, w.first)
            row = np.searchsorted(w.first, begin, "right") - 1
            hits: list[list] = [[] for _ in range(n_docs)]
            for r, a, b in zip(row, begin, end):
                hits[r].append({"a": int(a - w.first[r]), "b": int(b - w.first[r])})
            matches = [sorted(lists.get(d, []), key=lambda m: m["item_id"]) for d in range(n_docs)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.lo, n_docs), pa.array(np.diff(w.first), pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array(matches, pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int64()), ("n_match", pa.int32())]))),
                pa.array(hits, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                names=["row_key", "n_words", "n_hit", "matches", "hit_runs"])


def block_count(benchmark: DataFrame, item_text: str, block_bytes: int) -> int:
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def item_blocks(benchmark: DataFrame, item: str, item_text: str, blocks: int):
    """The items in ``blocks`` parts by hash of their id, each read when its turn comes."""
    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    for k in range(blocks):
        yield [(r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).distinct().sort("i", "t").toLocalIterator()]


def find_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: row_key (its ``key``), n_words, n_hit, matches
    (per item with an occurring window: the longest match, its place in the item
    and in the document) and hit_runs (the hit words as ranges)."""
    on_workers(spark)
    blocks = block_count(benchmark, item_text, block_bytes)
    run = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def one_pass(frame: DataFrame, items: list) -> DataFrame:
        sent = spark.sparkContext.broadcast(item_suffixes(items, window))
        schema = T.StructType([T.StructField("row_key", frame.schema["row_key"].dataType), T.StructField("n_words", T.LongType()),
                               T.StructField("n_hit", T.LongType()), T.StructField("matches", MATCHES), T.StructField("hit_runs", T.ArrayType(run))])
        return frame.mapInArrow(lambda batches: released(_scan(batches, sent.value)), schema)

    parts = item_blocks(benchmark, item, item_text, blocks)
    source = docs.select(F.col(key).alias("row_key"), F.col(text).alias("text"))
    if blocks == 1:
        return one_pass(source, next(parts))
    # several blocks: number the rows once, then unite what each block finds
    path = fresh_path(spark, "decontaminate")
    source.withColumn("n", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    found = None
    for items in parts:
        part = one_pass(numbered.select(F.col("n").alias("row_key"), "text"), items)
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("row_key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches"),
                                          F.array_sort(F.flatten(F.collect_list("hit_runs"))).alias("hit_runs"))
    zero = F.lit(0).cast("long")
    covered = F.aggregate("hit_runs", F.struct(zero.alias("n"), zero.alias("to")),
                          lambda s, r: F.struct((s.n + F.greatest(zero, r.b - F.greatest(r.a, s.to))).alias("n"), F.greatest(s.to, r.b).alias("to")))
    # one item's windows all lie in one block, so matches need no further merging
    merged = merged.select(F.col("row_key").alias("n"), "n_words", covered.n.alias("n_hit"), "matches", "hit_runs")
    return numbered.select("n", "row_key").join(merged, "n").drop("n")


def items_digest(matches: str):
    """sha256 of the item ids, sorted as strings, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m.item_id))), ","), 256)


def _clean(batches, found: Suffixes, text: str):
    search = ShardSearch(found)
    for batch in batches:
        for part in at.slices(batch.column(batch.schema.get_field_index(text)), SHARD_BYTES):
            w = at.words(part)
            _, place = search.search(w)
            keep = np.ones(part.hi - part.lo, bool)
            keep[w.doc[place]] = False
            yield batch.slice(part.lo, part.hi - part.lo).filter(pa.array(keep))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; same columns.
    Several blocks of the benchmark filter one after the other, without a shuffle."""
    on_workers(spark)
    for items in item_blocks(benchmark, item, item_text, block_count(benchmark, item_text, block_bytes)):
        sent = spark.sparkContext.broadcast(item_suffixes(items, window))
        docs = docs.mapInArrow(lambda batches, sent=sent: released(_clean(batches, sent.value, text)), docs.schema)
    return docs


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """The contract, word by word (for tests)."""
    out = {}
    for d, t in docs:
        w = at.text_words(t)
        hit, ids = set(), set()
        for i, x in items:
            v = at.text_words(x)
            if not v:
                continue
            size = min(window, len(v))
            for a in range(len(v) - size + 1):
                for p in range(len(w) - size + 1):
                    if w[p:p + size] == v[a:a + size]:
                        hit.update(range(p, p + size))
                        ids.add(str(i))
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
    return out
