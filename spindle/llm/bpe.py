"""Byte-pair encoding and decoding with a published vocabulary.

The vocabulary file (byte-level BPE whose words end in ``</w>``) is read once by
the driver and travels to the tasks; its size is bounded and checked. Encoding
a word: its characters are a doubly linked list of symbols; every neighbouring
pair that the merge table knows waits in a priority queue by merge rank, then
place; the lowest is merged if both its symbols still stand as queued (stale
entries are skipped), and the new neighbours are queued. Decoding concatenates
the vocabulary strings of the ids, one space between them, as the file has no
decoder of its own.

Before that a text is cut at the special tokens' strings, and each part is put
into NFC, lower-cased character by character and split into words (white space
separates and is dropped). Encoded words are kept in a bounded cache of each
Python worker; the cache changes the speed only.

Defined cases: null and empty texts have no ids and decode to an empty text;
repeated rows are encoded one by one; an empty table gives no rows; other
columns are not looked at. Rows are handled one at a time, so memory follows
the longest text.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import on_workers, released

MAX_FILE_BYTES = 64 << 20
CACHE_WORDS = 100_000           # words of a worker's cache, each with a few ids
EMIT_BYTES = 1 << 20             # ids, or decoded text, that a task holds before it hands them on

# How the vocabulary splits words (contractions, runs of letters, single digits, other runs).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[^{space}{letters}{numbers}]+"
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LATIN = "a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
# Texts of these characters only are split by the plain pattern; letters and digits are the same there.
_PLAIN_TEXT = re.compile(f"[\x00-\x1b\x20-\x7f{_LATIN}]*")
_PLAIN = re.compile(_SPLIT.format(letter=f"[{_LATIN}]", number="[0-9]", space="\t-\r ", letters=_LATIN, numbers="0-9"))
_FULL = regex.compile(_SPLIT.format(letter=r"\p{L}", number=r"\p{N}", space=_SPACE, letters=r"\p{L}", numbers=r"\p{N}"))


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable bytes for themselves, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@dataclass
class Bpe:
    ids: dict[str, int]
    merges: dict[tuple[int, int], tuple[int, int]]       # pair of ids -> (rank, id of the merged symbol)
    names: list[str]                                     # id -> vocabulary string
    special: dict[str, int]
    end: str
    cache: dict[str, bytes] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def __post_init__(self):
        self.symbols = byte_symbols()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def word_ids(self, word: str) -> list[int]:
        symbols = [self.symbols[b] for b in word.encode()]
        symbols[-1] += self.end
        at = [self.ids[s] for s in symbols]
        n = len(at)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        merges = self.merges
        for i in range(n - 1):
            if (m := merges.get((at[i], at[i + 1]))) is not None:
                queue.append((m[0], i, at[i], at[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = after[i]
            if at[i] != left or j < 0 or at[j] != right:
                continue                                  # stale: one of the two has been merged since
            at[i], at[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (m := merges.get((new, at[k]))) is not None:
                    heapq.heappush(queue, (m[0], i, new, at[k], m[1]))
            h = before[i]
            if h >= 0 and (m := merges.get((at[h], new))) is not None:
                heapq.heappush(queue, (m[0], h, at[h], new, m[1]))
        out, i = [], 0
        while i >= 0:
            out.append(at[i])
            i = after[i]
        return out

    def words(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()      # a sigma has one lower-case form here
        return (_PLAIN if _PLAIN_TEXT.fullmatch(text) else _FULL).findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.cut.split(text) if self.cut and "<" in text else [text]
        out = []
        cache = self.cache
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            for w in self.words(part):
                if (got := cache.get(w)) is None:
                    got = np.array(self.word_ids(w), "<u4").tobytes()
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    if len(w) < 200:
                        cache[w] = got
                out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def load(path: str) -> Bpe:
    """Read a vocabulary file of the tokenizers library (BPE with word ends)."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} has more than {MAX_FILE_BYTES} bytes; it is sent to all tasks")
    with open(path, encoding="utf-8") as f:
        read = json.load(f)
    model = read["model"]
    ids = model["vocab"]
    names = {i: s for s, i in ids.items()}
    special = {t["content"]: t["id"] for t in read["added_tokens"]}
    names.update({i: s for s, i in special.items()})
    merges = {}
    for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
    return Bpe(ids, merges, [names.get(i, "") for i in range(max(names) + 1)], special, model["end_of_word_suffix"] or "")


def _encoded(batches, sent):
    bpe = sent.value                        # a worker drops it, and its cache, when a task without it begins
    for batch in batches:
        lo, held, rows = 0, 0, []
        for k, t in enumerate(batch.column(1)):
            rows.append(bpe.encode(t.as_py() or ""))
            held += len(rows[-1])
            if held >= EMIT_BYTES or k == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(rows)), pa.array([len(r) // 4 for r in rows], pa.int64()),
                                                  pa.array(rows, pa.binary())], names=["row_key", "n_tokens", "ids"])
                lo, held, rows = k + 1, 0, []


def _decoded(batches, sent):
    bpe = sent.value
    for batch in batches:
        column = batch.schema.get_field_index("ids")
        lo, held, rows = 0, 0, []
        for k, ids in enumerate(batch.column(column)):
            rows.append(bpe.decode(ids.as_py() or b""))
            held += len(rows[-1])
            if held >= EMIT_BYTES or k == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, len(rows)) for c in batch.columns), pa.array(rows, pa.string())], names=[*batch.schema.names, "decoded"])
                lo, held, rows = k + 1, 0, []


def _sent(spark: SparkSession, vocabulary: str):
    on_workers(spark)
    return spark.sparkContext.broadcast(load(vocabulary))


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key, n_tokens, ids (little-endian unsigned 32-bit integers) of every text."""
    sent = _sent(spark, vocabulary)
    schema = T.StructType([T.StructField("row_key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select(F.col(key).alias("row_key"), F.col(text).alias("t")).mapInArrow(lambda b: released(_encoded(b, sent)), schema)


def decode(spark: SparkSession, encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` and the text that its ids stand for."""
    sent = _sent(spark, vocabulary)
    return encoded.mapInArrow(lambda b: released(_decoded(b, sent)), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that a task has one Python worker and one copy of the vocabulary."""
    sent = _sent(spark, vocabulary)
    schema = T.StructType([T.StructField("row_key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])
    return docs.select(F.col(key).alias("row_key"), F.col(text).alias("t")).mapInArrow(lambda b: released(_decoded(_encoded(b, sent), sent)), schema)
