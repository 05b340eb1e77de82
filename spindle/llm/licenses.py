"""License scan as an exact set-similarity join of text blocks with templates.

Blocks are the lines of a text, templates are short license notices; both are
sets of words. A block meets a template when it holds at least ``threshold`` of
the template's words (containment). The join is the usual filtered one:

* a first pass counts, over all blocks of the corpus, in how many blocks each
  template word stands; this gives one global order, rarest word first;
* prefix filter: of a template of n words of which c must be present, the first
  n - c + 1 in global order are its prefix, and a block without a prefix word
  cannot meet it;
* length filter: a block of fewer than c distinct words cannot meet it;
* positional filter: from a block's first prefix word at place p of the
  template, at most n - p words can be shared, so n - p >= c must hold.

The survivors are counted exactly. Words that stand in no template are never
looked up, so the work is one look-up per word, and nothing is shuffled but the
counts of the template words. Templates are a parameter of bounded size
(``MAX_TEMPLATE_WORDS`` words at most, checked) and travel with the tasks.

The base rule is a plain one: a phrase's words standing consecutively.

Defined cases: null and wordless texts have no words, no places and no labels,
score 0; repeated rows are scanned one by one; an empty table gives no rows;
columns other than the key and the text are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrowtext as at
from .runtime import on_workers

# Phrases and labels of the base rule.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices whose words a block must hold to get the label.
TEMPLATES = {
    "mit": "released under the mit license",
    "apache": "licensed under the apache license version 2 0",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by": "licensed under a creative commons attribution 4 0 international license",
    "cc0": "released under the cc0 1 0 universal public domain dedication",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mpl": "subject to the terms of the mozilla public license v 2 0",
    "proprietary": "all rights reserved",
}
THRESHOLD = 0.85
MAX_TEMPLATE_WORDS = 100_000


@dataclass
class Prepared:
    labels: list[str]
    sizes: np.ndarray           # words of each template
    need: np.ndarray            # words that must be present
    vocabulary: np.ndarray      # sorted hashes of all template words
    member: np.ndarray          # [word, template] is in
    prefix: np.ndarray          # [word, template] stands in the prefix
    place: np.ndarray           # [word, template] place in global order, 0 first


def vocabulary(templates: dict[str, str]) -> tuple[list[str], np.ndarray, list[str]]:
    """Distinct template words, their hashes sorted, and the words in that order."""
    tokens = sorted({w for t in templates.values() for w in at.text_words(t)})
    if len(tokens) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates hold {len(tokens)} words; they are sent to all tasks, so at most {MAX_TEMPLATE_WORDS}")
    h = at.word_hashes(tokens)
    order = np.argsort(h)
    return tokens, h[order], [tokens[i] for i in order]


def prepare(templates: dict[str, str], blocks_with: dict[str, int], threshold: float) -> Prepared:
    _, hashes, named = vocabulary(templates)
    column = {w: i for i, w in enumerate(named)}
    rank = {w: r for r, w in enumerate(sorted(named, key=lambda w: (blocks_with.get(w, 0), w)))}
    labels = list(templates)
    shape = (len(named), len(labels))
    member, prefix, place = np.zeros(shape, bool), np.zeros(shape, bool), np.zeros(shape, np.int64)
    sizes, need = np.zeros(len(labels), np.int64), np.zeros(len(labels), np.int64)
    for t, label in enumerate(labels):
        ordered = sorted(set(at.text_words(templates[label])), key=rank.__getitem__)
        sizes[t] = len(ordered)
        need[t] = max(1, math.ceil(threshold * len(ordered) - 1e-9))
        for p, w in enumerate(ordered):
            member[column[w], t], place[column[w], t] = True, p
            prefix[column[w], t] = p < len(ordered) - need[t] + 1
    return Prepared(labels, sizes, need, hashes, member, prefix, place)


def _block_words(w: at.Words, part: at.Slice, hashes: np.ndarray):
    """Distinct (block, template word) pairs, blocks being lines numbered through
    the slice, and the block of every word."""
    line = np.cumsum(part.data == 10)
    block = line[w.start] + w.doc if len(w.start) else np.zeros(0, np.int64)      # a new row is a new block, too
    at_ = np.searchsorted(hashes, w.hash)
    at_[at_ == len(hashes)] = 0
    known = hashes[at_] == w.hash if len(hashes) else np.zeros(len(w.hash), bool)
    pairs = np.unique(block[known] * np.int64(len(hashes)) + at_[known])
    return block, pairs // max(len(hashes), 1), pairs % max(len(hashes), 1)


def _count(batches, hashes, named):
    total = np.zeros(len(hashes), np.int64)
    for batch in batches:
        for part in at.slices(batch.column(0)):
            _, _, word = _block_words(at.words(part), part, hashes)
            total += np.bincount(word, minlength=len(hashes))
    yield pa.RecordBatch.from_arrays([pa.array(named, pa.string()), pa.array(total, pa.int64())], names=["word", "blocks"])


def template_word_counts(spark: SparkSession, docs: DataFrame, text: str, templates: dict[str, str]) -> dict[str, int]:
    """In how many blocks of the whole corpus each template word stands."""
    on_workers(spark)
    _, hashes, named = vocabulary(templates)
    counted = docs.select(text).mapInArrow(lambda b: _count(b, hashes, named), "word string, blocks long")
    return {r.word: r.blocks for r in counted.groupBy("word").agg(F.sum("blocks").alias("blocks")).collect()}


def _joined(part: at.Slice, w: at.Words, p: Prepared):
    """(block, row, template, shared words) of all pairs that meet the threshold."""
    block, b, v = _block_words(w, part, p.vocabulary)
    if not len(b):
        return (np.zeros(0, np.int64),) * 4
    # distinct words of each block that has a template word (length filter)
    mine = np.isin(block, b)
    ids, inverse = np.unique(block[mine], return_inverse=True)
    keyed = at.mix(w.hash[mine] ^ (inverse.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    _, one = np.unique(keyed, return_index=True)
    length = np.bincount(inverse[one], minlength=len(ids))
    of = np.searchsorted(ids, b)
    found = []
    for t in range(len(p.labels)):
        hit = p.prefix[v, t]                                                        # prefix filter
        if not hit.any():
            continue
        earliest = np.full(len(ids), p.sizes[t])
        np.minimum.at(earliest, of[hit], p.place[v[hit], t])
        candidate = (p.sizes[t] - earliest >= p.need[t]) & (length >= p.need[t])     # positional and length filters
        shared = np.bincount(of[p.member[v, t] & candidate[of]], minlength=len(ids))
        for i in np.flatnonzero(candidate & (shared >= p.need[t])):
            found.append((ids[i], t, shared[i]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    blk, t, shared = (np.array(x, np.int64) for x in zip(*found))
    first_word = np.searchsorted(block, blk, "left")
    return blk, w.doc[first_word], t, shared


def _phrase_places(w: at.Words, phrase: list[np.uint64]) -> np.ndarray:
    n = len(w.hash) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = w.doc[:n] == w.doc[len(phrase) - 1:]
    for j, h in enumerate(phrase):
        ok = ok & (w.hash[j:j + n] == h)
    return np.flatnonzero(ok)


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("label", T.StringType()),
                                                     T.StructField("containment", T.DoubleType())])))])


def _scan(batches, p: Prepared, phrases: list[tuple[str, list]]):
    for batch in batches:
        for part in at.slices(batch.column(1)):
            w = at.words(part)
            n = part.hi - part.lo
            lines = np.concatenate([[0], np.cumsum(part.data == 10)])
            n_base = np.zeros(n, np.int64)
            first = np.full(n, np.iinfo(np.int64).max)
            last = np.full(n, -1)
            base: list[set] = [set() for _ in range(n)]
            for label, phrase in phrases:
                place = _phrase_places(w, phrase)
                doc = w.doc[place]
                word = place - w.first[doc]
                n_base += np.bincount(doc, minlength=n)
                np.minimum.at(first, doc, word)
                np.maximum.at(last, doc, word)
                for d in np.unique(doc):
                    base[d].add(label)
            labels = [set(x) for x in base]
            blocks: list[list] = [[] for _ in range(n)]
            score = np.zeros(n)
            for b, d, t, shared in zip(*_joined(part, w, p)):
                c = float(shared) / float(p.sizes[t])
                labels[d].add(p.labels[t])
                score[d] = max(score[d], c)
                blocks[d].append({"line": int(b - d - lines[part.offsets[d]]), "label": p.labels[t], "containment": c})
            score[n_base > 0] = 1.0
            none = n_base == 0
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.lo, n), pa.array(np.diff(w.first), pa.int64()), pa.array(n_base), pa.array(first, mask=none),
                pa.array(last, mask=none), pa.array([",".join(sorted(x)) for x in base], pa.string()),
                pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score),
                pa.array(blocks, pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("containment", pa.float64())])))],
                names=["row_key", *RESULT.names])


def scan(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: row_key, n_words, the base rule's places and
    labels, all labels, score (1 where the base rule holds, else the best
    containment that met the threshold, else 0) and the joined blocks (line
    number, label, containment)."""
    templates = TEMPLATES if templates is None else templates
    p = prepare(templates, template_word_counts(spark, docs, text, templates), threshold)
    coded = [(label, list(at.word_hashes(at.text_words(x)))) for x, label in (PHRASES if phrases is None else phrases).items()]
    schema = T.StructType([T.StructField("row_key", docs.schema[key].dataType), *RESULT.fields])
    return docs.select(F.col(key).alias("row_key"), F.col(text).alias("t")).mapInArrow(lambda b: _scan(b, p, coded), schema)


def brute_force(text: str | None, templates: dict[str, str] | None = None, threshold: float = THRESHOLD):
    """(n_words, places, base labels, labels) of one text, block by block (for tests)."""
    templates = TEMPLATES if templates is None else templates
    w = at.text_words(text)
    places, base, labels = [], set(), set()
    for x, label in PHRASES.items():
        v = x.split()
        for i in range(len(w) - len(v) + 1):
            if w[i:i + len(v)] == v:
                places.append(i)
                base.add(label)
    for line in (text or "").split("\n"):
        block = set(at.text_words(line))
        for label, t in templates.items():
            v = set(at.text_words(t))
            if v and len(block & v) >= threshold * len(v) - 1e-9:
                labels.add(label)
    return len(w), sorted(places), sorted(base), sorted(labels | base)
