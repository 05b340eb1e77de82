"""Toxic spans by a linear-chain conditional random field.

Two states (clean, toxic) over the words of a sentence. A word's potential is
the sum of the weights of its features (the word, and its first three to nine
bytes if it is longer) as far as they are in the fitted dictionary; a transition
matrix ties neighbours. Forward-backward gives the
marginal probability of every word; words of 0.5 and more, next to each other
in a sentence, are an offending span with its place in the text. A document's
score comes from its largest marginal and from the number and the share of its
words expected to be toxic, by a logistic curve.

Documents carry one label, words none, so words are labelled first: in a toxic
document those with a feature that clean documents of the sample have at most
``CLEAN_SHARE`` times as often, and toxic ones more often than chance explains
(``CHANCE``), are toxic, all others clean. The dictionary holds the features that toxic documents have
``LIFT`` times as often, and more often than chance explains. The field is
then fitted to these sequences by gradient steps, the curve to the documents.

Copies would count as independent witnesses, so of the sample's texts that share
the smallest 5-word shingle under one of ``SKETCHES`` orders only the first is
learnt from.

Only the fit is bounded: at most ``PER_LABEL`` rows of each label, those of the
smallest hash, of at most ``MAX_TEXT_BYTES`` each. Scoring covers every row and
its whole text; a sentence ends at ``.``, ``!``, ``?`` or a line's end, and one of
more than ``LONGEST`` words is cut into several sequences.

Defined cases: null, empty and wordless texts get the curve's value for no toxic
word (a low score) and no spans; with only one label in the sample every score is
that label's share; null labels are ignored; repeated rows are scored one by one;
an empty table gives no rows; ``reject`` keeps all columns.
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
from .runtime import on_workers, released

PER_LABEL = 3000
MAX_TEXT_BYTES = 20_000
CHANCE = 1e-5
CLEAN_SHARE = 0.15
LIFT = 4.0
PREFIXES = (3, 4, 5, 6, 7, 8, 9)
LONGEST = 64
EPOCHS = 8
SKETCHES = 4
SEQUENCES = 30_000

_ENDS = np.zeros(256, bool)
_ENDS[[10, 33, 46, 63]] = True


@dataclass
class Chains:
    """The words of a slice as sequences: features [word, 4]; sequence begin and length."""
    words: at.Words
    features: np.ndarray
    begin: np.ndarray
    length: np.ndarray


def chains(s: at.Slice) -> Chains:
    w = at.words(s)
    n = len(w.hash)
    if not n:
        return Chains(w, np.zeros((0, 1 + len(PREFIXES)), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    hashes = [w.hash]
    hasher = at.range_hasher(w.low)
    for p in PREFIXES:
        longer = w.end - w.start > p
        hashes.append(np.where(longer, at.mix(hasher(w.start, np.where(longer, w.start + p, w.end)) + np.uint64(p)), np.uint64(0)))
    features = np.stack(hashes, axis=1)
    ends = np.concatenate([[0], np.cumsum(_ENDS[s.data])])
    new = np.ones(n, bool)
    new[1:] = (w.doc[1:] != w.doc[:-1]) | (ends[w.start[1:]] > ends[w.end[:-1]])
    begin = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(begin, np.diff([*begin, n]))
    begin = np.flatnonzero(within % LONGEST == 0)
    return Chains(w, features, begin, np.diff([*begin, n]))


@dataclass
class Field:
    known: np.ndarray             # hashes of the features in the dictionary, sorted
    weights: np.ndarray           # of the toxic state, per known feature; last, 0 for all others
    bias: float
    transition: np.ndarray        # [from, to]; from clean to clean is 0
    curve: np.ndarray             # of the columns of _summary
    constant: float | None = None

    def potentials(self, features: np.ndarray) -> np.ndarray:
        """``features`` as places in the dictionary."""
        return self.weights[features].sum(axis=1) + self.bias


def _steps(begin, length):
    """Sequences by falling length, and how many are still open at each step."""
    order = np.argsort(-length, kind="stable")
    sorted_length = length[order]
    return begin[order], [int(np.searchsorted(-sorted_length, -t, "left")) for t in range(int(sorted_length[0]) if len(order) else 0)]


def forward_backward(e: np.ndarray, begin: np.ndarray, length: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds (toxic against clean) of the forward and of the backward messages."""
    a, b = np.zeros(len(e)), np.zeros(len(e))
    if not len(begin):
        return a, b
    at_, open_ = _steps(begin, length)
    a[at_] = e[at_]
    for step in range(1, len(open_)):
        i = at_[:open_[step]] + step
        last = a[i - 1]
        a[i] = e[i] + np.logaddexp(t[0, 1], last + t[1, 1]) - np.logaddexp(t[0, 0], last + t[1, 0])
    for step in range(len(open_) - 1, 0, -1):
        i = at_[:open_[step]] + step
        later = e[i] + b[i]
        b[i - 1] = np.logaddexp(t[1, 0], t[1, 1] + later) - np.logaddexp(t[0, 0], t[0, 1] + later)
    return a, b


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def marginals(field: Field, c: Chains) -> np.ndarray:
    a, b = forward_backward(field.potentials(_places(field.known, c.features)), c.begin, c.length, field.transition)
    return _sigmoid(a + b)


def _summary(p: np.ndarray, w: at.Words, rows: int) -> np.ndarray:
    """Per row: 1, logit of the largest marginal, logs of the expected number and share of toxic words."""
    most, expected = np.full(rows, 1e-5), np.zeros(rows)
    np.maximum.at(most, w.doc, p)
    np.add.at(expected, w.doc, p)
    most = np.clip(most, 1e-5, 1 - 1e-5)
    return np.stack([np.ones(rows), np.log(most / (1 - most)), np.log1p(expected), np.log((expected + 0.01) / (np.diff(w.first) + 10))], axis=1)


def _per_row(c: Chains, mine: np.ndarray) -> np.ndarray:
    """The features of the chosen rows, each once a row."""
    of = mine[c.words.doc]
    f = c.features[of]
    doc = np.repeat(c.words.doc[of].astype(np.uint64), f.shape[1])
    f = f.ravel()
    _, one = np.unique(at.mix(f ^ ((doc + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)
    return f[one]


def _dictionary(cut: list[at.Slice], toxic: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the dictionary's features, sorted, and which of them mark a word as toxic."""
    rows = [sum(int((y == k).sum()) for y in toxic) for k in (0, 1)]
    known, n1 = np.unique(np.concatenate([_per_row(chains(s), y == 1) for s, y in zip(cut, toxic)]), return_counts=True)
    enough = (n1 >= np.log(CHANCE) / np.log(rows[1] / sum(rows))) & (known > 0)
    known, n1 = known[enough], n1[enough]
    n0 = np.zeros(len(known) + 1, np.int64)
    for s, y in zip(cut, toxic):
        n0 += np.bincount(_places(known, _per_row(chains(s), y == 0)), minlength=len(n0))
    n0 = n0[:-1]
    use = n1 / rows[1] >= LIFT * (n0 + 0.5) / rows[0]
    return known[use], (n0 / rows[0] <= CLEAN_SHARE * n1 / rows[1])[use]


def _places(known: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places in the dictionary; its length for all that is not in it."""
    if not len(known):
        return np.zeros(features.shape, np.int32)
    at_ = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return np.where(known[at_] == features, at_, len(known)).astype(np.int32)


def _train(known, features, target, begin, length, epochs: int = EPOCHS, seed: int = 5) -> Field:
    """Gradient steps (Adagrad) on the log-likelihood of the labelled sequences."""
    size = len(known) + 1
    field = Field(known, np.zeros(size), -4.0, np.zeros((2, 2)), np.zeros(4))
    g_w, g_b, g_t = np.full(size, 1e-2), 1.0, np.full((2, 2), 10.0)
    rng = np.random.RandomState(seed)
    for _ in range(epochs):
        for chosen in np.array_split(rng.permutation(len(begin)), max(1, len(begin) // 2000)):
            lens = length[chosen]
            first = np.cumsum(lens) - lens
            idx = np.repeat(begin[chosen] - first, lens) + np.arange(lens.sum())
            x, y = features[idx], target[idx].astype(float)
            e = field.potentials(x)
            a, b = forward_backward(e, first, lens, field.transition)
            error = y - _sigmoid(a + b)
            step = np.bincount(x.ravel(), np.repeat(error, x.shape[1]), size) - 1e-3 * field.weights
            step[-1] = 0.0
            g_w += step ** 2
            field.weights += 0.4 * step / np.sqrt(g_w)
            g_b += error.sum() ** 2
            field.bias += 0.4 * error.sum() / np.sqrt(g_b)
            inner = np.ones(len(idx), bool)
            inner[first + lens - 1] = False
            i = np.flatnonzero(inner)
            score = np.zeros((2, 2, len(i)))
            for u in (0, 1):
                for v in (0, 1):
                    score[u, v] = u * a[i] + field.transition[u, v] + v * (e[i + 1] + b[i + 1])
            score -= np.logaddexp(np.logaddexp(score[0, 0], score[0, 1]), np.logaddexp(score[1, 0], score[1, 1]))
            for u in (0, 1):
                for v in (0, 1):
                    if u or v:
                        d = ((y[i] == u) & (y[i + 1] == v)).sum() - np.exp(score[u, v]).sum()
                        g_t[u, v] += d ** 2
                        field.transition[u, v] += 0.4 * d / np.sqrt(g_t[u, v])
    return field


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, lightly regularised."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ beta)
        grad = x.T @ (weight * (y - p)) - 0.05 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(hess, grad)
    return beta


def _sequences(cut: list[at.Slice], toxic: list[np.ndarray], known: np.ndarray, marks: np.ndarray):
    """Sequences to learn from, as (places, targets, begin, length): all with a toxic word, and an even draw of the others."""
    total = sum(len(chains(s).begin) for s in cut)
    rng = np.random.RandomState(3)
    places, targets, lengths = [], [], []
    for s, y in zip(cut, toxic):
        c = chains(s)
        if not len(c.begin):
            continue
        p = _places(known, c.features)
        target = marks[p].any(axis=1) & (y[c.words.doc] == 1)
        sums = np.concatenate([[0], np.cumsum(target)])
        keep = (sums[c.begin + c.length] > sums[c.begin]) | (rng.rand(len(c.begin)) < SEQUENCES / total)
        words = np.repeat(keep, c.length)
        places.append(p[words])
        targets.append(target[words])
        lengths.append(c.length[keep])
    length = np.concatenate(lengths)
    return np.concatenate(places), np.concatenate(targets), np.cumsum(length) - length, length


def _fresh(cut: list[at.Slice]) -> list[np.ndarray]:
    """Which rows share no sketch with an earlier row."""
    seen: set[int] = set()
    out = []
    for s in cut:
        h, row, _ = at.shingles(at.words(s), 5)
        keep = np.zeros(s.hi - s.lo, bool)
        if len(h):
            rows, begin = np.unique(row, return_index=True)
            least = np.stack([np.minimum.reduceat(at.mix(h ^ np.uint64(977 * (k + 1))), begin) for k in range(SKETCHES)], axis=1)
            for r, sketch in zip(rows, least.tolist()):
                keep[r] = seen.isdisjoint(sketch)
                seen.update(sketch)
        out.append(keep)
    return out


def fit(spark: SparkSession, docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label",
        per_label: int = PER_LABEL) -> Field:
    """``labelled`` has ``key`` and ``label`` (0 or 1) of the rows that may be learnt from."""
    marked = labelled.where(F.col(label).isin(0, 1)).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).distinct()
    shares = {r.y: r.n for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    sample = labelled_texts(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), marked, per_label, (0, MAX_TEXT_BYTES), [0, 1])
    y = np.array(sample.column("y").to_pylist(), int)
    if len(set(y.tolist())) < 2:
        share = shares.get(1, 0) / max(1, sum(shares.values()))
        return Field(np.zeros(0, np.uint64), np.zeros(1), 0.0, np.zeros((2, 2)), np.zeros(4), constant=share)
    fresh = np.concatenate(_fresh(list(at.slices(sample.column("t").combine_chunks()))))
    if len(set(y[fresh].tolist())) == 2:
        sample, y = sample.filter(pa.array(fresh)), y[fresh]
    cut = list(at.slices(sample.column("t").combine_chunks()))
    toxic = [y[s.lo:s.hi] for s in cut]
    known, marks = _dictionary(cut, toxic)
    field = _train(known, *_sequences(cut, toxic, known, np.append(marks, False)))
    x = np.concatenate([_summary(marginals(field, c), c.words, s.hi - s.lo) for s, c in ((s, chains(s)) for s in cut)])
    each = np.array([shares.get(k, 0) / max(1, (y == k).sum()) for k in (0, 1)])
    weight = each[y] * len(y) / (each[y].sum() or 1)
    field.curve = _curve(x, y.astype(float), weight)
    return field


def _row_scores(field: Field, s: at.Slice):
    c = chains(s)
    p = marginals(field, c)
    rows = s.hi - s.lo
    if field.constant is not None:
        return np.full(rows, field.constant), c, np.zeros(len(p))
    return _sigmoid(_summary(p, c.words, rows) @ field.curve), c, p


def _spans(s: at.Slice, c: Chains, p: np.ndarray) -> list[list]:
    """Runs of toxic words in a sentence, as code points of the row's text."""
    out: list[list] = [[] for _ in range(s.hi - s.lo)]
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return out
    first = np.zeros(len(p), bool)
    first[c.begin] = True
    chars = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
    cut = np.flatnonzero((np.diff(hot) > 1) | first[hot[1:]]) + 1
    for run in np.split(hot, cut):
        row = c.words.doc[run[0]]
        zero = chars[s.offsets[row]]
        out[row].append({"begin": int(chars[c.words.start[run[0]]] - zero), "end": int(chars[c.words.end[run[-1]]] - zero), "probability": float(p[run].max())})
    return out


def _scored(batches, sent):
    field = sent.value
    for batch in batches:
        for part in at.slices(batch.column(1)):
            score, c, p = _row_scores(field, part)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.lo, part.hi - part.lo), pa.array(score, pa.float64()),
                pa.array(_spans(part, c, p), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])))],
                names=["row_key", "score", "spans"])


def score(spark: SparkSession, docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key, score (0 to 1) and the offending spans of every row."""
    on_workers(spark)
    sent = spark.sparkContext.broadcast(field)
    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("probability", T.DoubleType())])
    schema = T.StructType([T.StructField("row_key", docs.schema[key].dataType), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    return docs.select(F.col(key).alias("row_key"), F.col(text).alias("t")).mapInArrow(lambda b: released(_scored(b, sent)), schema)


def _accepted(batches, sent, text, limit):
    field = sent.value
    for batch in batches:
        for part in at.slices(batch.column(batch.schema.get_field_index(text))):
            keep = _row_scores(field, part)[0] < limit
            yield batch.slice(part.lo, part.hi - part.lo).filter(pa.array(keep))


def reject(spark: SparkSession, docs: DataFrame, field: Field, limit: float, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches ``limit``; same columns."""
    on_workers(spark)
    sent = spark.sparkContext.broadcast(field)
    return docs.mapInArrow(lambda b: released(_accepted(b, sent, text, limit)), docs.schema)
