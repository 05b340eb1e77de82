"""Personal data by candidate gradient boosting. DataFrame expressions only.

1. Base spans of four kinds are found by pattern, leftmost and not overlapping,
   and kept if their check holds (parts of an address, Luhn digits, numbers of
   digits). They are always part of the result.
2. Generators with wider patterns (``GENERATORS``) propose spans: also spelt-out
   mail addresses, numbers without a plus sign, cards and numbers that run into
   each other, keys and passwords. Their spans may overlap.
3. Learning: over all documents, every proposal is reduced to a few small
   numbers about its format and its surroundings, and to whether its check holds
   (``CHECKS``; the features do not look at what the check reads, so a model of
   the features carries over to proposals without it). Proposals are counted by
   these numbers, so what the driver sees is a table of counts whose size is
   bounded by the features' values (``_FEATURES``), not by the corpus. Boosted
   trees of depth 2 are fitted to these counts, weighted, with logistic loss.
4. Calibration: documents are dealt into two halves by a hash of their id. The
   trees learn from one; on the other, each kind gets the lowest threshold at
   which the checked share of its proposals is ``PRECISION`` or more, by the
   lower end of a Wilson interval. A kind without such a threshold adds nothing.
5. Proposals outside base spans (accepted ones are blanked out first) that
   reach their kind's threshold are added. Added spans of different kinds may
   overlap each other.

The texts are read once; what is found in them is written as a narrow table
(offsets and small numbers), from which the trees are fitted and the result is
made. No text is shuffled; the only shuffle is that of the counts. The work on a
text is linear in it: patterns start at the beginning of a run only and do not
go back (possessive), offsets are summed in blocks. Trees are written as CASE
expressions, so scoring runs in the JVM.

Offsets are code points, end exclusive. Defined cases: a null text is empty; an
empty one has no spans; rows are judged each on its own, repeated ones and ones
with a null id too; ties of learning are broken by the order of features and
values; with an empty table, or without any accepted proposal, nothing is added;
other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import written

BASE_KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 40
RATE = 0.3
PRECISION = 0.9
Z = 1.645
SMALLEST_LEAF = 5
CONTEXT = 24                  # characters before a proposal that features look at

# Patterns of the base spans and the numbers of digits that they may have.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# Patterns of the proposals.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]++(?:\.[0-9]++){3}(?![0-9.]*[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.])(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9]|[.-][0-9])",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16,}+",
}
KINDS = list(GENERATORS)
SECRET_PREFIX = r"^(?:AKIA|ASIA|ghp_|gho_|sk_live_|sk_test_|xoxb|xoxp|AIza)"
SECRET_CUE = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api_?key|access_?key)[\x20\"']*[:=][\x20\"']*$"
# Words before a proposal that tell its kind; the number is the feature's value.
CUES = {1: r"(?i)(?:tel|phone|call|fax|mobile|cell)\P{L}*$", 2: r"(?i)(?:e?-?mail|contact|write to)\P{L}*$", 3: r"(?i)(?:\bip|host|server|address|addr)\P{L}*$",
        4: r"(?i)(?:card|visa|credit|account|iban)\P{L}*$", 5: r"(?i)(?:version|\bver|\bv|section|chapter|release|isbn|no|nr)\P{L}*$"}

_MARK, _BLANK = "\u0001", "\u0002"
_CHUNK = 256
# Features and how many values each can take; their product bounds the table of counts.
_FEATURES = {"kind": 5, "digits": 6, "groups": 5, "brackets": 2, "letters": 4, "length": 5, "dots": 4, "left": 5, "right": 5, "cue": 6}


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at the matches: gaps at even places, matches at odd ones."""
    return F.split(F.regexp_replace(text, F.lit(f"(?:{pattern})"), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)


def _starts(lengths: Column) -> Column:
    """Sum of all earlier lengths, for each place: within chunks and over the chunks' sums, so that no long array is copied for each place."""
    chunks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int"))
    part = lambda b: F.slice(lengths, b * _CHUNK + 1, _CHUNK)                            # noqa: E731
    grow = lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))                    # noqa: E731
    sums = F.transform(chunks, lambda b: F.aggregate(part(b), F.lit(0), lambda a, x: a + x))
    return F.flatten(F.transform(F.arrays_zip(F.aggregate(sums, F.array(F.lit(0)), grow).alias("o"), chunks.alias("b")),
                                 lambda z: F.when(z.b.isNotNull(), F.slice(F.aggregate(part(z.b), F.array(z.o), grow), 1, F.size(part(z.b)))).otherwise(F.array().cast("array<int>"))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.reverse(_digits(value))
    each = F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.substring(d, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def _between(value: Column, bounds: tuple[int, int]) -> Column:
    return F.length(_digits(value)).between(*bounds)


#: What a span's own characters (for keys, those before it) must satisfy: (value, before) -> boolean.
CHECKS = {
    "email": lambda v, before: v.rlike(f"^(?:{BASE['email']})$"),
    "ip": lambda v, before: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda v, before: F.when(_between(v, CARD_DIGITS), _luhn(v)).otherwise(False),
    "phone": lambda v, before: v.startswith("+") & _between(v, PHONE_DIGITS),
    "secret": lambda v, before: v.rlike(SECRET_PREFIX) | before.rlike(SECRET_CUE),
}


def _edge(c: Column) -> Column:
    """Class of a neighbouring character: none, white space, letter or digit, quote or sign of assignment, other."""
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\p{L}\p{N}_]$"), 2).when(c.rlike("^[\"'=:<>]$"), 3).otherwise(4)


def _bucket(n: Column, limits: list[int]) -> Column:
    """How many of the limits n reaches."""
    return sum(((n >= x).cast("int") for x in limits[1:]), (n >= limits[0]).cast("int"))


def _described(kind: str, value: Column, before: Column, after: Column) -> dict[str, Column]:
    """The features of one proposal."""
    plain = F.regexp_replace(value, r"^\+", "")         # the sign is what the check of numbers reads
    letters = F.when(~plain.rlike("[A-Za-z]"), 0).when(~plain.rlike("[A-Z]"), 1).when(~plain.rlike("[a-z]"), 2).otherwise(3)
    cue = F.lit(0)
    for number, pattern in CUES.items():
        cue = F.when(before.rlike(pattern), number).otherwise(cue)
    return {"kind": F.lit(KINDS.index(kind)), "digits": _bucket(F.length(_digits(plain)), [4, 7, 10, 13, 17]),
            "groups": F.least(F.size(F.split(plain, "[^0-9]+")), F.lit(4)), "brackets": plain.contains("(").cast("int"), "letters": letters,
            "length": _bucket(F.length(plain), [10, 16, 20, 32]), "dots": F.least(F.length(F.regexp_replace(plain, r"[^.]", "")), F.lit(3)),
            "left": _edge(F.right(before, F.lit(1))), "right": _edge(F.left(after, F.lit(1))), "cue": cue if kind != "secret" else F.lit(0)}


def _matches(pieces: Column, starts: Column, make) -> Column:
    """``make`` (start, value, before, after) of every match."""
    places = F.when(F.size(pieces) > 1, F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: make(F.get(starts, i), F.get(pieces, i), F.right(F.get(pieces, i - 1), F.lit(CONTEXT)), F.left(F.get(pieces, i + 1), F.lit(1))))


def _blanked(pieces: str, check) -> Column:
    """The pieces with blanks for the matches that pass the check."""
    return F.transform(pieces, lambda p, i: F.when((i % 2 == 1) & check(p, F.lit("")), F.repeat(F.lit(_BLANK), F.char_length(p))).otherwise(p))


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row_key, half, base (accepted spans by kind, then start), seen (features
    and check of all proposals) and open (spans and features of the proposals outside base spans)."""
    frame = docs.select(F.col(f"`{key}`").alias("row_key"), F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(2)).alias("half"),
                        F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _MARK + _BLANK, "\u0003\u0003").alias("t"))
    none = F.array(F.lit(""))
    has = {"email": F.col("t").contains("@") | F.col("t").rlike(r"[(\[]at[)\]]"), "secret": F.col("t").rlike("[A-Za-z0-9_]{16}")}
    frame = frame.withColumns({f"has_{k}": has.get(k, F.col("t").rlike(r"[0-9][\x20().-]?[0-9]|[0-9]\.[0-9]")) for k in KINDS})

    def cut(frame: DataFrame, name: str, kind: str, source: str, pattern: str) -> DataFrame:
        frame = frame.withColumn(f"{name}_{kind}", F.when(F.col(f"has_{kind}"), _pieces(F.col(source), pattern)).otherwise(none))
        frame = frame.withColumn("l", F.transform(f"{name}_{kind}", F.char_length))
        return frame.withColumn(f"{name}_{kind}_at", _starts(F.col("l"))).drop("l")

    for kind in BASE_KINDS:
        frame = cut(frame, "b", kind, "t", BASE[kind])
        found = _matches(F.col(f"b_{kind}"), F.col(f"b_{kind}_at"), lambda at, v, before, after, k=kind: F.struct(
            F.lit(k).alias("kind"), at.alias("start"), (at + F.char_length(v)).alias("end"), CHECKS[k](v, before).alias("ok")))
        frame = frame.withColumn(f"found_{kind}", F.filter(found, lambda s: s.ok)).drop(f"b_{kind}", f"b_{kind}_at")
    blanked = F.col("t")
    for kind in ("email", "phone", "ip", "card"):
        frame = frame.withColumn("m", F.when(F.size(f"found_{kind}") > 0, _pieces(blanked, BASE[kind])))
        frame = frame.withColumn("masked", F.when(F.col("m").isNotNull(), F.array_join(_blanked("m", CHECKS[kind]), "")).otherwise(blanked)).drop("m")
        blanked = F.col("masked")
    for kind in KINDS:
        frame = cut(frame, "s", kind, "t", GENERATORS[kind])
        frame = frame.withColumn(f"seen_{kind}", _matches(F.col(f"s_{kind}"), F.col(f"s_{kind}_at"), lambda at, v, before, after, k=kind: F.struct(
            *[c.cast("int").alias(n) for n, c in _described(k, v, before, after).items()], CHECKS[k](v, before).cast("int").alias("ok")))).drop(f"s_{kind}", f"s_{kind}_at")
        frame = cut(frame, "o", kind, "masked", GENERATORS[kind])
        frame = frame.withColumn(f"open_{kind}", _matches(F.col(f"o_{kind}"), F.col(f"o_{kind}_at"), lambda at, v, before, after, k=kind: F.struct(
            at.alias("start"), (at + F.char_length(v)).alias("end"), *[c.cast("int").alias(n) for n, c in _described(k, v, before, after).items()]))).drop(f"o_{kind}", f"o_{kind}_at")
    base = F.transform(F.concat(*[F.col(f"found_{k}") for k in BASE_KINDS]), lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return frame.select("row_key", "half", base.alias("base"), F.concat(*[F.col(f"seen_{k}") for k in KINDS]).alias("seen"), F.concat(*[F.col(f"open_{k}") for k in KINDS]).alias("open"))


# ---------------------------------------------------------------- boosted trees

def _grow(rows: list[tuple], names: list[str], depth: int):
    """A regression tree of Newton steps; ``rows`` are (values, weight, gradient, curvature)."""
    g, h = sum(r[2] for r in rows), sum(r[3] for r in rows)
    best = (1e-9, None, None)
    if depth:
        for f in range(len(names)):
            sums: dict[int, list[float]] = {}
            for values, weight, gradient, curvature in rows:
                s = sums.setdefault(values[f], [0.0, 0.0, 0.0])
                s[0], s[1], s[2] = s[0] + gradient, s[1] + curvature, s[2] + weight
            lg = lh = lw = 0.0
            total = sum(s[2] for s in sums.values())
            for value in sorted(sums)[:-1]:
                lg, lh, lw = lg + sums[value][0], lh + sums[value][1], lw + sums[value][2]
                if min(lw, total - lw) < SMALLEST_LEAF:
                    continue
                gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
                if gain > best[0]:
                    best = (gain, f, value)
    if best[1] is None:
        return RATE * g / (h + 1)
    _, f, value = best
    return (f, value, _grow([r for r in rows if r[0][f] <= value], names, depth - 1), _grow([r for r in rows if r[0][f] > value], names, depth - 1))


def _value(tree, values: tuple) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if values[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(counts: list[tuple[tuple, int, int]], rounds: int = ROUNDS, depth: int = 2) -> list:
    """Trees whose summed values are the log odds; ``counts`` are (values, rows, rows that pass)."""
    names = list(_FEATURES)
    total, good = sum(c[1] for c in counts), sum(c[2] for c in counts)
    trees: list = [math.log((good + 0.5) / (total - good + 0.5))]
    score = [trees[0]] * len(counts)
    for _ in range(rounds if counts else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        tree = _grow([(v, n, y - n * q, n * q * (1 - q)) for (v, n, y), q in zip(counts, p)], names, depth)
        trees.append(tree)
        score = [s + _value(tree, c[0]) for s, c in zip(score, counts)]
    return trees


def thresholds(trees: list, counts: list[tuple[tuple, int, int]], precision: float = PRECISION, z: float = Z) -> dict[str, float]:
    """Per kind the lowest log odds at which the share that passes is surely ``precision``."""
    out = {}
    for k, kind in enumerate(KINDS):
        by_score: dict[float, list[int]] = {}
        for values, n, y in counts:
            if values[0] == k:
                s = by_score.setdefault(round(sum(_value(t, values) for t in trees), 9), [0, 0])
                s[0], s[1] = s[0] + n, s[1] + y
        n = good = 0
        for score in sorted(by_score, reverse=True):
            n, good = n + by_score[score][0], good + by_score[score][1]
            share = good / n
            low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            if low >= precision:
                out[kind] = score - 1e-6
    return out


def _sql(tree, at: str) -> str:
    if not isinstance(tree, tuple):
        return repr(float(tree)) + "D"
    return f"(CASE WHEN {at}.{list(_FEATURES)[tree[0]]} <= {tree[1]} THEN {_sql(tree[2], at)} ELSE {_sql(tree[3], at)} END)"


def learn(found: DataFrame) -> tuple[list, dict[str, float]]:
    """(trees, thresholds) from the proposals of all documents: the driver gets their counts by features."""
    names = list(_FEATURES)
    counted = (found.select("half", F.explode("seen").alias("s")).select("half", "s.*").groupBy("half", *names).agg(F.count("*").alias("n"), F.sum("ok").alias("y"))
               .orderBy("half", *names).collect())                 # at most twice the product of _FEATURES
    halves: list[list] = [[], []]
    for r in counted:
        halves[int(r["half"])].append((tuple(r[c] for c in names), r["n"], r["y"]))
    trees = boost(halves[0])
    return trees, thresholds(trees, halves[1])


def find(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", model: tuple[list, dict[str, float]] | None = None) -> DataFrame:
    """row_key, base and spans (kind, start, end; by kind, then start): the base
    spans, and with the added ones. ``model`` is what ``learn`` gave for other documents."""
    found, _ = written(spark, candidates(docs, key, text), "proposals")
    trees, limits = model or learn(found)
    limit = "CASE " + " ".join(f"WHEN c.kind = {KINDS.index(k)} THEN {v!r}D" for k, v in limits.items()) + " END" if limits else "CAST(NULL AS DOUBLE)"
    score = " + ".join(_sql(t, "c") for t in trees)
    added = F.expr(f"transform(filter(open, c -> coalesce({score} >= {limit}, false)), c -> struct(element_at(array({', '.join(repr(k) for k in KINDS)}), c.kind + 1) AS kind, c.start AS start, c.end AS end))")
    ranked = F.array_sort(F.transform(F.concat("base", added), lambda s: F.struct(F.array_position(F.array(*[F.lit(k) for k in [*BASE_KINDS, "secret"]]), s.kind).alias("n"),
                                                                                  s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    spans = F.transform(ranked, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))
    return found.select("row_key", "base", spans.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
