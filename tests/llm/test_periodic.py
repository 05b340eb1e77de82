import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spindle.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def check(docs):
    symbol = np.array([x for d in docs for x in d], np.uint64)
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    first = np.cumsum([0, *map(len, docs)])
    got = [[] for _ in docs]
    for a, b, q in zip(*periodic.find_runs(symbol, doc)):
        got[doc[a]].append((int(a - first[doc[a]]), int(b - a), int(q)))
    assert got == [periodic.brute_force(d) for d in docs]
    return sum(map(len, got))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=6), max_size=4))
def test_runs_equal_brute_force(parts):
    check([[x for word, times in d for x in word * times] for d in parts])


def test_nested_and_broken_runs():
    """Stretches whose period holds stretches of its own, with single words changed."""
    rng, found = random.Random(5), 0
    for _ in range(300):
        d = []
        while len(d) < rng.choice([60, 200, 600]):
            base = [rng.randrange(3) for _ in range(rng.randint(1, 20))]
            base = base[:rng.randint(1, 3)] * rng.randint(1, 8) + base
            d += base * rng.randint(1, 7)
            if rng.random() < 0.3:
                d[rng.randrange(len(d))] = rng.randrange(3)
        found += check([d])
    assert found > 1000


def test_wavelet_successor():
    values = np.random.RandomState(3).permutation(300)
    tree = periodic.WaveletTree(values)
    low, x = np.random.RandomState(4).randint(0, 300, (2, 2000))
    high = np.minimum(300, low + np.random.RandomState(5).randint(0, 60, 2000))
    x[:50] += 300
    got = tree.successor(low, high, x)
    assert [min((v for v in values[a:b].tolist() if v >= y), default=-1) for a, b, y in zip(low, high, x.tolist())] == got.tolist()


def test_long_and_repetitive():
    """One word 100,000 times; a long text whose period is a quarter of it; neither takes quadratic work."""
    assert [x.tolist() for x in periodic.find_runs(np.zeros(100_000, np.uint64), np.zeros(100_000, int))] == [[0], [100_000], [1]]
    x = np.tile(np.random.RandomState(1).permutation(25_000), 4).astype(np.uint64)
    assert [y.tolist() for y in periodic.find_runs(x, np.zeros(len(x), int))] == [[0], [100_000], [25_000]]


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
    found = periodic.brute_force(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    from fractions import Fraction
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def rows_of(frame):
    return {(r.doc_id, r.collapsed_sha256): (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in frame.collect()}


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    got = rows_of(queries.op11_periodic_runs(spark, SF))
    assert {k[0]: v for k, v in got.items()} == {i: expected(i, t) for i, t in docs.items()}
    assert sum(v[0] for v in got.values()) > 5


def test_odd_rows(spark, odd_docs, no_docs, tmp):
    again = spark.createDataFrame([(20, "a b a b a b a b\n c"), (21, "x " * 20_000), (22, "x\x0bx x x x x x x x"), (22, "x\x0bx x x x x x x x"), (None, "q q q q q q")], "doc_id long, text string")
    rows = odd_docs.unionByName(again, allowMissingColumns=True)
    rows.write.parquet(f"{tmp}/documents.parquet")
    want = sorted((expected(r.doc_id, r.text) for r in rows.collect()), key=str)
    got = queries.op11_periodic_runs(spark, tmp)
    assert sorted((tuple(r)[1:] for r in got.collect()), key=str) == want
    out = periodic.runs(spark, again).collect()
    assert [(x.start, x.length, x.period) for x in out[0].runs] == [(0, 8, 2)] and out[0].collapsed == "a b c" and out[1].collapsed == "x"
    assert periodic.runs(spark, no_docs).count() == 0
