import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import angular, queries


def brute_force(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    """Every row against every anchor, in plain integers."""
    good = [(k, y, [math.floor(256 * float(x)) for x in v]) for k, y, v in rows if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    by = lambda r: (-r[0], r[1] is None, r[1] or 0)          # noqa: E731
    out = []
    for k, y, v in good:
        if k is None or not is_anchor(k):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), i, z) for i, z, w in good if i != k]
        for p, i, _ in sorted((s for s in scored if s[2] == y), key=by)[:positives]:
            fit = sorted((s for s in scored if s[2] != y and low * p <= 100 * s[0] <= high * p), key=by)[:negatives]
            out += [(k, i, n + 1, j, p, s) for n, (s, j, _) in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows, anchors, **options):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted((tuple(r) for r in angular.mine(spark, frame, anchors, **options).collect()), key=str)


def made(seed, n=400, dims=12, labels=4):
    """Clustered vectors, some repeated, some zero, all as float32 holds them."""
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for k in range(n):
        v = centres[rng.randint(6)] + rng.normal(size=dims) * rng.choice([0.0, 0.2, 1.0])
        if k % 37 == 0:
            v = v * 0
        rows.append((k, int(rng.randint(labels)), [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made(seed)
    assert mined(spark, rows, F.col("vec_id") % 20 == 0) == brute_force(rows, lambda k: k % 20 == 0)


def test_other_limits_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(angular, "BLOCK_ROWS", 7)
    rows = made(3, n=150)
    got = mined(spark, rows, F.col("vec_id") % 10 == 3, positives=2, negatives=3, low=-50, high=80)
    assert got == brute_force(rows, lambda k: k % 10 == 3, 2, 3, -50, 80) and got


def test_bounds_hold_and_skip():
    """Bounds contain every score; on clustered vectors most rows lie outside a window near the top."""
    rows = made(5, n=600, dims=16)
    v = np.array([[math.floor(256 * x) for x in r[2]] for r in rows], np.int64)
    norms = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    refs = np.array([x / (np.linalg.norm(x) or 1) for x in v[1:9].astype(float)])
    angles = angular._angles(v, norms, refs)
    n = np.zeros(len(v), bool)
    block = angular._Block({"n": len(v), "dims": 16, "ids": n.astype(np.int64).tobytes(), "keys": n.astype(np.int64).tobytes(), "nulls": n.tobytes(), "labels": n.astype(np.int64).tobytes(),
                            "vectors": v.tobytes(), "norms": norms.tobytes(), "angles": angles.tobytes(), "windows": b""})
    seen = 0
    for a in range(0, 600, 25):
        low, high = block.bounds(angles[a], norms[a])
        scores = v @ v[a]
        assert (low <= scores).all() and (scores <= high).all()
        seen += (high >= 0.95 * scores.max()).sum()
    assert seen < 0.5 * 24 * 600


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 0.25]), (1, 1, [0.5, 0.5]), (2, 1, [0.5, 0.5]), (2, 1, [0.5, 0.5]), (3, 2, [0.3, 0.1]), (4, 2, [0.3, 0.1]), (4, 2, [0.3, 0.1]), (None, 2, [0.25, 0.125]),
            (5, None, [1.0, 1.0]), (6, 1, None), (7, 1, [nan, 1.0]), (8, 2, [inf, 1.0]), (9, 2, [None, 1.0]), (10, 2, []), (10, 3, [0.5]), (20, 4, [0.5, 0.5]), (30, 5, [0.0, 0.0]), (31, 5, [1.0, 0.0]),
            (40, 6, [-0.3, 0.2]), (41, 6, [0.3, -0.2]), (0, 2, [0.2, 0.2])]
    got = mined(spark, rows, F.col("vec_id") % 10 == 0)
    assert got == brute_force(rows, lambda k: k % 10 == 0) and got
    assert mined(spark, [], F.col("vec_id") % 10 == 0) == []
    assert mined(spark, [r for r in rows if r[0] == 20], F.col("vec_id") % 10 == 0) == []


def test_large_components(spark):
    """Scores beyond 2^53 stay exact."""
    rng = random.Random(2)
    rows = [(k, k % 3, [float(np.float32(rng.uniform(-1, 1) * 3e5)) for _ in range(40)]) for k in range(60)]
    got = mined(spark, rows, F.col("vec_id") % 6 == 0)
    assert got == brute_force(rows, lambda k: k % 6 == 0) and max(abs(r[4]) for r in got) > 2 ** 53


def test_extra_columns_with_clashing_names(spark):
    rows = made(4, n=60)
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, label int, embedding array<float>, key int, anchor string, score double")
    got = sorted((tuple(r) for r in angular.mine(spark, frame, F.col("vec_id") % 20 == 0).collect()), key=str)
    assert got == brute_force(rows, lambda k: k % 20 == 0)


def test_query_columns(spark):
    got = queries.op12_angular_negatives(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
