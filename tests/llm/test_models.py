"""Toxicity and quality: held-out accuracy, and odd rows."""
import random

import numpy as np
import pytest

from spindle.llm import latent_knn, queries, toxic_crf

SF = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    pairs = [(got[r.doc_id], r[label]) for r in queries.table(spark, SF, "labels").collect() if got[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 for r in got.values())
    return pairs


def test_toxic_held_out(spark):
    pairs = held_out(spark, "op8_toxic_crf", "toxic")
    caught = np.mean([r.predicted for r, y in pairs if y])
    flagged = np.mean([r.predicted for r, y in pairs if not y])
    assert caught > 0.9 and flagged < 0.01


def test_quality_held_out(spark):
    pairs = held_out(spark, "op10_latent_quality", "quality")
    assert np.mean([r.predicted == y for r, y in pairs]) > 0.98


def test_forward_backward_is_exact():
    rng = np.random.RandomState(0)
    length = np.array([1, 5, 3, 7])
    begin = np.cumsum(length) - length
    e, t = rng.randn(length.sum()), rng.randn(2, 2)
    a, b = toxic_crf.forward_backward(e, begin, length, t)
    for s, n in zip(begin, length):
        weight = np.zeros((n, 2))
        for states in np.ndindex(*(2,) * n):
            w = np.exp(sum(states * e[s:s + n]) + sum(t[x, y] for x, y in zip(states, states[1:])))
            for k, x in enumerate(states):
                weight[k, x] += w
        assert np.allclose(1 / (1 + np.exp(-(a + b)[s:s + n])), weight[:, 1] / weight.sum(axis=1))


@pytest.fixture()
def trained(spark):
    rnd = random.Random(6)
    words = [f"word{k}" for k in range(300)]
    rows = [(i, " ".join(rnd.choices(words, k=30)) + ".", 0) for i in range(40)]
    rows += [(100 + i, " ".join([*rnd.choices(words, k=12), f"grobbler{i}", *rnd.choices(words, k=12), f"grobbler{i + 1}"]) + ".", 1) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, label int")


def test_spans(spark, trained):
    docs, labels = trained
    field = toxic_crf.fit(spark, docs, labels)
    text = "é Plain words. She said grobblerxy, no more."
    (row,) = toxic_crf.score(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), field).collect()
    assert any(text[s.begin:s.end] == "grobblerxy" for s in row.spans) and row.score > 0.3
    kept = {r.doc_id for r in toxic_crf.reject(spark, docs, field, 0.3).collect()}
    assert kept == set(range(40))


def test_toxic_odd_rows(spark, trained, odd_docs, no_docs):
    field = toxic_crf.fit(spark, *trained)
    got = toxic_crf.score(spark, odd_docs, field).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score < 0.3 and r.spans == [] for r in got)
    assert toxic_crf.reject(spark, odd_docs, field, 0.3).count() == odd_docs.count()
    assert toxic_crf.reject(spark, odd_docs, field, 0.3).columns == odd_docs.columns
    assert toxic_crf.score(spark, no_docs, field).count() == 0
    nothing = toxic_crf.fit(spark, no_docs, trained[1])
    assert {r.score for r in toxic_crf.score(spark, odd_docs, nothing).collect()} == {41 / 81}
    one = toxic_crf.fit(spark, trained[0], trained[1].where("label = 0"))
    assert {r.score for r in toxic_crf.score(spark, odd_docs, one).collect()} == {0.0}


def test_quality_odd_rows(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, "good plain words in a row. And more of them.") for i in range(30)] + [(50 + i, "BAD!! BAD!! BAD!! BAD!!") for i in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(50 + i, 0) for i in range(10)] + [(None, 1), (1, None)], "doc_id long, label int")
    model = latent_knn.fit(spark, docs, labels)
    got = latent_knn.score(spark, odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.row_key in (2, 3)} == {0.75}
    by_text = {r.row_key: r.score for r in latent_knn.score(spark, docs, model).collect()}
    assert by_text[3] > 0.9 and by_text[55] < 0.5
    nothing = latent_knn.fit(spark, no_docs, labels)
    assert {r.score for r in latent_knn.score(spark, odd_docs, nothing).collect()} == {0.5}
    assert latent_knn.score(spark, no_docs, model).count() == 0


def test_votes_match_plain_cosines(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.001", "labels").selectExpr("doc_id", "quality as label")
    model = latent_knn.fit(spark, docs, labels, neighbours=5)
    got = {r.row_key: r.score for r in latent_knn.score(spark, docs, model).collect()}
    import pyarrow as pa
    for r in docs.collect()[:40]:
        (s,) = latent_knn.at.slices(pa.array([r.text]))
        v = model.latent(latent_knn.counted(s, model.dims))[0]
        c = sorted(((float(v @ u), y) for u, y in zip(model.vectors, model.labels)), reverse=True)[:5]
        w = [max(x, 1e-6) ** 4 for x, _ in c]
        assert abs(got[r.doc_id] - sum(a * y for a, (_, y) in zip(w, c)) / sum(w)) < 1e-3


def test_sample_is_bounded_in_rows_and_replaces_long_texts(spark):
    """One doc_id stands on a third of all rows; long and missing texts give way to the next keys."""
    from spindle.llm.samples import labelled_texts
    docs = [(7, f"hot {i % 50}") for i in range(500)] + [(i, "x" * 300 if i % 3 else f"text {i}") for i in range(1000, 1600)] + [(None, "no id")]
    marked = [(7, 1), (7, 0), (7, 1)] + [(i, i % 2) for i in range(1000, 1800)] + [(None, 1)]
    d, m = spark.createDataFrame(docs, "k long, t string"), spark.createDataFrame(marked, "k long, y int")
    whole = labelled_texts(d, m, 10_000, (0, 100), [0, 1])
    assert whole.num_rows == 202 and sorted(r["t"] for r in whole.to_pylist() if r["k"] == 7) == ["hot 0", "hot 0"]
    some = labelled_texts(d, m, 40, (0, 100), [0, 1]).to_pylist()
    assert sorted(r["y"] for r in some) == [0] * 40 + [1] * 40 and all(r["t"].startswith(("text", "hot")) for r in some)
    assert labelled_texts(d, m, 40, (0, 100)).num_rows == 40 and labelled_texts(d, m.limit(0), 40, (0, 100)).num_rows == 0
    assert labelled_texts(d.limit(0), m, 40, (0, 100), [0, 1]).num_rows == 0
