import re
from collections import defaultdict

import pytest

from spindle.llm import exact_dedup as ed


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return sorted((i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g if i is not None)


@pytest.mark.parametrize("digest_bytes,salt_rows,broadcast_rows", [(32, 1000, 100_000), (1, 3, 0), (1, 1000, 100_000)])
def test_against_brute_force(spark, digest_bytes, salt_rows, broadcast_rows):
    """A digest of one byte makes different texts meet under it: the bytes decide."""
    rows = [(i, f"text {i % 90}" if i % 3 else f"text\t \n{i % 90}") for i in range(400)] + [(900 + i, "hot") for i in range(60)] + [(2000, None), (1999, ""), (2001, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ed.members(spark, docs, digest_bytes=digest_bytes, salt_rows=salt_rows, broadcast_rows=broadcast_rows).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in got) == brute(rows)
    assert all(r.kept == (r.id == r.keep_id) for r in got)
    kept = ed.keep_first(spark, docs, digest_bytes=digest_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({k for _, k, _ in brute(rows)})


def test_state_meets_earlier_batches(spark, tmp):
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(70)], "id long, t string")
    arrivals = docs.select("id", ed._digest(docs.t, 32).alias("digest"), ed.F.xxhash64("t").alias("check"),
                           ed.F.struct(ed.F.lit("f").alias("file"), ed.F.lit(2).alias("bytes")).alias("locator")).repartition(6)
    arrivals.write.parquet(f"{tmp}/arrivals")
    state, where = ed.state_of(spark, f"{tmp}/arrivals", batches=3)
    assert sorted((r.keep_id, r.group_size) for r in state.collect()) == [(i, 10) for i in range(7)]
    commits = spark.read.text(f"{where}/commits").inputFiles()
    assert len(commits) >= 3


def test_odd_rows(spark, odd_docs, no_docs):
    kept = ed.keep_first(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    # 2, 3 and the null-id empties are equal texts; 4 is one space; 5 and 6, 1 and the two 8 are equal
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 4, 5, 7, 9, 10, 11, 12)] + [(True, 0)]
    got = ed.members(spark, odd_docs).collect()
    assert len(got) == odd_docs.count() and sum(r.kept for r in got) == 10
    assert ed.members(spark, no_docs).count() == 0 == ed.keep_first(spark, no_docs).count()


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (3, "b"), (3, "b"), (3, "c")], "doc_id long, text string")
    assert sorted(r.text for r in ed.keep_first(spark, docs).collect()) == ["a", "b", "c"]
