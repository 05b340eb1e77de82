"""The registered queries against DuckDB, and the pipeline against brute force."""
import re

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from spindle.llm import bpe, decontaminate, order_minhash, queries

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels embeddings".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{k}" for k in range(1, 14)} and "pipeline" in entry.queries()
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["toxicity", "exact_duplicates", "near_duplicates", "benchmark_decontamination", "bpe_round_trip"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_near_duplicates(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    want = order_minhash.brute_force(rows)
    got = {r.doc_id: r.class_id for r in queries.op1_order_minhash(spark, SF).collect()}
    assert {i: got[i] for i in want} == want and len(got) == len(rows)


def test_pipeline_against_brute_force(spark):
    """Every stage after the classifier, recomputed from what the one before kept."""
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    scored = {r.row_key: r.score for r in queries.toxic_crf.score(spark, docs, queries.toxic_field(spark, docs, queries.table(spark, SF, "labels"))).collect()}
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert kept.columns == columns and set(rows) == {i for i, s in scored.items() if s < queries.TOXIC_LIMIT}
    kept = corpus_pipeline.exact_duplicates(spark, kept, SF)
    first = {}
    for i in sorted(rows):
        first.setdefault(" ".join(re.split(r"[\x20\x09-\x0D]+", rows[i])), i)
    rows = {i: rows[i] for i in first.values()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(rows)
    kept = corpus_pipeline.near_duplicates(spark, kept, SF)
    group = order_minhash.brute_force(list(rows.items()))
    rows = {i: t for i, t in rows.items() if group.get(i, i) == i}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(rows)
    kept = corpus_pipeline.benchmark_decontamination(spark, kept, SF)
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    hit = decontaminate.brute_force(list(rows.items()), items)
    rows = {i: t for i, t in rows.items() if not hit[i][1]}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(rows)
    out = {r.doc_id: r for r in corpus_pipeline.bpe_round_trip(spark, kept, SF).collect()}
    own = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    assert {i: bytes(r.ids) for i, r in out.items()} == {i: own.encode(t) for i, t in rows.items()}
    whole = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in whole.collect()} == set(rows)


def test_pipeline_stages_on_odd_rows(spark, tmp):
    schema = queries.table(spark, SF, "documents").schema
    rows = [(1, None, None, None, None), (None, "some text of its own that nobody else has", "en", "s", 3), (2, "", None, None, 0), (3, "word " * 20000, "en", None, 1),
            (4, "a b c d e f g h i j k", "en", "s", 2), (4, "a b c d e f g h i j k", "en", "s", 2)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(1, "b c d e f g h i j k"), (None, None)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    docs = queries.table(spark, tmp, "documents")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, tmp)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), tmp).count() == 0
    assert corpus_pipeline.toxicity(spark, docs, tmp).columns == docs.columns
    assert corpus_pipeline.exact_duplicates(spark, docs, tmp).count() == 4
    assert corpus_pipeline.benchmark_decontamination(spark, docs, tmp).count() == 4
    assert corpus_pipeline.bpe_round_trip(spark, docs, tmp).count() == 6


def test_scratch_tables_go(spark, tmp):
    from spindle.llm import runtime
    with runtime.scratch_removed(spark):
        frame, path = runtime.written(spark, spark.range(3), "x")
        assert frame.count() == 3 and path in runtime._MADE
    assert path not in runtime._MADE
    with pytest.raises(Exception):
        spark.read.parquet(path)
