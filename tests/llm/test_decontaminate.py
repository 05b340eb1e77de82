import random

import pytest

from spindle.llm import decontaminate as d


def made(spark, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 5, 9, 10, 11, 14, 25])))) for i in range(14)]
    items += [(50, None), (51, " .. "), (3, items[3][1]), (60, items[4][1].upper())]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30)))]
        for _ in range(rnd.randint(0, 3)):
            words = rnd.choice(items[:14])[1].split()
            a = rnd.randint(0, len(words) - 1)
            parts += [", ".join(words[a:]), " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 4)))]
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 150])
def test_against_brute_force(spark, block_bytes):
    docs, items = made(spark)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = d.brute_force(docs, items)
    got = {r.row_key: r for r in d.find_matches(spark, frame, bench, block_bytes=block_bytes).collect()}
    import hashlib
    for k, (n_words, n_hit, n_items, digest) in want.items():
        ids = sorted({m.item_id for m in got[k].matches})
        assert (got[k].n_words, got[k].n_hit, len(got[k].matches)) == (n_words, n_hit, n_items)
        assert hashlib.sha256(",".join(ids).encode()).hexdigest() == digest
    assert any(v[1] for v in want.values()) and not all(v[1] for v in want.values())
    clean = {r.doc_id for r in d.decontaminate(spark, frame, bench, block_bytes=block_bytes).collect()}
    assert clean == {k for k, v in want.items() if not v[1]}


def test_longest_match_and_its_places(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e f g h i j k l z")], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "0 a b c d e f g h i j k l m n")], "item_id string, text string")
    (row,) = d.find_matches(spark, docs, bench).collect()
    (m,) = row.matches
    assert (m.item_id, m.item_word, m.doc_word, m.n_match, row.n_hit) == ("q", 1, 2, 12, 12)
    assert [(r.a, r.b) for r in row.hit_runs] == [(2, 14)]


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "three four five six seven eight nine ten eleven twelve", "x"), (2, "word", "y"), (None, "ü", "z")], "item_id long, text string, lang string")
    got = d.find_matches(spark, odd_docs, bench).collect()
    assert len(got) == odd_docs.count()
    assert sorted(r.row_key for r in got if r.n_hit) == [1, 7, 8, 8, 10, 11]      # the item without an id hits, but is not listed
    assert [r.matches for r in got if r.row_key == 10] == [[]]
    kept = d.decontaminate(spark, odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 6
    assert d.find_matches(spark, no_docs, bench).count() == 0 == d.decontaminate(spark, no_docs, bench).count()
    assert d.decontaminate(spark, odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert all(r.n_hit == 0 for r in d.find_matches(spark, odd_docs, bench.limit(0)).collect())


def test_memory_is_linear_in_a_long_item():
    import tracemalloc

    import pyarrow as pa
    item = " ".join(f"w{i}" for i in range(6000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([f"x y {item} z", " ".join(item.split()[100:4000])])], names=["row_key", "text"])
    tracemalloc.start()
    (got,) = d._scan([batch], d.item_suffixes([("q", item), ("r", "w1 w2")], 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[(m["item_id"], m["item_word"], m["doc_word"], m["n_match"]) for m in r] for r in got.column("matches").to_pylist()] == [[("q", 0, 2, 6000), ("r", 0, 3, 2)], [("q", 100, 0, 3900)]]
    assert got.column("n_hit").to_pylist() == [6000, 3900] and peak < 64 << 20


def test_two_texts_of_one_item_count_as_one_item(spark, tmp):
    from spindle.llm import queries
    spark.createDataFrame([(1, "a b c d e f"), (2, "x")], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(7, "a b"), (7, "e f"), (8, "c d")], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    assert {r.doc_id: (r.n_items, r.n_hit) for r in queries.op3_suffix_array_decontamination(spark, tmp).collect()} == {1: (2, 6), 2: (0, 0)}


def test_repetitive_text_and_item_take_linear_memory_and_time():
    """A megabyte of one word against an item of 2,000 equal words."""
    import time
    import tracemalloc

    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["ab " * 350_000, "x " + "ab " * 1500 + "y"])], names=["row_key", "text"])
    found = d.item_suffixes([("q", "ab " * 2000), ("r", "cd " * 11 + "ab " * 9), (None, "ab x")], 10)
    tracemalloc.start()
    begun = time.time()
    got = pa.Table.from_batches(d._scan([batch], found))
    took, peak = time.time() - begun, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [[(m["item_id"], m["item_word"], m["doc_word"], m["n_match"]) for m in r] for r in got.column("matches").to_pylist()] == [[("q", 0, 0, 2000)], [("q", 0, 1, 1500)]]
    assert got.column("n_hit").to_pylist() == [350_000, 1500] and peak < 1 << 30 and took < 60
    clean = pa.Table.from_batches(d._clean([batch], found, "text"))
    assert clean.num_rows == 0


@pytest.mark.parametrize("seed", range(4))
def test_longest_match_by_hand(spark, seed):
    docs, items = made(spark, seed + 20)
    items = [(i, x) for i, x in items if i != 3] + [(90, " ".join(["w1", "w2"] * 20))]
    docs = docs + [(70, " ".join(["w1", "w2"] * 30 + ["w3"]))]
    got = {r.row_key: {m.item_id: (m.n_match, m.doc_word, m.item_word) for m in r.matches}
           for r in d.find_matches(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for k, t in docs:
        w, want = d.at.text_words(t), {}
        for i, x in items:
            v = d.at.text_words(x)
            best = None
            for p in range(len(w)):
                for a in range(len(v)):
                    n = 0
                    while p + n < len(w) and a + n < len(v) and w[p + n] == v[a + n]:
                        n += 1
                    if n and n >= min(10, len(v)) and (best is None or (-n, p, a) < best):
                        best = (-n, p, a)
            if best:
                want[str(i)] = (-best[0], best[1], best[2])
        assert got[k] == want
