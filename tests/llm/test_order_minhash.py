import random

import numpy as np

from spindle.llm import order_minhash as omh


def family(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            k = rnd.randrange(len(w))
            rnd.choice([lambda: w.__setitem__(k, f"n{rnd.randrange(10**6)}"), lambda: w.insert(k, f"n{rnd.randrange(10**6)}"), lambda: w.pop(k)])()
        out.append(" ".join(w))
    return out


def classes(spark, docs, **options):
    members, links = omh.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4), **options)
    return {r.id: r["class"] for r in members.collect()}, links


def test_against_brute_force(spark):
    rnd = random.Random(2)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for size, n, edits in [(80, 6, 1), (200, 25, 2), (150, 40, 3), (40, 5, 1), (300, 3, 30), (100, 4, 2)]:
        texts += family(rnd, rnd.choices(vocabulary, k=size), n, edits)
    passage = rnd.choices(vocabulary, k=45)
    texts += [" ".join(passage + rnd.choices(vocabulary, k=rnd.randint(10, 40))) for _ in range(40)]      # a shared passage is no copy
    texts += [texts[0], texts[7].upper(), "a b c", "a b c d", "a  b c!"]
    rnd.shuffle(texts)
    docs = list(enumerate(texts))
    got, links = classes(spark, docs)
    assert got == omh.brute_force(docs)
    found = {(r.a, r.b): r.similarity for r in links.collect()}
    assert found and all(a < b and s >= 0.8 for (a, b), s in found.items())


def test_large_family_stays_together_without_all_pairs(spark):
    rnd = random.Random(3)
    base = [f"b{rnd.randrange(5000)}" for _ in range(300)]
    docs = list(enumerate(family(rnd, base, 400, 4) + [" ".join(f"u{i}x{j}" for j in range(60)) for i in range(50)]))
    got, links = classes(spark, docs)
    assert {got[i] for i in range(400)} == {0} and all(got[i] == i for i in range(400, 450))
    assert links.count() < 400 * omh.SKETCHES                           # all pairs would be 79,800


def test_alignment_keeps_order():
    a = np.arange(100, dtype=np.uint64)
    assert omh.aligned(a, a, 0.8) == 1.0
    assert omh.aligned(a, a[::-1].copy(), 0.8) == 0.0
    assert omh.aligned(a, np.delete(a, [3, 50]), 0.8) == 98 / 100
    assert omh.aligned(a, np.concatenate([a[50:], a[:50]]), 0.8) == 0.0     # the halves change places
    assert omh.aligned(a, a[:70], 0.8) == 0.0 and omh.aligned(a[:0], a[:0], 0.8) == 0.0


def test_odd_rows(spark, odd_docs, no_docs):
    members, _ = omh.near_duplicates(spark, odd_docs)
    got = [(r.id, r["class"]) for r in members.collect()]
    assert len(got) == odd_docs.count()
    assert {c for i, c in got if i in (1, 7, 8)} == {1} and {c for i, c in got if i in (5, 6)} == {5}
    assert all(c == i for i, c in got if i not in (1, 5, 6, 7, 8))
    kept = omh.keep_one(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 5, 9, 10, 11, 12)] + [(True, 0)] * 3
    assert omh.near_duplicates(spark, no_docs)[0].count() == 0 and omh.keep_one(spark, no_docs).count() == 0


def test_repeated_ids_with_other_texts(spark):
    docs = spark.createDataFrame([(5, "a b c d e f g h", 1), (5, "k l m n o p q r", 2), (6, "K L m n o p q r", 3), (6, "z z z", 4), (7, "s t u", 5), (7, "s t u", 6)],
                                 "doc_id long, text string, n_chars long")
    assert sorted(r.n_chars for r in omh.keep_one(spark, docs).collect())[:3] == [1, 2, 4]
    assert omh.keep_one(spark, docs).where("doc_id = 7").count() == 1


def test_pairs_within_a_family_that_shares_most_but_is_no_copy(spark):
    """Two near copies whose common sketches lie mostly in a passage that many texts hold."""
    rnd = random.Random(11)
    passage = [f"p{j}" for j in range(132)]
    docs, pairs = [], []
    for i in range(400):
        own = [f"u{i}x{j}" for j in range(32)]
        docs.append((len(docs), " ".join(passage + own)))
        if i < 200:
            pairs.append(len(docs) - 1)
            docs.append((len(docs), " ".join(passage + own[:15] + [f"v{i}x{j}" for j in range(17)])))
    for i in (0, 40, 399):                                              # links within the pairs, none between the texts of two
        a, b, c = (np.array([hash(t) for t in omh_shingles(docs[k][1])], np.int64).view(np.uint64) for k in (2 * min(i, 199), 2 * min(i, 199) + 1, -1))
        assert omh.aligned(a, b, 0.8) >= 0.8 and not omh.aligned(a, c, 0.8)
    got, links = classes(spark, docs)
    assert [i for i in pairs if got[i + 1] != i] == [] and len(set(got.values())) == 400
    assert all(r.b == r.a + 1 for r in links.collect())


def omh_shingles(text):
    w = text.split()
    return [tuple(w[k:k + omh.WORDS]) for k in range(len(w) - omh.WORDS + 1)]


def test_pairs_of_a_family_grow_with_its_size(spark):
    """Texts of one family, mostly just under the similarity: twice the texts, about
    twice the pairs a turn; the rare shingles of turn 0 add at most half of ``PAIRED`` an entry."""
    rnd = random.Random(13)
    base = [f"b{rnd.randrange(4000)}" for _ in range(150)]
    texts = family(rnd, base, 800, 3)
    counts = []
    for n in (200, 400, 800):
        docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts[:n])], "id long, class long, text string")
        entries = omh.prefix_entries(spark, docs, omh.SIMILARITY)
        none = spark.createDataFrame([], "id long, class long")
        counts.append([omh.prefix_pairs(entries, none, omh.SIMILARITY, turn, omh.PAIRED).count() for turn in (0, 1, 2)])
        assert counts[-1][0] <= entries.count() * omh.PAIRED / 2 and max(counts[-1][1:]) <= entries.count()
    for turn in (1, 2):
        assert all(b[turn] <= 2.2 * a[turn] for a, b in zip(counts, counts[1:])), counts


def slotted(rnd, n, copies, slots, kinds):
    """``n`` texts of ``slots`` passages, each one of ``kinds`` that many texts hold, so that no
    shingle is rare and no two are similar; ``copies`` more with the passage of one slot changed."""
    picks = [[rnd.randrange(kinds) for _ in range(slots)] for _ in range(n)]
    for p in picks[:copies]:
        k = rnd.randrange(slots)
        picks.append([*p[:k], (p[k] + 1) % kinds, *p[k + 1:]])
    return [" ".join(f"s{k}x{v}w{j}" for k, v in enumerate(p) for j in range(8)) for p in picks]


def test_links_of_nodes_that_no_leader_connects(spark):
    """Copies that share no rare shingle, in buckets and at shingles of many texts."""
    docs = list(enumerate(slotted(random.Random(17), 120, 30, 20, 2)))
    want = omh.brute_force(docs)
    assert [want[120 + i] for i in range(30)] == list(range(30)) and len(set(want.values())) == 120
    got, links = classes(spark, docs, sketches=4, paired=1)
    assert got == want and links.where("similarity < 0.8").isEmpty()


def test_keep_one_drops_copies_that_no_leader_connects(spark):
    docs = list(enumerate(slotted(random.Random(29), 100, 25, 20, 2)))
    want = omh.brute_force(docs)
    kept = omh.keep_one(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(4), sketches=4, paired=1)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) == list(range(100))


def test_blocks_hold_every_similar_pair_once(spark):
    rnd = random.Random(19)
    texts = slotted(rnd, 60, 20, 20, 2) + family(rnd, [f"b{rnd.randrange(4000)}" for _ in range(120)], 90, 3)
    texts[3] = texts[0]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "id long, text string")
    entries = omh.prefix_entries(spark, frame.withColumn("class", frame["id"]), omh.SIMILARITY)
    none = spark.createDataFrame([], "id long, class long")
    for size in (7, 1000):                                              # many blocks, and one a shingle
        placed, met = omh.blocks(spark, entries, none, omh.SIMILARITY, 1, size)
        assert placed.count() == placed.select("id").distinct().count()
        assert met.count() == met.distinct().count() and met.where("i > j").isEmpty()
        links = omh.block_links(spark, placed, met, frame, omh.SIMILARITY)
        assert links.where("a >= b or similarity < 0.8").isEmpty()
        got = {r.id: r["class"] for r in omh.components(spark, links).collect()}
        assert {i: got.get(i, i) for i, _ in docs} == omh.brute_force(docs)


def test_common_shingles_are_counted(monkeypatch):
    rnd = np.random.RandomState(23)
    x, y = ([rnd.choice(60, rnd.randint(0, 40), replace=False).astype(np.uint64) for _ in range(n)] for n in (9, 5))
    for columns in (1, 7, 4096):
        monkeypatch.setattr(omh, "COLUMNS", columns)
        assert omh._common(x, y).tolist() == [[len(set(a) & set(b)) for b in y] for a in x]
    assert omh._common([x[0][:0]], y[:1]).tolist() == [[0]]


def test_given_columns_with_clashing_names(spark):
    rows = [(1, "a b c d e f g", "x", "y", 1), (2, "a b c d e f g", "z", "w", 2), (3, "q r s t u v", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spindle_id string, spindle_words string, spindle_nth int")
    assert [tuple(r) for r in omh.keep_one(spark, docs).orderBy("doc_id").collect()] == [rows[0], rows[2]]


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """With many partitions and few rows, a table of known size has no file a partition."""
    files = []
    real = omh.written

    def counted(session, frame, name, rows=None):
        table, path = real(session, frame, name, rows)
        files.append((name, len(table.inputFiles())))
        return table, path
    monkeypatch.setattr(omh, "written", counted)
    rnd = random.Random(31)
    docs = list(enumerate(family(rnd, [f"b{rnd.randrange(4000)}" for _ in range(150)], 60, 3) + [" ".join(f"u{i}x{j}" for j in range(20)) for i in range(60) for _ in range(2)]))
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got, _ = classes(spark, docs)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == omh.brute_force(docs)
    many = {name for name, n in files if n > spark.sparkContext.defaultParallelism}
    assert {"nodes", "pairs", "joined", "labels"} <= {name for name, _ in files} and not many, files
