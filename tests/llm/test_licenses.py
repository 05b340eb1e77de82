import random

from spindle.llm import licenses as lic


def test_against_brute_force(spark):
    rnd = random.Random(4)
    docs = []
    for i in range(150):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            words = rnd.choice(list(lic.TEMPLATES.values())).split()
            rnd.shuffle(words) if rnd.random() < 0.3 else None
            words = [w for w in words if rnd.random() < 0.93] + rnd.choices(["foo", "the", "License,", "MIT"], k=rnd.randint(0, 4))
            lines.append(" ".join(words))
        docs.append((i, rnd.choice(["\n", "\n\n", " "]).join(lines)))
    got = {r.row_key: r for r in lic.scan(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    for i, t in docs:
        n, places, base, labels = lic.brute_force(t)
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels, r.labels) == (n, len(places), ",".join(base), ",".join(labels))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)
        for b in r.blocks:
            block = set(lic.at.text_words(t.split("\n")[b.line]))
            v = set(lic.at.text_words(lic.TEMPLATES[b.label]))
            assert abs(len(block & v) / len(v) - b.containment) < 1e-12 and b.containment >= lic.THRESHOLD
    assert len({r.labels for r in got.values()}) > 5


def test_odd_rows(spark, odd_docs, no_docs):
    got = lic.scan(spark, odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.score == 0 and r.labels == "" and r.first_word is None for r in got)
    assert lic.scan(spark, no_docs).count() == 0
    assert all(r.labels == "" for r in lic.scan(spark, odd_docs, templates={}).collect())


def test_word_counts_cover_all_blocks(spark):
    docs = spark.createDataFrame([(1, "mit mit\nmit x\ny"), (2, "MIT"), (3, None)], "doc_id long, text string").repartition(3)
    assert lic.template_word_counts(spark, docs, "text", {"a": "mit y"}) == {"mit": 3, "y": 1}
