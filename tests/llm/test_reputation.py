from spindle.llm import reputation as rep


def test_rules_and_parsing(spark):
    urls = ["http://www.Example.com/en/x?y=/", "https://a.example.com/en/x", "http://example.com/de/", "http://notexample.com/en/", "http://x.net/es/1#top", "x.net/es/", None,
            "http://b.net", "http://b.net/fr", "http://b.net/fr/", "http://u@h.org:80/p", "://?q", "http://c.co.uk/a", "http://com/en/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in rep.judge(spark, pages, labels).collect()}
    assert [got[i].rule for i in range(len(urls))] == ["www.example.com/en/", "example.com/en/", "com/", "com/", "net/es/", None, None, None, None, "net/fr/", None, None, None, "com/"]
    assert [got[i].verdict for i in range(len(urls))] == ["allow", "block", "allow", "allow", "block", "allow", "allow", "allow", "allow", "block", "allow", "allow", "allow", "allow"]
    assert (got[0].host, got[0].path) == ("www.example.com", "/en/x") and (got[6].host, got[6].path) == ("", "") and (got[10].host, got[10].path) == ("u@h.org:80", "/p")
    d = {r.page_id: (r.suffix, r.domain) for r in rep.parsed(pages).collect()}
    assert d[12] == ("co.uk", "c.co.uk") and d[10] == ("org", "h.org") and d[1] == ("com", "example.com")


def test_shrinkage(spark):
    """A host with many bad pages is blocked, one with a single bad page is not; unlabelled hosts follow their domain."""
    pages, labels, n = [], [], 0
    for host, good, bad, unknown in [("bad.spam.org", 2, 60, 5), ("new.spam.org", 0, 0, 3), ("one.fine.org", 0, 1, 2), ("big.fine.org", 80, 4, 0), ("x.fine.org", 40, 2, 0), ("y.spam.org", 1, 50, 0),
                                     ("z.spam.org", 0, 70, 0), ("w.else.org", 60, 1, 1)]:
        for k in range(good + bad + unknown):
            pages.append((n, f"http://{host}/en/{n}.html"))
            if k < good + bad:
                labels.append((n, int(k < good) if k % 2 else 1 if k < good else 0, 0))
            n += 1
    got = {}
    for r in rep.judge(spark, spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect():
        got.setdefault(r.host, set()).add((r.verdict, round(r.bad_share_bound, 9)))
    assert all(len(v) == 1 for v in got.values())
    verdict = {h: next(iter(v))[0] for h, v in got.items()}
    assert verdict["bad.spam.org"] == verdict["z.spam.org"] == "block" and verdict["one.fine.org"] == verdict["big.fine.org"] == "allow"
    bound = {h: next(iter(v))[1] for h, v in got.items()}
    assert bound["new.spam.org"] > bound["big.fine.org"] and bound["one.fine.org"] < 0.5


def test_outcomes_of_odd_labels(spark):
    pages = spark.createDataFrame([(1, "http://h.org/1"), (2, "http://h.org/2"), (3, "http://h.org/x"), (4, "http://h.org/1"), (5, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, None, 1), (1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    (row,) = [r for r in rep.outcomes(pages, labels).collect() if r.host]
    assert (row.n, row.bad) == (2, 2)
    empty = pages.limit(0)
    assert rep.judge(spark, empty, labels).count() == 0


def test_no_python_on_the_path(spark):
    from spindle.llm import queries
    plan = queries.op7_host_reputation(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
