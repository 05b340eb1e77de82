import datetime as dt

from pyspark.sql import functions as F

from spindle.operators import text as textops
from spindle.sources import folders, tagged
from spindle.sources.delimited import flatten_records

# An invented record.
REC = """***
Type:status
Origin: my cat says "meow" #cat http://example.org/c
Text: my cat  says "meow"
on two lines
URL: http://example.org/c
ID: 4000000000000000001
Time: Mon Feb 06 10:15:30 CST 2012
RetCount: 2
Favorite: false
MentionedEntities: 11 22 11 
Hashtags:  cat pets
***"""


def test_tagged_records_file(spark, tmp):
    body = "\n".join([REC, REC.replace("4000000000000000001", "2").replace("RetCount: 2", "RetCount: 14"),
                      REC.replace("4000000000000000001", "3")]) + "\n"
    open(f"{tmp}/1427", "w").write(body)
    recs = tagged.read_tagged_records(spark, tmp)
    assert recs.count() == 3
    rows = {r["tweet_id"]: r for r in tagged.parse_tagged_records(recs).collect()}
    r = rows[4000000000000000001]
    assert r["type"] == "status" and r["text"] == 'my cat  says "meow"\non two lines'
    assert r["url"] == "http://example.org/c" and r["ret_count"] == 2 and r["favorite"] is False
    assert r["time"] == dt.datetime(2012, 2, 6, 16, 15, 30)   # CST = UTC-6
    assert r["mentioned"] == [11, 22, 11]
    assert r["hashtags"] == ["cat", "pets"]
    assert rows[2]["ret_count"] == 14


def test_render_parse_roundtrip(spark):
    df = spark.createDataFrame([("status", "o", "a\nb \"q\"", "", 5, dt.datetime(2011, 7, 1, 0, 5), 3, True, [1, 2], ["x"])],
                               "type string, origin string, text string, url string, tweet_id long, time timestamp, "
                               "ret_count int, favorite boolean, mentioned array<long>, hashtags array<string>")
    back = tagged.parse_tagged_records(tagged.render_tagged_records(df)).first()
    assert back["text"] == "a\nb \"q\"" and back["tweet_id"] == 5 and back["mentioned"] == [1, 2]
    assert back["time"] == dt.datetime(2011, 7, 1, 0, 5) and back["hashtags"] == ["x"]


def test_tweet_csv_quoting(spark):
    df = spark.createDataFrame([(7, dt.datetime(2011, 7, 19, 8, 33, 6), 'he said "x", ok')],
                               "tweet_id long, time timestamp, text string")
    line = tagged.tweet_csv_line(df).first()["line"]
    assert line == '7,"Tue Jul 19 08:33:06 UTC 2011","he said ""x"", ok"'


def test_flatten_records(spark):
    df = spark.createDataFrame([("***\nType:status\nID: 1\n***",)], "value string")
    assert flatten_records(df).first()[0] == "Type:status,,ID: 1"


def test_merge_lines_edge_cases(spark):
    cases = {"a\nb": "a,b,", "a\nb\n": "a,b,", "": "", "\n": ",", "a\n\nb": "a,,b,", "a\r\nb\rc": "a,b,c,"}
    df = spark.createDataFrame([(k,) for k in cases], "content string")
    got = {r["content"]: r["merged"] for r in folders.merge_lines(df).collect()}
    assert got == cases


def test_read_files_recursive(spark, tmp):
    import os
    os.makedirs(f"{tmp}/a/b")
    open(f"{tmp}/a/one.txt", "w").write("x\ny\n")
    open(f"{tmp}/a/b/two.txt", "w").write("z")
    got = sorted(r["merged"] for r in folders.merge_lines(folders.read_files(spark, f"{tmp}/a")).collect())
    assert got == ["x,y,", "z,"]


def test_sentiment_both_ways(spark):
    """Whole and fractional scores, a NULL text, repeated ids: one row per row, the same by broadcast and by shuffle."""
    docs = spark.createDataFrame([(1, "good bad good"), (2, "nothing here"), (3, ""), (4, "Good  good"), (1, "good"), (5, None)], "doc_id long, text string")
    lex = spark.createDataFrame([("good", 2), ("bad", -3), (None, 7), ("here", None)], "term string, score int")
    for size in (textops.BROADCAST_BYTES, 0):
        got = sorted(tuple(r) for r in textops.sentiment_score(docs, lex, broadcast_bytes=size).collect())
        assert got == [(1, 1), (1, 2), (2, 0), (3, 0), (4, 2), (5, 0)]
        half = spark.createDataFrame([("good", 1.5), ("bad", -1.0)], "term string, score double")
        got = sorted(tuple(r) for r in textops.sentiment_score(docs, half, broadcast_bytes=size).collect())
        assert got == [(1, 1.5), (1, 2.0), (2, 0.0), (3, 0.0), (4, 1.5), (5, 0.0)]
        none = lex.limit(0)
        assert {r["score"] for r in textops.sentiment_score(docs, none, broadcast_bytes=size).collect()} == {0}


def test_large_lexicon(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{(i * 37 + j) % 3000}" for j in range(50))) for i in range(40)], "doc_id long, text string")
    lex = spark.createDataFrame([(f"t{k}", k % 11 - 5) for k in range(2500)], "term string, score int")
    want = {i: sum(k % 11 - 5 for k in ((i * 37 + j) % 3000 for j in range(50)) if k < 2500) for i in range(40)}
    for size in (textops.BROADCAST_BYTES, 0):
        assert {r["doc_id"]: r["score"] for r in textops.sentiment_score(docs, lex, broadcast_bytes=size).collect()} == want


def test_sentiment_job_from_files(spark, tmp):
    rows = [(1, dt.datetime(2011, 1, 1, 0, 0), "old bad"), (1, dt.datetime(2011, 1, 2, 0, 0), 'new "good",\ngood'), (2, dt.datetime(2011, 1, 1, 0, 0), "bad;"), (None, dt.datetime(2011, 1, 1, 0, 0), "good")]
    df = spark.createDataFrame(rows, "tweet_id long, time timestamp_ntz, text string")
    tagged.write_tweet_csv(df, f"{tmp}/t")
    tweets = tagged.read_tweet_csv(spark, f"{tmp}/t")
    assert tweets.where("_corrupt IS NOT NULL").count() == 1
    lex = spark.createDataFrame([("bad", -3), ("bad;", 1), ('"good",\ngood', 5)], "term string, score int")
    got = textops.sentiment_job(tweets, lex)
    assert {tuple(r) for r in got.collect()} == {(1, 'new "good",\ngood', 5), (2, "bad;", 1)}
    assert "2;bad;\t->\t1" in {r["value"] for r in textops.scored_line(got).collect()}


def test_tag_lines_within_a_text(spark):
    text = "hello\nURL: fake\nID: 9\n***\n***\n\\***\nmore"
    df = spark.createDataFrame([("status", "o", text, "u", 5, dt.datetime(2011, 7, 1, 0, 5), 3, True, [1], ["x"])],
                               "type string, origin string, text string, url string, tweet_id long, time timestamp_ntz, ret_count int, favorite boolean, mentioned array<long>, hashtags array<string>")
    r = tagged.parse_tagged_records(tagged.render_tagged_records(df)).first()
    assert (r["text"], r["url"], r["tweet_id"], r["_corrupt"]) == (text, "u", 5, None)


def test_bad_records_are_flagged(spark):
    bad = [REC.replace("ID: 4000000000000000001", "ID: x9"), REC.replace("11 22 11", "11 bob"), REC.replace("ID: 4000000000000000001", "ID: "), "***\nType:status\n***", ""]
    rows = tagged.parse_tagged_records(spark.createDataFrame([(x,) for x in [REC, *bad]], "value string")).collect()
    assert len(rows) == 5 and sorted(r["_corrupt"] for r in rows if r["_corrupt"]) == sorted(bad[:4])


def test_lexicon_later_duplicate_wins(spark):
    docs = spark.createDataFrame([(1, "w")], "doc_id long, text string")
    lex = spark.createDataFrame([("w", 1, 0), ("w", 4, 1)], "term string, score int, line long")
    assert textops.sentiment_score(docs, lex, order="line").first()["score"] == 4


def test_dedup_last(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 30, "b"), (1, 20, "c"), (2, 5, "d")], "k long, ts long, v string")
    got = sorted(tuple(r) for r in textops.dedup_last(df, "k", ["ts"]).collect())
    assert got == [(1, 30, "b"), (2, 5, "d")]


def test_dedup_plan_has_partial_aggregate(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = textops.dedup_last(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_sentiment_phrases(spark):
    docs = spark.createDataFrame([(1, "this does not work at all"), (2, "not"), (3, "")], "doc_id long, text string")
    lex = spark.createDataFrame([("not", -1), ("does not work", -3), ("at all", 1)], "term string, score int")
    for size in (textops.BROADCAST_BYTES, 0):
        got = sorted(tuple(r) for r in textops.sentiment_score(docs, lex, ngrams=3, broadcast_bytes=size).collect())
        assert got == [(1, -3), (2, -1), (3, 0)]
        one = sorted(tuple(r) for r in textops.sentiment_score(docs, lex, broadcast_bytes=size).collect())
        assert one == [(1, -1), (2, -1), (3, 0)]


def test_record_time_ignores_session_zone(spark):
    df = spark.createDataFrame([(REC,)], "value string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = tagged.parse_tagged_records(df).first()
        assert r["time"] == dt.datetime(2012, 2, 6, 16, 15, 30)
        line = tagged.tweet_csv_line(tagged.parse_tagged_records(df)).first()["line"]
        assert '"Mon Feb 06 16:15:30 UTC 2012"' in line
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_phrases_of_a_long_text_split_it_once(spark):
    words = [f"w{i % 700}" for i in range(30_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "w1"), (3, ""), (4, None)], "doc_id int, text string")
    lex = spark.createDataFrame([("w1 w2", 1), ("w699 w0 w1", 10), ("w5", 100), ("w1", 1000)], "term string, score int")
    scored = textops.sentiment_score(docs, lex, ngrams=3)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("split(text") == 1
    joined = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    want = sum({"w1 w2": 1, "w699 w0 w1": 10, "w5": 100, "w1": 1000}.get(g, 0) for g in joined)
    assert sorted(tuple(r) for r in scored.collect()) == [(1, want), (2, 1000), (3, 0), (4, 0)]
