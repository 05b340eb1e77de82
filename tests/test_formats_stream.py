import time

from spindle.sources import arff, delimited


def test_arff_roundtrip_types_and_quoting(spark, tmp):
    df = spark.createDataFrame([(1, "a b", 2.5, "x"), (2, "it's, ok", None, "y"), (3, None, -1.0, "x")],
                               "id long, name string, v double, cat string")
    arff.write_arff(df, f"{tmp}/a", relation="t", nominal=["cat"])
    head = open([p for p in __import__("glob").glob(f"{tmp}/a/header/part-*")][0]).read()
    assert "@attribute cat {'x','y'}" in head and "@attribute v real" in head and "@attribute id integer" in head
    back = arff.read_arff(spark, f"{tmp}/a")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == sorted(map(tuple, df.collect()), key=lambda r: r[0])


def test_read_single_arff_file(spark, tmp):
    p = f"{tmp}/w.arff"
    open(p, "w").write("% comment\n@relation w\n\n@attribute a numeric\n@attribute 'b c' {u,v}\n\n@data\n1.5,u\n?,v\n")
    got = sorted(((r["a"], r["b c"]) for r in arff.read_arff(spark, p).collect()), key=lambda r: r[1])
    assert got == [(1.5, "u"), (None, "v")]


def test_arff_odd_texts(spark, tmp):
    from decimal import Decimal
    texts = ["x\ny", "?", "@bob", "%z", "a\\nb", "\\", "it's", "", " lead", "c,d", "\r\n", "nul\0end", "{", None, "?,'"]
    df = spark.createDataFrame([(i, t, Decimal("12345678901234567.123456789"), None if i % 2 else i / 3) for i, t in enumerate(texts)],
                               "id int, `a b` string, d decimal(30,9), x double")
    arff.write_arff(df, f"{tmp}/a")
    back = arff.read_arff(spark, f"{tmp}/a", schema=df.schema)
    assert sorted(back.collect(), key=lambda r: r["id"]) == sorted(df.collect(), key=lambda r: r["id"])


def test_arff_rows_that_look_like_a_header(spark, tmp):
    p = f"{tmp}/w.arff"
    open(p, "w").write("% c\n@relation w\n@attribute a string\n@attribute n integer\n@DATA\n@bob,1\n% comment\n\n'%q',2\nx ,?\n")
    got = {(r["a"], r["n"]) for r in arff.read_arff(spark, p).collect()}
    assert got == {("@bob", 1), ("%q", 2), ("x", None)}


def test_csv_texts(spark, tmp):
    df = spark.createDataFrame([(1, "a\nb \"q\", c "), (2, " lead"), (3, "plain")], "id int, s string")
    arff.write_csv(df, f"{tmp}/c")
    assert sorted(arff.read_csv_inferred(spark, f"{tmp}/c").collect()) == sorted(df.collect())


def test_book_rows_values_and_separators(spark, tmp):
    lines = ["7|A|x|x|T|P|1999|Z", "8|A|x|x|T|P|bad|Z", "short|row", "u|A|x|x|T|P|1999|Z"]
    delimited.write_values(spark.createDataFrame([(x,) for x in lines], "value string"), f"{tmp}/b")
    rows = delimited.read_book_rows(spark, f"{tmp}/b").collect()
    assert sorted(r["_corrupt"] for r in rows if r["_corrupt"]) == ["short|row", "u|A|x|x|T|P|1999|Z"]
    assert {(r["user_id"], r["year"]) for r in rows if not r["_corrupt"]} == {(7.0, 1999), (8.0, 0)}
    delimited.write_separated(spark.createDataFrame([("a", 1)], "k string, v int"), f"{tmp}/s", ";")
    assert spark.read.text(f"{tmp}/s").first()[0] == "a;1"


def test_lexicon_across_files(spark, tmp):
    import os
    os.makedirs(f"{tmp}/lex")
    open(f"{tmp}/lex/a.txt", "w").write("w\t1\n" + "".join(f"pad{i}\t0\n" for i in range(500)))
    open(f"{tmp}/lex/b.txt", "w").write("w\t9\nbroken\n\t3\n")
    lex = delimited.read_lexicon(spark, f"{tmp}/lex")
    assert sorted(r["_corrupt"] for r in lex.where("_corrupt IS NOT NULL").collect()) == ["\t3", "broken"]
    from spindle.operators.text import sentiment_score
    docs = spark.createDataFrame([(1, "w broken")], "doc_id long, text string")
    assert sentiment_score(docs, lex, order="line").first()["score"] == 9


def test_csv_arff_conversions(spark, tmp):
    df = spark.createDataFrame([(1, "p q", 0.25)], "id int, s string, x double")
    arff.write_csv(df, f"{tmp}/c")
    arff.csv_to_arff(spark, f"{tmp}/c", f"{tmp}/a")
    arff.arff_to_csv(spark, f"{tmp}/a", f"{tmp}/c2")
    assert arff.read_csv_inferred(spark, f"{tmp}/c2").collect()[0].asDict() == {"id": 1, "s": "p q", "x": 0.25}


def test_points_centroids_lexicon_readers(spark, tmp):
    open(f"{tmp}/pts.txt", "w").write("u1\t3\nu2 5\nbad\tx\n")
    pts = delimited.read_points(spark, f"{tmp}/pts.txt").collect()
    assert [(r["id"], r["x"]) for r in pts if r["_corrupt"] is None] == [("u1", 3.0), ("u2", 5.0)]
    import os
    os.makedirs(f"{tmp}/cent")
    open(f"{tmp}/cent/part-r-00000", "w").write("10.0\t4\n20.5\t1\n")
    assert delimited.read_centroids(spark, f"{tmp}/cent") == [10.0, 20.5]
    open(f"{tmp}/lex.txt", "w").write("good\t3\nbad\t-2\ngood\t1\n")
    lex = delimited.read_lexicon(spark, f"{tmp}/lex.txt")
    from spindle.operators.text import sentiment_score
    docs = spark.createDataFrame([(1, "good bad")], "doc_id long, text string")
    assert sentiment_score(docs, lex, order="line").first()["score"] == -1


def test_follower_count_stream(spark, tmp):
    from spindle.streaming.follower_stream import follower_count_stream
    import os
    os.makedirs(f"{tmp}/in")
    open(f"{tmp}/in/a.txt", "w").write("1,2\n3,2\n")
    q = follower_count_stream(spark, f"{tmp}/in", name="fc_test", checkpoint=f"{tmp}/ck")
    try:
        q.processAllAvailable()
        open(f"{tmp}/in/b.txt", "w").write("4,2\n4,5\n")
        time.sleep(1)
        q.processAllAvailable()
        got = {r["dst"]: r["cnt"] for r in spark.sql("SELECT * FROM fc_test").collect()}
    finally:
        q.stop()
    assert got == {"2": 3, "5": 1}


def test_write_per_file(spark, tmp):
    df = spark.createDataFrame([("a", "x,y,"), ("b", "z,")], "file string, value string")
    delimited.write_per_file(df, f"{tmp}/out")
    back = spark.read.text(f"{tmp}/out")
    assert sorted((r["file"], r["value"]) for r in back.collect()) == [("a", "x,y,"), ("b", "z,")]
