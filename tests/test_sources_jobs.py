"""Numbered lines, records between asterisks, ARFF of other writers, named files."""
import pytest
from pyspark.sql import functions as F

from spindle.sources import arff, delimited, named, numbered, records, tagged


@pytest.fixture()
def small_splits(spark):
    """Files are read in many splits."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, name, data):
    with open(f"{path}/{name}", "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())


def test_line_numbers_over_splits(spark, tmp, small_splits):
    small_splits(97)
    want = set()
    for name, n, end in (("a.txt", 300, "\n"), ("b.txt", 41, "\r\n"), ("c.txt", 1, "\n"), ("d.txt", 0, "")):
        lines = [f"{name} {i} {'x' * (i * 7 % 50)}" for i in range(n)]
        write(tmp, name, end.join(lines) + (end if n != 41 else ""))
        want |= {(name, i, v) for i, v in enumerate(lines)}
    got = numbered.read_numbered_lines(spark, tmp)
    assert spark.read.text(tmp).rdd.getNumPartitions() > 20
    assert {(r.file.rsplit("/", 1)[1], r.line, r.value) for r in got.collect()} == want


def test_line_records_and_a_bad_last_one(spark, tmp, small_splits):
    small_splits(120)
    def rec(i):
        return ["***", "Type:status", "Origin: o", f"Text: text {i}, with more", "URL: ", f"ID: {i}", f"Time: t{i}", "RetCount: 1", "Favorite: true", "MentionedEntities: ", "Hashtags: ", "***"]
    lines = [x for i in range(25) for x in rec(i)] + rec(99)[:7]
    write(tmp, "r.txt", "\n".join(lines) + "\n")
    write(tmp, "s.txt", "\n".join([*rec(100), *[x.replace("ID: 7", "ID: seven") for x in rec(7)]]))
    got = numbered.time_and_text(numbered.read_line_records(spark, tmp)).collect()
    good = {r.tweet_id: r for r in got if r._corrupt is None}
    assert set(good) == {*range(25), 100} and good[3].line == "t3,text 3, with more" and good[3].text == "text 3, with more"
    bad = sorted(r._corrupt.split("\n")[5] for r in got if r._corrupt is not None)
    assert bad == ["ID: 99", "ID: seven"] and all(r.tweet_id is None and r.line is None for r in got if r._corrupt is not None)
    assert numbered.read_line_records(spark, tmp, 5).where("_corrupt IS NULL").count() == (25 * 12 + 7) // 5 + 24 // 5


@pytest.mark.parametrize("split", [16, 61, 1 << 20])
def test_records_single_double_and_crlf(spark, tmp, small_splits, split):
    small_splits(split)
    bodies = ["A\nsecond line", "B", "text with\n***stars at a line's start\n***\\ and more\n****\nend", "C\n\\***\nescaped", "D  \nlast"]
    write(tmp, "single.txt", "***\n" + "\n***\n".join(bodies) + "\n***\n")
    write(tmp, "double.txt", "***\n" + "\n***\n***\n".join(bodies) + "\n***")
    write(tmp, "crlf.txt", ("***\n" + "\n***\n".join(bodies) + "\n***\n***\n").replace("\n", "\r\n"))
    write(tmp, "bare.txt", "\n***\n".join(bodies))
    got = records.read_records(spark, tmp).orderBy("file", "record").collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
    assert by_file == {f"{f}.txt": bodies for f in ("single", "double", "crlf", "bare")}


def test_records_without_text(spark, tmp):
    write(tmp, "a.txt", "***\n***\n***\n\n***\n")
    write(tmp, "b.txt", "")
    assert records.read_records(spark, tmp).count() == 0


def test_two_records_parted_by_one_line(spark, tmp):
    rec = "Type:status\nOrigin: o\nText: one\ntwo\nURL: \nID: {}\nTime: Fri Jul 01 00:00:00 UTC 2011\nRetCount: 1\nFavorite: true\nMentionedEntities: 5 \nHashtags:  x"
    write(tmp, "a.txt", ("***\n" + rec.format(1) + "\n***\n" + rec.format(2) + "\n***\n").replace("\n", "\r\n"))
    got = tagged.parse_tagged_records(tagged.read_tagged_records(spark, tmp)).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.text, r._corrupt) for r in got] == [(1, "one\ntwo", None), (2, "one\ntwo", None)]
    flat = delimited.flatten_records(tagged.read_tagged_records(spark, tmp)).collect()
    assert sorted(r.value for r in flat)[0].startswith("Type:status,,Origin: o,,Text: one,,two,,URL: ,,ID: 1,,")


def arff_file(tmp, head, rows):
    write(tmp, "x.arff", "\n".join(["% comment", "@relation 'a b'", *head, "@DATA", *rows]) + "\n")
    return f"{tmp}/x.arff"


HEAD = ["@attribute a numeric", "@ATTRIBUTE 'b c' STRING", "@attribute d { x, 'y z', \"w,v\" }", "@attribute e date \"yyyy-MM-dd\"", "@attribute f integer"]


def test_arff_of_other_writers(spark, tmp):
    rows = ["1.5,\"x, y\",x,\"2011-01-02\",7", "  2 ,\t'it\\'s\\n' , 'y z' , 2012-02-03 ,\t8 ", "{0 5, 1 z, 3 '2011-01-02'}", "{2 \"w,v\",4 -1}", "{}", "?,?,?,?,?", "% a comment", "", "3,,'w,v',?,9"]
    got = [tuple(r) for r in arff.read_arff(spark, arff_file(tmp, HEAD, rows), corrupt="_corrupt").collect()]
    import datetime as dt
    zero = dt.datetime(1970, 1, 1)
    assert got == [(1.5, "x, y", "x", dt.datetime(2011, 1, 2), 7, None), (2.0, "it's\n", "y z", dt.datetime(2012, 2, 3), 8, None), (5.0, "z", "x", dt.datetime(2011, 1, 2), 0, None),
                   (0.0, "", "w,v", zero, -1, None), (0.0, "", "x", zero, 0, None), (None,) * 6, (3.0, None, "w,v", None, 9, None)]


def test_arff_rows_that_break_the_header(spark, tmp):
    bad = ["1,b,x,2011-01-02", "1,b,x,2011-01-02,7,8", "1,b,unknown,2011-01-02,7", "one,b,x,2011-01-02,7", "1,b,x,02.01.2011,7", "1,'b'c,x,2011-01-02,7", "{0 1, 0 2}", "{9 1}", "{a b}", "{0 1,}", "1,'b,x,2011-01-02,7", "1,b,x,2011-01-02,7.5"]
    frame = arff.read_arff(spark, arff_file(tmp, HEAD, bad), corrupt="_corrupt")
    assert [r._corrupt for r in frame.collect()] == bad and frame.where("a IS NOT NULL OR f IS NOT NULL").count() == 0
    loose = arff.read_arff(spark, f"{tmp}/x.arff")
    assert loose.columns == ["a", "b c", "d", "e", "f"] and loose.count() == len(bad)


def test_inferred_domains(spark, tmp):
    rows = [(i, f"v{i % 3}'s", f"id {i}", None, "only" if i else None) for i in range(500)]
    df = spark.createDataFrame(rows, "n int, few string, many string, none string, one string")
    assert arff.infer_domains(df) == {"few": ["v0's", "v1's", "v2's"], "one": ["only"]}
    assert arff.infer_domains(df, max_domain=2) == {"one": ["only"]} and "many" in arff.infer_domains(df, max_domain=500)
    head = arff.arff_header(df, nominal="infer")
    assert "@attribute few {'v0\\'s','v1\\'s','v2\\'s'}" in head and "@attribute many string" in head and "@attribute none string" in head
    with pytest.raises(ValueError):
        arff.arff_header(df, nominal=["many"])
    arff.write_arff(df, f"{tmp}/d", nominal="infer")
    back = arff.read_arff(spark, f"{tmp}/d", corrupt="_c")
    assert back.where("_c IS NOT NULL").count() == 0 and back.select("few").distinct().count() == 3
    arff.write_arff(df, f"{tmp}/s", sparse=True)
    assert sorted(map(tuple, arff.read_arff(spark, f"{tmp}/s", schema=df.schema).collect()), key=str) == sorted(rows, key=str)


def test_named_files(spark, tmp):
    rows = [("a/b c+*%=é", 2, "two"), ("a/b c+*%=é", 1, "one"), (None, 1, "null"), ("", 1, "empty"), ("x.y-z_1", 3, "lé"), ("x.y-z_1", 1, "k")]
    df = spark.createDataFrame(rows, "key string, n int, value string").repartition(3)
    assert named.write_named_files(df, f"{tmp}/out", "key", ["n"]) == 4
    import os
    assert sorted(f for f in os.listdir(f"{tmp}/out") if not f.startswith(".")) == sorted(["=00.txt", "f.txt", "fx.y-z_1.txt", "fa=2Fb=20c=2B=2A=25=3D=C3=A9.txt"])
    got = sorted(((r.key, r.line, r.value) for r in named.read_named_files(spark, f"{tmp}/out").collect()), key=str)
    assert got == sorted([("a/b c+*%=é", 0, "one"), ("a/b c+*%=é", 1, "two"), (None, 0, "null"), ("", 0, "empty"), ("x.y-z_1", 0, "k"), ("x.y-z_1", 1, "lé")], key=str)
    # again: files are replaced; a staging folder that never committed leaves nothing, one that did is finished
    assert named.write_named_files(df.where("key = ''").withColumn("value", F.lit("new")), f"{tmp}/out", "key", ["n"]) == 1
    os.makedirs(f"{tmp}/out/.staged-lost/spindle_file=fz")
    write(f"{tmp}/out/.staged-lost/spindle_file=fz", "part-0.txt", "half")
    os.makedirs(f"{tmp}/out/.staged-done/spindle_file=fw")
    write(f"{tmp}/out/.staged-done/spindle_file=fw", "part-0.txt", "whole\n")
    write(f"{tmp}/out/.staged-done", "_SUCCESS", "")
    assert named.finish(spark, f"{tmp}/out") == 1
    left = {r.key: r.value for r in named.read_named_files(spark, f"{tmp}/out").where("line = 0").collect()}
    assert left[""] == "new" and left["w"] == "whole" and "z" not in left
    assert not [f for f in os.listdir(f"{tmp}/out") if f.startswith(".staged")]
