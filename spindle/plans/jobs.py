"""Registered queries of whole jobs: files written and read back by the
library's own sources and sinks, resampling, and loops over files. They join
the queries of ``registry``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import cluster, counting, graph
from ..operators import distinct_neighbors as dn
from ..operators import neighbors as nb
from ..operators import resample
from ..operators import text as textops
from ..session import drop_scratch, scratch_path, stored
from ..sources import arff, delimited, folders, named, numbered, tagged
from . import workloads as W
from .loops import cut
from .registry import (KMEANS_K, KNN_K, LEXICON, ORACLES, _BAND, _BOOKS_CTE, _DIST_SQL, _GRAPH_SQL, _KNN_CTE, _LARGE_LEX_SQL, _LARGE_SCORE_SQL, _NODES_SQL, _SSSP_SQL, _TWEETS_SQL,
                       _counts, _kmeans_chain_sql, _large_lexicon, _points, _tweets, register, sssp_source)

# ---------------------------------------------------------------- records of N lines

_ONE_LINE = r"regexp_replace(text, '[\n\r]', ' ', 'g')"


@register("line_records", f"""
SELECT tweet_id, strftime(time, '%a %b %d %H:%M:%S UTC %Y') AS time, {_ONE_LINE} AS text,
       strftime(time, '%a %b %d %H:%M:%S UTC %Y') || ',' || {_ONE_LINE} AS line FROM ({_TWEETS_SQL})""")
def q_line_records(spark, sf):
    """Documents rendered as records of twelve lines, read back by counting lines over the splits of each file."""
    path = scratch_path(spark, "line-records")
    flat = _tweets(spark, sf).withColumn("text", F.regexp_replace("text", r"[\n\r]", " "))
    tagged.render_tagged_records(flat).write.text(path)
    records = cut(numbered.time_and_text(numbered.read_line_records(spark, path)))
    drop_scratch(spark, path)
    return records.where("_corrupt IS NULL").select("tweet_id", "time", "text", "line")


# ---------------------------------------------------------------- resampling

SCHEME_SEED = 11


def _u(name: str, counter: str) -> str:
    return f"(('0x' || substr(md5('{SCHEME_SEED}:{name}:' || row_key || ':' || CAST({counter} AS VARCHAR)), 1, 15))::BIGINT % (1::BIGINT << 48) + 0.5) / (1::BIGINT << 48)"


def _normal(name: str) -> str:
    return f"sqrt(-2 * ln({_u(name, '0')})) * cos(2 * 3.141592653589793 * {_u(name, '1')})"


def _binomial(n: str, p: str, q: str, z: str) -> str:
    return f"greatest(0, least({n}, floor({n} * {p} + {z} * sqrt({n} * {p} * {q}) + 0.5)))::BIGINT"


@register("bootstrap_scheme", f"""
WITH {_BOOKS_CTE},
r AS (SELECT row_key, location, count(*) OVER (PARTITION BY location) AS n, row_number() OVER (PARTITION BY location ORDER BY row_key) AS i FROM t),
d AS (SELECT row_key, location, n, n - i + 1 AS d FROM r),
h AS (SELECT *, {_binomial('d', '0.2', '0.8', _normal('hits'))} AS h FROM d),
m AS MATERIALIZED (SELECT row_key, location, n, CASE WHEN d <= {resample.EXACT} THEN
        list_sum(list_transform(range(1, d + 1), lambda j: CASE ('0x' || substr(md5('{SCHEME_SEED}:draw:' || row_key || ':' || CAST(j AS VARCHAR)), 1, 15))::BIGINT % 10 WHEN 4 THEN 2 WHEN 8 THEN 4 ELSE 0 END))
      ELSE 4 * h - 2 * {_binomial('h', '0.5', '0.5', _normal('twos'))} END AS m FROM h),
k AS (SELECT row_key, location, n, j AS copy, sum(-ln({_u('key', 'j')}) / (m - j + 1)) OVER (PARTITION BY row_key ORDER BY j) AS e
      FROM m, range(1, 49) x(j) WHERE j <= m)
SELECT row_key, location, copy FROM k QUALIFY row_number() OVER (PARTITION BY location ORDER BY 1 - exp(-e), row_key, copy) <= n""")
def q_bootstrap_scheme(spark, sf):
    """The training rows as the reference draws them, each nation's rows being one split."""
    rows = W.book_training(spark, sf).select("row_key", "location")
    return resample.scheme_sample(rows, "row_key", "location", seed=SCHEME_SEED).select("row_key", "location", "copy")


# ---------------------------------------------------------------- K distinct distances

DISTINCT_K = 5
_DISTINCT_CTE = (f"{_BOOKS_CTE}, c AS (SELECT q.row_key, q.title, t.row_key AS t_row_key, {_DIST_SQL} AS distance "
                 f"FROM q JOIN t ON t.user_id BETWEEN q.user_id - {_BAND} AND q.user_id + {_BAND}), "
                 f"dd AS (SELECT row_key, title, distance, max(t_row_key) AS t_row_key FROM c GROUP BY ALL), "
                 f"knn AS (SELECT row_key, title, CAST(row_number() OVER (PARTITION BY row_key ORDER BY distance) AS INT) AS rank, t_row_key, distance "
                 f"FROM dd QUALIFY rank <= {DISTINCT_K})")


@register("knn_distinct", f"WITH {_DISTINCT_CTE} SELECT row_key, rank, t_row_key, distance FROM knn")
def q_knn_distinct(spark, sf):
    q, t = W.book_split(spark, sf)
    return dn.knn_distinct(q, t, k=DISTINCT_K)


@register("knn_distinct_by_title", f"""
WITH {_DISTINCT_CTE}, bt AS (SELECT title, distance, max(t_row_key) AS t_row_key FROM knn GROUP BY ALL)
SELECT title, CAST(row_number() OVER (PARTITION BY title ORDER BY distance) AS INT) AS rank, t_row_key, distance FROM bt QUALIFY rank <= {DISTINCT_K}""")
def q_knn_distinct_by_title(spark, sf):
    q, t = W.book_split(spark, sf)
    return dn.distinct_by_title(dn.knn_distinct(q, t, k=DISTINCT_K, q_carry=["title"]), q, k=DISTINCT_K)


# ---------------------------------------------------------------- records between lines of asterisks

_ESCAPED = r"regexp_replace(text, '(?m)^(\\*\*\*\*)$', '\\\1', 'g')"


_FLAT = " || ',,' || ".join(["'Type:status'", "'Origin: ' || origin", f"'Text: ' || replace({_ESCAPED}, chr(10), ',,')", "'URL: '", "'ID: ' || tweet_id", "'Time: ' || strftime(time, '%a %b %d %H:%M:%S UTC %Y')",
                             "'RetCount: ' || ret_count", "'Favorite: ' || favorite", "'MentionedEntities: ' || mentioned || ' '", "'Hashtags:  ' || hashtags"])


@register("flat_records", f"SELECT form, {_FLAT} AS value FROM ({_TWEETS_SQL}), (VALUES ('double'), ('single'), ('crlf')) f(form)")
def q_flat_records(spark, sf):
    """Every document as a record, in files with double and single separator lines and with CRLF ends; read back and flattened to one line each."""
    out = None
    value = tagged.render_tagged_records(_tweets(spark, sf))
    open_end = F.regexp_replace("value", r"\n\*\*\*\z", "")       # the next record's opening line is the only separator
    for form, lines in {"double": F.col("value"), "single": open_end, "crlf": F.concat(F.replace(open_end, F.lit("\n"), F.lit("\r\n")), F.lit("\r"))}.items():
        path = scratch_path(spark, f"records-{form}")
        value.select(lines.alias("value")).write.text(path)
        flat = cut(delimited.flatten_records(tagged.read_tagged_records(spark, path)).select(F.lit(form).alias("form"), "value"))
        drop_scratch(spark, path)
        out = flat if out is None else out.unionByName(flat)
    return out


# ---------------------------------------------------------------- loops over files

@register("bfs_files", _SSSP_SQL + """, adj AS (SELECT src, string_agg(CAST(dst AS VARCHAR), ':' ORDER BY dst) || ':' AS adj FROM e GROUP BY src),
s AS (SELECT min(src) AS s FROM e), nodes AS (SELECT src AS node FROM e UNION SELECT dst FROM e)
SELECT CAST(n.node AS VARCHAR) AS node, CASE WHEN n.node = s THEN 0 ELSE d.dist END AS dist, adj.adj AS adj
FROM nodes n LEFT JOIN d ON d.node = n.node LEFT JOIN adj ON adj.src = n.node, s""")
def q_bfs_files(spark, sf):
    """Node-line files relaxed step by step, each reading the files of the one before, until no distance changes."""
    e = stored(W.order_graph(spark, sf), "edges")
    folder = scratch_path(spark, "bfs-steps")
    found = stored(graph.bfs_files(spark, graph.node_lines(e, sssp_source(e)), folder), "bfs-found")
    drop_scratch(spark, folder)
    return found


@register("kmeans_files", _kmeans_chain_sql(5).split("\nSELECT")[0] + "\nSELECT CAST(cid AS BIGINT) AS cid, round(center, 9) AS center FROM c5")
def q_kmeans_files(spark, sf):
    """Five Lloyd steps chained by centre files; ids are those of the seeds, so a cluster without points keeps its number free."""
    counts = _counts(spark, sf)
    folder = scratch_path(spark, "kmeans-steps")
    seeds = cluster.init_centres_df(spark, counting.max_count(counts), KMEANS_K)
    last = cut(cluster.kmeans_files(_points(counts), seeds, folder, iterations=5))
    drop_scratch(spark, folder)
    return last.select(F.row_number().over(Window.orderBy("cid")).cast("long").alias("cid"), F.round("center", 9).alias("center")).withColumn("cid", F.col("cid") - 1)   # k rows


# ---------------------------------------------------------------- nearest of many centres

@register("nearest_many", """
WITH c AS (SELECT p_retailprice * 100 AS center, min(p_partkey) AS cid FROM part GROUP BY 1),
o AS (SELECT o_orderkey, o_totalprice AS x FROM orders),
lo AS (SELECT o_orderkey, x, c.center AS lc, c.cid AS li FROM o ASOF LEFT JOIN c ON o.x >= c.center),
hi AS (SELECT o_orderkey, c.center AS hc, c.cid AS hi FROM o ASOF LEFT JOIN c ON o.x <= c.center)
SELECT o_orderkey, x, CASE WHEN low THEN li ELSE hi END AS cid, CASE WHEN low THEN lc ELSE hc END AS center FROM (
  SELECT *, hc IS NULL OR (lc IS NOT NULL AND (x - lc < hc - x OR (x - lc = hc - x AND li <= hi))) AS low FROM lo JOIN hi USING (o_orderkey))""")
def q_nearest_many(spark, sf):
    """Each order's total beside the nearest of as many centres as there are parts (a hundred times their prices)."""
    o = W.table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("x"))
    c = W.table(spark, sf, "part").select(F.col("p_partkey").alias("cid"), (F.col("p_retailprice") * 100).alias("center"))
    return cluster.nearest_join(o, c)


# ---------------------------------------------------------------- ARFF as others write it

def _type_sql(table: str, column: str, limit: int) -> str:
    quoted = f"chr(39) || replace(replace({column}, chr(92), chr(92) || chr(92)), chr(39), chr(92) || chr(39)) || chr(39)"
    return (f"SELECT '{column}' AS attribute, CASE WHEN count(DISTINCT {column}) <= {limit} THEN chr(123) || string_agg(DISTINCT {quoted}, ',' ORDER BY {quoted}) || chr(125) ELSE 'string' END AS type "
            f"FROM {table}")


_DOCUMENT_TYPES = " UNION ALL ".join(["SELECT 'doc_id' AS attribute, 'integer' AS type", *[_type_sql("documents", c, arff.MAX_DOMAIN) for c in ("text", "lang", "source")], "SELECT 'n_chars', 'integer'"])


@register("arff_domains", _DOCUMENT_TYPES)
def q_arff_domains(spark, sf):
    """CSV -> ARFF of documents with inferred domains: the attributes as the written header declares them."""
    c_path, a_path = scratch_path(spark, "csv"), scratch_path(spark, "arff")
    arff.write_csv(W.table(spark, sf, "documents"), c_path)
    arff.csv_to_arff(spark, c_path, a_path)
    lines = cut(spark.read.text(f"{a_path}/header").where("value LIKE '@attribute%'"))      # a line an attribute
    drop_scratch(spark, c_path, a_path)
    declared = r"(?s)^@attribute (\S+) (.*)$"
    return lines.select(F.regexp_extract("value", declared, 1).alias("attribute"), F.regexp_extract("value", declared, 2).alias("type"))


@register("arff_foreign", """
SELECT form, doc_id, text, lang, n_chars, TIMESTAMP '2011-07-01 00:00:00' + (doc_id * 60) * INTERVAL 1 SECOND AS seen FROM documents, (VALUES ('dense'), ('sparse')) f(form)""")
def q_arff_foreign(spark, sf):
    """Documents as other tools write ARFF: double quotes, tabs and blanks around values, dates with a format, and sparse rows."""
    d = _tweets(spark, sf).select(F.col("tweet_id").alias("doc_id"), "text", F.element_at("hashtags", 1).alias("lang"), F.col("ret_count").alias("n_chars"), F.col("time").alias("seen"))
    quoted = F.col("text")
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        quoted = F.replace(quoted, F.lit(raw), F.lit(safe))
    values = {"doc_id": F.col("doc_id").cast("string"), "text": F.concat(F.lit('"'), quoted, F.lit('"')), "lang": F.col("lang"), "n_chars": F.col("n_chars").cast("string"),
              "seen": F.concat(F.lit("'"), F.date_format("seen", "yyyy/MM/dd HH.mm.ss"), F.lit("'"))}
    langs = arff.infer_domains(d, ["lang"])["lang"]
    head = ["% written elsewhere", "@RELATION 'some documents'", "@ATTRIBUTE doc_id INTEGER", "@attribute text string", "@attribute lang { " + ", ".join(langs) + " }", "@attribute n_chars numeric",
            "@attribute 'seen' date \"yyyy/MM/dd HH.mm.ss\"", "@DATA"]
    zeros = {"doc_id": "0", "text": "", "lang": langs[0], "n_chars": "0", "seen": "1970-01-01 00:00:00"}
    named = [F.when(F.coalesce(F.col(c).cast("string") != zeros[c], F.lit(True)), F.concat(F.lit(f"{i} "), F.coalesce(v, F.lit("?")))) for i, (c, v) in enumerate(values.items())]
    forms = {"dense": F.concat_ws("\t, ", *[F.coalesce(v, F.lit("?")) for v in values.values()]), "sparse": F.concat(F.lit("{ "), F.concat_ws(" ,", *named), F.lit("}"))}
    out = None
    for form, line in forms.items():
        path = scratch_path(spark, f"arff-{form}")
        spark.createDataFrame([(x,) for x in head], "value string").coalesce(1).write.text(f"{path}/header")
        d.select(line.alias("value")).write.text(f"{path}/data")
        back = stored(arff.read_arff(spark, path, corrupt="_corrupt").where("_corrupt IS NULL").select(F.lit(form).alias("form"), "doc_id", "text", "lang", F.col("n_chars").cast("long").alias("n_chars"), "seen"), "arff-read")
        drop_scratch(spark, path)
        out = back if out is None else out.unionByName(back)
    return out


# ---------------------------------------------------------------- relaxation over pieces

PIECE = 20


@register("bfs_relax_pieces", f"""
WITH e AS ({_GRAPH_SQL}), nodes AS ({_NODES_SQL}),
n AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {PIECE} AS piece FROM e),
adj AS (SELECT src, piece, string_agg(CAST(dst AS VARCHAR), ':' ORDER BY dst) || ':' AS adj FROM n GROUP BY src, piece),
start AS (SELECT min(src) AS s FROM e),
best AS (SELECT node, min(dist) AS dist FROM (SELECT s AS node, 0 AS dist FROM start UNION ALL SELECT e.dst, 1 FROM e, start WHERE e.src = s) GROUP BY node)
SELECT CAST(nodes.node AS VARCHAR) AS node, coalesce(piece, 0) AS piece, CAST(best.dist AS INT) AS dist, coalesce(adj, '') AS adj
FROM nodes LEFT JOIN adj ON adj.src = nodes.node LEFT JOIN best ON best.node = nodes.node""")
def q_bfs_relax_pieces(spark, sf):
    """One relaxation over node lines in pieces of at most twenty neighbours, written as files."""
    e = cut(W.order_graph(spark, sf))
    path = scratch_path(spark, "node-pieces")
    graph.node_pieces(e, sssp_source(e), max_per_row=PIECE).write.text(path)
    out = cut(graph.bfs_relax_pieces(spark.read.text(path)))
    drop_scratch(spark, path)
    return out


@register("generated_chains", """
WITH k AS (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS k FROM customer)
SELECT i AS src, CASE WHEN i % k <> 0 THEN i + 1 END AS dst FROM k, range(1, k * k + 1) r(i)""")
def q_generated_chains(spark, sf):
    """The chain generator with as many nodes as there are customers (the largest square)."""
    k = W.table(spark, sf, "customer").agg(F.floor(F.sqrt(F.count(F.lit(1)))).alias("k")).first().k
    return graph.chain_graph(spark, k)


# ---------------------------------------------------------------- named files

@register("named_files", """
SELECT CAST(o_orderkey // 1000 AS VARCHAR) AS file, string_agg(concat_ws('|', o_orderkey, o_custkey, o_orderstatus), ',' ORDER BY o_orderkey) || ',' AS merged FROM orders GROUP BY 1""")
def q_named_files(spark, sf):
    """Orders written to one named file per thousand keys, then merged file by file."""
    path = scratch_path(spark, "named")
    o = W.table(spark, sf, "orders").select((F.floor(F.col("o_orderkey") / 1000)).cast("long").alias("file"), "o_orderkey",
                                            F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("value"))
    named.write_named_files(o, path, "file", ["o_orderkey"])
    merged = cut(folders.merge_lines(folders.read_files(spark, path)))
    drop_scratch(spark, path)
    return merged.select(F.regexp_extract("path", r"/f([^/]*)\.txt$", 1).alias("file"), "merged")


@register("neighbour_lines", f"""
WITH {_KNN_CTE}, x AS (SELECT DISTINCT row_key, title, year FROM t), y AS (SELECT DISTINCT row_key, publisher FROM q)
SELECT CAST(distance AS VARCHAR) AS distance, x.title || ',' || x.year || ',' || y.publisher AS model, count(*) AS n
FROM knn JOIN x ON x.row_key = knn.t_row_key JOIN y ON y.row_key = knn.row_key GROUP BY ALL""")
def q_neighbour_lines(spark, sf):
    """Neighbours written as ``distance<TAB>title,year,publisher`` lines, read back and counted."""
    q, t = W.book_split(spark, sf)
    knn = nb.knn_topk(q, t, k=KNN_K, carry=["title", "year"], q_carry=["publisher"])
    path = scratch_path(spark, "neighbours")
    delimited.write_separated(knn.select("distance", F.concat_ws(",", "t_title", F.col("t_year").cast("string"), "q_publisher").alias("model")), path, "\t")
    back = stored(spark.read.schema("distance STRING, model STRING").option("sep", "\t").option("escape", '"').csv(path), "neighbours-read")
    drop_scratch(spark, path)
    return back.groupBy("distance", "model").agg(F.count(F.lit(1)).alias("n"))


@register("scored_lines", f"""
WITH s AS ({_LARGE_SCORE_SQL}) SELECT CAST(doc_id AS VARCHAR) || ';' || {_ONE_LINE} || chr(9) || '->' || chr(9) || score AS value FROM documents JOIN s USING (doc_id)""")
def q_scored_lines(spark, sf):
    """Scored documents written as ``id;text -> score`` lines and read back."""
    path = scratch_path(spark, "scored")
    docs = W.table(spark, sf, "documents")
    scored = textops.sentiment_score(docs, _large_lexicon(spark, sf)).join(docs.select("doc_id", F.regexp_replace("text", r"[\n\r]", " ").alias("text")), "doc_id")
    delimited.write_values(textops.scored_line(scored.withColumnRenamed("doc_id", "tweet_id")), path)
    lines = cut(spark.read.text(path))
    drop_scratch(spark, path)
    return lines


_PAIR_LEX_SQL = ("SELECT w1 || ' ' || w2 AS term, (length(w1) + length(w2) * 3) % 7 - 3 AS score FROM (SELECT DISTINCT unnest(list_zip(l[:len(l) - 1], l[2:])) AS p, p[1] AS w1, p[2] AS w2 "
                 "FROM (SELECT string_split(text, ' ') AS l FROM benchmark))")


@register("sentiment_phrases", f"""
WITH lex AS ({_LARGE_LEX_SQL} UNION ALL {_PAIR_LEX_SQL}),
l AS (SELECT doc_id, string_split(text, ' ') AS l FROM documents),
toks AS (SELECT doc_id, unnest(l) AS tok FROM l UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) FROM l)
SELECT d.doc_id, CAST(coalesce(sum(lex.score), 0) AS BIGINT) AS score FROM documents d LEFT JOIN toks USING (doc_id) LEFT JOIN lex ON lex.term = tok GROUP BY d.doc_id""")
def q_sentiment_phrases(spark, sf):
    """A lexicon of words and of word pairs (every pair of neighbours in ``benchmark``): phrases match too."""
    w = F.split("text", " ")
    pairs = W.table(spark, sf, "benchmark").select(F.explode(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.struct(F.get(w, i - 1).alias("a"), F.get(w, i).alias("b")))).alias("p")).select("p.*").distinct()
    phrases = pairs.select(F.concat_ws(" ", "a", "b").alias("term"), ((F.length("a") + F.length("b") * 3) % 7 - 3).cast("int").alias("score"))
    return textops.sentiment_score(W.table(spark, sf, "documents"), _large_lexicon(spark, sf).unionByName(phrases), ngrams=2)


@register("sentiment_score_joined", ORACLES["sentiment_score"])
def q_sentiment_score_joined(spark, sf):
    """The ten-word lexicon by the shuffle join."""
    return textops.sentiment_score(W.table(spark, sf, "documents"), spark.createDataFrame(LEXICON, "term string, score int"), broadcast_bytes=0)
