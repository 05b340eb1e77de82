"""Queries of the training-data operators: thin wrappers that read the given
tables, call an operator and derive the result columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as deco
from . import angular, boilerplate, bpe, exact_dedup, latent_knn, licenses, order_minhash, periodic, pii, reputation, toxic_crf, warc
from .runtime import fresh_path


TOXIC_LIMIT = 0.3
QUALITY_LIMIT = 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op3_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deco.find_matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row_key").alias("doc_id"), "n_words", "n_hit", F.size(F.array_distinct(F.transform("matches", lambda m: m.item_id))).cast("long").alias("n_items"),
                        deco.items_digest("matches").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: class_id (smallest doc_id of its near-duplicate
    class), class_size (documents in it), n_links (verified links of the class
    between different texts), kept."""
    members, links = order_minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))
    sizes = members.groupBy("class").agg(F.count("*").alias("class_size"))
    linked = (links.select("a", "b").distinct().join(members.where("id = node").select(F.col("id").alias("a"), "class").distinct(), "a")
              .groupBy("class").agg(F.count("*").alias("n_links")))
    about = sizes.where("class_size > 1").join(linked, "class", "left")
    return (members.join(about, "class", "left")
            .select(F.col("id").alias("doc_id"), F.col("class").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.col("id") == F.col("class"), F.lit(True)).alias("kept")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents")).select(
        F.col("row_key").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.size("blocks").cast("long").alias("n_blocks"))


def op2_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.members(spark, table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archives(spark, table(spark, sf_dir, "pages"), path)
    told = F.str_to_map(F.col("metadata")[0].body, F.lit("\r\n"), F.lit(": "))
    captures = warc.read_captures(spark, path).withColumn("told", told)
    revisit = F.col("response.type") == "revisit"
    return captures.select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_responses"))).alias("copy"), F.expr("try_cast(told['page-id'] as bigint)").alias("page_id"),
        F.when(revisit, F.expr("try_cast(told['payload-bytes'] as bigint)")).otherwise(F.octet_length("response.payload")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("response.payload_digest", ":", -1)).otherwise(warc.base32_sha1(F.col("response.payload"))).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(revisit, F.expr("try_cast(split(response.refers_to, ':')[3] as bigint)")).alias("refers_to")).drop("copy")


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reputation.judge(spark, table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("bad_share_bound")


def encoded_and_decoded(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Digests of every text's ids and of the text they decode to; on request the ids."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    both = bpe.round_trip(spark, docs, vocabulary)
    return both.select(F.col("row_key").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                       *(["ids"] if with_ids else []))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_decoded(spark, table(spark, sf_dir, "documents"))


def _remainder(n: int):
    """crc32 of the id as text, modulo n (a null id has no remainder)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(-1))


def toxic_field(spark: SparkSession, docs: DataFrame, labels: DataFrame):
    """The field, learnt from the rows that are not held out."""
    return toxic_crf.fit(spark, docs, labels.where(_remainder(4) != 2).select("doc_id", F.col("toxic").alias("label")))


def op8_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxic_crf.score(spark, docs, toxic_field(spark, docs, table(spark, sf_dir, "labels")))
    return scored.withColumnRenamed("row_key", "doc_id").select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= TOXIC_LIMIT).cast("int").alias("predicted"),
                                                                F.size("spans").cast("long").alias("n_spans"))


def op10_latent_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = table(spark, sf_dir, "labels").where(_remainder(3) != 1).select("doc_id", F.col("quality").alias("label"))
    scored = latent_knn.score(spark, docs, latent_knn.fit(spark, docs, learn))
    return scored.withColumnRenamed("row_key", "doc_id").select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"))


def op9_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(spark, table(spark, sf_dir, "pages")).select(
        F.col("row_key").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_repeated")


def tiled(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document (by crc32 of its id)
    repeats a stretch from some word on; other texts stay as they are."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    chosen = F.when((F.col("h") % 10 == 0), words)
    first = F.expr("(h div 10) % size(w)").cast("int")
    period = F.expr("1 + (size(w) - a) div (3 + (h div 10) % 8)").cast("int")
    at = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return (hashed.withColumn("w", chosen).withColumn("a", F.when(F.size("w") > 0, first)).withColumn("p", period)
            .select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(at, " ")).otherwise(F.col("text")).alias("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.runs(spark, tiled(table(spark, sf_dir, "documents")))
    # the greatest exponent: by cross products, so that equal fractions are equal
    better = lambda x, y: (y.length * x.period > x.length * y.period)       # noqa: E731  (of ties the earlier one stays)
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda x, y: F.when(better(x, y), y).otherwise(x))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return found.withColumn("best", best).select(
        F.col("row_key").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return angular.mine(spark, rows, F.col("vec_id") % 100 == 0)


def op13_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(spark, table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s.kind)
    counts = [F.size(F.filter(kinds, lambda x: x == kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select(F.col("row_key").alias("doc_id"), *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("spans").alias("spans"))


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_streaming_exact_dedup": op2_streaming_exact_dedup,
    "op3_suffix_array_decontamination": op3_suffix_array_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_warc_transactions": op6_warc_transactions,
    "op7_host_reputation": op7_host_reputation,
    "op8_toxic_crf": op8_toxic_crf,
    "op9_host_suffix_array": op9_host_suffix_array,
    "op10_latent_quality": op10_latent_quality,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_angular_negatives": op12_angular_negatives,
    "op13_pii_boosting": op13_pii_boosting,
}

def _words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def _license_sql() -> str:
    templates = ", ".join(f"('{label}', {sorted(set(t.split()))})" for label, t in licenses.TEMPLATES.items())
    phrases = []
    for phrase, label in licenses.PHRASES.items():
        v = phrase.split()
        test = " AND ".join(f"w[p + {j}] = '{x}'" for j, x in enumerate(v))
        phrases.append(f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(w) - {len(v) - 2}), lambda p: {test})) - 1 AS word FROM d")
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_words_sql("coalesce(text, '')")} AS w FROM documents),
        tpl(label, v) AS (VALUES {templates}),
        p AS ({" UNION ALL ".join(phrases)}),
        base AS (SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM p GROUP BY doc_id),
        lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        b AS (SELECT doc_id, list_distinct({_words_sql("line")}) AS w FROM lines),
        m AS (SELECT doc_id, label, len(list_intersect(w, v)) / len(v) AS c FROM b, tpl WHERE len(list_intersect(w, v)) >= ceil({licenses.THRESHOLD} * len(v) - 1e-9)),
        found AS (SELECT doc_id, label, c FROM m UNION ALL SELECT doc_id, label, 1.0 FROM p),
        l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score FROM found GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n_blocks FROM m GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score, coalesce(n_blocks, 0) AS n_blocks
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN n USING (doc_id)
    """


ORACLES: dict[str, str] = {
    "op12_angular_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label AS al, o.vec_id AS id, o.label AS label, list_inner_product(a.v, o.v)::BIGINT AS score FROM e a JOIN e o ON a.vec_id IS DISTINCT FROM o.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = al QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.al AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op3_suffix_array_decontamination": f"""
        WITH d AS (SELECT doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
        i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words_sql("text")} AS w FROM benchmark WHERE text IS NOT NULL),
        k AS (SELECT item_id, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS t FROM k),
        spots AS (SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: {{'p': p, 't': array_to_string(w[p:p + k - 1], ' ')}})) AS x
               FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
        hit AS (SELECT doc_id, x.p AS p, spots.k, item_id FROM spots JOIN win ON win.k = spots.k AND win.t = x.t),
        h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
        n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id, ',' ORDER BY item_id)) AS s FROM hit GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
               n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
    "op4_license_scan": _license_sql(),
    "op2_streaming_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
        g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, sha256(body) AS text_sha256 FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
    "op6_warc_transactions": """
        WITH t AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        g AS (SELECT page_id, body, h, min(page_id) OVER (PARTITION BY body) AS first_id FROM t)
        SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM g
    """,
    "op7_host_reputation": r"""
        WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        q AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts,
                     try_cast(regexp_extract(path, '/(\d+)[^/]*/?$', 1) AS BIGINT) AS doc FROM p),
        s AS (SELECT *, CASE WHEN len(parts) > 2 AND length(parts[-1]) = 2 AND parts[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') THEN 2 ELSE 1 END AS k FROM q),
        h AS (SELECT *, array_to_string(parts[-k:], '.') AS suffix, array_to_string(parts[-(k + 1):], '.') AS domain FROM s),
        l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id),
        hosts AS (SELECT host, domain, suffix, count(l.bad) AS n, coalesce(sum(l.bad), 0) AS bad FROM h LEFT JOIN l ON l.doc_id = h.doc GROUP BY ALL),
        w AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS m, sum(n) AS n FROM hosts),
        s0 AS (SELECT suffix, sum(x.n) AS n, sum(bad) AS bad, any_value(w.m) AS m FROM hosts x, w GROUP BY suffix),
        ks AS (SELECT 1 / (CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) > 0 THEN least(greatest(sum((bad - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.5) ELSE 1e-4 END) - 1 AS k FROM s0),
        s1 AS (SELECT suffix, (m * k + bad) / (k + n) AS mean FROM s0, ks),
        d0 AS (SELECT domain, sum(n) AS n, sum(bad) AS bad, min(mean) AS m FROM hosts JOIN s1 USING (suffix) GROUP BY domain),
        kd AS (SELECT 1 / (CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) > 0 THEN least(greatest(sum((bad - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.5) ELSE 1e-4 END) - 1 AS k FROM d0),
        d1 AS (SELECT domain, (m * k + bad) / (k + n) AS m FROM d0, kd),
        h0 AS (SELECT host, n, bad, m FROM hosts JOIN d1 USING (domain)),
        kh AS (SELECT 1 / (CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) > 0 THEN least(greatest(sum((bad - n * m) ** 2 - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.5) ELSE 1e-4 END) - 1 AS k FROM h0),
        h1 AS (SELECT host, (m * k + bad) / (k + n) AS mean, k + n AS size FROM h0, kh),
        b AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (size + 1)) AS bound FROM h1 WHERE host != ''),
        r AS (SELECT page_id, p.host, path, coalesce(bound, w.m - 1.645 * sqrt(w.m * (1 - w.m) / (w.n + 2))) AS bound,
                     CASE WHEN (p.host = 'www.example.com' OR ends_with(p.host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                          WHEN (p.host = 'example.com' OR ends_with(p.host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                          WHEN (p.host = 'net' OR ends_with(p.host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                          WHEN (p.host = 'net' OR ends_with(p.host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                          WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
              FROM p LEFT JOIN b ON b.host = p.host, w)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM r
    """,
}
