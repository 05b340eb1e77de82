"""Text family: lexicon sentiment scoring and last-value-per-key dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.loops import cut

BROADCAST_BYTES = 32 << 20     # a lexicon of more bytes is joined by shuffle
SALTS = 16                     # parts of a hot term in that shuffle


def _dedup_lexicon(lexicon: DataFrame, term: str, score: str, order: str | None) -> DataFrame:
    """One score per term; the later row wins, as with a hash map filled in file
    order (by ``order`` if given, else by the row order of the DataFrame)."""
    at = F.col(order) if order else F.monotonically_increasing_id()
    return (lexicon.select(term, score, at.alias("_at")).where(F.col(term).isNotNull() & F.col(score).isNotNull())
            .groupBy(term).agg(F.max_by(score, "_at").alias(score)))


def _grams(toks, max_n: int):
    """Tokens plus, for n = 2..max_n, every run of n consecutive tokens joined
    by one space (so lexicon phrases containing spaces can match).

    The runs of n are those of n - 1 zipped with the tokens that follow them, and
    the tokens are bound once, so a text is split once and costs time in
    proportion to its length."""
    if max_n < 2:
        return toks

    def grams(words):
        runs, parts = words, [words]
        for n in range(2, max_n + 1):
            # the shorter side is the followers': what lies beyond the last whole run is NULL and dropped
            later = F.slice(words, n, F.greatest(F.size(words) - F.lit(n - 1), F.lit(0)))
            runs = F.filter(F.zip_with(runs, later, lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b))), lambda x: x.isNotNull())
            parts.append(runs)
        return F.concat(*parts)

    return F.get(F.transform(F.array(toks), grams), F.lit(0))


def sentiment_score(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    term: str = "term", score: str = "score", order: str | None = None,
                    broadcast_bytes: int = BROADCAST_BYTES, ngrams: int = 1) -> DataFrame:
    """``(id, score)``, one row per row of ``docs``: sum of the lexicon scores of
    its tokens (split on a single space, case kept); 0 when nothing matches or
    the text is NULL. Whole scores give a BIGINT, fractional ones a DOUBLE.

    Tokens are exploded and joined with the lexicon: broadcast if its measured
    bytes allow, else by shuffle on (term, salt) so that a frequent token is
    spread over ``SALTS`` parts. Both give the same rows. A document's hits are
    summed within its task before the shuffle."""
    lex = cut(_dedup_lexicon(lexicon, term, score, order))
    whole = isinstance(lex.schema[score].dataType, T.IntegralType)
    size = lex.agg(F.sum(F.octet_length(term) + F.lit(16))).first()[0] or 0
    toks = _grams(F.split(F.col(text_col), " "), ngrams)
    each = (docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), toks.alias("_toks"))
            .select("_row", "_id", F.explode_outer("_toks").alias("_tok")))
    value = lex.select(F.col(term).alias("_tok"), F.col(score).alias("_score"))
    if size <= broadcast_bytes:
        hits = each.join(F.broadcast(value), "_tok", "left")
    else:
        salted = value.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = each.withColumn("_salt", F.pmod(F.col("_row"), F.lit(SALTS)).cast("int")).join(salted, ["_tok", "_salt"], "left")
    total = F.coalesce(F.sum("_score"), F.lit(0)).cast("long" if whole else "double")
    return hits.groupBy("_row", "_id").agg(total.alias("score")).select(F.col("_id").alias(id_col), "score")


def sentiment_job(tweets: DataFrame, lexicon: DataFrame, **options) -> DataFrame:
    """Tweets -> one ``(tweet_id, text, score)`` row per id: of repeated ids the
    last by time (then text) is scored."""
    last = dedup_last(tweets.where(F.col("tweet_id").isNotNull()).select("tweet_id", "time", "text"), "tweet_id", ["time", "text"])
    scored = sentiment_score(last.select("tweet_id", "text"), lexicon, id_col="tweet_id", text_col="text", **options)
    return last.select("tweet_id", "text").join(scored, "tweet_id")


def scored_line(df: DataFrame) -> DataFrame:
    """``id;text<TAB>-><TAB>score`` lines of scored tweets."""
    return df.select(F.concat(F.col("tweet_id").cast("string"), F.lit(";"), F.coalesce("text", F.lit("")), F.lit("\t->\t"), F.col("score").cast("string")).alias("value"))


def dedup_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row that is last in ``order``.

    ``max_by`` over a struct is a partial aggregate: each map task keeps one
    candidate per key, so a key with a third of all rows costs one row per
    task in the shuffle."""
    cols = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*cols), F.struct(*order))
    return df.groupBy(key).agg(best.alias("_r")).select(key, *[F.col("_r." + c).alias(c) for c in cols])
