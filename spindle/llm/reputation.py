"""URL verdicts: path rules, and for the rest an empirical-Bayes reputation of
the host. DataFrame expressions only.

Labelled page outcomes (good or bad) are counted per host. The share of bad
pages of a level is shrunk towards the level above by a beta-binomial prior:
all hosts, then suffix, registered domain, host. A prior's mean is the posterior
mean of the parent; its weight (pseudo-pages) is fitted per level by the method
of moments, from how far the children spread beyond binomial noise. A host is
blocked if the lower bound of its posterior share of bad pages (mean less
``z`` standard deviations of the beta) is above ``block_share``; a host without
labelled pages falls back on its domain, suffix or the whole.

Counts are combined per task before they are shuffled, so a host with a third of
the pages costs a row a task; only one row per host is kept. The three fitted
weights are the only values that reach the driver.

Defined cases: a null url and one without ``://`` have an empty host and path,
fit no rule and get the verdict of the whole; the host is taken as it stands
(with user and port); urls without a page number and labels without a page count
nowhere; null labels count as missing; of repeated labels of a document the worst
counts; repeated pages count as often as they stand; empty tables give no rows or
the prior alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import written

# Fixed values: (verdict, host, path) of the rules.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
# Second-level labels that belong to a suffix under a two-letter country domain.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
BLOCK_SHARE = 0.5
Z = 1.645
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path and, of the host, domain and suffix."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    out = pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})
    bare = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    parts = F.split(bare, "\\.")
    two = (F.size(parts) > 2) & (F.length(F.element_at(parts, -1)) == 2) & F.get(parts, F.size(parts) - 2).isin(SECOND_LEVEL)
    return out.withColumns({name: F.when(two, F.substring_index(bare, ".", -more - 1)).otherwise(F.substring_index(bare, ".", -more))
                            for name, more in (("suffix", 1), ("domain", 2))})


def rule_of(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, else null."""
    rule, verdict = None, None
    for kind, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def outcomes(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """(host, domain, suffix, n, bad) over all pages; a page's outcome is the
    label of the document whose number ends its path: bad if its quality is 0 or it is toxic."""
    seen = parsed(pages.select(url), url).withColumn("doc", F.expr(r"try_cast(regexp_extract(path, '/(\\d+)[^/]*/?$', 1) as bigint)"))
    worst = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
                                              .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)).alias("bad"))
    per_doc = seen.groupBy("host", "domain", "suffix", "doc").agg(F.count("*").alias("pages"))
    marked = per_doc.join(worst.where("bad is not null").withColumnRenamed("doc_id", "doc"), "doc", "left")
    return marked.groupBy("host", "domain", "suffix").agg(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages")).otherwise(0)).alias("n"),
                                                         F.sum(F.coalesce(F.col("bad") * F.col("pages"), F.lit(0))).alias("bad"))


def _weight(level: DataFrame) -> float:
    """Pseudo-pages of a level's prior by the method of moments; columns n, bad, m (parent's mean)."""
    noise = F.col("m") * (1 - F.col("m"))
    got = level.agg(F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) - F.col("n") * noise).alias("over"),
                    F.sum(F.col("n") * (F.col("n") - 1) * noise).alias("pairs")).first()
    rho = min(max((got.over or 0.0) / got.pairs, 1e-4), 0.5) if got.pairs else 1e-4
    return 1 / rho - 1


def reputations(spark: SparkSession, counted: DataFrame, z: float = Z) -> tuple[DataFrame, float]:
    """(host, mean, bound) of every host, and the bound of a page without a host."""
    hosts, _ = written(spark, counted, "host-outcomes")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = whole.n or 0, whole.bad or 0
    mean = (bad + 0.5) / (n + 1)
    whole_bound = mean - z * (mean * (1 - mean) / (n + 2)) ** 0.5

    def shrunk(level: DataFrame, name: str) -> DataFrame:
        k = _weight(level)
        return level.select(name, F.col("n"), F.col("m"), ((F.col("m") * k + F.col("bad")) / (k + F.col("n"))).alias("mean"), (F.lit(k) + F.col("n")).alias("size"))

    def total(name: str, *also: str) -> DataFrame:
        return hosts.groupBy(name, *also).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = shrunk(total("suffix").withColumn("m", F.lit(mean)), "suffix")
    domains = total("domain", "suffix").join(suffixes.select("suffix", F.col("mean").alias("m")), "suffix")
    domains = shrunk(domains.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("m").alias("m")), "domain")
    each = hosts.join(domains.select("domain", F.col("mean").alias("m")), "domain")
    each = shrunk(each, "host")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))
    return each.select("host", "n", "mean", (F.col("mean") - z * spread).alias("bound")), whole_bound


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame, url: str = "url", key: str = "page_id", rules: list[tuple[str, str, str]] = RULES,
          block_share: float = BLOCK_SHARE, z: float = Z) -> DataFrame:
    """key, host, path, rule, verdict and bad_share_bound (the host's posterior bound) of every page."""
    found, whole_bound = reputations(spark, outcomes(pages, labels, url), z)
    rule, verdict = rule_of(rules)
    judged = parsed(pages.select(key, url), url).withColumns({"rule": rule, "fixed": verdict}).join(found.where("host != ''").select("host", "bound"), "host", "left")
    bound = F.coalesce("bound", F.lit(whole_bound))
    return judged.withColumn("bad_share_bound", bound).withColumn("verdict", F.coalesce("fixed", F.when(bound > block_share, "block").otherwise("allow"))).select(key, "host", "path", "rule", "verdict", "bad_share_bound")
