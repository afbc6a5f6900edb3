"""URL filter: given host rules first, then association rules.  DataFrame functions and Spark's FP-growth only.

A URL becomes a set of tokens (registered domain, words of the host and of the
path, names of query parameters).
FP-growth mines the token sets of the labelled URLs together with the label
``=block``; every frequent set that holds the label is a rule (tokens -> block)
with its support and confidence.  Rules under either threshold are pruned, so are those
without lift or whose confidence may be chance, and
rules that a shorter rule of at least their confidence makes redundant.

Matching uses an inverted index: (token, rule) pairs, joined with the tokens of
the distinct URLs; a rule fires where all its tokens have met.  The index holds
at most ``sum of rule sizes`` rows, and it is broadcast only when counted to be
small, else the same join is shuffled.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.session import materialize

#: Fixed values: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.5
#: A rule also needs this many labelled URLs, so that few labels do not make every URL a rule.
MIN_COUNT = 5
BROADCAST_ROWS = 100_000
#: What the registered query asks of a rule besides: lift, and a chance of at most 5 % that any rule at all is chance.
MIN_LIFT, LEVEL = 1.5, 0.05
LABEL = "=block"


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; NULL or no '://': empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host_: Column, path_: Column) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or NULL."""
    fits = []
    for h, p, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1])):
        fit = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        fits.append(F.when(fit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, each marked with the part that it is from; numbers are left out.

    d: the last two labels of the host, w: its words, p: words of the path, q: names of query parameters.
    """
    name = host(url)
    query = F.regexp_extract_all(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]*)"), F.lit(1))
    mark = lambda kind, parts: F.transform(parts, lambda x: F.concat(F.lit(kind), F.regexp_replace(x, "[^a-z_-]", "")))
    every = F.concat(F.array(F.concat(F.lit("d:"), F.substring_index(name, ".", -2))), mark("w:", F.split(name, "[.-]")),
                     mark("p:", F.split(F.lower(path(url)), "[^a-z0-9]+")), mark("q:", F.transform(query, F.lower)))
    return F.filter(F.array_distinct(every), lambda x: F.length(x) > 2)


def wilson_low(hits: Column, of: Column, z: float) -> Column:
    """The lower end of Wilson's interval for a share of `hits` in `of`."""
    share, spread = hits / of, F.lit(z * z) / of
    return (share + spread / 2 - F.sqrt(spread * (share * (1 - share) + spread / 4))) / (1 + spread)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_lift: float = 0.0, level: float | None = None) -> DataFrame:
    """(rule_tokens, support, confidence) from rows of (url, block).

    ``min_lift``: confidence over the share of blocked URLs; ``level``: the lower end of the confidence's interval
    must lie above that share, at this level over all candidates together (so the more sets are looked at, the
    wider each one's interval), and what a few URLs share by chance is no rule.
    """
    baskets = materialize(labelled.select(
        F.concat(tokens(F.col("url")), F.when(F.col("block"), F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))).alias("items"))
        .where(F.size("items") > 0), "url-baskets")
    n = baskets.count()
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, MIN_COUNT / max(n, 1)))).fit(baskets).freqItemsets
    sets = materialize(sets.select(F.array_sort("items").alias("items"), "freq"), "url-itemsets")
    blocked = sets.where(F.array_contains("items", LABEL) & (F.size("items") > 1)) \
        .select(F.array_remove("items", LABEL).alias("items"), F.col("freq").alias("both"))
    base = baskets.where(F.array_contains("items", LABEL)).count() / max(n, 1)
    told = F.col("both") / F.col("freq") >= min_lift * base
    if level is not None:
        z = NormalDist().inv_cdf(1 - level / max(1, blocked.count()))
        told &= wilson_low(F.col("both"), F.col("freq"), z) > base
    rules = blocked.join(sets, "items").where(told).select(F.col("items").alias("rule_tokens"), (F.col("both") / F.lit(max(n, 1))).alias("support"),
                                               (F.col("both") / F.col("freq")).alias("confidence")) \
        .where(F.col("confidence") >= min_confidence)
    # Redundant: the rule without one of its tokens is at least as confident.
    shorter = rules.select("rule_tokens", "confidence", F.explode("rule_tokens").alias("off")) \
        .select("rule_tokens", F.col("confidence").alias("own"), F.array_remove("rule_tokens", F.col("off")).alias("part"))
    redundant = shorter.join(rules.select(F.col("rule_tokens").alias("part"), "confidence"), "part") \
        .where(F.col("confidence") >= F.col("own")).select("rule_tokens").distinct()
    return rules.join(redundant, "rule_tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(url, confidence, rule_tokens) of the most confident rule that fires, for the distinct URLs that one fires for."""
    index = rules.select(F.explode("rule_tokens").alias("token"), F.array_join("rule_tokens", " ").alias("rule_id"),
                         F.size("rule_tokens").alias("size"), "confidence")
    index = materialize(index, "url-index")
    small = index.count() <= broadcast_rows
    postings = urls.select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    met = postings.join(F.broadcast(index) if small else index, "token") \
        .groupBy("url", "rule_id", "size", "confidence").agg(F.count(F.lit(1)).alias("n")).where("n = size")
    return met.groupBy("url").agg(F.max(F.struct("confidence", "rule_id")).alias("best")) \
        .select("url", F.col("best.confidence").alias("confidence"), F.split("best.rule_id", " ").alias("rule_tokens"))


def filter_urls(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                min_lift: float = 0.0, level: float | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, confidence, rule_tokens.

    ``labels``: (doc_id, quality, toxic) of the page with that id.  A page counts as
    labelled ``block`` when its text is of quality 0 or toxic; the label is no input
    of a verdict.  Without a rule that fits or fires the verdict is ``allow``.  NULL
    and malformed URLs have empty host and path.  Very long URLs are read whole, repeated rows judged each.  Empty tables give no rules, or an
    empty result.
    """
    marks = labels.groupBy("doc_id").agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("block"))
    labelled = pages.select("page_id", "url").join(marks, F.col("page_id") == F.col("doc_id")).select("url", "block")
    rules = mine_rules(labelled, min_support, min_confidence, min_lift, level)
    fired = match_rules(pages, rules).withColumnRenamed("url", "_url")
    judged = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    judged = judged.withColumn("given", given_rule(F.col("host"), F.col("path"))) \
        .join(fired, F.col("url") == F.col("_url"), "left")
    verdict = F.coalesce(F.col("given.verdict"), F.when(F.col("confidence").isNotNull(), F.lit("block")), F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"),
                         "confidence", "rule_tokens")
