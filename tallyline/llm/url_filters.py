"""URL filters: rules by host and path, and gradient-boosted trees for the rest.

A rule fits its host and all subdomains if the url's path starts with the
rule's; the longest rule that fits decides. Urls that a rule decides are the
labelled urls: trees trained on their lexical features (lengths, depth, digit
ratio, entropy, parameters, and statistics of the host's suffix over all urls)
judge the others. Training takes at most about ``SAMPLE`` labelled urls,
chosen by a digest; features and suffix statistics cover every url.

Everything here is column functions and Spark's own tree learner.

Nulls and ties: a null url or one without ``://`` has an empty host and path,
fits no rule, and is judged by its features like any other. Rows that repeat a
url are judged alike. With labels of one kind only, that verdict is given to
all; with none, ``allow``. An empty table gives an empty table.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE = 20_000
TREES = 10
DEPTH = 4
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "hyphens", "parameters",
            "fragment", "suffix_log_count", "suffix_host_length", "suffix_depth")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    size = F.size(chars)
    def bits(total, c):
        share = (size - F.size(F.array_remove(chars, c))).cast("double") / size
        return total - share * F.log2(share)
    return F.when(size > 0, F.aggregate(F.array_distinct(chars), F.lit(0.0), bits)).otherwise(0.0)


def features(urls: DataFrame) -> DataFrame:
    """``urls(page_id, url)`` with host, path and the features."""
    host, path = split_url(F.col("url"))
    url = F.coalesce("url", F.lit(""))
    rows = urls.withColumns({"host": host, "path": path}).withColumns({
        "url_length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "labels": F.regexp_count("host", F.lit(r"\.")).cast("double"),
        "digits": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)).cast("double"),
        "entropy": entropy(url),
        "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "parameters": F.regexp_count(url, F.lit("[?&][^=&#]*=")).cast("double"),
        "fragment": F.when(F.contains(url, F.lit("#")), 1.0).otherwise(0.0),
        "suffix": F.substring_index("host", ".", -1),
    })
    stats = rows.groupBy("suffix").agg(F.log1p(F.count("*").cast("double")).alias("suffix_log_count"),
                                       F.avg("host_length").alias("suffix_host_length"), F.avg("depth").alias("suffix_depth"))
    # A left join: adaptive execution splits the rows of a hot suffix where the statistics are not small.
    return rows.join(stats, "suffix", "left")


def judged(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages(page_id, url)``."""
    rows = features(pages.select("page_id", "url"))
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = stored(rows.withColumns({"rule": rule, "decided": decided}), "url-features")
    known = rows.filter("decided is not null").groupBy("decided").count().collect()  # two rows at most
    total = sum(r["count"] for r in known)
    if len(known) < 2:
        return rows.select("page_id", "host", "path", "rule",
                           F.coalesce("decided", F.lit(known[0]["decided"] if known else "allow")).alias("verdict"))
    share = int(min(1.0, sample / total) * (1 << 30))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    labelled = (rows.filter("decided is not null").filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < share)
                .withColumn("label", F.when(F.col("decided") == "block", 1.0).otherwise(0.0))
                .orderBy("page_id", "url").coalesce(4))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, maxBins=32).fit(
        vectors.transform(stored(labelled.select("label", *FEATURES), "url-labelled")).select("label", "features"))
    scored = trees.transform(vectors.transform(rows))
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "decided", F.when(F.col("prediction") == 1.0, "block").otherwise("allow")).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))
