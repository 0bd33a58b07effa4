"""URL filter: a blocked Bloom filter in front of an exact hash join.

Listed entries are keys: ``host/path-prefix`` rules (a rule fits its host,
all subdomains, and paths that start with its path) and canonical URLs.  Every
URL is expanded to the keys it could match; a blocked Bloom filter of the
listed keys drops almost all of them, and an exact equi-join with the list
removes the filter's false positives, so verdicts never depend on hashing.

The filter has a fixed largest size, whatever the length of the list (see
``bloom``): this is the proven size bound under which it is broadcast.  A
longer list only lets more keys through to the exact join, which is planned by
size (shuffled when the list is large).

Defined cases: a NULL URL and one without ``://`` have empty host and path,
match nothing and are allowed; equal URLs get equal verdicts; of two rules the
longer one wins, and of equally long ones ``block``; an empty list allows
everything; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bloom
from strata.llm.common import ascii_lower, materialize

LIST_SCHEMA = "key string, rule string, verdict string"


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", 2), F.lit(""))


def canonical_key(host: Column, path: Column) -> Column:
    """Key of one page: scheme, ``www.``, query, fragment, a final slash and
    ``.html`` do not tell pages apart.  The leading ``=`` keeps it apart from
    rule keys."""
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.concat(F.lit("="), bare, F.regexp_replace(path, r"(/|\.html?)$", ""))


def rule_list(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(rule, verdict)`` pairs as list rows; a rule is ``host/path-prefix``."""
    return spark.createDataFrame([(r, r, v) for r, v in rules], LIST_SCHEMA)


def listed_pages(urls: DataFrame, verdict: str = "block") -> DataFrame:
    """List rows of whole canonical URLs, from a frame with a ``url`` column."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    return (
        urls.where(host != "")
        .select(canonical_key(host, path).alias("key"))
        .distinct()
        .select("key", F.lit(None).cast("string").alias("rule"), F.lit(verdict).alias("verdict"))
    )


def possible_keys(host: Column, path: Column, lengths: Sequence[int], labels: int) -> Column:
    """All list keys that would fit: host suffixes of at most ``labels`` labels
    (no listed host has more), each with the path prefixes of the lengths that
    occur in the list."""
    suffixes = F.array_distinct(F.array(*(F.substring_index(host, ".", -k) for k in range(1, labels + 1))))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path)),
        lambda n: F.substring(path, F.lit(1), n),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every row of ``pages``."""
    listed = materialize(listed.where(F.col("key").isNotNull()).distinct(), "url-list")
    slash = F.instr("rule", "/")
    size = listed.agg(
        F.count(F.lit(1)).alias("n"),
        # as many as there are different path lengths among the rules
        F.collect_set(F.when(slash > 0, F.length("rule") - slash + 1).otherwise(F.lit(0))).alias("lens"),
        F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\.", -1))).alias("labels"),
    ).first()
    lengths = sorted(int(n) for n in size["lens"])
    bits, blocks = bloom.build(listed, "key", size["n"])

    parts = pages.select("page_id", "url").withColumn("host", url_host(F.col("url")))
    parts = parts.withColumn("path", url_path(F.col("url")))
    keys = F.array_append(
        possible_keys(F.col("host"), F.col("path"), lengths, size["labels"] or 1) if lengths else F.array().cast("array<string>"),
        canonical_key(F.col("host"), F.col("path")),
    )
    probes = parts.where(F.col("host") != "").select("url", F.explode(keys).alias("_key"))
    maybe = bloom.possible(probes, "_key", bits, blocks).distinct()
    hits = maybe.join(listed, F.col("_key") == F.col("key"))
    order = F.struct(F.length("rule"), F.col("verdict") == "block", F.col("rule"))
    by_rule = F.col("rule").isNotNull()
    best = hits.groupBy(F.col("url").alias("_url")).agg(
        F.max_by(F.when(by_rule, F.struct("rule", "verdict")), F.when(by_rule, order)).alias("_rule"),
        F.max(F.when(~by_rule, F.col("verdict"))).alias("_page"),
    )
    return parts.join(best, F.col("url") == F.col("_url"), "left").select(
        "page_id",
        "url",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.col("_page"), F.lit(default)).alias("verdict"),
    )
