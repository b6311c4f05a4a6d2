"""URL filters: block and allow rules on hosts and paths, looked up by hash.

Every URL is expanded into expressions: each suffix of its host at a dot, with each prefix of its path that
has the length of some rule's path. Expressions and rules meet in an equi-join on the first hex digits of
their SHA-256; a match counts once the whole digests are equal. Of the rules that fit, the longest wins.

Distinct (host, path) pairs are expanded, not rows: a host with a third of all rows is one group per pair and
map task before the shuffle. What comes back to the rows is one row per matched pair, joined on the pair,
so a hot pair can be split. DataFrame functions only. The lengths of rule paths are the only thing that
the driver sees: distinct integers, bounded by the longest rule path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import without

#: Hex digits of the digest that the join compares.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    """Of host and path with a character between that neither has."""
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def expressions(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """``host``, ``path`` -> one row for each suffix of the host and each path prefix of a rule's length."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]) if lengths else F.array().cast("array<string>"), lambda p: p.isNotNull())
    return (urls.withColumn("__suffix", F.explode(suffixes)).withColumn("__prefix", F.explode(prefixes))
            .withColumn("__digest", digest(F.col("__suffix"), F.col("__prefix")))
            .select("host", "path", "__digest", F.substring("__digest", 1, SHORT).alias("__short")))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the longest rule that fits, else null) and
    ``verdict`` (the rule's, else ``otherwise``).

    ``rules`` has ``host``, ``path``, ``verdict``; a rule fits its host and all subdomains where the URL's
    path starts with the rule's. Of rules of one length the one with the longer host wins, of equal rules
    ``block``. Null and odd URLs have empty host and path and fit no rule of a non-empty host. Columns of
    ``pages`` named like the new ones are replaced; other columns, repeated rows and the row count stay."""
    pages = without(pages, ["host", "path", "rule", "verdict"])
    rules = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
             .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(F.max(F.col("verdict") == "block").alias("block")))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().toLocalIterator())
    known = rules.select(digest(F.col("host"), F.col("path")).alias("__rule_digest"),
                         F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
                                  F.concat("host", "path").alias("rule"), F.when(F.col("block"), "block").otherwise("allow").alias("verdict")).alias("__rule"))
    known = known.withColumn("__rule_short", F.substring("__rule_digest", 1, SHORT))
    pages = pages.withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`")))
    asked = expressions(pages.select("host", "path").distinct(), lengths)
    fits = (asked.join(known, F.col("__short") == F.col("__rule_short")).where(F.col("__digest") == F.col("__rule_digest"))
            .groupBy(F.col("host").alias("__host"), F.col("path").alias("__path")).agg(F.max("__rule").alias("__best")))
    return (pages.join(fits, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
            .withColumn("rule", F.col("__best.rule")).withColumn("verdict", F.coalesce("__best.verdict", F.lit(otherwise)))
            .drop("__host", "__path", "__best"))
