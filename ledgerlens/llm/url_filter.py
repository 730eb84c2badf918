"""URL filters: hashed host-suffix / path-prefix lookups with rule precedence.

Method: every URL is expanded into host-suffix x path-prefix expressions, the
expressions are joined to the rules by equality of a short prefix of their
SHA-256, candidates are confirmed by the full digest, and the longest
confirmed rule decides. Only suffixes with as many labels and prefixes with as
many characters as some rule has are made, so a long URL costs no more than
the rules need and no rule is missed.

Cases: a null URL, or one without ``://``, has empty host and path and no
rule; a URL without a rule gets ``default``; rules of equal length: the longer
host wins, then block; repeated rows are judged alike and all returned; an
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT = 8  # hex digits of the digest in the equi-join: 32 bits


def url_parts(url):
    """(host, path) expressions of a URL column."""
    return (lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))),
            F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")))


def _digest(host, path):
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _labels(host):
    return F.size(F.split(host, r"\."))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
                default: str = "allow") -> DataFrame:
    """The input's rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict (``allow`` or ``block``).
    """
    known = rules.select(
        F.concat("host", "path").alias("_rule"), F.col("verdict").alias("_verdict"),
        F.length("host").alias("_h"), _digest(F.col("host"), F.col("path")).alias("_full"),
    ).withColumn("_short", F.substring("_full", 1, SHORT))
    shapes = rules.select(F.collect_set(_labels(F.col("host"))).alias("labels"),
                          F.collect_set(F.length("path")).alias("lengths")).first()
    host, path = url_parts(F.col("_url"))
    urls = (pages.select(F.col(url).alias("_url")).where(F.col("_url").contains("://")).distinct()
            .select("_url", host.alias("_host"), path.alias("_path")))
    expressions = [
        F.when((_labels(F.col("_host")) >= n) & (F.length("_path") >= size),
               _digest(F.substring_index("_host", ".", -n), F.substring("_path", 1, size)))
        for n in sorted(shapes["labels"]) for size in sorted(shapes["lengths"])]
    if not expressions:
        expressions = [F.lit(None).cast("string")]
    tried = (urls.select("_url", F.explode(F.array_compact(F.array(*expressions))).alias("_try"))
             .withColumn("_short", F.substring("_try", 1, SHORT)))
    found = tried.join(known, "_short").where(F.col("_try") == F.col("_full"))
    best = found.groupBy("_url").agg(F.max(F.struct(
        F.length("_rule").alias("size"), F.col("_h").alias("host"),
        (F.col("_verdict") == "block").alias("block"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"))).alias("_best"))
    host, path = url_parts(F.col(url))
    return (pages.join(best, F.col(url) == F.col("_url"), "left")
            .withColumns({"host": host, "path": path, "rule": F.col("_best.rule"),
                          "verdict": F.coalesce("_best.verdict", F.lit(default))})
            .drop("_url", "_best"))
