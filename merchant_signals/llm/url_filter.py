"""URL filters: host-suffix / path-prefix expressions, hash-prefix equi-join, full-digest confirmation.

DataFrame functions only.  Each distinct URL is expanded into its expressions: the suffixes of the host at a label
boundary, times the prefixes of the path that end with ``/`` (and the empty one), of as many labels and slashes as some
rule has: others can't meet one, and a URL of thousands of slashes costs its length.  A rule has one expression: its
host and its path up to the last ``/``.  Expressions meet on the first ``PREFIX_HEX`` hex digits of their SHA-256;
the whole digest and the rest of the rule's path are compared afterwards, then the longest rule wins.

Cases: a null URL or one without ``://`` has an empty host and path, fits no rule and gets the default verdict; an
empty rule table gives the default everywhere; repeated rules count once; of fitting rules of equal length the one
with the longer host wins, then ``block``.  Repeated rows and further columns of the pages stay as they are; columns
named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the join key (32 bits).
PREFIX_HEX = 8


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substring(url, at + F.lit(3), F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, lower_ascii(rest)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substring(url, at + F.lit(3), F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _numbers(values: set[int]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values)]).cast("array<int>")


def host_suffixes(labels: Column, counts: set[int]) -> Column:
    """[a, b, c], {1, 3} -> [c, a.b.c]"""
    fit = F.filter(_numbers(counts), lambda n: n <= F.size(labels))
    return F.transform(fit, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def path_prefixes(parts: Column, counts: set[int]) -> Column:
    """['', a, b] of ``/a/b``, {0, 2} -> ['', '/a/']"""
    fit = F.filter(_numbers(counts), lambda n: n < F.size(parts))
    return F.transform(fit, lambda n: F.when(n > 0, F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
                       .otherwise(F.lit("")))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule (host and path of the rule that decides, else null) and verdict.

    rules: host, path, verdict.  A rule fits its host and all subdomains if the URL's path starts with its path.
    """
    own = rules.where(F.col("host").isNotNull()).select(
        lower_ascii(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"),
        F.col("verdict").alias("r_verdict")).distinct()
    own = own.withColumn("r_expr", F.concat_ws("\n", "r_host", F.regexp_extract("r_path", r"^(.*/)?", 0)))
    own = own.withColumn("r_digest", F.sha2("r_expr", 256)).drop("r_expr")
    own = own.withColumn("r_key", F.substring("r_digest", 1, PREFIX_HEX))

    # one control row: the numbers of labels and of slashes that rules have
    depths = own.agg(F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"),
                     F.collect_set(F.size(F.split("r_path", "/")) - 1).alias("slashes")).first()
    urls = pages.select(F.coalesce(F.col(url_col), F.lit("")).alias("u")).distinct()
    split = urls.select("u", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"))
    found = (split.where(F.col("host") != "")
             .select("u", "path", F.split("path", "/").alias("parts"),
                     F.explode(host_suffixes(F.split("host", r"\."), set(depths["labels"]))).alias("suffix"))
             .select("u", "path", "suffix", F.explode(path_prefixes(F.col("parts"), set(depths["slashes"]))).alias("prefix"))
             .select("u", "path", F.sha2(F.concat_ws("\n", "suffix", "prefix"), 256).alias("digest"))
             .withColumn("key", F.substring("digest", 1, PREFIX_HEX))
             .join(own, (F.col("key") == F.col("r_key")), "inner")
             .where((F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))))
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"),
                    (F.col("r_verdict") == "block").cast("int"))
    best = found.groupBy("u").agg(
        F.max(F.struct(rank.alias("rank"), F.concat("r_host", "r_path").alias("rule"),
                       F.col("r_verdict").alias("verdict"))).alias("best"))
    judged = split.join(best, "u", "left").select(
        F.col("u").alias("__u"), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "__u")]
    return (pages.select(*kept, F.coalesce(F.col(url_col), F.lit("")).alias("__u"))
            .join(judged, "__u").drop("__u"))
