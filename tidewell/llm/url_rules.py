"""Allow and block rules over URLs, looked up by hashes of host suffixes and path prefixes.

Each URL is expanded into the expressions (host suffix, path prefix) that a rule
could have. Expressions meet rules by an equi-join on the first 32 bits of their
SHA-256 digest; the full digests then decide. Of a URL's rules the longest wins.
All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.sizing import Bound, salted_join

#: Hexadecimal digits of a digest that rules and expressions are joined on.
PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    after = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    return (F.translate(F.regexp_extract(after, "^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1))


def _count(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def _up_to(last: Column) -> Column:
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def _code(host_chars: Column, path_chars: Column, blocks: Column) -> Column:
    """The precedence of a rule as one number: longest, then longest host, then block before allow."""
    return (host_chars + path_chars).cast("long") * (1 << 32) + host_chars.cast("long") * 2 + blocks.cast("long")


def _sound_rules(rules: DataFrame) -> DataFrame:
    """host, path, blocks of the rules that can fit some URL; one row per host and path."""
    host = F.translate(F.col("host"), _UPPER, _LOWER)
    return (rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == "block").alias("blocks"))
            .where("host != '' AND NOT host RLIKE '[/?#]' AND NOT path RLIKE '[?#]' AND blocks IS NOT NULL AND (path = '' OR path LIKE '/%')")
            .groupBy("host", "path").agg(F.max("blocks").alias("blocks")))


def expressions(host: Column, path: Column, labels: int, slashes: int, lengths: list[int]) -> Column:
    """The empty expression, and every distinct ``suffix || prefix`` of a URL that a rule can equal.

    Suffixes have up to ``labels`` labels. Prefixes end at one of the first
    ``slashes`` slashes or have one of ``lengths``: a rule's path that does not
    end in a slash may end inside a name.
    """
    suffixes = F.transform(_up_to(F.least(_count(host, ".") + 1, F.lit(labels))),
                           lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    cut = F.transform(_up_to(F.least(_count(path, "/"), F.lit(slashes))),
                      lambda n: F.concat(F.call_function("substring_index", path, F.lit("/"), n), F.lit("/")))
    inside = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length(path)),
                         lambda n: F.substring(path, F.lit(1), n))
    prefixes = F.concat(cut, inside)
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.array_distinct(F.concat(F.array(F.lit("")), pairs))


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", bound: Bound = Bound()) -> DataFrame:
    """key, url, host, path, rule, verdict: one row for each row of ``pages``.

    ``rules`` has host, path and verdict ('allow' or 'block'). A rule fits its
    host and all subdomains if the URL's path starts with the rule's path. The
    longest rule (host and path together) wins, then the one with the longer
    host; of contrary rules with one host and path the block wins. ``rule`` is
    host and path of the winner; a URL without one has rule null and is allowed.

    A null URL, or one without ``://``, has empty host and path and fits no
    rule. Rules without a host or a verdict, or with a path that no URL can
    have, fit nothing; a null path is empty and fits every path. Repeated rows,
    also without a key, are repeated in the result. Other columns of ``pages``
    play no part, whatever their names. No pages give no rows; without rules
    all are allowed.

    Pages keep one row each through the only shuffle, as expressions are
    reduced to the best rule before it. Rules within ``bound`` are broadcast;
    beyond it, hash prefixes are joined with salt, since one ("com/") may belong
    to most URLs.
    """
    sound = _sound_rules(rules)
    # Three numbers and the distinct lengths of paths that end inside a name: no more than the longest path has characters.
    labels, slashes, lengths = sound.agg(
        F.coalesce(F.max(_count(F.col("host"), ".") + 1), F.lit(0)), F.coalesce(F.max(_count(F.col("path"), "/")), F.lit(0)),
        F.array_sort(F.collect_set(F.when(~F.col("path").endswith("/"), F.char_length("path"))))).first()
    digest = F.sha2(F.concat("host", "path"), 256)
    listed = (sound.select(F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
                           F.struct(digest.alias("digest"), _code(F.char_length("host"), F.char_length("path"), F.col("blocks")).alias("code")).alias("rule"))
              .groupBy("prefix").agg(F.collect_list("rule").alias("candidates")))

    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    # The empty expression stands for the page itself: no rule has its digest, and it counts repeated rows.
    asked = own.select("key", "url", F.explode_outer(expressions(host, path, labels, slashes, lengths)).alias("expression"))
    asked = asked.withColumn("digest", F.sha2("expression", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    if bound.holds(sound):
        met = asked.join(F.broadcast(listed), "prefix", "left")
    else:
        met = salted_join(asked, listed, ["prefix"], F.xxhash64("key", "url"), "left")
    confirmed = F.filter("candidates", lambda c: c["digest"] == F.col("digest"))
    best = (met.select("key", "url", F.get(confirmed, F.lit(0))["code"].alias("code"), (F.col("expression") == "").cast("long").alias("copies"))
            .groupBy("key", "url").agg(F.max("code").alias("code"), F.sum("copies").alias("copies")))

    host_chars = F.floor(F.pmod("code", F.lit(1 << 32)) / 2).cast("int")
    path_chars = (F.shiftright("code", 32) - host_chars).cast("int")
    rule = F.concat(F.right("host", host_chars), F.left("path", path_chars))
    judged = best.select("key", "url", host.alias("host"), path.alias("path"), "code",
                         F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return judged.select(
        F.col("key").alias(key), F.col("url").alias(url), "host", "path",
        F.when(F.col("code").isNotNull(), rule).alias("rule"),
        F.when(F.col("code") % 2 == 1, "block").when(F.col("code").isNotNull(), "allow").otherwise(DEFAULT_VERDICT).alias("verdict"))
