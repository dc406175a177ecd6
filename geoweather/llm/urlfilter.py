"""URL filters: longest matching host/path rule, else a blocked Bloom filter with exact confirmation.

DataFrame functions only.  Canonical form of a URL: lower-cased host without a leading
``www.`` or ``m.`` label, then the path without ``.html`` and trailing slashes; scheme,
query and fragment are dropped.  The filter of the listed canonical URLs is a table of
512-bit blocks (eight longs); a URL's hash names one block and ``PROBES`` bits in it.
Distinct candidate URLs are joined with their block; those with all bits set are joined
exactly with the list, which removes false positives.  The filter is never collected; Spark
broadcasts it only below its own size threshold and shuffles by block otherwise.

Null urls and urls without ``://`` have empty host and path, fit no rule and are allowed.
Repeated rows are judged alike; an empty table or list gives an empty result or no hits;
other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweather.llm.common import stage, table

# (action, host suffix, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Hosts with one of these dash-separated words in a label are listed.
LISTED_WORDS = ("adult", "bets", "casino", "xxx")
BITS_PER_URL = 12
PROBES = 7
BLOCK_BITS = 512
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    short = F.regexp_replace(F.regexp_replace(path, r"/+\z", ""), r"\.html?\z", "")
    return F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""), short)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, action) of the longest rule that fits; nulls if none does.  Ties go to block."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, suffix, prefix in reversed(ordered):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        text = F.when(fits, F.lit(suffix + prefix)).otherwise(text)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return text, action


def _block(url: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(0)), blocks)


def _bits(url: Column) -> Column:
    """PROBES bit positions of 0..511 in the block: 9 bits each of a second hash."""
    h = F.xxhash64(url, F.lit(1))
    return F.array(*[F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)])


def build_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """Frame of (block, words: array of eight longs) and the number of blocks.  ``listed`` has a column ``url``."""
    blocks = max(1, math.ceil(listed.count() * BITS_PER_URL / BLOCK_BITS))
    bits = listed.select(_block(F.col("url"), F.lit(blocks)).alias("block"), F.explode(_bits(F.col("url"))).alias("bit"))
    word = F.shiftrightunsigned("bit", 6)
    one = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    words = [F.coalesce(F.bit_or(F.when(word == i, one)), F.lit(0).cast("long")) for i in range(BLOCK_BITS // 64)]
    return bits.groupBy("block").agg(F.array(*words).alias("words")), blocks


def possible_hits(urls: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``urls`` (column ``url``) whose bits are all set in their block."""
    probes = urls.withColumn("at", _block(F.col("url"), F.lit(blocks)))
    joined = probes.join(filter_blocks, probes["at"] == filter_blocks["block"])
    in_word = lambda b: F.element_at(F.col("words"), (F.shiftrightunsigned(b, 6) + 1).cast("int"))
    test = F.forall(_bits(F.col("url")), lambda b: F.getbit(in_word(b), b.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return joined.where(test).select("url")


def listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct rows of ``urls`` that are in ``listed``: Bloom filter first, then the exact join."""
    filter_blocks, blocks = build_filter(listed)
    possible = possible_hits(urls, stage(filter_blocks, "bloom"), blocks)
    return possible.join(listed.select(F.col("url").alias("on_list")), F.col("url") == F.col("on_list"), "left_semi")


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row; ``listed`` holds canonical URLs (column ``url``)."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("canon", canonical(F.col("host"), F.col("path")))
    rule, action = longest_rule(F.col("host"), F.col("path"), rules)
    p = p.select("page_id", "host", "path", "canon", rule.alias("rule"), action.alias("action"))
    open_urls = p.where(F.col("rule").isNull() & (F.col("host") != "")).select(F.col("canon").alias("url")).distinct()
    hits = stage(listed_hits(open_urls, listed), "url-hits").select(F.col("url").alias("hit"))
    judged = p.join(hits, (p["canon"] == hits["hit"]) & p["rule"].isNull(), "left")
    verdict = F.coalesce("action", F.when(F.col("hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def listed_urls(pages: DataFrame, words=LISTED_WORDS) -> DataFrame:
    """Canonical URLs (distinct, column ``url``) of pages on hosts that carry a listed word."""
    p = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    named = F.col("host").rlike(r"(^|[.-])(" + "|".join(words) + r")([.-]|$)")
    return p.where(named).select(canonical(F.col("host"), F.col("path")).alias("url")).distinct()


def query(spark, sf_dir: str) -> DataFrame:
    """Judge every page's url; the list is drawn from the pages on listed hosts."""
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, stage(listed_urls(pages), "url-list"))


ORACLE_SQL = """
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (
  SELECT *, regexp_replace(host, '^(?:www|m)\\.', '')
            || regexp_replace(regexp_replace(path, '/+\\z', ''), '\\.html?\\z', '') AS canon,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM parts),
listed AS (SELECT DISTINCT canon FROM named WHERE regexp_matches(host, '(^|[.-])(adult|bets|casino|xxx)([.-]|$)'))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN host <> '' AND canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM named
"""
