"""URL verdicts by host rules, then by a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import ascii_lower, query, table

# A block is four 64-bit words; a key sets two bits in each word.
WORDS = 4
BLOCK_BITS = 64 * WORDS
BITS_PER_KEY = 16
# Upper bound of a filter that is sent to all executors; larger ones are joined.
MAX_BROADCAST_BYTES = 8 << 20

# (verdict, host and path)
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def host_of(url: Column) -> Column:
    """From after the first :// up to / ? # or end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From after the host up to ? # or end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ://, null without one."""
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))


def canonical(url: Column) -> Column:
    """One form for the spellings of an address; null without ://.

    Scheme and fragment go, so do a leading "www." or "m." of the host, a port 80
    or 443, "index.html", ".html" and slashes at the end of the path, and the
    query's tracking parameters; the other parameters are sorted.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(/index)?(\.html?)?/*$", "")
    asked = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def _fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, else null."""
    chosen = [F.when(_fits(host, path, r), F.lit(r)) for _, r in sorted(rules, key=lambda x: -len(x[1]))]
    return F.coalesce(*chosen) if chosen else F.lit(None).cast("string")


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its bits in each word."""
    bits = F.xxhash64(F.lit("bits"), key)

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(bits, 6 * i).bitwiseAND(63).cast("int"))

    words = [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]
    return F.pmod(F.xxhash64(key), F.lit(blocks)), words


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter of the column `key`: (block, w0..w3), at most `blocks` rows."""
    block, words = _place(F.col("key"), blocks)
    marked = keys.select(block.alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def listed(
    urls: DataFrame, keys: DataFrame, bits_per_key: int = BITS_PER_KEY, max_broadcast: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Add to `urls` (with a column `key`) the exact boolean `is_listed`.

    The filter passes possible hits; only these meet the list in a hash join, which
    removes the false positives. The filter has a known size: within
    `max_broadcast` bytes it goes to every executor, beyond that the rows are
    joined to it by block. A null key is never listed. `keys` holds distinct,
    non-null keys in a column `key`.
    """
    blocks = max(1, ceil(keys.count() * bits_per_key / BLOCK_BITS))
    bloom = blocked_bloom(keys, blocks)
    if blocks * 8 * (WORDS + 1) <= max_broadcast:
        bloom = F.broadcast(bloom)
    block, words = _place(F.col("key"), blocks)
    probed = urls.withColumn("block", F.when(F.col("key").isNotNull(), block)).join(bloom, "block", "left")
    inside = [F.col(f"w{i}").bitwiseAND(w) == w for i, w in enumerate(words)]
    possible = F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(False))
    probed = probed.withColumn("possible", possible).select(*urls.columns, "possible")
    clear = probed.filter(~F.col("possible")).withColumn("is_listed", F.lit(False))
    marked = keys.select("key", F.lit(True).alias("found"))
    hits = probed.filter("possible").join(marked, "key", "left")
    hits = hits.withColumn("is_listed", F.coalesce("found", F.lit(False)))
    return clear.select(*urls.columns, "is_listed").unionByName(hits.select(*urls.columns, "is_listed"))


def filter_urls(
    pages: DataFrame,
    bad_urls: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    bits_per_key: int = BITS_PER_KEY,
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Judge every row: id, url, host, path, rule, is_listed, verdict.

    The longest rule that fits decides; without one, a URL whose canonical form is
    that of a URL in `bad_urls` is blocked and any other allowed. A rule fits its
    host and all subdomains if the path starts with the rule's path. A null URL or
    one without :// has an empty host and path, fits no rule and is allowed.
    Every row gives one row, repeated rows too; nulls, empty texts and repeats in
    `bad_urls` do not matter; other columns are not read.
    """
    keys = bad_urls.select(canonical(F.col(url_col)).alias("key")).filter("key is not null").distinct()
    url = F.col(url_col)
    urls = pages.select(F.col(id_col), url, host_of(url).alias("host"), path_of(url).alias("path")).select(
        "*", canonical(url).alias("key"), rule_of(F.col("host"), F.col("path"), rules).alias("rule")
    )
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for v, r in rules], F.lit(None).cast("string"))
    by_list = F.when(F.col("is_listed"), F.lit("block")).otherwise("allow")
    return listed(urls, keys, bits_per_key, max_broadcast).select(
        id_col, url_col, "host", "path", "rule", "is_listed", F.coalesce(by_rule, by_list).alias("verdict")
    )


# Host labels whose URLs make up the list of the registered query.
BAD_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def bad_urls(pages: DataFrame) -> DataFrame:
    """URLs of hosts that have a bad label."""
    return pages.filter(F.arrays_overlap(F.split(host_of(F.col("url")), r"\."), F.array(*map(F.lit, BAD_LABELS))))


OP1_SQL = r"""
WITH cut AS (
  SELECT page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS args,
         rest
  FROM cut),
keyed AS (
  SELECT *, CASE WHEN rest IS NOT NULL THEN
      regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '(/index)?(\.html?)?/*$', '')
      || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS key,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
           THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
           THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts),
bad AS (
  SELECT DISTINCT key FROM keyed
  WHERE len(list_intersect(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])) > 0)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN key IN (SELECT key FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM keyed
"""


@query("op1_url_filter", OP1_SQL)
def op1_url_filter(spark, folder):
    """Every page judged by the rules, then by the list of bad hosts' URLs."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, bad_urls(pages), RULES).select("page_id", "host", "path", "rule", "verdict")
