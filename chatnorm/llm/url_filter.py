"""URL filter: rules for hosts and paths, and a list of URLs behind a blocked Bloom filter. DataFrame
operations only.

The filter is a table of blocks of eight 32-bit words. A listed canonical URL sets one bit in each word of
one block, so a block is found with one join and tested with eight comparisons. What passes is a possible
hit and goes into an exact join with the list, which takes out the false positives. The filter has a few
bits per listed URL; it and the list are written tables, so the planner broadcasts them when their true
size allows it and shuffles them otherwise.

Defined results: a null URL and one without ``://`` have empty host and path, fit no rule, are not listed
and are allowed. Repeated rows give repeated results, null ids are passed on. With an empty list nothing
is listed. Null entries of the list are left out. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

# The rules, as host and path, and what they say.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# Words of host names whose URLs the list of the query holds.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")

WORDS = 8
BITS_PER_URL = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without a closing ``.html``, ``/index.html`` or slashes."""
    bare = F.regexp_replace(path, r"((/index)?\.html?)?/*$", "")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), bare))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null. Rules are settings, few enough for one expression."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    """The bit that a URL sets in a word of its block."""
    five = F.shiftrightunsigned(F.xxhash64(url, F.lit(1)), 5 * word).bitwiseAND(F.lit(31).cast("long"))
    return F.call_function("shiftleft", F.lit(1).cast("long"), five.cast("int"))


def bloom_blocks(urls: DataFrame, blocks: int) -> DataFrame:
    """``block, w0 .. w7`` of the column ``url``."""
    url = F.col("url")
    keyed = urls.select(_block(url, blocks).alias("block"), *[_bit(url, i).alias(f"w{i}") for i in range(WORDS)])
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(
    pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """``id, host, path, rule, listed, verdict`` of each page; ``listed`` has canonical URLs in ``url``."""
    urls = written(listed.select("url").where("url IS NOT NULL").distinct())
    blocks = max(1, -(-urls.count() * BITS_PER_URL // (32 * WORDS)))
    bloom = written(bloom_blocks(urls, blocks))

    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    parts = parts.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path, own = F.col("host"), F.col("path"), F.col("own")
    parts = parts.select("id", "host", "path", canonical(host, path).alias("own"), fitting_rule(host, path, rules).alias("rule"))
    hit = F.col("w0").isNotNull()
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(_bit(own, i)) == _bit(own, i))
    probed = parts.withColumn("block", _block(own, blocks)).join(bloom, "block", "left")
    probed = written(probed.select("id", "host", "path", "own", "rule", F.coalesce(hit, F.lit(False)).alias("hit")))

    exact = probed.where("hit").join(urls.select(F.col("url").alias("own"), F.lit(True).alias("on_list")), "own", "left")
    rest = probed.where("NOT hit").withColumn("on_list", F.lit(False))
    both = exact.select("id", "host", "path", "rule", F.coalesce("on_list", F.lit(False)).alias("listed")).unionByName(
        rest.select("id", "host", "path", "rule", F.col("on_list").alias("listed"))
    )
    by_rule = F.lit(None).cast("string")
    for rule, says in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(says)).otherwise(by_rule)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return both.withColumn("verdict", F.coalesce(by_rule, by_list)).withColumnRenamed("id", id_col)


def words_on_list() -> str:
    return r"(^|[.-])(" + "|".join(LISTED_WORDS) + r")([.-]|$)"


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """All pages; listed are the URLs of hosts named by a word of the list."""
    pages = table(spark, sf_dir, "pages")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    listed = pages.where(host.rlike(words_on_list())).select(canonical(host, path).alias("url"))
    return judge(pages, listed).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = rf"""
    WITH u AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), c AS (
        SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
                       || regexp_replace(path, '((/index)?\.html?)?/*$', '') END AS own,
               CASE WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
                    THEN 'example.org/en/1'
                    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
                    THEN 'example.org/es/'
                    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
                    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
                    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
        FROM u
    ), l AS (
        SELECT DISTINCT own FROM c WHERE regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)')
    )
    SELECT page_id, host, path, rule,
           CASE rule WHEN 'org/' THEN 'allow' WHEN 'com/fr/' THEN 'allow' WHEN 'com/de/' THEN 'block'
                     WHEN 'example.org/es/' THEN 'block' WHEN 'example.org/en/1' THEN 'block'
                     ELSE CASE WHEN own IN (SELECT own FROM l WHERE own IS NOT NULL) THEN 'block' ELSE 'allow' END
           END AS verdict
    FROM c
"""
