"""URL filtering, native: a blocked Bloom filter of the listed canonical URLs
passes possible hits on to an exact hash join.

A listed entry is a host and a path prefix; its canonical form is the two put
together, like `example.com/en/`. A page's host asks first, with its suffixes at
label borders, which path lengths are listed under each. The page then asks with
the canonical forms of those lengths alone, so that the number of asks follows
what is listed for its host and not the whole list. All of it is DataFrame
expressions; nothing of the list goes to the driver but its number of rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a block, of 32 bits each; every entry sets one bit in each word.
WORDS = 8
#: Bits of the filter for each listed entry.
BITS_PER_ENTRY = 32
#: A filter or list of so many rows at most is broadcast (a row has under 300 bytes); a larger one is shuffled.
BROADCAST_ROWS = 200_000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://` or if null."""
    text = F.coalesce(url, F.lit(""))
    pattern = r"://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, pattern, 2)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rules as a table of literals."""
    rows = [F.struct(*(F.lit(v).cast("string").alias(n) for v, n in zip(r, ("list_verdict", "list_host", "list_path"), strict=True))) for r in rules]
    listed = F.array(*rows).cast("array<struct<list_verdict:string,list_host:string,list_path:string>>")
    return spark.range(1).select(F.inline(listed))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    """The bit that a key sets in a word: five bits of a second hash."""
    hashed = F.xxhash64(key, F.lit(1))
    return F.call_function("shiftleft", F.lit(1), F.shiftright(hashed, 5 * word).bitwiseAND(F.lit(31)).cast("int"))


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block that has a bit set; keys has the column `canonical`."""
    bits = [_bit(F.col("canonical"), i).alias(f"bit{i}") for i in range(WORDS)]
    return keys.select(_block(F.col("canonical"), blocks).alias("block"), *bits).groupBy("block").agg(*(F.bit_or(f"bit{i}").alias(f"word{i}") for i in range(WORDS)))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages (page_id, url).

    rules: list_verdict, list_host, list_path. Of the rules that fit, the
    longest canonical form wins; of rules listed twice, the smaller verdict.
    A page without a rule gets `default`. Null URLs and URLs without `://` have
    empty host and path. Repeated rows stay; other columns aren't read; an
    empty list leaves every page at `default`, and no pages give no rows.
    """
    host, path = host_path(F.col("url"))
    asked = pages.select("page_id", host.alias("host"), path.alias("path"))
    listed = (
        rules.where("list_host is not null and list_path is not null")
        .select(F.concat("list_host", "list_path").alias("canonical"), "list_host", "list_path", "list_verdict")
        .groupBy("canonical", "list_host", "list_path")
        .agg(F.min("list_verdict").alias("list_verdict"))
    )
    entries = listed.count()
    blocks = max(1, entries * BITS_PER_ENTRY // (32 * WORDS))
    bloom = blocked_bloom(listed, blocks)
    near = F.broadcast if entries <= BROADCAST_ROWS else (lambda x: x)

    lengths = listed.groupBy("list_host").agg(F.collect_set(F.length("list_path")).alias("lengths"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    hosts = asked.select("host").distinct().select("host", F.explode(suffixes).alias("ask_host"))
    hosts = hosts.join(near(lengths), F.col("ask_host") == F.col("list_host")).select("host", "ask_host", "lengths")
    asks = (
        asked.select("host", "path")
        .distinct()
        .join(hosts, "host")
        .select("host", "path", "ask_host", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("chars"))
        .select("host", "path", "ask_host", F.expr("left(path, chars)").alias("ask_path"))
        .withColumn("ask", F.concat("ask_host", "ask_path"))
        .withColumn("block", _block(F.col("ask"), blocks))
    )
    passed = F.lit(True)
    for i in range(WORDS):
        bit = _bit(F.col("ask"), i)
        passed = passed & (F.col(f"word{i}").bitwiseAND(bit) == bit)
    maybe = asks.join(near(bloom), "block").where(passed).select("host", "path", "ask_host", "ask_path")
    exact = [F.col("ask_host") == F.col("list_host"), F.col("ask_path") == F.col("list_path")]
    best = (
        maybe.join(near(listed), exact)
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("canonical").alias("n"), F.length("list_host").alias("h"), "canonical", "list_verdict")).alias("best"))
        .select("host", "path", F.col("best.canonical").alias("rule"), F.col("best.list_verdict").alias("list_verdict"))
    )
    return asked.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("list_verdict", F.lit(default)).alias("verdict"))


#: The rules of the query: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def rules_sql(rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    """The query for RULES in DuckDB's SQL."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fit = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in longest]
    rule = " ".join(f"WHEN {c} THEN '{h}{p}'" for c, (_, h, p) in zip(fit, longest, strict=True))
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, (v, _, _) in zip(fit, longest, strict=True))
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS tail FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(tail, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
)
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule, CASE {verdict} ELSE '{default}' END AS verdict FROM split
"""
