"""URL filters: a blocked Bloom filter passes possible hits on to an exact hash join with the list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, noted, table

#: bits set for a key in each of the four 64-bit words of its block
BITS_PER_WORD = 2
#: listed keys for each 256-bit block; with 8 bits a key about one absent key in a thousand passes
KEYS_PER_BLOCK = 16
#: blocks at most: 16 MB of bits, which every task may be sent. A list of over 8 million keys fills them further, so
#: that more false hits reach the exact join
MOST_BLOCKS = 2**19

RULES = [  # fixed values: host, path, verdict
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _until(text: Column, marks: str) -> Column:
    """The part of ``text`` before the first of the given marks."""
    return reduce(lambda left, mark: F.substring_index(left, mark, 1), marks, text)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a text without ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = _until(rest, "/?#")
    path = _until(F.substr(rest, F.char_length(host) + 1), "?#")
    return F.translate(host, UPPER, LOWER), path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks))


def _word(key: Column, word: int) -> Column:
    """The bits of a key in one word of its block."""
    picks = [F.pmod(F.xxhash64(key, F.lit(1 + word * BITS_PER_WORD + b)), F.lit(64)).cast("int")
             for b in range(BITS_PER_WORD)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in picks])


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocks that hold a key: block, w0..w3. Words are or-ed where the keys lie, then by block."""
    return keys.groupBy(_block(F.col(key), blocks).alias("bloom_block")).agg(
        *[F.bit_or(_word(F.col(key), w)).alias(f"w{w}") for w in range(4)])


def possible_hits(rows: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """Rows whose key may be listed. The filter is sent to the tasks: it has at most MOST_BLOCKS rows."""
    probe = rows.withColumn("bloom_block", _block(F.col(key), blocks))
    seen = [F.col(f"w{w}").bitwiseAND(_word(F.col(key), w)) == _word(F.col(key), w) for w in range(4)]
    joined = probe.join(F.broadcast(filter_blocks), "bloom_block", "inner").where(reduce(lambda a, b: a & b, seen))
    return joined.drop("bloom_block", "w0", "w1", "w2", "w3")


def rule_keys(rules: DataFrame) -> DataFrame:
    """Canonical keys host + path of a rule table (host, path, verdict); of repeated keys block wins."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    return rules.where("verdict in ('allow', 'block')").groupBy(
        host.alias("rule_host"), path.alias("rule_path")).agg(F.max("verdict").alias("rule_verdict")).withColumn(
        "rule_key", F.concat("rule_host", F.lit(" "), "rule_path"))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict.

    A listed key is host + path. It fits a url when its host is the url's host or a parent domain and the
    url's path starts with its path; the longest key wins, of equally long ones that with the longer host. Every url is spelled out as
    its canonical candidates (each parent domain with each leading part of the path whose length the list
    knows); the blocked Bloom filter throws out nearly all of them, an exact join on the key the rest of the
    false ones. A url without a rule gets ``default``.

    Null urls and those without ``://`` have an empty host and path and no rule. Empty tables, repeated rows,
    null or repeated ids are kept as they are; other columns are not read. An empty list gives ``default``.
    """
    listed = noted(rule_keys(rules), "url-rules")
    # the number of different lengths of listed paths is bounded by the longest url
    known = listed.agg(F.count("*"), F.collect_set(F.char_length("rule_path")),
                       F.collect_set(F.size(F.split("rule_host", "[.]")))).first()
    blocks = min(MOST_BLOCKS, max(1, -(-known[0] // KEYS_PER_BLOCK)))
    filter_blocks = noted(bloom_blocks(listed, "rule_key", blocks), "url-bloom")
    host, path = split_url(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    # candidates depend on host and path alone: a page that occurs many times is looked up once
    seen = urls.where("host != ''").select("host", "path").distinct()
    labels = F.split("host", "[.]")
    lengths = F.array(*[F.lit(n) for n in sorted(known[1])]) if known[1] else F.array().cast("array<int>")
    depths = F.array(*[F.lit(n) for n in sorted(known[2])]) if known[2] else F.array().cast("array<int>")
    parents = F.transform(F.filter(depths, lambda n: n <= F.size(labels)),
                          lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    leads = F.transform(F.filter(lengths, lambda n: n <= F.char_length("path")),
                        lambda n: F.substr(F.col("path"), F.lit(1), n))
    candidates = (seen.withColumn("parent", F.explode(parents)).withColumn("lead", F.explode(leads))
                  .withColumn("key", F.concat("parent", F.lit(" "), "lead")))
    hits = possible_hits(candidates, "key", filter_blocks, blocks).join(
        listed, F.col("key") == F.col("rule_key"), "inner")
    # written first and merged, never sent out: its rows grow with the pages, and a page with a great part of all
    # rows can be split in the join
    best = noted(hits.groupBy("host", "path").agg(F.max_by(
        F.struct("rule_host", "rule_path", "rule_verdict"),
        F.struct(F.char_length("rule_key"), F.char_length("rule_host"))).alias("best")), "url-verdicts")
    return urls.join(best.withColumnsRenamed({"host": "hit_host", "path": "hit_path"}).hint("merge"),
                     (F.col("host") == F.col("hit_host")) & (F.col("path") == F.col("hit_path")), "left").select(
        "page_id", "host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter(table(spark, folder, "pages"), rules)


ORACLE = """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, coalesce(rest, '') AS rest, split_part(split_part(split_part(coalesce(rest, ''), '/', 1), '?', 1),
             '#', 1) AS raw_host FROM r),
u AS (SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             split_part(split_part(substr(rest, length(raw_host) + 1), '?', 1), '#', 1) AS path FROM h),
v AS (SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
        THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""
