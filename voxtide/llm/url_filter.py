"""Operator 3, URL filters: a blocked Bloom filter before an exact hash join.

Two lists are looked up: rules (host and path prefixes with a verdict) and listed
canonical URLs (blocked).  Every URL gives its lookup keys: each suffix of its
host at a dot with each path prefix of a length that occurs among the rules, and
its canonical form.  The lists' keys set one bit in each of the eight 64-bit
words of one block of the filter.  A key passes if its block has all eight bits;
only passing keys are shuffled to the exact hash join with the lists, which
removes false positives.  The filter never outgrows ``most_blocks`` (64 bytes
each): longer lists pass more keys to the join and change no result.  Verdicts
are made once per distinct URL with a hit and joined back to the pages.

Canonical form: host without a leading ``www.`` and without port 80 or 443, path
without closing slashes; scheme, query and fragment dropped.

Defined results: a null URL, or one without ``://``, has empty host and path, no
rule, and is allowed unless the empty URL is listed; repeated pages each get
their row; empty lists allow everything; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
BITS_PER_KEY, WORDS, MOST_BLOCKS = 16, 8, 1 << 15


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    return F.concat(plain, F.regexp_replace(path, "/+$", ""))


def _keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Lookup keys of a URL, distinct: r|host suffix|path prefix and u|canonical."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(path))
    rules = F.flatten(F.transform(suffixes, lambda s: F.transform(fits, lambda n: F.concat(F.lit("r|"), s, F.lit("|"), F.substring(path, F.lit(1), n)))))
    return F.array_distinct(F.concat(rules, F.array(F.concat(F.lit("u|"), canonical(host, path)))))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit of each word: six bits of a second hash each."""
    second = F.xxhash64(key, F.lit("mask"))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def bloom(keys: DataFrame, n: int, most_blocks: int = MOST_BLOCKS) -> tuple[DataFrame, int]:
    """(block, w0..w7) of the blocks with a key, and the number of blocks."""
    blocks = max(1, min(most_blocks, -(-n * BITS_PER_KEY // (64 * WORDS))))
    masks = _masks(F.col("key"))
    rows = keys.select(_block(F.col("key"), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(masks)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS))), blocks


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``pages`` (page_id, url) → page_id, host, path, rule, verdict.

    ``rules``: verdict, host, path; the longest fitting rule (host and path
    together; of equal ones the first by name) wins.  ``listed``: canonical, the
    URLs blocked where no rule fits."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    lists = (rules.select(F.concat(F.lit("r|"), "host", F.lit("|"), "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict").distinct()
             .unionByName(listed.select(F.concat(F.lit("u|"), "canonical").alias("key")).distinct()
                          .select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"))))
    lengths = [r[0] for r in rules.select(F.length("path").alias("n")).distinct().orderBy("n").collect()]
    blocks, n = bloom(lists.select("key"), lists.count(), most_blocks)
    keys = urls.select("host", "path", F.explode(_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
    has = [(F.col(f"w{i}").bitwiseAND(m)) == m for i, m in enumerate(_masks(F.col("key")))]
    passes = has[0]
    for h in has[1:]:
        passes = passes & h
    # at most most_blocks rows of 72 bytes: the filter's size is proven
    possible = (keys.withColumn("block", _block(F.col("key"), n)).join(F.broadcast(blocks), "block").where(passes)
                .select("host", "path", "key").distinct())
    hits = possible.join(lists, "key")
    first = F.min(F.when(F.col("rule").isNotNull(), F.struct((-F.length("rule")).alias("n"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))))
    verdicts = hits.groupBy("host", "path").agg(first.alias("best"))
    found = verdicts.select("host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("block")).alias("verdict"))
    return urls.join(found, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
