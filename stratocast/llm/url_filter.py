"""URL filters: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The list's canonical URLs are spread over the filter's blocks by hash; each
sets ``PROBES`` bits in one block of 512 bits (eight 64-bit words). A URL that
misses a bit is not listed. The few that pass are possible hits and go to an
exact join on the canonical URL, which removes false positives. Only possible
hits are shuffled for it. The filter itself is a table of at most
``MAX_BLOCKS`` blocks (8 MB), whatever the size of the list, and is broadcast;
a longer list only lets more false positives through to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import opened, sealed

#: (host, path, verdict)
Rule = tuple[str, str, str]

BITS_PER_URL = 16
PROBES = 6
MAX_BLOCKS = 1 << 17
#: Query parameters that don't name another page.
TRACKING = r"utm_[^=]*|ref|gclid|fbclid"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased;
    empty for null or without ://."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return _lower(F.coalesce(after, F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty as for the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last slash, and the query's
    parameters in order without those of tracking; no scheme and no fragment.
    Null if there is no host."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    params = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{TRACKING})(?:=|$)")))
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    name = F.regexp_replace(host(url), r"^www\.", "")
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), "/$", ""), tail))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule (host + path) that fits, and its verdict; null if none
    does. A rule fits its host and all subdomains if the path starts with its."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: str) -> list[Column]:
    """The places 0 to 511 in its block that a URL sets."""
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(511)) for i in range(PROBES)]


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))


def bloom_filter(urls: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w7): the blocks of the filter with any URL, at most ``blocks`` rows."""
    set_ = urls.select(_block(key, blocks).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
    word = lambda i: F.when(F.shiftright("bit", 6) == i, _mask(F.col("bit"))).otherwise(F.lit(0).cast("long"))
    return set_.groupBy("block").agg(*[F.bit_or(word(i)).alias(f"w{i}") for i in range(8)])


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame) -> DataFrame:
    """The rows of ``pages`` (url and any others) with host, path, rule and
    verdict; columns of these names are replaced. ``listed`` (url) is the block
    list.

    verdict is that of the longest fitting rule; else block if the canonical
    URL is listed and allow if not. A null url, or one without ://, has an empty
    host and path, fits no rule and is allowed. Repeated rows stay; repeated,
    null and hostless list entries change nothing; an empty list blocks nothing.
    """
    whole = opened(pages.columns, "url", but=("host", "path", "rule", "verdict"))
    pages = sealed(pages, "url")
    kept = pages.columns
    urls = listed.select(canonical(F.col("url")).alias("url_")).where("url_ is not null").distinct()
    blocks = min(MAX_BLOCKS, max(1, -(-urls.count() * BITS_PER_URL // 512)))
    rows = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("rule_verdict_", verdict).withColumn("url_", canonical(F.col("url")))
    bits = F.broadcast(bloom_filter(urls, "url_", blocks).withColumnRenamed("block", "block_"))
    passes = F.lit(True)
    for bit in _bits("url_"):
        word = F.lit(0).cast("long")
        for i in range(8):
            word = F.when(F.shiftright(bit, 6) == i, F.col(f"w{i}")).otherwise(word)
        passes = passes & (word.bitwiseAND(_mask(bit)) != 0)
    asked = rows.withColumn("block_", F.when(F.col("rule").isNull() & F.col("url_").isNotNull(), _block("url_", blocks)))
    asked = asked.join(bits, "block_", "left").withColumn("possible_", F.coalesce(F.col("w0").isNotNull() & passes, F.lit(False)))
    columns = [F.col(c) for c in (*kept, "host", "path", "rule", "rule_verdict_")]
    sure = asked.where(~F.col("possible_")).select(*columns, F.lit(False).alias("listed_"))
    exact = urls.withColumn("listed_", F.lit(True))
    possible = asked.where("possible_").join(exact, "url_", "left").select(*columns, F.coalesce("listed_", F.lit(False)).alias("listed_"))
    return sure.unionByName(possible).select(
        *whole,
        *[F.col(c) for c in ("host", "path", "rule")],
        F.coalesce("rule_verdict_", F.when(F.col("listed_"), "block").otherwise("allow")).alias("verdict"),
    )
