"""URL verdicts: policy rules, then a list of URLs behind a blocked Bloom filter.

Listed URLs are made canonical (host without a leading ``www.`` or ``m.``,
path without trailing slashes) and hashed into a blocked Bloom filter: 2**k
blocks of 256 bits, eight bits of one block per URL, built by ``bit_or`` over
the blocks. The number of blocks is a parameter, so the filter's size is fixed
(44 bytes a block before overhead) however long the list is, and it can be
broadcast. Pages that miss the filter are certainly unlisted and are done; the
possible hits are joined exactly to the listed URLs, which removes the false
positives. A longer list only sends more pages into the exact join.

Main path: DataFrame functions only.

Defined cases. A null URL or one without ``://`` has an empty host and path, no
rule fits it and it is never listed: verdict ``allow``. Empty and repeated
list entries count once. Rows are judged one by one. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS, PROBES = 4, 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWERED), F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling per page; null without a host."""
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, "/+$", "")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (its text, its verdict); nulls where none fits.

    ``rules``: (verdict, host, path) of a policy, a list short enough to write down.
    """
    text = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # longer rules go on the outside
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def _block(key: Column, log2_blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << log2_blocks) - 1).cast("int")


def _masks(key: Column) -> list[Column]:
    """The four 64-bit words of a URL's eight bits within its block."""
    h = F.xxhash64(key, F.lit("bits"))
    bits = [F.shiftright(h, 8 * i).bitwiseAND(255) for i in range(PROBES)]
    one = F.lit(1).cast("long")
    words = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for b in bits:
            bit = F.call_function("shiftleft", one, b.bitwiseAND(63).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftright(b, 6) == w, bit).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def bloom(keys: DataFrame, key: str, log2_blocks: int) -> DataFrame:
    """The filter as rows ``block, w0..w3``: 2**log2_blocks at most."""
    masked = keys.select(_block(F.col(key), log2_blocks).alias("block"),
                         *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id",
               url: str = "url", listed_url: str = "url", log2_blocks: int = 16,
               exact: bool = True) -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict``. ``exact=False`` leaves
    the filter's possible hits unchecked (to measure its false positives)."""
    host, path = split_url(F.col(url).cast("string"))
    own = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    own = own.select("*", rule.alias("rule"), said.alias("said"),
                     canonical(F.col("host"), F.col("path")).alias("canonical"))
    l_host, l_path = split_url(F.col(listed_url).cast("string"))
    listing = (listed.select(canonical(l_host, l_path).alias("listed")).where("listed IS NOT NULL").distinct())
    filter_ = bloom(listing, "listed", log2_blocks)  # at most 2**log2_blocks rows
    passes = F.lit(True)
    for i, m in enumerate(_masks(F.col("canonical"))):
        passes = passes & (F.col(f"w{i}").bitwiseAND(m) == m)
    probed = (own.join(F.broadcast(filter_), _block(F.col("canonical"), log2_blocks) == F.col("block"), "left")
              .withColumn("possible", F.coalesce(passes, F.lit(False)) & F.col("said").isNull())
              .select("page_id", "host", "path", "rule", "said", "canonical", "possible"))
    out = ["page_id", "host", "path", "rule"]
    done = probed.where("NOT possible").select(*out, F.coalesce("said", F.lit("allow")).alias("verdict"))
    maybe = probed.where("possible")
    if not exact:
        return done.unionByName(maybe.select(*out, F.lit("block").alias("verdict")))
    checked = (maybe.join(listing, F.col("canonical") == F.col("listed"), "left")
               .select(*out, F.when(F.col("listed").isNotNull(), "block").otherwise("allow").alias("verdict")))
    return done.unionByName(checked)
