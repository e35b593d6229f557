"""URL rules and a Bloom filter cascade, in DataFrame operations only.

The cascade decides exactly whether a key of the corpus is on a list. Level 1
is a Bloom filter of the listed keys; the other keys of the corpus that pass
it by chance are encoded in level 2, listed keys that pass level 2 in level 3,
and so on until a level lets nothing wrong through. Every key of the corpus is
tested while the cascade is built, so that afterwards the first level a key
fails decides: an odd level means not listed, an even one listed.

The finished levels are one-row arrays of 64-bit words that Spark hands to the
tasks as scalar subqueries: membership needs no join and no shuffle. Their
size is bounded: above ``SHARD_KEYS`` listed keys the keys are split by hash
into shards with a cascade each, and rows are tested shard by shard, so that
no task holds more than one shard's levels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import common as C

SHARD_KEYS = 2_000_000
LATER_RATE = 1 / 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(rules: list[tuple[str, str]], host, path) -> tuple[Column, Column]:
    """Rule text and its verdict, of the longest rule that fits; null without one.

    A rule ``(verdict, host/path)`` fits its host and all subdomains when the
    path starts with the rule's. The list is configuration: one condition each.
    """
    which = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        which, verdict = F.when(fits, F.lit(text)).otherwise(which), F.when(fits, F.lit(kind)).otherwise(verdict)
    return which, verdict


class Level:
    """One Bloom filter: its bits as a one-row array, and the test for a key column."""

    def __init__(self, keys: DataFrame, count: int, rate: float, seed: int):
        self.seed = seed
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.words = max(1, math.ceil(count * self.hashes / math.log(2) / 64))
        spark = keys.sparkSession
        bits = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
        masks = (bits.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("m"))
                 .groupBy("w").agg(F.bit_or("m").alias("m")))
        dense = spark.range(self.words).join(masks, F.col("id") == F.col("w"), "left").select("id", F.coalesce("m", F.lit(0)).alias("m"))
        row = dense.agg(F.sort_array(F.collect_list(F.struct("id", "m"))).alias("a")).select(F.col("a.m").alias("words"))
        self.bits = C.stored(row, "bloom-level")

    def positions(self, key) -> list[Column]:
        one, two = F.xxhash64(F.lit(self.seed), key), F.xxhash64(F.lit(~self.seed), key)
        size = F.lit(self.words * 64)
        # double hashing; pmod first, so that nothing overflows
        one, two = F.pmod(one, size), F.pmod(two, size)
        return [F.pmod(one + two * j, size) for j in range(self.hashes)]

    def passes(self, key) -> Column:
        words = self.bits.select("words").scalar()
        out = None
        for p in self.positions(key):
            bit = F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0
            out = bit if out is None else out & bit
        return out


def _bit(p: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63).cast("long")).cast("int"))


class Cascade:
    """Exact membership of the corpus's keys in a list."""

    def __init__(self, listed: DataFrame, universe: DataFrame, shard_keys: int = SHARD_KEYS):
        """``listed`` and ``universe``: one column ``key``, repeats and nulls allowed (nulls are never listed)."""
        both = universe.select("key", F.lit(0).alias("on")).union(listed.select("key", F.lit(1).alias("on")))
        keys = C.stored(both.where("key IS NOT NULL").groupBy("key").agg(F.max("on").alias("on")), "url-keys")
        counted = keys.agg(F.coalesce(F.sum("on"), F.lit(0)), F.count(F.lit(1))).head()
        self.shards = max(1, -(-counted[0] // shard_keys))
        self.levels = [self._build(keys.where(self._shard(F.col("key")) == s)) for s in range(self.shards)]

    def _shard(self, key) -> Column:
        return F.pmod(F.xxhash64(F.lit(-7), key), F.lit(self.shards))

    @staticmethod
    def _build(keys: DataFrame) -> list[Level]:
        inside, outside, levels = keys.where("on = 1").select("key"), keys.where("on = 0").select("key"), []
        n, others = inside.count(), outside.count()
        rate = min(LATER_RATE, n / max(1, others) / 2) if n else 1.0
        while n:
            level = Level(inside, n, rate, len(levels) + 1)
            levels.append(level)
            wrong = C.stored(outside.where(level.passes(F.col("key"))), "bloom-wrong")
            inside, outside, n, rate = wrong, inside, wrong.count(), LATER_RATE
        return levels

    def _listed(self, levels: list[Level], key) -> Column:
        out = F.lit(len(levels) % 2 == 1)           # passes all levels
        for i in range(len(levels) - 1, -1, -1):
            out = F.when(levels[i].passes(key), out).otherwise(F.lit(i % 2 == 1))
        return F.coalesce(out, F.lit(False))

    def mark(self, rows: DataFrame, key: str, name: str = "listed") -> DataFrame:
        """``rows`` with a boolean column; a null key is not listed."""
        out = None
        for s, levels in enumerate(self.levels):
            part = rows if self.shards == 1 else rows.where(F.coalesce(self._shard(F.col(key)), F.lit(0)) == s)
            part = part.withColumn(name, self._listed(levels, F.col(key)))
            out = part if out is None else out.union(part)
        return out


def judged(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id",
           url_col: str = "url", shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict, listed: one row per input row.

    The verdict is that of the longest fitting rule; without one, block for a
    listed key (host and path) and allow for others. Null URLs and URLs
    without ``://`` have empty host and path and fit no list or rule. Repeated
    rows are judged alike; other columns are not read.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", F.when(F.col("host") != "", F.concat("host", "path")))
    rows = Cascade(listed, rows.select("key"), shard_keys).mark(rows, "key")
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")
