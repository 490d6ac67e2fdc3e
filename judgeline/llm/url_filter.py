"""URL filters: rules and host lists behind Bloom filter cascades.

A cascade answers exactly whether a key of a known universe is listed.  Level 0
is a Bloom filter of the listed keys, level 1 one of the unlisted keys that
level 0 lets pass, level 2 one of the listed keys that level 1 lets pass, and so
on until nothing passes wrongly.  The universe is complete: every key that any
url of the corpus can ask for, so no answer can be wrong.  The filters' bits
travel as constants, and urls are judged in one projection, without joins.

Level 0 is sized by the ratio of listed to unlisted keys, so that about as many
unlisted keys pass it as there are listed ones, however large the universe is; the
later levels are then as small as the list.  Of a host only the parent domains with
as many labels as some listed host has are asked for, so a host of very many labels
costs no more than another.

Defined cases: a null url, or one without "://", has an empty host and path, no
rule and the verdict allow; repeated rows are judged one by one; an empty table
gives an empty result.  Other columns than page_id and url are not read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import constant, lower_ascii
from judgeline.session import cut_lineage

LATER_RATE = 1 / 4       # of keys that wrongly pass a level after the first
MAX_FILTER_MB = 8        # a list whose first level exceeds this is answered by joins instead

#: Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Names of unwanted sites, under each of the zones below.
UNWANTED = ("spam-farm", "cheap-pills", "casino-win", "free-bets", "adult-x", "ads-track")
ZONES = ("example.com", "example.net", "example.org")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased.
    Path: from there up to "?", "#" or the end.  Both empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, "^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def n_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def host_suffixes(host: Column, labels: list[int]) -> Column:
    """The host and its parent domains of so many labels, as an array; none for an
    empty host.  ``labels`` are the numbers of labels that listed hosts have."""
    if not labels:
        return F.expr("cast(array() as array<string>)")
    known = F.filter(F.array(*[F.lit(n) for n in labels]), lambda n: (n <= n_labels(host)) & (host != ""))
    return F.transform(known, lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def rule_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every host-and-path key by which a rule could name this url; ``lengths``
    are the lengths that the rules' paths have."""
    if not lengths:
        return F.expr("cast(array() as array<string>)")
    heads = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(host_suffixes(host, labels), lambda s: F.transform(
        heads, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))


def _different(values: DataFrame) -> list[int]:
    """The different numbers of a column, ascending, without null."""
    return sorted(r[0] for r in values.distinct().collect() if r[0] is not None)


def _bit(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits))


class Cascade:
    """Exact membership in ``listed`` (column key) for the keys of ``universe``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_mb: float = MAX_FILTER_MB):
        universe = cut_lineage(universe.select("key").distinct())
        inside = cut_lineage(listed.select("key").distinct().join(universe, "key", "left_semi"))
        outside = universe.join(inside, "key", "left_anti")
        self.listed, self.levels, self.exact = inside, [], True
        level, own, other = 0, inside, outside
        while True:
            n = own.count()
            if n == 0:
                break
            rate = LATER_RATE if level else self.first_rate(n, outside.count())
            hashes = max(1, round(-math.log2(rate)))
            bits = max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)
            if bits > max_mb * 8 * 2**20:
                self.exact = False  # too large to send to every task
                break
            self.levels.append((self._filter(own, level, bits, hashes), bits, hashes))
            own, other = cut_lineage(other.where(self._passes(F.col("key"), level))), own
            level += 1

    @staticmethod
    def first_rate(listed: int, unlisted: int) -> float:
        """Share of the unlisted keys that may pass level 0: with it, some 0.7 times as
        many unlisted keys pass as there are listed ones."""
        return min(LATER_RATE, math.sqrt(1 / 2) * listed / max(1, unlisted))

    @staticmethod
    def _filter(keys: DataFrame, level: int, bits: int, hashes: int) -> Column:
        """The filter's words as a constant array<long>; ``bits`` bounds what
        comes to the driver."""
        at = F.explode(F.array(*[_bit(F.col("key"), level, i, bits) for i in range(hashes)]))
        words = keys.select(at.alias("at")).groupBy((F.col("at") / 64).cast("long").alias("word")) \
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set"))
        out = [0] * (bits // 64)
        for word, set_ in words.collect():
            out[word] = set_
        return constant(out, "array<bigint>")

    def _passes(self, key: Column, level: int) -> Column:
        words, bits, hashes = self.levels[level]
        tests = [F.getbit(F.element_at(words, (F.floor(b / 64) + 1).cast("int")), (b % 64).cast("int")) == 1
                 for b in (_bit(key, level, i, bits) for i in range(hashes))]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed (boolean)."""
        out = None
        for level in reversed(range(len(self.levels))):
            own = self._passes(key, level)
            out = own if out is None else own & ~out
        return F.lit(False) if out is None else out


def judge_urls(pages: DataFrame, rules: DataFrame, unwanted: DataFrame,
               max_mb: float = MAX_FILTER_MB) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block); the longest rule that
    fits gives the verdict.  ``unwanted`` has host: without a rule, a url is
    blocked when its host or a parent domain is listed there.
    """
    host, path = host_and_path(pages["url"])
    urls = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    # the lengths of urls bound how many different lengths and numbers of labels can fit
    lengths = _different(rules.select(F.length("path")))
    labels = _different(rules.select(n_labels(F.col("host"))))
    listed_labels = _different(unwanted.select(n_labels(F.col("host"))))
    rules = rules.select(F.concat(lower_ascii(F.col("host")), "path").alias("key"), "verdict")
    allow, block = rules.where("verdict = 'allow'"), rules.where("verdict = 'block'")
    unwanted = unwanted.select(lower_ascii(F.col("host")).alias("key"))
    keys = rule_keys(F.col("host"), F.col("path"), labels, lengths)
    parents = host_suffixes(F.col("host"), listed_labels)
    asked = urls.select("host", "path").distinct()
    universe = cut_lineage(asked.select(F.explode(keys).alias("key")).distinct())
    hosts = asked.select("host").distinct().select(F.explode(parents).alias("key"))
    sets = [Cascade(allow, universe, max_mb), Cascade(block, universe, max_mb), Cascade(unwanted, hosts, max_mb)]
    if not all(s.exact for s in sets):
        return _by_joins(urls, keys, parents, rules, unwanted)
    urls = urls.withColumn("keys", F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))
    longest = lambda s: F.array_max(F.filter("keys", lambda k: s.has(k["k"])))
    listed = F.exists(parents, sets[2].has)
    d = urls.select("page_id", "host", "path", longest(sets[0]).alias("allow"),
                    longest(sets[1]).alias("block"), listed.alias("listed"))
    best = F.greatest("allow", "block")
    return d.select("page_id", "host", "path", best["k"].alias("rule"),
                    F.when(best.isNull(), F.when(F.col("listed"), "block").otherwise("allow"))
                    .when(best == F.col("allow"), "allow").otherwise("block").alias("verdict"))


def _by_joins(urls: DataFrame, keys: Column, parents: Column, rules: DataFrame, unwanted: DataFrame) -> DataFrame:
    """The same verdicts by shuffle joins, for lists too large for filters."""
    asked = urls.select("host", "path").distinct()
    ruled = asked.select("host", "path", F.explode(keys).alias("key")).join(rules, "key") \
        .groupBy("host", "path").agg(F.max(F.struct(F.length("key"), "key", "verdict")).alias("best"))
    listed = asked.select("host").distinct().select("host", F.explode(parents).alias("key")) \
        .join(unwanted.distinct(), "key", "left_semi").select("host").distinct().withColumn("listed", F.lit(True))
    return urls.join(ruled, ["host", "path"], "left").join(listed, "host", "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))


def fixed_rules(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "host string, path string, verdict string")


def fixed_unwanted(spark) -> DataFrame:
    return spark.createDataFrame([(f"{n}.{z}",) for n in UNWANTED for z in ZONES], "host string")
