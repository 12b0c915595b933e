"""URL rules by Bloom filter cascades."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phaseloom.llm.common import stored

LATER_BITS = 3  # bits a key in all levels but the first


def host_of(url: Column) -> Column:
    """Host after the first ://, up to / ? # or the end, A-Z in lower case; empty for null or without ://."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All keys that a rule for this url could have: its host or a parent of at most `labels` labels, with a path prefix of one of `lengths`."""
    names = F.split(host, "\\.")
    n = F.size(names)
    counts = F.sequence(F.lit(1), F.least(n, F.lit(labels)))
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.transform(counts, lambda k: F.array_join(F.slice(names, n - k + 1, k), "."))
    )
    sizes = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length(path))
    return F.flatten(F.transform(hosts, lambda h: F.transform(sizes, lambda x: F.concat(h, F.substring(path, F.lit(1), x)))))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key, F.lit(1)).alias("h1"), F.xxhash64(key, F.lit(2)).alias("h2"))


@dataclass(frozen=True)
class Level:
    number: int  # each level hashes in its own way, or what one lets through the next might again
    bits: int
    probes: int
    data: bytes

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words = np.frombuffer(self.data, np.uint8)
        found = np.ones(len(h1), bool)
        for at in _places(h1, h2, self.number, self.bits, self.probes):
            found &= (words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def _places(h1: np.ndarray, h2: np.ndarray, number: int, bits: int, probes: int):
    salt = np.uint64(0x9E3779B97F4A7C15 * (number + 1) & (2**64 - 1))
    a, b = ((h.astype(np.int64).view(np.uint64) ^ salt) * np.uint64(0xBF58476D1CE4E5B9) for h in (h1, h2))
    a, b = a ^ (a >> np.uint64(31)), (b ^ (b >> np.uint64(29))) | np.uint64(1)
    for k in range(probes):
        yield ((a + np.uint64(k) * b) % np.uint64(bits)).astype(np.int64)


def cascade_has(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact for every key of the universe that the cascade was built over: the first level that lacks a key decides."""
    answer = np.full(len(h1), len(levels) % 2 == 1)
    open_ = np.ones(len(h1), bool)
    for k, level in enumerate(levels):
        out = open_ & ~level.has(h1, h2)
        answer[out] = k % 2 == 1
        open_ &= ~out
    return answer


def first_bits(listed: int, others: int) -> int:
    """Bits a key in the first level, such that of the other keys about as many are let through as are listed.

    So all levels together take some 1.44 log2(others / listed) + 8 bits a listed key, however large the universe.
    """
    return max(LATER_BITS, ceil(log2(max(2.0, others / max(1, listed))) / log(2)))


def _encode(keys: DataFrame, number: int, n: int, per_key: int) -> Level:
    """A Bloom filter of n keys (h1, h2): tasks emit the distinct 64-bit words that they set, which are or-ed by place."""
    bits = max(64, n * per_key)
    probes = max(1, round(per_key * 0.7))

    def places(batches):
        for pdf in batches:
            at = np.concatenate(list(_places(pdf["h1"].to_numpy(), pdf["h2"].to_numpy(), number, bits, probes))) if len(pdf) else np.zeros(0, np.int64)
            at = np.unique(at)
            word, value = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else word
            yield pd.DataFrame({"at": word[starts], "v": (np.bitwise_or.reduceat(value, starts) if len(word) else value).astype(np.int64)})

    found = keys.mapInPandas(places, "at long, v long").groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()
    data = np.zeros((bits + 63) // 64, np.int64)
    data[found["at"].to_numpy()] = found["v"].to_numpy()
    return Level(number, bits, probes, data.astype("<i8").tobytes())


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels over listed keys and all keys of the universe (column key, distinct).

    Level 1 holds the listed keys, level 2 the other keys that level 1 lets through, level 3 the listed keys that
    level 2 lets through, and so on until nothing is let through. Only what a level lets through is looked at again.
    No level has many more keys than are listed (first_bits), whatever the size of the universe.
    """
    inside = stored(listed.select("key").distinct().select("key", _hashes(F.col("key")).alias("h")).select("key", "h.*"), "cascade-listed")
    outside = universe.select("key").join(inside.select("key"), "key", "left_anti")
    outside = outside.select("key", _hashes(F.col("key")).alias("h")).select("key", "h.*")
    levels: list[Level] = []
    now, other = inside, outside
    while n := now.count():
        level = _encode(now, len(levels), n, LATER_BITS if levels else first_bits(n, outside.count()))
        levels.append(level)

        def through(batches, level=level):
            for pdf in batches:
                yield pdf[level.has(pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64))]

        now, other = stored(other.mapInPandas(through, other.schema), "cascade-through"), now
    return levels


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page by rules (verdict, host, path), verdicts 'allow' and 'block'.

    A rule fits its host and all subdomains of it where the path starts with the rule's; of several the longest
    (host and path together) wins. Each verdict's rules make one cascade over all keys that any page of the corpus
    could match, so membership is exact and is decided without joins, by two hashes of each candidate key. Pages
    that no key decides get the method's verdict, `default`: they are on no list. What is broadcast are the cascades:
    a few bytes a rule at any number of pages, far less than the list of rules that the caller holds.

    Null urls and those without :// have empty host and path and fit no rule. Repeated rows and page_ids are judged
    each; an empty table gives no rows. Other columns of pages are ignored. One key with both verdicts is an error.
    """
    spark: SparkSession = pages.sparkSession
    by_key = {h + p: v for v, h, p in rules}
    if any(by_key[h + p] != v for v, h, p in rules) or not set(by_key.values()) <= {"allow", "block"}:
        raise ValueError("each rule needs one verdict, allow or block")
    url = F.col("url").cast("string")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labels = max((len(h.split(".")) for _, h, _ in rules), default=1)
    lengths = sorted({len(p) for _, _, p in rules}) or [0]
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = stored(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    cascades: dict[str, list[Level]] = {}
    for verdict in ("allow", "block"):
        listed = spark.createDataFrame([(k,) for k, v in by_key.items() if v == verdict], "key string")
        cascades[verdict] = build_cascade(listed, universe)
    sent = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf(T.ArrayType(T.ByteType()))
    def lists(h1: pd.Series, h2: pd.Series) -> pd.Series:
        sizes = h1.map(len).to_numpy(np.int64)
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (h1, h2))
        code = np.where(cascade_has(sent.value["allow"], a, b), 1, np.where(cascade_has(sent.value["block"], a, b), 2, 0)).astype(np.int8)
        return pd.Series(np.split(code, np.cumsum(sizes)[:-1]) if len(sizes) else [], dtype=object)

    h = lambda seed: F.transform("keys", lambda k: F.xxhash64(k, F.lit(seed)))
    found = keyed.withColumn("codes", lists(h(1), h(2)))
    hits = F.filter(F.arrays_zip("keys", "codes"), lambda x: x["codes"] > 0)
    best = F.aggregate(
        hits,
        F.struct(F.lit(None).cast("string").alias("keys"), F.lit(0).cast("tinyint").alias("codes")),
        lambda acc, x: F.when(acc["keys"].isNull() | (F.length(x["keys"]) > F.length(acc["keys"])), x).otherwise(acc),
    )
    verdict = F.when(F.col("best.codes") == 1, "allow").when(F.col("best.codes") == 2, "block").otherwise(default)
    return found.withColumn("best", best).select("page_id", "host", "path", F.col("best.keys").alias("rule"), verdict.alias("verdict"))

