"""Operator 9: URL filter by a Bloom filter cascade.

The cascade answers "is this host listed?" exactly for every host of the corpus, without a join. Its
key universe is complete: all distinct hosts. Level 1 is a Bloom filter of the listed hosts; level 2
holds the unlisted hosts that level 1 lets through, level 3 the listed ones that level 2 lets
through, and so on until a level lets no wrong key through. A host's first level that rejects it tells
the answer by its parity.

Levels are built by Spark: bit positions come from two 64-bit hashes of the host, and the bits of a
level are OR-ed by word in a pre-aggregated group-by, so a host on a third of all pages is one key.
A filter needs some ten bits a listed host. Keys are split by hash into as many segments as keep
each cascade below ``MAX_BYTES``; every segment is applied in a pass of its own over the pages, so
what a task holds is bounded at every size.

Explicit rules come first: the longest rule whose host is the URL's host or a parent domain and whose path begins
the URL's path. A null URL, or one without ``://``, has an empty host and path. Repeated rows each
get their verdict. Hosts are data, so an empty table or an empty list is fine: nothing is blocked then.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrocal.llm.common import lazily_once, table

MAX_BYTES = 32 << 20
MAX_LEVELS = 64
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: The block list names hosts by these parts of their names.
LISTED_PARTS = ["ads", "adult", "bets", "casino", "pills", "spam"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.withColumn("h1", F.xxhash64("host")).withColumn("h2", F.xxhash64("host", F.lit(1)))


class Level:
    """One Bloom filter; ``has`` works on rows of (h1, h2) as Spark hashed them."""

    def __init__(self, words: np.ndarray, k: int, level: int):
        self.words, self.k, self.level = words, k, level

    def has(self, positions: np.ndarray) -> np.ndarray:
        p = positions.view(np.uint64)
        return ((self.words[(p >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (p & np.uint64(63))) & np.uint64(1)).astype(bool).all(axis=1)


def _mixed(h1: np.ndarray, h2: np.ndarray, k: int, level: int, m: int) -> np.ndarray:
    """int64[n, k] bit positions of keys with hashes h1, h2."""
    from hydrocal.llm.common import mix

    h = mix(h1.view(np.uint64), np.full(len(h1), level, np.uint64))
    step = mix(h2.view(np.uint64), h) | np.uint64(1)
    return ((h[:, None] + np.arange(k, dtype=np.uint64) * step[:, None]) % np.uint64(m)).astype(np.int64)


def _level(keys: DataFrame, n: int, k: int, level: int) -> tuple[Level, int]:
    """A filter of the ``n`` keys with ``k`` bits each, about half of its bits set."""
    m = max(64, int(np.ceil(n * k / np.log(2) / 64)) * 64)

    def positions(batches):
        for b in batches:
            p = _mixed(b.column("h1").to_numpy(), b.column("h2").to_numpy(), k, level, m).ravel()
            word, at = np.unique(p >> 6, return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, at, np.uint64(1) << (p & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits.view(np.int64))], names=["word", "bits"])

    words = np.zeros(m // 64, np.int64)
    got = keys.select("h1", "h2").mapInArrow(positions, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return Level(words, k, level), m


def _through(keys: DataFrame, level: Level, m: int) -> DataFrame:
    """The keys that the filter lets through."""

    def check(batches):
        for b in batches:
            ok = level.has(_mixed(b.column("h1").to_numpy(), b.column("h2").to_numpy(), level.k, level.level, m))
            yield b.filter(pa.array(ok))

    return keys.mapInArrow(check, keys.schema)


Cascade = list[tuple[Level, int]]


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """listed and universe: distinct (h1, h2) rows, the listed ones among the universe."""
    inside = lazily_once(listed, "listed")
    outside = lazily_once(universe.join(inside, ["h1", "h2"], "left_anti"), "unlisted")
    n, rest = inside.count(), outside.count()
    out: Cascade = []
    while n:
        if len(out) == MAX_LEVELS:
            raise ValueError("two hosts with equal 128-bit hashes, one listed and one not")
        # The first level is as selective as the sides' sizes ask for, later ones halve what is left.
        k = max(1, int(np.ceil(np.log2(max(2.0, rest / (n * np.sqrt(0.5))))))) if not out else 1
        level, m = _level(inside, n, k, len(out))
        out.append((level, m))
        wrong = lazily_once(_through(outside, level, m), "through")
        inside, outside, n, rest = wrong, inside, wrong.count(), n
    return out


def blocked(cascade: Cascade, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact for keys of the universe: True for listed ones."""
    answer = np.zeros(len(h1), bool)
    live = np.arange(len(h1))
    for i, (level, m) in enumerate(cascade):
        has = level.has(_mixed(h1[live], h2[live], level.k, level.level, m))
        answer[live[~has]] = i % 2 == 1
        live = live[has]
    answer[live] = len(cascade) % 2 == 1
    return answer


def listed_column(df: DataFrame, listed: DataFrame) -> DataFrame:
    """df with a column ``host`` -> df plus boolean ``listed``. listed: one column ``host``."""
    hashed = _hashed(df)
    universe = lazily_once(hashed.select("h1", "h2").distinct(), "hosts")
    inside = _hashed(listed.select("host").where("host is not null").distinct()).select("h1", "h2").join(universe, ["h1", "h2"], "left_semi")
    segments = max(1, -(-inside.count() * 4 // MAX_BYTES))  # up to 32 bits a listed host
    of = lambda d, g: d.where(F.pmod(F.col("h1"), F.lit(segments)) == g)
    schema = df.withColumn("listed", F.lit(True)).schema

    def part(g: int) -> DataFrame:
        cascade = build(of(inside, g), of(universe, g))

        def ask(batches):
            for b in batches:
                answer = blocked(cascade, b.column("h1").to_numpy(), b.column("h2").to_numpy())
                yield b.drop_columns(["h1", "h2"]).append_column("listed", pa.array(answer, pa.bool_()))

        return of(hashed, g).mapInArrow(ask, schema)

    return reduce(DataFrame.unionByName, map(part, range(segments)))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # longer ones are asked first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    out = listed_column(rows, listed).withColumn("rule", rule)
    return out.withColumn("verdict", F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow"))).select("page_id", "host", "path", "rule", "verdict", "listed")


def op9_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; listed are the hosts with one of ``LISTED_PARTS`` among the parts of their name."""
    pages = table(spark, sf_dir, "pages")
    hosts = pages.select(host(F.col("url")).alias("host")).distinct()
    listed = hosts.where(F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, LISTED_PARTS))))
    return judge(pages, listed)


_RULE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{i}}}" for i, (h, p, v) in reversed(list(enumerate(sorted(RULES, key=lambda r: len(r[0] + r[1])))))
) + " END"
_SORTED = sorted(RULES, key=lambda r: len(r[0] + r[1]))
ORACLE_SQL = f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages
), r AS (
  SELECT *, {_RULE.format(*(f"'{h}{p}'" for h, p, v in _SORTED))} AS rule, {_RULE.format(*(f"'{v}'" for h, p, v in _SORTED))} AS v,
    regexp_matches(host, '(^|[.-])({"|".join(LISTED_PARTS)})([.-]|$)') AS listed FROM p
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed FROM r
"""
