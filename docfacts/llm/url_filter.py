"""URL rules with a Bloom filter cascade behind them (operator 10).

Rules judge a url first; the longest fitting rule wins. Every other url is
judged by membership of its host in a listed set, held as a cascade of Bloom
filters: level 0 encodes the listed hosts, level 1 those unlisted hosts of the
corpus that pass level 0 by accident, level 2 the listed ones that pass level
1, and so on until no false answer is left for any host of the corpus.
Membership is then exact for the whole key universe without a join.

Edge cases: a null url or one without `://` has host '' and path ''; the empty
host is a key like any other. Empty tables give an empty result. Columns of
the input other than page_id and url are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfacts.llm.shared import ascii_lower, materialize, read

#: (host, path, verdict), as the contract fixes them.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: A cascade whose first level would be larger is cut by the keys' hash into several, used one after the other.
MAX_LEVEL_BYTES = 128 << 20
#: Bits of Spark's bitmap pieces.
PIECE = 32768


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def apply_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Add rule and rule_verdict of the longest fitting rule (null if none fits)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):  # longer ones override
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(1000 * level + j)), F.lit(bits)) for j in range(hashes)]


def _tester(words):
    @F.pandas_udf("boolean")
    def passes(*at: pd.Series) -> pd.Series:
        bits = words.value
        ok = np.ones(len(at[0]), dtype=bool)
        for p in at:
            p = p.to_numpy(dtype=np.int64)
            ok &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return pd.Series(ok)

    return passes


def level_size(n: int, rest: int, first: bool) -> tuple[int, int]:
    """(hashes, bits) of a level of n keys: level 0 lets through about as many of the `rest` others as it holds, later ones half of them."""
    p = min(0.5, max(1e-6, n / max(rest, 1))) if first else 0.5
    hashes = max(1, math.ceil(-math.log2(p)))
    return hashes, max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))


class Cascade:
    """levels: (number of hashes, bits, broadcast bytes); level i encodes listed keys if i is even."""

    def __init__(self, levels: list):
        self.levels = levels

    @classmethod
    def build(cls, keys: DataFrame) -> "Cascade":
        """keys: (key, listed), every key of the universe once. A level's bits are gathered in tasks and collected in pieces of 4 KB."""
        spark = keys.sparkSession
        encoded, other, levels = keys.filter("listed"), keys.filter("NOT listed"), []
        n, rest = encoded.count(), other.count()
        while n:
            hashes, bits = level_size(n, rest, not levels)
            at = lambda: _positions(F.col("key"), len(levels), hashes, bits)  # noqa: B023, E731
            each = encoded.select(F.explode(F.array(*at())).alias("p")).withColumn("p", F.col("p") + 1)
            pieces = each.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("b"))
            filled = np.zeros(-(-bits // PIECE) * PIECE // 8, dtype=np.uint8)
            for r in pieces.collect():  # bits / 32768 rows; the caller bounds the bits
                filled[(r["k"] - 1) * PIECE // 8:][:PIECE // 8] = np.frombuffer(r["b"], dtype=np.uint8)
            sent = spark.sparkContext.broadcast(filled)
            false = materialize(other.filter(_tester(sent)(*at())), f"level{len(levels)}")
            levels.append((hashes, bits, sent))
            encoded, other, rest, n = false, encoded, n, false.count()
        return cls(levels)

    def member(self, df: DataFrame, key: str, out: str) -> DataFrame:
        """Add the boolean column out: whether the key is listed. Exact for every key of the universe that the cascade was built from."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            hashes, bits, words = self.levels[level]
            passed = _tester(words)(*_positions(F.col(key), level, hashes, bits))
            answer = F.when(passed, answer).otherwise(F.lit(level % 2 == 1))
        return df.withColumn(out, answer)

    def release(self) -> None:
        for *_, sent in self.levels:
            sent.destroy()


def members(df: DataFrame, key: str, keys: DataFrame, out: str, max_level_bytes: int = MAX_LEVEL_BYTES) -> DataFrame:
    """df with the boolean column out: whether `key` is listed in keys (key, listed), the whole universe.

    If level 0 of one cascade would be larger than `max_level_bytes`, the keys
    are cut by hash into so many ranges that each has a small cascade; each is
    built, used on its rows and released before the next, so one is held at a time.
    """
    sizes = keys.agg(F.count_if("listed").alias("n"), F.count_if(~F.col("listed")).alias("rest")).first()
    ranges = max(1, -(-level_size(sizes["n"], sizes["rest"], True)[1] // (8 * max_level_bytes)))
    if ranges == 1:
        return Cascade.build(keys).member(df, key, out)
    part = lambda c: F.pmod(F.xxhash64(c, F.lit(-1)), F.lit(ranges))
    df, keys, done = materialize(df, "asked"), materialize(keys, "keys"), None
    for r in range(ranges):
        cascade = Cascade.build(keys.filter(part(F.col("key")) == r))
        own = materialize(cascade.member(df.filter(part(F.col(key)) == r), key, out), f"members{r}")
        cascade.release()
        done = own if done is None else done.unionByName(own)
    return done


def listed_hosts(judged: DataFrame) -> DataFrame:
    """Every host once, listed if rules block more of its pages than they allow."""
    return judged.groupBy(F.col("host").alias("key")).agg(
        (F.count(F.when(F.col("rule_verdict") == "block", 1)) > F.count(F.when(F.col("rule_verdict") == "allow", 1))).alias("listed")
    )


def judge(pages: DataFrame, rules=RULES, max_level_bytes: int = MAX_LEVEL_BYTES) -> DataFrame:
    host, path = split_url(F.col("url"))
    judged = apply_rules(pages.select("page_id", host.alias("host"), path.alias("path")), rules)
    out = members(judged, "host", materialize(listed_hosts(judged), "hosts"), "listed", max_level_bytes)
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


_CASE = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}={v}'"
    for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)
ORACLE = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE {_CASE} END AS hit FROM parts
), split AS (
  SELECT page_id, host, path, CASE WHEN hit IS NULL THEN NULL ELSE string_split(hit, '=')[1] END AS rule, CASE WHEN hit IS NULL THEN NULL ELSE string_split(hit, '=')[2] END AS said FROM ruled
), hosts AS (
  SELECT host, count(*) FILTER (said = 'block') > count(*) FILTER (said = 'allow') AS listed FROM split GROUP BY host
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM split JOIN hosts USING (host)
"""
