"""URL rules by a cascade of Bloom filters, made of built-in functions only.

The listed keys are the rules. The key universe is every key the corpus can ask about: each
combination of a host suffix and a path prefix with as many labels and characters as some rule
has. The first filter holds the listed keys; the next holds those keys of the universe that pass it
without being listed, the next the listed keys that pass that one, and so on until none is left.
On the universe the cascade answers exactly, and a page is judged without a join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits and hash functions for every key of a level; a filter is as large as the list needs.
BITS_PER_KEY = 10
HASHES = 4


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """All keys of a page that could be a rule, the longest first (then the longest host)."""
    labels = F.split(host, "\\.")
    depths = sorted({r.host.count(".") + 1 for r in rules})
    widths = sorted({len(r.path) for r in rules})
    made = [
        F.when(
            (F.size(labels) >= depth) & (F.length(path) >= width),
            F.struct(
                (F.length(F.substring_index(host, ".", -depth)) + width).alias("size"),
                F.lit(depth).alias("depth"),
                F.concat(F.substring_index(host, ".", -depth), F.substring(path, 1, width)).alias("key"),
            ),
        )
        for depth in depths
        for width in widths
    ]
    ordered = F.sort_array(F.array_compact(F.array(*made)), asc=False)
    return F.transform(ordered, lambda c: c["key"])


def _places(key: Column, level: int, bits: int) -> list[Column]:
    first, step = (F.pmod(F.xxhash64(F.lit(2 * level + i), key), F.lit(bits)) for i in range(2))
    return [(first + F.lit(i) * step) % bits for i in range(HASHES)]


def _passes(key: Column, words: Column, level: int, bits: int) -> Column:
    tests = [
        F.get(words, (place / 64).cast("int")).bitwiseAND(
            F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        )
        != 0
        for place in _places(key, level, bits)
    ]
    passed = tests[0]
    for test in tests[1:]:
        passed = passed & test
    return passed


def _filter_of(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row: the filter as an array of 64-bit words."""
    places = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("place"))
    words = places.groupBy((F.col("place") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))).alias("w")
    )
    filled = F.map_from_entries(F.collect_list(F.struct("word", "w")))
    return words.agg(filled.alias("m")).select(
        F.transform(
            F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long"))
        ).alias("words")
    )


class Cascade:
    """Exact membership of the keys of a universe in a list."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        """``listed`` and ``universe``: tables of distinct ``key``. Every level is written once."""
        self.levels: list[tuple[DataFrame, int]] = []
        inside, outside = listed, universe.join(listed, "key", "left_anti")
        number = inside.count()
        while number:
            level = len(self.levels)
            bits = 64 * max(1, math.ceil(number * BITS_PER_KEY / 64))
            words = settle(_filter_of(inside, level, bits), "bloom-level")
            self.levels.append((words, bits))
            # what passes without belonging is what the next level must hold
            passing = outside.withColumn("words", words.scalar()).where(
                _passes(F.col("key"), F.col("words"), level, bits)
            )
            inside, outside = settle(passing.select("key"), "bloom-passing"), inside
            number = inside.count()

    def with_filters(self, df: DataFrame, prefix: str) -> DataFrame:
        """``df`` with the filters as columns, one value each for the whole table."""
        return df.withColumns({f"{prefix}{i}": w.scalar() for i, (w, _) in enumerate(self.levels)})

    def holds(self, key: Column, prefix: str) -> Column:
        """Whether the key is listed: the first level that it fails decides."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            passed = _passes(key, F.col(f"{prefix}{level}"), level, self.levels[level][1])
            answer = F.when(passed, answer).otherwise(F.lit(level % 2 == 1))
        return answer

    def listed_among(self, keys: str, prefix: str) -> Column:
        return F.filter(keys, lambda key: self.holds(key, prefix))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins
    (then the one with the longer host). A url that no rule fits, null, empty and malformed ones included, has a null
    rule and the verdict ``default``: the cascades hold every listed key, so what they reject is not
    listed. ``pages`` needs ``page_id`` and ``url``; other columns are not read. Repeated rows are judged
    each; an empty table gives an empty result. If a key is listed twice the last verdict counts.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return parts.select(
            "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")
        )
    asked = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules))
    universe = settle(asked.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    verdicts = {r.key: r.verdict for r in rules}
    judged = asked
    cascades = {}
    for verdict in sorted(set(verdicts.values())):
        keys = F.array(*[F.lit(k) for k, v in verdicts.items() if v == verdict])
        listed = spark.range(1).select(F.explode(keys).alias("key"))
        cascades[verdict] = Cascade(listed, universe)
        judged = cascades[verdict].with_filters(judged, f"{verdict}_")
    found = judged
    for verdict, cascade in cascades.items():
        found = found.withColumn(f"in_{verdict}", cascade.listed_among("keys", f"{verdict}_"))
    # keys are ordered, so the winner is the listed key that comes first
    listed_keys = F.concat(*[F.col(f"in_{v}") for v in cascades])
    winner = F.get(F.filter("keys", lambda k: F.array_contains(listed_keys, k)), F.lit(0))
    outcome = F.lit(default)
    for verdict in cascades:
        outcome = F.when(F.array_contains(F.col(f"in_{verdict}"), F.col("rule")), F.lit(verdict)).otherwise(outcome)
    return found.withColumn("rule", winner).select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNull(), F.lit(default)).otherwise(outcome).alias("verdict"),
    )
