"""URL rules through a Bloom filter cascade: exact membership without joins.

A rule is a host and a path; it fits the host and its subdomains where the URL's path starts with
the rule's. So the keys a URL can match are its host's last labels followed by its path's first
characters, for the label counts and path lengths that occur in the rules: the key universe.

Level 1 of a cascade encodes the listed keys, level 2 the universe's keys that level 1 lets through
wrongly, level 3 the listed keys that level 2 lets through, and so on until nothing is wrong. The
first level that does not hold a key decides. That is exact for every key of the universe, and the
universe is all keys of all URLs, so the answers hold for the whole table without a join. Level 1 is
sized so that about as many keys pass wrongly as are listed; the later levels then shrink, and the
whole cascade takes some 50 bits per rule, whatever the table's size. One cascade tells the listed
keys, a second one, over the listed keys, which of them block.

Of the rules that fit, the longest (in code points, host and path together) wins; a URL that no rule
fits is allowed: it is not on the list.

Edge cases: a NULL URL, or one without `://`, has an empty host and path; no rule fits it. A rule
listed as both allow and block blocks; repeated rules count once; NULL hosts, paths or verdicts make
no rule. Repeated rows and NULL ids stay. Empty tables and empty lists work. Other columns are never
looked at.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.bits import below, bit_array, is_set
from orderloom.llm.common import ascii_lower, staged

MOST_HASHES = 8
MOST_LEVELS = 64


class Level:
    """A Bloom filter over `count` keys with a given share of wrong passes."""

    def __init__(self, keys: DataFrame, count: int, wrong: float, salt: int) -> None:
        self._hashes = max(1, min(MOST_HASHES, round(-log(wrong) / log(2))))
        self._salt = salt
        bits = -self._hashes * max(count, 1) / log(1 - wrong ** (1 / self._hashes))
        self.size = 64
        while self.size < bits:
            self.size *= 2
        self._longs = bit_array(keys, self._bits(F.col("key")), self.size)

    def _bits(self, key: Column) -> list[Column]:
        return [
            below(F.xxhash64(key, F.lit(self._salt), F.lit(i)), self.size)
            for i in range(self._hashes)
        ]

    def may_hold(self, key: Column) -> Column:
        first, *rest = [is_set(self._longs, bit) for bit in self._bits(key)]
        for bit in rest:
            first = first & bit
        return first


class Cascade:
    """Tells the keys of `listed` from all other keys of `universe`, exactly.

    Both are tables of `key`; `listed` is distinct, `universe` may hold anything.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, n_listed: int, n_universe: int):
        wrong = min(0.5, max(n_listed, 1) / max(n_universe, 1))
        self.levels = [Level(listed, n_listed, wrong, 0)]
        passing = universe.where(self.levels[0].may_hold(F.col("key"))).distinct()
        here, other = listed, staged(passing.join(listed, "key", "left_anti"), "passing")
        left = other.count()
        while left:
            if len(self.levels) == MOST_LEVELS:
                raise RuntimeError("the cascade does not end")
            level = Level(other, left, 0.5, len(self.levels))
            self.levels.append(level)
            here, other = other, here.where(level.may_hold(F.col("key")))
            left = other.count()

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            passes = self.levels[number - 1].may_hold(key)
            answer = F.when(passes, answer).otherwise(F.lit(number % 2 == 0))
        return answer


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def _keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """All keys of a URL that a list with these label counts and path lengths can name."""
    parts = F.split(host, r"\.", -1)
    found = []
    for n in labels:
        start = F.greatest(F.size(parts) - (n - 1), F.lit(1))
        tail = F.when(F.size(parts) >= n, F.array_join(F.slice(parts, start, n), "."))
        for m in lengths:
            found.append(F.when(F.length(path) >= m, F.concat(tail, F.left(path, F.lit(m)))))
    return F.filter(F.array(*found), lambda key: key.isNotNull())


def judged(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row; `rules` has host, path and verdict."""
    valid = rules.where("host <> '' AND path IS NOT NULL AND verdict IN ('allow', 'block')")
    valid = valid.select(
        ascii_lower(F.col("host")).alias("host"), "path", (F.col("verdict") == "block").alias("b")
    )
    keys = valid.groupBy(F.concat("host", "path").alias("key")).agg(F.max("b").alias("blocks"))
    keys = staged(keys, "rules")
    shapes = valid.select(F.size(F.split("host", r"\.", -1)), F.length("path")).distinct().collect()
    labels, lengths = sorted({n for n, _ in shapes}), sorted({m for _, m in shapes})

    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    if not shapes:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    own = _keys(F.col("host"), F.col("path"), labels, lengths)
    universe = parsed.select(F.explode(own).alias("key"))
    n_rules, n_blocking = keys.agg(F.count("*"), F.count_if("blocks")).first()
    n_universe = pages.count() * len(labels) * len(lengths)
    listed = Cascade(keys.select("key"), universe, n_rules, n_universe)
    blocking = Cascade(keys.where("blocks").select("key"), keys.select("key"), n_blocking, n_rules)

    ranked = F.transform(
        F.filter(own, listed.holds),
        lambda key: F.struct(F.length(key).alias("length"), key.alias("key")),
    )
    rule = F.array_max(ranked)["key"]
    found = parsed.withColumn("rule", rule)
    verdict = F.when(blocking.holds(F.col("rule")), "block").otherwise("allow")
    return found.withColumn("verdict", F.when(F.col("rule").isNull(), "allow").otherwise(verdict))
