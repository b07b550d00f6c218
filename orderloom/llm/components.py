"""Connected components of a link table, by alternating large-star and small-star steps.

Links are rows (a, b) of long vertices. Each step is a grouped minimum (combined on the map side)
joined back to the links, so a vertex with very many links is never gathered in one task. Every
round is written to the shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own)


def _tidy(links: DataFrame) -> DataFrame:
    return links.where("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    sums = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), sums).first())


def components(links: DataFrame, n_links: int | None = None) -> DataFrame:
    """(vertex, root): every vertex of `links` with the smallest vertex it reaches.

    Self links, NULL ends, repeated and reversed links change nothing; no links give no rows.
    `n_links` is about how many there are, if that is known.
    """
    current = staged(
        _tidy(links.toDF("u", "v").where("u IS NOT NULL AND v IS NOT NULL")), "links", n_links
    )
    before = _mark(current)
    while before[0]:
        step = _tidy(_small_star(_tidy(_large_star(current))))
        current = staged(step, "links", before[0])
        after = _mark(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(roots)
