"""SimHash near-duplicates through an inverted index on byte positions.

A fingerprint is eight positional bytes. Two fingerprints within `MOST_BITS` = 2 bits differ in at
most two bytes, so they share at least six positional bytes: the guaranteed minimum of the count
filter. Lists of single bytes would pair up 1/256 of everything, so a list is kept per value of four
positional bytes: the positions form four blocks of two, two differing bytes leave two blocks
whole, and the six pairs of blocks give each fingerprint six lists. Pairs that share a list share
four bytes at least; their shared positional bytes are tallied, pairs below six go, and the rest is
verified by its bit distance over all 64 bits. `filter_counts` tells how many pairs each step leaves.

Pairs are tallied in lists of up to `LONG` members only, so a member meets a bounded number of others.
The members of longer lists are posted again under the 28 combinations of six bytes, which is what the
filter demands: there they agree in six bytes and differ in two, so a list never holds more than
65,536 distinct fingerprints, and its pairs are not enumerated but looked up, each member's free two
bytes at the 136 values within two bits. Nothing is left out: two members of a long list are both
posted again. A spanning forest of the verified links leaves the task, which keeps connectivity and
stays below one row per member.

Only distinct fingerprints enter the index: copies weigh one row, however many there are.

Edge cases: NULL and empty texts have fingerprint zero and are linked like any other. Repeated rows
and repeated ids stay one row each. A NULL id never becomes a component's id unless all ids of the
component are NULL. Empty tables give empty results. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import ASCII_LOWER, staged
from orderloom.llm.components import components
from orderloom.operators.dedup import unused

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
LEAST_SHARED = 8 - MOST_BITS
# The most members of a list whose pairs are tallied.
LONG = 64
_SHINGLES_AT_ONCE = 1 << 16

# The positions a list fixes: two of four blocks.
BLOCKS = [(0, 1), (2, 3), (4, 5), (6, 7)]
LISTED = [a + b for a, b in combinations(BLOCKS, 2)]
# The positions a list of a crowd leaves free, and those it fixes.
FREE = list(combinations(range(8), MOST_BITS))
KEPT = [tuple(p for p in range(8) if p not in free) for free in FREE]
# Differences of at most two bits within the two free bytes.
NEAR = np.array(
    [1 << a for a in range(16)] + [1 << a | 1 << b for a, b in combinations(range(16), 2)],
    dtype=np.int64,
)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles, as an unsigned number."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    lasts = ends[words - 1 :].tolist() or [len(joined)]
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for low in range(0, len(lasts), _SHINGLES_AT_ONCE):
        part = [
            hashed(joined[a:b], SEED)
            for a, b in zip(starts[low:], lasts[low : low + _SHINGLES_AT_ONCE], strict=False)
        ]
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(lasts)).tobytes(), "big")


def fingerprints(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long, Spark's only 64-bit integer."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return of(text)


def _bytes_at(value: Column, positions: tuple[int, ...]) -> Column:
    """The bytes at these positions (0 is the highest), packed into one long."""
    packed = F.lit(0).cast("long")
    for p in positions:
        one = F.shiftrightunsigned(value, 8 * (7 - p)).bitwiseAND(F.lit(255).cast("long"))
        packed = F.shiftleft(packed, 8).bitwiseOR(one)
    return packed


def postings(prints: DataFrame, fixed: list[tuple[int, ...]]) -> DataFrame:
    """(list, fp): each fingerprint in a list per combination of positions; its number sits on top."""
    keys = [
        _bytes_at(F.col("fp"), kept).bitwiseOR(F.lit(number << 8 * len(kept)).cast("long"))
        for number, kept in enumerate(fixed)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("list"), "fp")


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MOST_BITS


def _shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differing = (a ^ b).view(np.uint8).reshape(-1, 8)
    return (differing == 0).sum(axis=1)


def _pairs(lists: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows in one list, as two index arrays per distance; a list's rows are together."""
    x, step = np.arange(len(lists)), 1
    while len(x):
        x = x[x + step < len(lists)]
        x = x[lists[x] == lists[x + step]]
        yield x, x + step
        step += 1


def tallied(lists: np.ndarray, prints: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple]:
    """The verified pairs of short lists, and how many pairs met, reached the minimum, and are near."""
    prints, found, met, reached, near = prints.view(np.uint64), [], 0, 0, 0
    for x, y in _pairs(lists):
        met += len(x)
        enough = _shared_bytes(prints[x], prints[y]) >= LEAST_SHARED
        x, y = x[enough], y[enough]
        reached += len(x)
        verified = _within(prints[x], prints[y])
        found.append((x[verified], y[verified]))
        near += int(verified.sum())
    return found, (met, reached, near)


def looked_up(lists: np.ndarray, prints: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple]:
    """The verified pairs of lists that fix six bytes, all searched side by side, and their number.

    A pair within the 136 differences shares six bytes, so each one that is found reaches the minimum.
    """
    prints, found = prints.view(np.uint64), []
    free = np.array([[8 * (7 - p) for p in pair] for pair in FREE], dtype=np.uint64)
    shifts, byte = free[lists >> 48], np.uint64(255)
    high, low = (prints >> shifts[:, 0]) & byte, (prints >> shifts[:, 1]) & byte
    numbers = np.cumsum(np.r_[0, lists[1:] != lists[:-1]])
    values = numbers << 16 | (high << np.uint64(8) | low).astype(np.int64)
    order = np.argsort(values)
    values = values[order]
    for difference in NEAR:
        wanted = values ^ difference
        at = np.searchsorted(values, wanted)
        at[at == len(values)] = 0
        one = np.flatnonzero((values[at] == wanted) & (wanted > values))
        x, y = order[one], order[at[one]]
        verified = _within(prints[x], prints[y])
        found.append((x[verified], y[verified]))
    n = sum(len(x) for x, _ in found)
    return found, (n, n, n)


def forest(prints: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs, as pairs of fingerprints."""
    parent, kept = list(range(len(prints))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for xs, ys in found:
        for x, y in zip(xs.tolist(), ys.tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[q] = p
                kept.append((int(prints[x]), int(prints[y])))
    return kept


Search = Callable[[np.ndarray, np.ndarray], tuple[list[tuple[np.ndarray, np.ndarray]], tuple]]


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows arrive sorted by list; a list cut by a batch border is carried over. Lone rows go."""
    lists, prints = np.empty(0, np.int64), np.empty(0, np.int64)

    def shared() -> tuple[np.ndarray, np.ndarray]:
        same = np.empty(0, dtype=bool) if len(lists) < 2 else lists[1:] == lists[:-1]
        together = np.r_[False, same] | np.r_[same, False]
        return lists[:cut][together[:cut]], np.ascontiguousarray(prints[:cut][together[:cut]])

    for batch in batches:
        lists = np.concatenate([lists, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy()])
        if len(lists):
            cut = int(np.searchsorted(lists, lists[-1]))
            if cut:
                yield shared()
                lists, prints = lists[cut:], prints[cut:]
    cut = len(lists)
    if cut > 1:
        yield shared()


def _lists(prints: DataFrame) -> list[tuple[DataFrame, Search]]:
    """The short lists and those of the crowds, sorted by list, each with its search."""
    entries = postings(prints, LISTED)
    sizes = entries.groupBy("list").agg(F.count(F.lit(1)).alias("members"))
    long = sizes.where(F.col("members") > LONG).select("list")
    crowded = entries.join(long, "list", "left_semi").select("fp").distinct()
    short = entries.join(long, "list", "left_anti")
    return [
        (short.repartition("list").sortWithinPartitions("list"), tallied),
        (postings(crowded, KEPT).repartition("list").sortWithinPartitions("list"), looked_up),
    ]


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect whatever distinct fingerprints are within two bits."""

    def of(search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for lists, members in _whole_lists(batches):
                kept = forest(members, search(lists, members)[0]) if len(lists) else []
                ends = [pa.array([x[i] for x in kept], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

        return run

    found = [rows.mapInArrow(of(search), "a long, b long") for rows, search in _lists(prints)]
    return reduce(DataFrame.union, found).distinct()


def filter_counts(prints: DataFrame) -> DataFrame:
    """(crowded, met, reached, near), a row per kind of list: how many pairs met in a list, how many of
    them share the least number of bytes, and how many are within two bits. A pair counts per list."""

    def of(crowded: bool, search: Search) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for lists, members in _whole_lists(batches):
                counts = search(lists, members)[1] if len(lists) else (0, 0, 0)
                columns = [pa.array([crowded])] + [pa.array([n], pa.int64()) for n in counts]
                yield pa.RecordBatch.from_arrays(columns, ["crowded", "met", "reached", "near"])

        return run

    schema = "crowded boolean, met long, reached long, near long"
    counted = [
        rows.mapInArrow(of(bool(i), search), schema) for i, (rows, search) in enumerate(_lists(prints))
    ]
    sums = [F.sum(c).alias(c) for c in ("met", "reached", "near")]
    return reduce(DataFrame.union, counted).groupBy("crowded").agg(*sums)


def _rooted(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, copy, fp, root, component_id) per row; `copy` is a hash of the text."""
    text = F.col(text_col)
    own = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("copy"),
            fingerprints(text, words).alias("fp"),
        ),
        "fingerprints",
    )
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct = staged(least, "distinct", own.count())
    # Links beyond a spanning forest are few, so there are about as many as fingerprints at most.
    roots = components(links(distinct.select("fp")), distinct.count())
    rooted = distinct.join(roots, distinct["fp"] == roots["vertex"], "left").select(
        F.col("fp").alias("of"), "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").drop("least")
    return own.join(named, own["fp"] == named["of"]).drop("of")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Rows are linked at 2 or fewer differing bits; `component_id` is the smallest id reachable.
    """
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _rooted(docs, id_col, text_col, words).select("doc_id", digits, "component_id")


def one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """Of each component one row, with all its columns: that with the smallest id.

    Where that id is repeated (or all are NULL), it is the row with the smallest hash of its text.
    """
    found = _rooted(docs, id_col, text_col, words)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
    first = first.agg(F.first("doc_id").alias("_id"), F.min("copy").alias("_copy"))
    copy = F.xxhash64(docs[text_col])
    same = docs[id_col].eqNullSafe(first["_id"]) & (copy == first["_copy"])
    chosen = docs.join(first, same, "left_semi")
    # Only equal rows are left to choose from; the group limit runs before the exchange.
    order = Window.partitionBy(id_col, F.xxhash64(text_col)).orderBy(text_col)
    row = unused("_row", docs.columns)
    ranked = chosen.withColumn(row, F.row_number().over(order)).where(F.col(row) == 1)
    return ranked.select(*docs.columns)
