"""Benchmark decontamination: find a benchmark's word windows in training texts, remove them.

The benchmark's normalised n-grams form a hash set. Every window of every training text is hashed
and tested against a small bitmap of that set inside the scan, without leaving the row; the few
that pass are joined with the broadcast set on hash and words, which verifies them exactly. Texts
are never exploded and never shuffled; what is shuffled are hits.

The bitmap holds 64 bits per benchmark window and at most `MOST_BITS`; the set is broadcast up to
`MOST_BROADCAST` windows and joined by a shuffle beyond. Neither limit changes a result.

Edge cases: NULL and empty texts (of documents or items) have no words, so no windows. An item with
fewer words than a window is one window of its own length. Windows of items with a NULL id are hit
but name no item. Repeated documents are reported once per row, repeated items once. An empty
benchmark hits nothing, an empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.bits import below, bit_array, is_set
from orderloom.llm.common import ascii_lower, staged

WINDOW_WORDS = 10
MOST_BITS = 1 << 26
MOST_BROADCAST = 2_000_000
# After lower-casing: every run without ASCII control, space, punctuation or upper-case characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same in the text as it is, and what lies between; the two alternate.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    found = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _starts(words: Column, length: int) -> Column:
    """The first words of all windows of a length, counted from 1."""
    n = F.size(words)
    return F.when(n >= length, F.sequence(F.lit(1), n - (length - 1))).otherwise(
        F.array().cast("array<int>")
    )


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(h, length, phrase, items): each distinct window once, with the sorted ids it occurs in."""
    own = items.select(
        F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")
    ).where("size(words) > 0")
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    each = own.select("item", "words", length.alias("length"), F.explode(starts).alias("start"))
    part = F.slice("words", F.col("start"), F.col("length"))
    each = each.select("item", "length", part.alias("part"))
    return each.groupBy(
        F.xxhash64("part").alias("h"), "length", F.array_join("part", " ").alias("phrase")
    ).agg(F.sort_array(F.collect_set("item")).alias("items"))


class Bitmap:
    """A Bloom filter with two bits per key."""

    def __init__(self, windows: DataFrame, count: int) -> None:
        self.size = 1 << 12
        while self.size < min(64 * count, MOST_BITS):
            self.size *= 2
        self._longs = bit_array(windows, self._bits(F.col("h")), self.size)

    def _bits(self, h: Column) -> list[Column]:
        return [below(h, self.size), below(F.shiftright(h, 32), self.size)]

    def may_hold(self, h: Column) -> Column:
        one, two = self._bits(h)
        return is_set(self._longs, one) & is_set(self._longs, two)


def _passing(words: Column, length: int, bitmap: Bitmap) -> Column:
    def part(start: Column) -> Column:
        return F.slice(words, start, length)

    hashed = F.transform(
        _starts(words, length), lambda i: F.struct(i.alias("start"), F.xxhash64(part(i)).alias("h"))
    )
    return F.transform(
        F.filter(hashed, lambda w: bitmap.may_hold(w["h"])),
        lambda w: F.struct(
            w["start"].alias("start"),
            F.lit(length).alias("length"),
            w["h"].alias("h"),
            F.array_join(part(w["start"]), " ").alias("phrase"),
        ),
    )


def _candidates(words: Column, lengths: list[int], bitmap: Bitmap) -> Column:
    """The windows that pass the bitmap: first word, length, hash and words."""
    return F.concat(*[_passing(words, length, bitmap) for length in lengths])


def _covered(spans: Column) -> Column:
    """Words inside at least one of the sorted spans (start, stop)."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))

    def add(so_far: Column, span: Column) -> Column:
        new = span["stop"] - F.greatest(so_far["reach"], span["start"])
        return F.struct(
            (so_far["n"] + F.greatest(new, F.lit(0))).alias("n"),
            F.greatest(so_far["reach"], span["stop"]).alias("reach"),
        )

    return F.aggregate(spans, empty, add, lambda so_far: so_far["n"])


def _scan(
    docs: DataFrame,
    items: DataFrame,
    id_col: str,
    text_col: str,
    item_id_col: str,
    item_text_col: str,
    window: int,
) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): per document row its key and word count; per key its spans and items."""
    windows = staged(benchmark_windows(items, item_id_col, item_text_col, window), "windows")
    per_length = {r["length"]: r["count"] for r in windows.groupBy("length").count().collect()}
    count, lengths = sum(per_length.values()), sorted(per_length) or [window]
    text = F.col(text_col)
    own = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("copy"), words_of(text).alias("words")
    )
    scanned = staged(
        own.select(
            "doc_id",
            "copy",
            F.size("words").cast("long").alias("n_words"),
            _candidates(F.col("words"), lengths, Bitmap(windows, count)).alias("found"),
        ),
        "scanned",
    )
    found = scanned.select("doc_id", "copy", F.inline("found"))
    known = windows.drop("length")
    if count <= MOST_BROADCAST:
        known = F.broadcast(known)
    span = F.struct("start", (F.col("start") + F.col("length")).alias("stop"))
    hits = (
        found.join(known, ["h", "phrase"])
        .groupBy("doc_id", "copy")
        .agg(
            F.sort_array(F.collect_set(span)).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    return scanned.select("doc_id", "copy", "n_words"), hits


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["copy"] == b["copy"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """One row per document row: words, hit words, items found and the hit spans in words."""
    rows, hits = _scan(docs, items, id_col, text_col, item_id_col, item_text_col, window)
    joined = rows.join(hits, _same_row(rows, hits), "left")
    names = F.coalesce(hits["items"], F.array().cast("array<string>"))
    n_hit = F.coalesce(_covered(hits["spans"]), F.lit(0)).cast("long")
    return joined.select(
        rows["doc_id"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
    )


def without_documents(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """The rows of `docs` that hold no benchmark window, with all their columns."""
    names = {"id_col": "doc_id", "text_col": "text", "item_id_col": "item_id"}
    names |= {"item_text_col": "text", "window": WINDOW_WORDS} | columns
    _, hits = _scan(docs, items, **names)
    same = docs[names["id_col"]].eqNullSafe(hits["doc_id"])
    same &= F.xxhash64(docs[names["text_col"]]) == hits["copy"]
    return docs.join(hits, same, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, **columns) -> DataFrame:
    """All rows of `docs`; hit words, and what follows each up to the next word, are cut out."""
    names = {"id_col": "doc_id", "text_col": "text", "item_id_col": "item_id"}
    names |= {"item_text_col": "text", "window": WINDOW_WORDS} | columns
    _, hits = _scan(docs, items, **names)
    text = docs[names["text_col"]]
    same = docs[names["id_col"]].eqNullSafe(hits["doc_id"]) & (F.xxhash64(text) == hits["copy"])
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    # Words are the tokens 1, 3, 5 ..., or 2, 4, 6 ... after a leading separator.
    lead = F.when(F.regexp_like(text, F.lit(rf"^({TOKEN.split('|')[1]})")), 1).otherwise(0)

    def stays(token: Column, i: Column) -> Column:
        word = F.floor((i - lead + 2) / 2)
        return ~F.exists(hits["spans"], lambda s: (s["start"] <= word) & (word < s["stop"]))

    rest = F.array_join(F.filter(tokens, stays), "")
    new = F.when(hits["spans"].isNull(), text).otherwise(rest)
    joined = docs.join(hits, same, "left")
    kept = [docs[c] if c != names["text_col"] else new.alias(c) for c in docs.columns]
    return joined.select(*kept)
