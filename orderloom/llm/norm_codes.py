"""Vector codes: product quantisation whose rounds skip comparisons by norm-of-sum bounds.

Vectors are cut into equal parts, each with a codebook of its own, refined by exact Lloyd rounds.
For each part a vector keeps its entry, one lower bound of the distance to every other entry, and
the stamp of the round that computed the bound. The codebooks of all rounds are kept. In a later
round the bound loosens by the largest net displacement of any other entry between the stamped
codebook and the present one: the norm of the summed moves, which is at most the sum of their norms
and, for entries that move back and forth, much less. The distance to the own entry is computed anew
in every round; where it stays below the loosened bound, by a margin, the entry is kept. Where it
does not, all entries are compared exactly, and the bound and its stamp are renewed.

Defined results: rows whose vector is NULL or empty, or holds NULL, NaN or infinity, are left out, as
are rows of another length than the first kept one (by id) whose length the parts divide; repeated rows and
repeated or NULL ids count each for itself (NULL ids last); parts at equal distance get the lower index; entries
without parts stay; equal starting entries stay apart; fewer vectors than entries give as many
entries as vectors; NULL labels are summed together; an empty table gives no rows. Other columns are
ignored. Components must stay below 2**27 once scaled; larger ones raise an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import vector_blocks as blocks
from orderloom.operators.groups import with_group_measures

MARGIN = 1e-9
# Entries are written with two hex digits, rounds stamped with one byte.
MOST_ENTRIES = 256
MOST_ROUNDS = 255

_MOVED = "array<struct<part:int,entry:int,n:long,sums:array<long>>>"
_MOVED_TYPE = pa.struct(
    [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]
)
_STATE = f"entries binary, lower binary, stamps binary, n_scanned long, moved {_MOVED}"
_RESULT = "codes array<string>, errors array<long>, n_scanned long"


def displacement(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """[part, entry]: the largest net move of any *other* entry of the part."""
    moves = np.sqrt(((new - old).astype(np.float64) ** 2).sum(2))
    if moves.shape[1] < 2:
        return np.zeros_like(moves)
    order = np.sort(moves, axis=1)
    first, second = order[:, -1:], order[:, -2:-1]
    return np.where(moves == first, np.where((moves == first).sum(1, keepdims=True) > 1, first, second), first)


def _assigned(vectors: np.ndarray, state: dict | None, history: list[np.ndarray]):
    """Entries before and now, bounds, stamps, own squared distances, parts compared with all."""
    books, now = history[-1], len(history) - 1
    n_parts, n_entries, width = books.shape
    count = len(vectors)
    parts = vectors.reshape(count, n_parts, width)
    shape = (count, n_parts)
    squares = np.zeros(shape, np.int64)
    scanned = 0
    if state is None:
        before = np.full(shape, -1, np.int16)
        entries, lower = np.zeros(shape, np.uint8), np.zeros(shape, np.float32)
        stamps = np.zeros(shape, np.uint8)
    else:
        entries = np.frombuffer(state["entries"], np.uint8).reshape(shape).copy()
        lower = np.frombuffer(state["lower"], np.float32).reshape(shape).copy()
        stamps = np.frombuffer(state["stamps"], np.uint8).reshape(shape).copy()
        before = entries.astype(np.int16)
        # [stamp, part, entry]
        net = np.stack([displacement(book, books) for book in history[:-1]])
    for p in range(n_parts):
        own = parts[:, p, :]
        if state is None:
            doubtful = np.arange(count)
        else:
            squares[:, p] = blocks.squared_own(own, books[p][entries[:, p]])
            bound = lower[:, p].astype(np.float64) - net[stamps[:, p], p, entries[:, p]]
            near = np.sqrt(squares[:, p])
            doubtful = np.flatnonzero(~(near * (1 + MARGIN) + MARGIN < bound))
        if not len(doubtful):
            continue
        scanned += len(doubtful)
        all_squares = blocks.squared_to(own[doubtful], books[p])
        best = all_squares.argmin(1)
        rows = np.arange(len(best))
        entries[doubtful, p] = best
        squares[doubtful, p] = all_squares[rows, best]
        all_squares[rows, best] = np.iinfo(np.int64).max
        others = np.sqrt(all_squares.min(1)) if n_entries > 1 else np.full(len(best), np.inf)
        # Rounded down: a float32 must not exceed the bound it stands for.
        lower[doubtful, p] = np.nextafter(others.astype(np.float32), np.float32(-np.inf))
        stamps[doubtful, p] = now
    return before, entries, lower, stamps, squares, scanned


def _moves(vectors: np.ndarray, before: np.ndarray, entries: np.ndarray, books: np.ndarray) -> pa.Array:
    """Per part and entry: parts and component sums that came less those that went."""
    n_parts, n_entries, width = books.shape
    parts = vectors.reshape(len(vectors), n_parts, width).astype(np.int64)
    rows = []
    for p in range(n_parts):
        changed = np.flatnonzero(before[:, p] != entries[:, p])
        left = changed[before[changed, p] >= 0]
        n = np.zeros(n_entries, np.int64)
        sums = np.zeros((n_entries, width), np.int64)
        for sign, which, at in ((1, changed, entries[changed, p]), (-1, left, before[left, p])):
            np.add.at(n, at, sign)
            np.add.at(sums, at, sign * parts[which, p])
        for entry in np.flatnonzero((n != 0) | (sums != 0).any(1)):
            rows.append({"part": p, "entry": int(entry), "n": int(n[entry]), "sums": sums[entry].tolist()})
    return pa.array([rows], pa.list_(_MOVED_TYPE))


def _round(history: list[np.ndarray]):
    def step(vectors: np.ndarray, state: dict | None) -> dict:
        before, entries, lower, stamps, _, scanned = _assigned(vectors, state, history)
        return {
            "entries": entries.tobytes(),
            "lower": lower.tobytes(),
            "stamps": stamps.tobytes(),
            "n_scanned": scanned,
            "moved": _moves(vectors, before, entries, history[-1]),
        }

    return step


def _last_round(history: list[np.ndarray]):
    def step(vectors: np.ndarray, state: dict | None) -> dict:
        _, entries, _, _, squares, scanned = _assigned(vectors, state, history)
        return {
            "codes": pa.array([[row.tobytes().hex() for row in entries]]),
            "errors": blocks.listed(squares.sum(1)),
            "n_scanned": scanned,
        }

    return step


def _moved_books(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    used = counts > 0
    means = sums // np.where(used, counts, 1)[:, :, None]
    return np.where(used[:, :, None], means, books)


def encode(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    n_parts: int = 16,
    n_entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    watch: list | None = None,
) -> DataFrame:
    """Per vector: its id, code, squared error, its label's error sum, the codebooks' hash.

    `watch` collects how many parts each round had to compare with all entries.
    """
    if not 0 < n_entries <= MOST_ENTRIES or rounds > MOST_ROUNDS:
        raise ValueError(f"at most {MOST_ENTRIES} entries and {MOST_ROUNDS} rounds")
    spark = rows.sparkSession
    size = F.size(vector)
    fits = (size > 0) & (size % n_parts == 0) & blocks.finite(F.col(vector))
    kept = rows.select(id_column, vector, label).where(fits)
    by_id = [F.col(id_column).asc_nulls_last(), F.col(vector)]
    leading = kept.orderBy(*by_id).limit(1).select(size.alias("dim")).first()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if leading is None:
        names = f"`{id_column}` {kinds[id_column]}, code string, error long, label_error long"
        return spark.createDataFrame([], f"{names}, codebooks_sha256 string")
    dim = leading["dim"]
    kept = kept.where(size == dim)
    first = kept.orderBy(*by_id).limit(n_entries).select(vector).collect()
    starts = blocks.to_integers(np.array([row[0] for row in first], np.float64), scale).astype(np.int64)
    books = starts.reshape(len(first), n_parts, -1).transpose(1, 0, 2).copy()

    buckets = blocks.buckets_for(rows, rows.count())
    data = blocks.packed(kept, vector, scale, dim, buckets, id_column, label)
    keeper = blocks.Rounds(data, buckets, dim)
    counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
    history = [books]
    kept_state = ("entries", "lower", "stamps")
    for number in range(rounds):
        state = keeper.advance(_round(history), _STATE, kept_state if number else ())
        # One row per part and entry: bounded by the codebooks.
        totals = [F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(books.shape[2])]]
        for row in state.select(F.inline("moved")).groupBy("part", "entry").agg(*totals).collect():
            counts[row["part"], row["entry"]] += row["n"]
            sums[row["part"], row["entry"]] += np.array(row[3:], np.int64)
        if watch is not None:
            watch.append(state.agg(F.sum("n_scanned")).first()[0])
        history = [*history, _moved_books(history[-1], counts, sums)]

    last = keeper.advance(
        _last_round(history), _RESULT, kept_state if rounds else (), (id_column, label)
    )
    if watch is not None:
        watch.append(last.agg(F.sum("n_scanned")).first()[0])
    listed = F.arrays_zip(
        F.col(id_column), F.col("codes").alias("code"), F.col("errors").alias("error"), F.col(label)
    )
    coded = last.select(F.inline(listed))
    summed = with_group_measures(coded, [label], {"label_error": F.sum("error")})
    digest = F.lit(books_hash(history[-1])).alias("codebooks_sha256")
    return summed.select(id_column, "code", "error", "label_error", digest)


def books_hash(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
