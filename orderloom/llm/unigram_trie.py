"""Token counts of a unigram tokenizer, by dynamic programming shared along a trie.

A pre-token is a word with the word mark before it. The best segmentation of a prefix depends on the
prefix alone, so pre-tokens are put into a trie whose nodes hold the forward score (the best sum of
piece scores up to there) and its number of pieces. A prefix that many pre-tokens share is scored
once; a new pre-token pays only for the nodes it adds. Its last node is a terminal that stores the
count, and a document is the sum of its terminals.

The trie lives in a task and holds the distinct pre-tokens of that task's texts, so nothing is
shuffled and a lost task is simply run again. It is emptied when it reaches `MOST_NODES`, the
terminals at `MOST_TERMINALS`; a word of more than `LONG_WORD` characters runs through the same
recursion with the last positions only. None of this changes a count.

The vocabulary is a published file's, in its order. That file has merge ranks, not probabilities, so
the pieces are given Zipf's: log p = -log(rank) - log(H). A character outside the vocabulary
costs one piece per UTF-8 byte, each at the lowest probability. Of equal sums the one with fewer
pieces wins.

Edge cases: NULL and empty texts have no pre-token and zero pieces. Repeated rows and NULL ids stay.
An empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_MARK = "▁"
MOST_NODES = 400_000
MOST_TERMINALS = 500_000
TEXTS_AT_ONCE = 2048
LONG_WORD = 1000
COUNTS = "doc_id long, n_pretokens long, n_tokens long, unigram_score double"


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """The log probability of each piece, from the most to the least frequent."""
    whole = log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -log(r) - whole for r, p in enumerate(pieces, 1)}


def vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file, in order."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ordinary = [
        i
        for i in range(model.vocab_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    return [model.id_to_piece(i) for i in ordinary]


class Trie:
    def __init__(self, scores: dict[str, float]) -> None:
        # Every end of a piece: its score if it is a piece itself, else None. What is not here
        # ends no piece, so no longer string with that end is one.
        self._ends: dict[str, float | None] = {}
        for piece in scores:
            for at in range(len(piece)):
                self._ends.setdefault(piece[at:], None)
        self._ends.update(scores)
        self._longest = max(map(len, scores), default=1)
        self._byte = min(scores.values(), default=-1.0)
        self._terminals: dict[bytes, tuple[float, int]] = {b"": (0.0, 0)}
        self._clear()

    def _clear(self) -> None:
        """Node 0 is the empty prefix; a child is found by its parent and character."""
        self._children: dict[tuple[int, str], int] = {}
        self._forward: list[tuple[float, int]] = [(0.0, 0)]

    def _step(self, token: str, end: int, before: list[tuple[float, int]]) -> tuple[float, int]:
        """The forward score and piece count at `end`; `before` ends with position end - 1."""
        ends = self._ends
        last = token[end - 1]
        score = ends.get(last)
        pieces = 1
        if score is None:
            pieces = len(last.encode("utf-8", "surrogatepass"))
            score = pieces * self._byte
        total, count = before[-1]
        best, fewest = total + score, count + pieces
        for start in range(end - 2, -1, -1):
            score = ends.get(token[start:end], 0.0)
            if score is None:
                continue
            if score == 0.0:  # no log probability of a piece is zero
                break
            total, count = before[start - end]
            total += score
            if total > best or (total == best and count + 1 < fewest):
                best, fewest = total, count + 1
        return best, fewest

    def _insert(self, token: str) -> tuple[float, int]:
        node, children, forward = 0, self._children, self._forward
        path = [forward[0]]
        for end, character in enumerate(token, 1):
            child = children.get((node, character))
            if child is None:
                forward.append(self._step(token, end, path))
                child = children[node, character] = len(forward) - 1
            node = child
            path.append(forward[node])
        return forward[node]

    def _long(self, token: str) -> tuple[float, int]:
        path = [(0.0, 0)]
        for end in range(1, len(token) + 1):
            path.append(self._step(token, end, path))
            if len(path) > 4 * self._longest:
                del path[: -self._longest]
        return path[-1]

    def best(self, word: bytes) -> tuple[float, int]:
        """The best score and piece count of the pre-token of a word; none for the empty word."""
        found = self._terminals.get(word)
        if found is None:
            token = WORD_MARK + word.decode("utf-8", "surrogatepass")
            if len(token) > LONG_WORD:
                return self._long(token)
            if len(self._forward) > MOST_NODES:
                self._clear()
            if len(self._terminals) > MOST_TERMINALS:
                self._terminals = {b"": (0.0, 0)}
            found = self._terminals[word] = self._insert(token)
        return found


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum between each two offsets; nothing sums to zero."""
    running = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return running[offsets[1:]] - running[offsets[:-1]]


def token_counts(
    docs: DataFrame, pieces: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The columns of COUNTS per row, for a vocabulary of pieces from most to least frequent."""
    shared = docs.sparkSession.sparkContext.broadcast(zipf_scores(pieces))
    names = [part.split()[0] for part in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                lists = pc.ascii_split_whitespace(part.column(1).fill_null(""))
                words = pc.dictionary_encode(lists.flatten())
                found = [trie.best(w) for w in words.dictionary.cast(pa.binary()).to_pylist()]
                at = words.indices.to_numpy()
                offsets = lists.offsets.to_numpy()
                # The empty word stands where a text begins or ends in white space.
                counts = np.array([n for _, n in found], dtype=np.int64)[at]
                scores = np.array([s for s, _ in found], dtype=np.float64)[at]
                columns = [_sums((counts > 0).astype(np.int64), offsets), _sums(counts, offsets)]
                sums = [float(scores[a:b].sum()) for a, b in zip(offsets, offsets[1:])]
                arrays = [part.column(0), *map(pa.array, columns), pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return own.mapInArrow(run, COUNTS)
